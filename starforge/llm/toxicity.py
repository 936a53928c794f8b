"""Toxicity: weighted lexicon, matched by Aho-Corasick on folded text.

* *Folding*: lower case, accents dropped, look-alike letters of other scripts
  and digits or signs used as letters mapped to plain letters; what is left
  between letters becomes one space.
* *Lexicon*: learned from a bounded sample of labelled documents: words and
  word beginnings whose document frequency among toxic documents is above that
  among clean ones: the lower confidence bound of the log odds, ``MIN_ODDS``
  at least and ``MIN_SHARE`` of the strongest pattern's, is its weight.  A
  pattern whose beginning is in the lexicon already is left out.
* *Matching*: one Aho-Corasick automaton over the folded text.  Exception
  phrases (harmless uses and, learned, whole words that hold a pattern but are
  common in clean text) are patterns of the same automaton; matches inside an
  exception do not count.
* *Score*: a logistic model over the weight matched, in all and per word,
  fitted on the same sample.

Work on the corpus: one scan with the automaton broadcast (its size is bounded
by the sample).  Defined results: NULL or empty text has no match and gets the
score of a text without matches; NULL labels are ignored, a document labelled
twice counts as toxic if any label says so; without labelled rows of both
classes the lexicon is empty and every score is 0.  Rows are scored one by one
(repeated rows repeat their score); a very long text takes time and memory linear
in its length.
"""

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut, held_out, id_text

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000     # labelled documents learned from, at most
MIN_DOCS, MIN_ODDS, MIN_SHARE = 5, 1.5, 0.4
STEM_LENGTHS = range(4, 9)
THRESHOLD = 0.3

# Letters of other scripts that look like Latin ones
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q",
    "ԝ": "w", "һ": "h", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v",
    "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ß": "ss", "æ": "ae", "œ": "oe",
}
# Digits and signs used as letters
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "l"}
# Harmless uses of words that lexicons hold
EXCEPTIONS = ["trash can", "clown fish", "scum line", "hash table"]


def fold_table() -> dict[int, str]:
    """Code point -> plain letters, for accents and width forms by Unicode
    decomposition, then the fixed tables."""
    table = {}
    for cp in [*range(0x80, 0x250), *range(0x300, 0x370), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        ch = chr(cp).lower()
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if plain != ch:
            table[cp] = "".join(SUBSTITUTES.get(c, c) for c in plain)
    for k, v in {**HOMOGLYPHS, **SUBSTITUTES}.items():
        table[ord(k)] = v
    return table


def folder():
    """The folding function; words of the result are separated by one space,
    with a space at both ends."""
    table, gaps = fold_table(), re.compile(r"[^a-z]+")
    # a sign stands for a letter only alone and right before a word character
    signs = re.compile(r"[@$!|]{2,}|[@$!|](?!\w)")

    def fold(text: str | None) -> str:
        plain = signs.sub(" ", text or "").lower().translate(table)
        return " " + gaps.sub(" ", plain).strip() + " "
    return fold


def doc_patterns(folded: str) -> set[str]:
    """Whole words (" word ") and beginnings (" wor") of a folded text."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEM_LENGTHS if n <= len(w))
    return out


def choose_lexicon(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> tuple[dict, list]:
    """Weights of the chosen patterns, and learned exceptions, from the
    document frequencies ``pos`` and ``neg`` of patterns."""
    pos, neg = counts["pos"] + 0.5, counts["neg"] + 0.5
    odds = np.log(pos / (n_toxic + 1)) - np.log(neg / (n_clean + 1))
    counts = counts.assign(odds=odds, sure=odds - 1.64 * np.sqrt(1 / pos + 1 / neg))
    good = counts[(counts["pos"] >= MIN_DOCS) & (counts["sure"] >= max(MIN_ODDS, MIN_SHARE * counts["sure"].max()))]
    lexicon: dict[str, float] = {}
    for p, o in sorted(zip(good["pattern"], good["sure"]), key=lambda x: (len(x[0].rstrip()), x[0])):
        body = p.rstrip()
        if not any(body[:n] in lexicon for n in range(5, len(body) + 1)):
            lexicon[p] = float(o)
    stems = [p for p in lexicon if not p.endswith(" ")]
    plain = counts[(counts["odds"] < 0) & (counts["neg"] >= MIN_DOCS) & counts["pattern"].str.endswith(" ")]
    learned = [p for p in plain["pattern"] if any(p.startswith(s) for s in stems)]
    return lexicon, learned


def automaton(lexicon: dict, exceptions: list):
    import ahocorasick
    a = ahocorasick.Automaton()
    for p, w in lexicon.items():
        a.add_word(p, (len(p), w))
    for p in exceptions:
        if p not in lexicon:
            a.add_word(p, (len(p), None))
    if len(a):
        a.make_automaton()
    return a


def match(a, folded: str) -> tuple[float, int, int]:
    """(weight, matches, different patterns) outside exceptions."""
    hits, shield = [], []
    if len(a):
        for end, (n, w) in a.iter(folded):
            (hits if w is not None else shield).append((end - n + 1, end, w))
    if shield:      # both come in order of their ends: one sweep
        first = [s for s, _, _ in shield]       # smallest start of this exception and the later ones
        for k in range(len(first) - 2, -1, -1):
            first[k] = min(first[k], first[k + 1])
        k, free = 0, []
        for h in hits:
            while k < len(shield) and shield[k][1] < h[1]:
                k += 1
            if k == len(shield) or first[k] > h[0]:
                free.append(h)
        hits = free
    return sum(h[2] for h in hits), len(hits), len({folded[h[0]:h[1] + 1] for h in hits})


def features(weight, n_hits, n_distinct, n_words) -> np.ndarray:
    w = np.asarray(weight, float)
    words = np.asarray(n_words, float)
    return np.column_stack([np.ones(len(w)), w > 0, np.log1p(w), np.log1p(100 * w / (words + 20)),
                            np.log1p(np.asarray(n_distinct, float))])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """(text, y) of at most SAMPLE_TOXIC + SAMPLE_CLEAN documents whose labels
    may be learned from, drawn by a hash of the id."""
    lab = (labels.select(labels["doc_id"].cast("long").alias("doc_id"),
                         (labels[label_col] > 0).cast("int").alias("y"))
           .filter(F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    draw = [lab.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
            for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    chosen = draw[0].unionByName(draw[1])       # at most 12,000 ids: safe to broadcast
    return docs.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("y").alias("y"))


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon, exceptions and logistic weights from the labelled sample."""
    sample = cut(labelled_sample(docs, labels), "toxicity-sample").repartition(8)
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return {"lexicon": {}, "exceptions": [], "weights": None}

    def count(batches):
        fold = folder()
        pos, neg = Counter(), Counter()
        for b in batches:
            for text, y in zip(b["text"], b["y"]):
                (pos if y else neg).update(doc_patterns(fold(text)))
        keys = [*pos, *(k for k in neg if k not in pos)]    # all: rare ones may add up over the tasks
        yield pd.DataFrame({"pattern": keys, "pos": [pos[k] for k in keys], "neg": [neg[k] for k in keys]})

    counts = (sample.mapInPandas(count, "pattern string, pos long, neg long")
              .groupBy("pattern").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
              .filter((F.col("pos") >= MIN_DOCS) | (F.col("neg") >= MIN_DOCS)))
    strong = counts.filter(f"(pos + 0.5) / {n[1] + 1} > exp({MIN_ODDS}) * (neg + 0.5) / {n[0] + 1}").toPandas()
    lexicon, _ = choose_lexicon(strong, n[1], n[0])
    stems = [p for p in lexicon if not p.endswith(" ")]
    learned = []
    if stems:       # clean whole words that begin with a stem of the lexicon
        words = counts.filter((F.substring("pattern", -1, 1) == " ")
                              & F.substring("pattern", 1, 5).isin([s[:5] for s in stems])).toPandas()
        _, learned = choose_lexicon(pd.concat([strong, words]).drop_duplicates("pattern"), n[1], n[0])
    model = {"lexicon": lexicon, "exceptions": [*(f" {e} " for e in EXCEPTIONS), *learned]}
    x = (sample.select("y", match_udf(model)("text").alias("m")).select("y", "m.*")).toPandas()
    model["weights"] = fit_logistic(features(x["weight"], x["n_hits"], x["n_distinct"], x["n_words"]),
                                    x["y"].to_numpy(float))
    return model


def match_udf(model: dict):
    """Text -> weight, n_hits, n_distinct, n_words."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fold, a = folder(), automaton(model["lexicon"], model["exceptions"])
        for texts in batches:
            rows = []
            for text in texts:
                folded = fold(text)
                rows.append((*match(a, folded), folded.count(" ") - 1 if len(folded) > 2 else 0))
            yield pd.DataFrame(rows, columns=["weight", "n_hits", "n_distinct", "n_words"]).astype(
                {"weight": float, "n_hits": "int64", "n_distinct": "int64", "n_words": "int64"})
    return F.pandas_udf(run, "weight double, n_hits long, n_distinct long, n_words long")


def score_of(m: str, weights) -> Column:
    """The logistic score of a match struct column."""
    if weights is None:
        return F.lit(0.0)
    terms = [F.lit(1.0), (F.col(f"{m}.weight") > 0).cast("double"), F.log1p(f"{m}.weight"),
             F.log1p(100 * F.col(f"{m}.weight") / (F.col(f"{m}.n_words") + 20)), F.log1p(f"{m}.n_distinct")]
    z = F.lit(0.0)
    for b, t in zip(weights, terms):
        z = z + F.lit(float(b)) * t
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             model: dict | None = None) -> DataFrame:
    """Score of every row: doc_id, held_out, score, predicted, weight, n_hits,
    n_words."""
    d = id_text(docs, id_col, text_col)
    model = model or learn(d, labels)
    out = d.select("doc_id", match_udf(model)("text").alias("m"))
    out = out.select("doc_id", "m", score_of("m", model["weights"]).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      "m.weight", "m.n_hits", "m.n_words")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, all columns."""
    model = learn(id_text(docs), labels)
    m = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                    match_udf(model)(docs["text"].cast("string")).alias("m"))
    return m.filter(score_of("m", model["weights"]) < THRESHOLD).select("row.*")
