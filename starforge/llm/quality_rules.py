"""Quality rules: a threshold table compiled into one projection.

Every metric is a Spark expression over the text (no user functions), every
rule a row of :data:`RULES`: a name, a metric and its allowed range.  The
table is compiled into boolean columns of the same projection, so adding a
rule adds an expression, never a pass.

Defined results: a NULL or empty text has no words, all counts 0, fails the
base rule (too few words) and is not kept.  Rows are judged one by one:
repeated rows give repeated results, an empty table gives an empty result,
and other columns of the input are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import WHITE, id_text

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the four languages
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as",
           "with", "by", "at", "from", "this", "be", "have", "or", "an", "a", "not"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "des", "im", "ein",
           "eine", "nicht", "auf", "für", "sich"],
    "fr": ["le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "qui", "pour",
           "dans", "par", "sur", "au", "avec"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "para",
           "se", "del", "al", "es", "no"],
}

# (rule, metric, lowest allowed or None, highest allowed or None)
RULES = [
    ("mean_word_chars", "word_chars / n_words", 2.0, 14.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.3),
    ("stop_word_share", "n_stop_words / n_words", 0.02, None),
    ("duplicate_line_share", "n_dup_lines / n_lines", None, 0.5),
    ("longest_word", "longest_word", None, 1000.0),
]


def stop_forms() -> list[str]:
    """Every stop word, also capitalised, alone or before a comma or full stop."""
    words = {f(w) for ws in STOP_WORDS.values() for w in ws for f in (str, str.capitalize)}
    return sorted(w + end for w in words for end in ("", ",", "."))


def _next_to_equal(a: str, key):
    """Elements of the sorted array ``a`` whose key equals a neighbour's."""
    return F.filter(a, lambda x, k: F.coalesce(key(F.get(a, k - 1)) == key(x), F.lit(False))
                    | F.coalesce(key(F.get(a, k + 1)) == key(x), F.lit(False)))


def _metrics(docs: DataFrame) -> DataFrame:
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    df = df.select(
        "doc_id", "t",
        F.filter(F.split("t", WHITE), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    n = F.size("w")
    triple = lambda i: [F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)]
    # 3-word windows as hash (upper half) and start (lower half): a primitive
    # sort puts equal hashes side by side; only those are compared as text
    windows = F.sort_array(F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*triple(i)).bitwiseAND(-(1 << 32)).bitwiseOR(i.cast("long"))))
    df = df.select(
        "doc_id", "w",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: x.isin(stop_forms()))).cast("long").alias("n_stop_words"),
        F.coalesce(F.array_max(F.transform("w", F.length)), F.lit(0)).cast("long").alias("longest_word"),
        windows.alias("h"))
    df = df.withColumn("c", _next_to_equal("h", lambda x: F.shiftright(x, 32)))
    df = df.withColumn("s", F.sort_array(F.transform(
        F.transform("c", lambda x: x.bitwiseAND((1 << 32) - 1).cast("int")),
        lambda i: F.struct(F.concat_ws(" ", *triple(i)).alias("k"), i.alias("i")))))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        _next_to_equal("s", lambda x: x["k"]), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("w", "h", "c", "s")


def compile_rules(rules=RULES) -> list[Column]:
    """One boolean column per row of the table; a metric without a value
    (nothing to divide by) breaks no rule."""
    out = []
    for name, metric, low, high in rules:
        value = F.try_divide(*[F.expr(p).cast("double") for p in metric.split("/")]) \
            if "/" in metric else F.expr(metric).cast("double")
        ok = F.lit(True)
        if low is not None:
            ok = ok & (value >= F.lit(low))
        if high is not None:
            ok = ok & (value <= F.lit(high))
        out.append(F.coalesce(ok, F.lit(True)).alias(f"ok_{name}"))
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules=RULES) -> DataFrame:
    """One row per input row: the metrics, ``base_failed``, ``failed_rules``
    (names, comma-joined) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    m = _metrics(id_text(docs, id_col, text_col)).select("*", base.alias("base_failed"),
                                                         *compile_rules(rules))
    oks = [F.col(f"ok_{r[0]}") for r in rules]
    passed = F.lit(True)
    for ok in oks:
        passed = passed & ok
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(r[0])) for ok, r in zip(oks, rules)])
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "n_lines", "n_stop_words", "longest_word", "base_failed",
                    failed.alias("failed_rules"), (~F.col("base_failed") & passed).alias("kept"))


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in stop_forms())
    checks, names = [], []
    for name, metric, low, high in RULES:
        v = "CAST({} AS DOUBLE) / nullif({}, 0)".format(*metric.split(" / ")) if "/" in metric else metric
        terms = [f"({v}) >= {low}"] * (low is not None) + [f"({v}) <= {high}"] * (high is not None)
        checks.append(f"coalesce({' AND '.join(terms)}, true)")
        names.append(f"CASE WHEN NOT coalesce({' AND '.join(terms)}, true) THEN '{name}' END")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c >= 2),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
             len(ls) AS n_lines,
             len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
             coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word
      FROM d JOIN w USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_stop_words AS BIGINT) AS n_stop_words, CAST(longest_word AS BIGINT) AS longest_word, base_failed,
       concat_ws(',', {', '.join(names)}) AS failed_rules,
       NOT base_failed AND {' AND '.join(checks)} AS kept FROM b
"""
