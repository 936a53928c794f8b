"""Alignment of the tokens of two tokenizers over the same texts.

Both sides encode the same bytes: a space and the text.  Per batch of documents,
``pandas.merge_asof`` keyed by document gives each token start the other side's
token that covers it (the last one that starts no later).  Every overlapping
pair has one of its two starts inside the other token, so the union of both
directions is all overlaps, a pair with equal starts counted once.  Byte places
where tokens of both sides end cut the tokens into groups.

Side A is a byte-level BPE read from a ``tokenizers`` JSON file, side B a
``sentencepiece`` model; both files are parameters, read by the driver (they are
of fixed size), and travel with the job.

Corpus-wide counts of id pairs: each batch states every different pair once.
Of the pairs that hold at least 1/``HEAVY`` of all links there are at most
``HEAVY``, by arithmetic and whatever the corpus; tasks look these up in an array.
The others meet their counts in a join, where no key holds more than that share.

Defined results: texts that are NULL, empty, or whose tokens do not give back
the bytes (U+2581 in a text, for one) have no tokens and zeros.  Special tokens'
strings inside texts are plain text.  NULL ids and repeated rows each keep their
own row; repeated rows count again in the corpus.  Ties for a B id's highest
count all count as best.  A text is encoded whole, so a task holds the longest
text's tokens (some 60 bytes per byte of text).  An empty table gives an empty
result.
"""

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut, id_text
from starforge.llm.minhash_dedup import portions

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
HEAVY = 100_000         # pairs with at least 1/HEAVY of all links are looked up, not joined

# fixed value: how the byte-level vocabulary splits a text into words
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                     ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
ALIGNED_SQL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
               "codes array<long>, counts array<long>")


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: printable bytes
    for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Side:
    """A tokenizer as its tokens' bytes and ``encode(texts) -> arrays of ids``."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.bytes = np.array([*token_bytes, None], object)[:-1]
        self.encode = encode
        self.size = np.array([len(b) for b in token_bytes], np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes[ids])


def read_byte_bpe(path: str) -> tuple[dict[bytes, int], set[int]]:
    """Token bytes -> id (the ids are in merge order), and the ids of special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["id"] for t in spec["added_tokens"] if t["special"]}
    return {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
            if i not in special}, special


def byte_side(ranks: dict[bytes, int]) -> Side:
    import tiktoken
    bpe = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    token = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        token[i] = b
    return Side(token, lambda texts: [bpe.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts])


def piece_side(model: bytes) -> Side:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    token = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        token.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(token, lambda texts: [np.array(x, np.int64) for x in sp.encode(texts, num_threads=1)])


def covering(doc: np.ndarray, at: np.ndarray, other_doc: np.ndarray, other_at: np.ndarray) -> np.ndarray:
    """For each token start the number of the other side's token that covers it.
    Starts count on through the batch, so they ascend over all documents."""
    left = pd.DataFrame({"at": at, "doc": doc})
    right = pd.DataFrame({"at": other_at, "doc": other_doc, "token": np.arange(len(other_at))})
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy().astype(np.int64)


def flat(ids: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a batch in a row, their documents, and their starts through the batch."""
    n = np.array([len(x) for x in ids], np.int64)
    out = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    width = size[out]
    return out, np.repeat(np.arange(len(ids)), n), np.cumsum(width) - width


def groups_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, signs: dict) -> np.ndarray:
    """Every token's decimal id and the sign after it, group by group, A before B.
    ``cut_a``, ``cut_b``: tokens that begin a group."""
    first_a, first_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    out = np.empty(len(a) + len(b), object)
    last = np.append(cut_a[1:], True)
    out[np.arange(len(a)) + first_b[np.cumsum(cut_a) - 1]] = np.where(last, signs["a_last"][a], signs["a"][a])
    last = np.append(cut_b[1:], True)
    out[np.arange(len(b)) + np.append(first_a, len(a))[np.cumsum(cut_b)]] = np.where(
        last, signs["b_last"][b], signs["b"][b])
    return out


def align_texts(texts: list, a_side: Side, b_side: Side, signs: dict) -> dict:
    """Columns of the alignment of a batch of texts (None: no tokens)."""
    some = [t or "" for t in texts]
    a_ids, b_ids = a_side.encode(some), b_side.encode(some)
    for k, t in enumerate(some):
        raw = b" " + t.encode()
        if not t or a_side.joined(a_ids[k]) != raw or b_side.joined(b_ids[k]) != raw:
            a_ids[k] = b_ids[k] = np.zeros(0, np.int64)
    n = len(some)
    a, a_doc, a_at = flat(a_ids, a_side.size)
    b, b_doc, b_at = flat(b_ids, b_side.size)
    by_a, by_b = covering(a_doc, a_at, b_doc, b_at), covering(b_doc, b_at, a_doc, a_at)
    cut_a, cut_b = b_at[by_a] == a_at, a_at[by_b] == b_at
    more = ~cut_b                               # pairs with equal starts are in the first direction already
    pair_doc = np.concatenate([a_doc, b_doc[more]])
    code = np.concatenate([a * len(b_side.bytes) + b[by_a], a[by_b[more]] * len(b_side.bytes) + b[more]])
    order = np.lexsort((code, pair_doc))
    code, pair_doc = code[order], pair_doc[order]
    new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (pair_doc[1:] != pair_doc[:-1])])[:len(code)])
    words = groups_text(a, b, cut_a, cut_b, signs)
    n_a, n_b = np.bincount(a_doc, minlength=n), np.bincount(b_doc, minlength=n)
    ends = np.cumsum(n_a + n_b)
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(a_doc[cut_a], minlength=n),
            "n_links": np.bincount(pair_doc, minlength=n),
            "groups": ["".join(words[e - k:e])[:-1] for e, k in zip(ends, n_a + n_b)],
            "offsets": np.searchsorted(pair_doc[new], np.arange(n + 1)), "codes": code[new],
            "counts": np.diff(np.append(new, len(code)))}


def _aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """One row per document, and after each batch one with the batch's pairs (row NULL)."""
    ranks, _ = read_byte_bpe(byte_bpe)
    with open(piece_bpe, "rb") as f:
        model = f.read()

    def run(batches):
        from pyspark import TaskContext
        a_side, b_side = byte_side(ranks), piece_side(model)
        ids = [np.array([str(i) for i in range(len(s.bytes))], object) for s in (a_side, b_side)]
        signs = {"a": ids[0] + ",", "a_last": ids[0] + "|", "b": ids[1] + ",", "b_last": ids[1] + ";"}
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in portions(batch):
                got = align_texts(part.column("text").to_pylist(), a_side, b_side, signs)
                n = part.num_rows
                whole, inverse = np.unique(got["codes"], return_inverse=True)
                summed = np.bincount(inverse, got["counts"], len(whole)).astype(np.int64)
                offsets = pa.array(np.append(got["offsets"], len(got["codes"]) + len(whole)), pa.int32())
                none = [None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*range(number, number + n), None], pa.int64()),
                     pa.concat_arrays([part.column("doc_id"), pa.nulls(1, pa.int64())]),
                     *[pa.array([*got[c].tolist(), None], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(got["groups"] + none, pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([got["codes"], whole]), pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([got["counts"], summed]), pa.int64()))],
                    schema=ALIGNED)
                number += n
    size_b = len(piece_side(model).bytes)
    return id_text(docs, id_col, text_col).mapInArrow(run, ALIGNED_SQL), size_b


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (text like ``a1,a2|b1;a3|b2,b3``),
    pairs (array of different overlapping id pairs: a, b, links)."""
    rows, size_b = _aligned(docs, byte_bpe, piece_bpe, id_col, text_col)
    pair = F.transform(F.arrays_zip("codes", "counts"), lambda x: F.struct(
        F.floor(x["codes"] / size_b).cast("int").alias("a"), (x["codes"] % size_b).cast("int").alias("b"),
        x["counts"].alias("links")))
    return rows.filter("row is not null").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups",
                                                 pair.alias("pairs"))


SCORED_SQL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, digest string, "
              "best long, total long, codes array<long>, counts array<long>")


def _look_up(rows: DataFrame, code: np.ndarray, links: np.ndarray, top: np.ndarray) -> DataFrame:
    """Sums over the pairs listed in ``code`` (ascending); the other pairs stay."""
    def run(batches):
        for batch in batches:
            codes, counts = batch.column("codes"), batch.column("counts")
            at = np.asarray(codes.offsets, dtype=np.int64)
            c = codes.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
            n = counts.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            k = np.minimum(np.searchsorted(code, c), max(len(code) - 1, 0))
            hit = code[k] == c if len(code) else np.zeros(len(c), bool)
            total, best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, doc[hit], n[hit] * links[k[hit]])
            np.add.at(best, doc[hit], np.where(top[k[hit]], n[hit], 0))
            offsets = pa.array(np.searchsorted(doc[~hit], np.arange(batch.num_rows + 1)), pa.int32())
            kept = [batch.column(x) for x in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "digest")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(best), pa.array(total),
                 pa.ListArray.from_arrays(offsets, pa.array(c[~hit], pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(n[~hit], pa.int64()))],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "digest", "best", "total", "codes", "counts"])
    return rows.mapInArrow(run, SCORED_SQL)


def alignment_report(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, id_col: str = "doc_id",
                     text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its B id's
    highest count in the corpus), count_sum (the links' counts), groups_sha256."""
    rows, size_b = _aligned(docs, byte_bpe, piece_bpe, id_col, text_col)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    rows = cut(rows.withColumn("digest", digest).drop("groups"), "alignment")

    listed = F.explode(F.arrays_zip("codes", "counts")).alias("x")
    pairs = cut(rows.filter("row is null").select(listed).groupBy(F.col("x.codes").alias("code"))
                .agg(F.sum("x.counts").alias("links")), "pairs")
    b_id = F.col("code") % size_b
    high = pairs.groupBy(b_id.alias("b")).agg(F.max("links").alias("high"))      # a row per B id at most: bounded
    pairs = cut(pairs.join(F.broadcast(high), b_id == F.col("b")).select(
        "code", "links", (F.col("links") == F.col("high")).alias("top")), "pairs")
    all_links = pairs.agg(F.sum("links")).first()[0] or 0
    is_heavy = F.col("links").cast("decimal(38,0)") * heavy >= F.lit(all_links)
    known = pairs.filter(is_heavy).orderBy("code").toPandas()                   # at most ``heavy`` rows

    scored = cut(_look_up(rows.filter("row is not null"), known["code"].to_numpy(np.int64),
                          known["links"].to_numpy(np.int64), known["top"].to_numpy(bool)), "scored")
    light = (scored.select("row", listed).select("row", F.col("x.codes").alias("code"), F.col("x.counts").alias("n"))
             .join(pairs.filter(~is_heavy), "code")
             .groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).alias("light_best"),
                                 F.sum(F.col("n") * F.col("links")).alias("light_total")))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")     # noqa: E731
    return scored.drop("codes", "counts").join(light, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("best", "light_best").alias("n_best"),
        plus("total", "light_total").alias("count_sum"), F.col("digest").alias("groups_sha256"))
