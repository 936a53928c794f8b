"""Substring dedup with fixed-block anchors.

A window of ``WINDOW`` words that occurs twice holds, in its first occurrence,
a whole block of the non-overlapping grid of ``WINDOW / 2`` words; so every
repeat is found by probing the index of grid blocks with every rolling block:

1. Every chunk of texts states its different rolling blocks, marking those that
   stand on its grid (the index); a bucket of hashes tells which occur in
   several chunks and on a grid.
2. A hit is extended to every window around it.  Each chunk states its
   different windows once, with 96-bit fingerprints, the first place of each
   (smallest doc_id, then start); buckets of fingerprints find the first of all.
3. Windows that are not the first merge into maximal repeated runs; their words
   are removed.

Nothing larger than a chunk or a bucket is held in a task, and a passage common
to many documents is stated once per chunk.  Windows are judged on the input.

Defined results: NULL and empty texts have no words and lose none; a text under
``WINDOW`` words loses none; rows with a NULL id come after all others; rows
that share an id count as one document, each with its own starts, so a repeated
row loses nothing to its twin.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.passages import (Chunk, ENTRIES_SQL, bucket_of, cover, entries_table,
                                      find_repeats, marks_of, mixed, n_buckets, pack, result_schema,
                                      result_table, runs, state_codes, with_chunks)

WINDOW = 20
HOT = 1 << 30               # blocks need no other treatment however common
MULTIPLIERS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)


class Words:
    """Words of a chunk's texts: where they are, whose they are, hashes."""

    def __init__(self, c: Chunk):
        b = c.bytes
        word = ~((b == 32) | ((b >= 9) & (b <= 13)))
        before = np.concatenate([[False], word[:-1]]) if len(b) else word
        first = np.zeros(len(b) + 1, bool)
        first[c.starts] = True                      # a text's first byte starts a word
        start = word & (~before | first[:-1])
        self.start = np.flatnonzero(start)
        n = np.add.reduceat(word, self.start, dtype=np.int64) if len(self.start) else np.zeros(0, np.int64)
        self.end = self.start + n                   # bytes of a word are consecutive
        self.doc = np.searchsorted(c.ends, self.start, side="right")
        self.n_words = np.bincount(self.doc, minlength=len(c.ids)) if len(c.ids) else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)[:-1]]).astype(np.int64) \
            if len(c.ids) else np.zeros(0, np.int64)
        self.place = np.arange(len(self.start)) - self.first[self.doc]      # in its text
        self._b, self._word = b, word

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        m = np.uint64(MULTIPLIERS[seed])
        n = self.end - self.start
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(n.max()), m, np.uint64)]))
        out = np.zeros(len(self.start), np.uint64)
        inside = np.flatnonzero(self._word)
        offset = np.arange(len(inside)) - np.repeat(np.cumsum(n) - n, n)
        value = (self._b[inside].astype(np.uint64) + np.uint64(1)) * powers[offset]
        out = np.add.reduceat(value, np.cumsum(n) - n)
        return mixed(out + n.astype(np.uint64) * powers[1])


def gram_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each run of ``n`` words."""
    m = np.uint64(MULTIPLIERS[1 - seed])
    size = max(0, len(words) - n + 1)
    h = np.zeros(size, np.uint64)
    for j in range(n):
        h = h * m + words[j:j + size]
    return mixed(h)


def grams(w: Words, n: int) -> np.ndarray:
    """Starts (word numbers of the chunk) of the runs of ``n`` words of one text."""
    size = max(0, len(w.start) - n + 1)
    return np.flatnonzero(w.doc[:size] == w.doc[n - 1:n - 1 + size])


def blocks(c: Chunk, window: int):
    """Different rolling blocks of a chunk: (hashes, anchor flag, words, start
    of every block, number of its hash)."""
    w, n = Words(c), window // 2
    at = grams(w, n)
    h, inverse, count = np.unique(gram_hashes(w.hashes(0), n, 0)[at], return_inverse=True, return_counts=True)
    anchor = np.zeros(len(h), np.uint32)
    anchor[inverse[w.place[at] % n == 0]] = 1
    return h, anchor, w, at, inverse, count


def substring_dedup(docs: DataFrame, window: int = WINDOW, keep: list[str] = (), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (array of removed runs: first word, word after the
    last), kept (the words left, joined by one space), rest (columns ``keep``)."""
    if window % 2:
        raise ValueError("the window must be even: it holds two blocks")
    chunks = pack(docs, "substring-chunks", keep, id_col, text_col)
    buckets, half = n_buckets(chunks), window // 2

    def index(c):
        h, anchor, *_ = blocks(c, window)
        return h, anchor

    hits = find_repeats(state_codes(chunks, index, buckets), HOT)

    def extend(c: Chunk, replies: pa.Table) -> pa.Table:
        h, _, w, at, inverse, count = blocks(c, window)
        hit = np.zeros(len(w.start) + 1, bool)
        hit[at] = ((marks_of(h, replies, buckets) > 0) | (count > 1))[inverse]
        starts = grams(w, window)
        seen = np.concatenate([[0], np.cumsum(hit)])        # hits before a place
        starts = starts[seen[starts + half + 1] > seen[starts]]
        if not len(starts):
            return entries_table([])
        a = gram_hashes(w.hashes(0), window, 0)[starts]
        b = gram_hashes(w.hashes(1), window, 1)[starts]
        ids, place = c.ids[w.doc[starts]], w.place[starts]
        order = np.lexsort((place, ids, b, a))
        a, b, ids, place, starts = a[order], b[order], ids[order], place[order], starts[order]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        # equal (id, start) in twin rows: none of them is later than the other
        lead = np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(a))))
        same = (ids == ids[lead]) & (place == place[lead])
        rows = [(-1 - c.number % buckets, c.number, np.sort(starts[~same]).astype(np.uint32).tobytes())]
        a, b, ids, place, starts = a[same], b[same], ids[same], place[same], starts[same]
        # in text order within a bucket: ids and places compress well
        home = bucket_of(a, buckets)
        order = np.lexsort((starts, home))
        a, b, ids, place, starts, home = (x[order] for x in (a, b, ids, place, starts, home))
        cut_at = np.searchsorted(home, np.arange(buckets + 1))
        b = (b >> np.uint64(32)).astype(np.uint32)
        for k in np.flatnonzero(np.diff(cut_at)):
            s = slice(cut_at[k], cut_at[k + 1])
            rows.append((int(k), c.number, b"".join(x[s].tobytes() for x in (
                a, b, ids, place.astype(np.uint32), starts.astype(np.uint32)))))
        return entries_table(rows)

    def judge(t: pa.Table) -> pa.Table:
        """Windows (word numbers of their chunk) that start earlier elsewhere."""
        if t.column("bucket")[0].as_py() < 0:       # settled inside their chunks
            return t
        data, numbers = t.column("data").to_pylist(), t.column("chunk").to_pylist()
        n = [len(x) // 28 for x in data]
        part = lambda i, j, kind: np.concatenate(
            [np.frombuffer(x[i * k:j * k], kind) for x, k in zip(data, n)])
        a, b, ids = part(0, 8, np.uint64), part(8, 12, np.uint32), part(12, 20, np.int64)
        place, start = part(20, 24, np.uint32), part(24, 28, np.uint32)
        order = np.lexsort((place, ids, b, a))
        head = np.flatnonzero(np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)]))
        lead = np.empty(len(a), np.int64)
        lead[order] = np.repeat(order[head], np.diff(np.append(head, len(a))))
        late = (ids != ids[lead]) | (place != place[lead])
        at = np.append(0, np.cumsum(n))
        return entries_table([(0, c, start[at[i]:at[i + 1]][late[at[i]:at[i + 1]]].tobytes())
                                for i, c in enumerate(numbers) if late[at[i]:at[i + 1]].any()])

    late = with_chunks(chunks, hits, extend, ENTRIES_SQL).groupBy("bucket").applyInArrow(judge, ENTRIES_SQL)

    def drop(c: Chunk, replies: pa.Table) -> pa.Table:
        w = Words(c)
        gone = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(x, np.uint32)
                                                         for x in replies.column("data").to_pylist()]])
        mask = cover(gone.astype(np.int64), window, len(w.start))
        spans, kept = [], []
        for i in range(len(c.ids)):
            s = slice(int(w.first[i]), int(w.first[i] + w.n_words[i]))
            lo, hi = runs(mask[s])
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lo, hi)])
            if len(lo):
                left = ~mask[s]
                words = [c.blob[x:y] for x, y in zip(w.start[s][left].tolist(), w.end[s][left].tolist())]
            else:
                words = c.blob[c.starts[i]:c.ends[i]].split()
            kept.append(b" ".join(words).decode())
        return result_table(c, {
            "n_words": pa.array(w.n_words, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.string())})

    return with_chunks(chunks, late, drop, result_schema(
        docs, list(keep), "n_words long, spans array<struct<start: bigint, end: bigint>>, kept string"))


def removed_length(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def substring_sql(window: int = WINDOW) -> str:
    """Every window as text, first start by a window function."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i + 1, i + {window}), ' ') AS k
      FROM (SELECT r, doc_id, w, unnest(range(0, len(w) - {window - 1})) AS i FROM d)),
l AS (SELECT r, i FROM (SELECT r, i, doc_id, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY k) AS f FROM g)
      WHERE f.d < doc_id OR (f.d = doc_id AND f.i < i)),
c AS (SELECT DISTINCT r, unnest(range(i, i + {window})) AS p FROM l),
x AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept, count(c.p) AS gone
      FROM x LEFT JOIN c ON x.r = c.r AND x.p = c.p GROUP BY x.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
