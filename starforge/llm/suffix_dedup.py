"""Suffix-array dedup: merged Burrows-Wheeler transforms of string shards.

Finds every string of ``WIDTH`` bytes that also starts in a document with a
smaller id, and removes the bytes such strings cover.

*Dealing.*  A window of ``WIDTH`` bytes is dealt by its minimizer, the ``SEED``
bytes in it with the smallest hash: equal windows have equal minimizers, so
they meet in one bucket wherever they come from.  Consecutive windows with the
same minimizer travel as one string.  Minimizers found in one chunk of texts
only (told by packed fingerprints) send nothing, and equal strings of a chunk
are sent once, with the smallest doc_id.

*Merging.*  In a bucket equal strings collapse to one.  The strings that share
a minimizer with a different string are cut into shards; each shard has its
suffixes sorted by prefix doubling and gives its Burrows-Wheeler transform.
The transforms are merged without comparing suffixes again: the interleave
starts as shard after shard, and each round reads the symbols in the current
order and moves every entry behind its symbol, after which the interleave is
right for prefixes one symbol longer.  Entries that were in different intervals,
or came behind different symbols, differ within the prefix length of the round,
which gives the common prefixes; after ``WIDTH`` rounds the intervals hold the
suffixes that share ``WIDTH`` bytes, and the smallest doc_id of an interval
judges its windows.

Nothing larger than a chunk or a bucket is held in a task, and a bucket is held
as one byte buffer with places in it.  A minimizer that more than ``HOT`` chunks
share is split by its neighbours: its windows with more bytes before it are dealt
by the bytes before it too, the others by the bytes behind it, which equal windows
have in common.  What the transforms judge are different strings around one
minimizer; strings equal as a whole are found by two 64-bit hashes before, in the
chunk and in the bucket, and only their smallest id goes on.

Defined results: NULL and empty texts have no bytes and lose none; rows with a
NULL id come after all others; rows that share an id do not judge each other
(the id must be smaller), so a repeated row loses nothing to its twin.  The
bytes left need not be whole characters; ``kept`` is binary.  An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starforge.llm.common import release_memory
from starforge.llm.passages import (Chunk, ENTRIES_SQL, bucket_of, cover, entries_table, find_repeats,
                                    marks_of, mixed, n_buckets, pack, result_schema, result_table, runs,
                                    state_codes, with_chunks)

WIDTH, SEED = 50, 16
SHARD_BYTES = 1 << 16
HOT = 64             # chunks with the same minimizer before it is split by its neighbours
NEAR = 8             # bytes of a neighbour
GROUP_BYTES = 1 << 20    # strings merged at a time


# -- minimizers -----------------------------------------------------------

def seed_hashes(b: np.ndarray, k: int = SEED) -> np.ndarray:
    """64-bit hash of the ``k`` bytes (a power of two) from each place."""
    h, step = b.astype(np.uint64) + np.uint64(1), 1
    m = np.uint64(0x9E3779B97F4A7C15)
    while step < k:
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            power = m
            for _ in range(step - 1):
                power = power * m
        h = h[:-step] * power + h[step:]
        step *= 2
    return mixed(h)


BLOCK = 1 << 15     # places worked on at a time: the arrays stay in the cache


def minimizers(b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the place of its minimizer (the first of equal ones),
    and the hashes of the seeds at all places."""
    size, want = max(0, len(b) - width + 1), width - SEED + 1
    h, place = np.empty(max(0, len(b) - SEED + 1), np.uint64), np.empty(size, np.int64)
    for s in range(0, size, BLOCK):
        n = min(BLOCK, size - s)
        part = seed_hashes(b[s:s + n + width - 1])
        h[s:s + len(part)] = part
        low = (part & ~np.uint64(0xFFFFFFFF)) | np.arange(len(part), dtype=np.uint64)
        step = 1
        while 2 * step <= want:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if want > step:
            low = np.minimum(low[:-(want - step)], low[want - step:])
        place[s:s + n] = (low & np.uint64(0xFFFFFFFF)).astype(np.int64) + s
    return h, place


class Strings:
    """Runs of windows of one text that share a minimizer place."""

    def __init__(self, c: Chunk, width: int):
        h, place = minimizers(c.bytes, width)
        size = len(place)
        doc = np.repeat(np.arange(len(c.ids)), c.lengths)
        whole = doc[:size] == doc[width - 1:width - 1 + size] if size else np.zeros(0, bool)
        at = np.flatnonzero(whole)                  # windows inside one text
        place, own = place[at], doc[at]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]) if len(at) else whole
        first = np.flatnonzero(new)
        self.start = at[first]                                      # of the string
        self.n = np.diff(np.append(first, len(at)))                 # windows in it
        self.size = self.n + width - 1
        self.doc = own[first]
        self.seed = mixed(h[place[first]] + np.uint64(1))           # the minimizer, hashed anew:
        # as the smallest of its neighbours its own hash is far from uniform
        self.offset = place[first] - self.start                     # its place in the string


def index(c: Chunk, width: int):
    """(different minimizers, strings, number of each string's minimizer, count)"""
    s = Strings(c, width)
    h, inverse, count = np.unique(s.seed, return_inverse=True, return_counts=True)
    return h, s, inverse, count


def byte_hashes(b: np.ndarray, start: np.ndarray, size: np.ndarray, base: int) -> np.ndarray:
    """Hash of the bytes of each string, from running sums of ``byte * m^place``
    brought back to place 0 by the inverse of the odd ``m``."""
    def powers(m: int) -> np.ndarray:
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), m, np.uint64)]))
    run = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(base)[:-1])])
    back = powers(pow(base, -1, 1 << 64))
    return mixed((run[start + size] - run[start]) * back[start] + size.astype(np.uint64))


# -- shards ---------------------------------------------------------------

PACK = 7        # symbols in the first key: 257 ** 7 fits 63 bits


def sorted_suffixes(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of strings (each closed by a 0, symbols from 1) in order of
    their first ``depth`` symbols up to the 0, ties by place: prefix doubling
    from keys of ``PACK`` symbols."""
    n = len(text)
    places = np.arange(n)
    rank = np.zeros(n, np.int64)
    for j in range(PACK):
        rank = rank * 257 + text[np.minimum(places + j, ends)]      # 0 from the end on
    step = PACK
    while True:
        order = np.argsort(rank)
        k = rank[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])
        if step >= depth:
            return np.argsort(rank * n + places)
        rank = rank * (n + 1) + rank[np.minimum(places + step, ends)]
        step *= 2


class Shard:
    """Sorted suffixes of some strings and their Burrows-Wheeler transform."""

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        self.ends = np.cumsum(size + 1) - 1             # places of the closing 0
        self.starts = self.ends - size
        owner = np.repeat(np.arange(len(strings)), size + 1)
        text = np.zeros(len(owner), np.int64)
        inside = np.ones(len(owner), bool)
        inside[self.ends] = False
        text[inside] = flat.astype(np.int64) + 1
        order = sorted_suffixes(text, self.ends[owner], int(size.max()) + 1)
        before = np.concatenate([[0], text[:-1]])
        before[self.starts] = 0                         # a string begins behind its closing 0
        self.bwt = before[order].astype(np.uint16)
        self.rank = np.empty(len(order), np.int32)      # of the suffix at each place
        self.rank[order] = np.arange(len(order))
        # where the suffix one symbol longer stands: equal symbols keep their order
        self.step = np.empty(len(order), np.int32)
        self.step[np.argsort(self.bwt, kind="stable")] = np.arange(len(order))


def merge(shards: list[Shard], begin: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the suffixes that lie ``rounds`` symbols before the suffixes
    ``begin`` (ranks, counted through the shards): (which of ``begin`` each
    entry comes from, number of its interval of equal prefixes).

    The interleave of the other suffixes is not followed: an entry needs its
    own shard's transform only, and its order among the entries followed.
    Entries alone in their interval are settled and left out from then on."""
    size = [len(s.bwt) for s in shards]
    base = np.cumsum(size) - size
    symbols = np.concatenate([s.bwt for s in shards])
    used = np.unique(symbols)
    kind = np.uint8 if len(used) <= 1 << 8 else np.uint16
    symbols = np.searchsorted(used, symbols).astype(kind)
    step = np.concatenate([s.step + np.int32(b) for s, b in zip(shards, base)])
    which = np.argsort(begin, kind="stable").astype(np.int32)       # shard after shard, as sorted there
    rank = begin[which].astype(np.int32)
    interval = np.zeros(len(rank), np.int32)
    for k in range(1, rounds + 1):
        now = symbols[rank]
        move = np.argsort(now, kind="stable")
        now, old = now[move], interval[move]
        rank, which = step[rank[move]], which[move]
        new = (now[1:] != now[:-1]) | (old[1:] != old[:-1])
        interval = np.zeros(len(rank), np.int32)
        np.cumsum(new, out=interval[1:])
        if k % 4 == 0 and len(rank):
            shared = ~(np.append(True, new) & np.append(new, True))
            if not shared.all():
                rank, which, interval = rank[shared], which[shared], interval[shared]
                if not len(rank):
                    break
    return which, interval


def smallest_by_window(strings: list[bytes], ids: np.ndarray, width: int,
                       shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each string (all at least ``width`` long), the
    smallest id of a string that holds the window anywhere; and the place of
    each string's first window in that array."""
    length = np.array([len(s) for s in strings], np.int64)
    n = length - width + 1
    base = np.cumsum(n) - n
    shards, begin, size, first = [], [], 0, 0
    for i in range(len(strings)):
        size += len(strings[i]) + 1
        if size >= shard_bytes or i == len(strings) - 1:
            shard = Shard(strings[first:i + 1])
            m = n[first:i + 1]
            # a window is followed from the suffix behind it
            at = np.repeat(shard.starts + width, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            begin.append(shard.rank[at] + np.int32(sum(len(s.bwt) for s in shards)))
            shard.rank = None
            shards.append(shard)
            size, first = 0, i + 1
    which, interval = merge(shards, np.concatenate(begin), width)
    out = np.repeat(np.asarray(ids, np.int64), n)
    if len(which):
        head = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
        low = np.minimum.reduceat(out[which], head)
        out[which] = np.repeat(low, np.diff(np.append(head, len(which))))
    return out, base


# -- dealing --------------------------------------------------------------

def split_by_neighbours(b: np.ndarray, s: Strings, wide: np.ndarray, width: int) -> tuple:
    """(start, size, string, key, offset) of the strings ``wide`` cut in two: windows
    with more than half of their other bytes before the minimizer, and the rest."""
    half = (width - SEED) // 2
    near = min(NEAR, half)
    before = np.clip(s.offset[wide] - half, 0, s.n[wide])           # windows of the first kind
    place = s.start[wide] + s.offset[wide]

    def key(at: np.ndarray) -> np.ndarray:
        h = s.seed[wide]
        for j in range(near):
            h = mixed(h + b[np.clip(at + j, 0, len(b) - 1)].astype(np.uint64) + np.uint64(1))
        return h
    start = np.concatenate([s.start[wide], s.start[wide] + before])
    n = np.concatenate([before, s.n[wide] - before])
    offset = np.concatenate([s.offset[wide], s.offset[wide] - before])
    some = n > 0
    keys = np.concatenate([key(place - near), key(place + SEED) + np.uint64(1)])
    return start[some], n[some] + width - 1, np.tile(wide, 2)[some], keys[some], offset[some]


def deal(c: Chunk, marks, buckets: int, width: int) -> list[tuple[int, int, bytes]]:
    """What a chunk sends: (bucket, chunk, strings), and under a negative bucket
    the windows settled in the chunk itself.  ``marks(hashes)``: 1 for a minimizer
    of other chunks too, 2 for one of more than ``hot``."""
    h, s, inverse, count = index(c, width)
    mark = marks(h)
    mark = np.where((mark == 0) & (count > 1), 1, mark)[inverse]
    take, wide = np.flatnonzero(mark == 1), np.flatnonzero(mark == 2)
    start, size, doc = s.start[take], s.size[take], s.doc[take]
    home, offset = bucket_of(s.seed[take], buckets), s.offset[take]
    if len(wide):
        start2, size2, of, key, offset2 = split_by_neighbours(c.bytes, s, wide, width)
        start, size, doc = np.append(start, start2), np.append(size, size2), np.append(doc, s.doc[of])
        home, offset = np.append(home, bucket_of(key, buckets)), np.append(offset, offset2)
    if not len(start):
        return []
    a = byte_hashes(c.bytes, start, size, 0x9FB21C651E98DF25)
    b = byte_hashes(c.bytes, start, size, 0xA0761D6478BD642F)
    ids = c.ids[doc]
    order = np.lexsort((ids, b, a, home))
    start, size, ids, home, offset, a, b = (x[order] for x in (start, size, ids, home, offset, a, b))
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (home[1:] != home[:-1])])
    at = np.flatnonzero(head)
    lead = np.repeat(at, np.diff(np.append(at, len(a))))
    later = ids != ids[lead]                        # an earlier document of this chunk has it
    here = np.zeros(len(c.bytes), bool)
    n = (size - width + 1)[later]
    here[np.repeat(start[later], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = True
    rows = [(-1 - c.number % buckets, c.number, _pairs(*runs(here)))]
    start, size, ids, home, offset = (x[~later] for x in (start, size, ids, home, offset))
    order = np.lexsort((start, home))               # in text order: compresses well
    start, size, ids, home, offset = (x[order] for x in (start, size, ids, home, offset))
    cut_at = np.searchsorted(home, np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cut_at)):
        p = slice(cut_at[k], cut_at[k + 1])
        text = b"".join([c.blob[x:x + y] for x, y in zip(start[p].tolist(), size[p].tolist())])
        n = len(start[p])
        rows.append((int(k), c.number, b"".join([
            np.uint32(n).tobytes(), ids[p].tobytes(), start[p].astype(np.uint32).tobytes(),
            size[p].astype(np.uint8).tobytes(), offset[p].astype(np.uint8).tobytes(), text])))
    return rows


# -- the job --------------------------------------------------------------

def suffix_dedup(docs: DataFrame, width: int = WIDTH, keep: list[str] = (), id_col: str = "doc_id",
                 text_col: str = "text", hot: int = HOT, as_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (array of removed runs: first byte, byte after the
    last), kept (the bytes left; with ``as_text`` a string, without characters of
    which a part was removed), rest (columns ``keep``)."""
    chunks = pack(docs, "suffix-chunks", keep, id_col, text_col)
    buckets = n_buckets(chunks)

    def state(c):
        h, *_ = index(c, width)
        return h, np.ones(len(h), np.uint32)

    hits = find_repeats(state_codes(chunks, state, buckets), hot)

    def send(c: Chunk, replies: pa.Table) -> pa.Table:
        return entries_table(deal(c, lambda h: marks_of(h, replies, buckets), buckets, width))

    def judge(t: pa.Table) -> pa.Table:
        if t.column("bucket")[0].as_py() < 0:           # settled inside their chunks
            return t
        out = judge_bucket(t.column("chunk").to_pylist(), t.column("data").to_pylist(), width)
        release_memory()
        return out

    late = with_chunks(chunks, hits, send, ENTRIES_SQL).groupBy("bucket").applyInArrow(judge, ENTRIES_SQL)

    def drop(c: Chunk, replies: pa.Table) -> pa.Table:
        d = np.zeros(len(c.bytes) + 1, np.int64)
        for x in replies.column("data").to_pylist():
            lo, hi = np.frombuffer(x, np.uint32).astype(np.int64).reshape(2, -1)
            np.add.at(d, lo, 1)
            np.add.at(d, hi - 1 + width, -1)            # the last window covers to its end
        mask = np.cumsum(d[:-1]) > 0
        spans, kept = [], []
        for i in range(len(c.ids)):
            lo, hi = runs(mask[c.starts[i]:c.ends[i]])
            text = c.blob[c.starts[i]:c.ends[i]]
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lo, hi)])
            kept.append(text if not len(lo) else b"".join(
                [text[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(text)])]))
        return result_table(c, {
            "n_bytes": pa.array(c.lengths, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text
            else pa.array(kept, pa.binary())})

    return with_chunks(chunks, late, drop, result_schema(
        docs, list(keep),
        "n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept "
        + ("string" if as_text else "binary")))


def _pairs(lo: np.ndarray, hi: np.ndarray) -> bytes:
    return lo.astype(np.uint32).tobytes() + hi.astype(np.uint32).tobytes()


def blocks_of(size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs (first, after the last) of strings with at most ``most`` bytes, or one."""
    ends, out, first = np.cumsum(size), [], 0
    while first < len(size):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        out.append((first, last))
        first = last
    return out


def judge_bucket(numbers: list[int], data: list[bytes], width: int) -> pa.Table:
    """Runs of windows (first, after the last; places in their chunk) that also
    stand in a document with a smaller id."""
    counts = np.array([int(np.frombuffer(x, np.uint32, 1)[0]) for x in data], np.int64)

    def column(kind, skip: int) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind, n, 4 + skip * n) for x, n in zip(data, counts.tolist())])
    ids, start = column(np.int64, 0), column(np.uint32, 8)
    size, offset = column(np.uint8, 12).astype(np.int32), column(np.uint8, 13).astype(np.int32)
    text = np.concatenate([np.frombuffer(x, np.uint8, offset=4 + 14 * n) for x, n in zip(data, counts.tolist())])
    at = np.cumsum(size, dtype=np.int64) - size
    # equal strings by two hashes, a block at a time
    a, b = np.empty(len(size), np.uint64), np.empty(len(size), np.uint64)
    for lo, hi in blocks_of(size, 1 << 16):
        part = text[at[lo]:at[hi - 1] + size[hi - 1]]
        a[lo:hi] = byte_hashes(part, at[lo:hi] - at[lo], size[lo:hi].astype(np.int64), 0x9FB21C651E98DF25)
        b[lo:hi] = byte_hashes(part, at[lo:hi] - at[lo], size[lo:hi].astype(np.int64), 0xA0761D6478BD642F)
    order = np.lexsort((ids, b, a))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    del a, b
    first = order[new]                              # of each different string, the one with the smallest id
    k = np.empty(len(size), np.int32)
    k[order] = np.cumsum(new) - 1
    low, length = ids[first], size[first]
    # different strings around the same minimizer
    seed = np.stack([text[at[first] + offset[first] + j] for j in range(SEED)], axis=1)
    seed = np.ascontiguousarray(seed).view(np.uint64)
    order = np.lexsort((seed[:, 1], seed[:, 0]))
    seed = seed[order]
    new = np.concatenate([[True], (seed[1:] != seed[:-1]).any(axis=1)])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    order, group = order[several], group[several]
    windows = length - width + 1
    base = np.cumsum(windows, dtype=np.int64) - windows
    best = np.repeat(low, windows)                  # smallest id by window of each different string
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    sizes = np.add.reduceat(length[order], heads) if len(heads) else heads
    heads = np.append(heads, len(order))
    for lo, hi in blocks_of(sizes, GROUP_BYTES):
        own = order[heads[lo]:heads[hi]]
        strings = [text[p:p + n].tobytes() for p, n in zip(at[first[own]].tolist(), length[own].tolist())]
        merged, _ = smallest_by_window(strings, low[own], width)
        m = windows[own]
        best[np.repeat(base[own], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)] = merged
    del text
    out, done = [], np.cumsum(counts)
    for r, n in enumerate(counts.tolist()):         # a chunk's strings at a time
        p = slice(done[r] - n, done[r])
        m = windows[k[p]]
        inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        late = best[np.repeat(base[k[p]], m) + inner] < np.repeat(ids[p], m)
        if not late.any():
            continue
        place, edge = np.repeat(start[p].astype(np.int64), m) + inner, inner == 0
        lo = np.flatnonzero(late & (edge | ~np.concatenate([[False], late[:-1]])))
        hi = np.flatnonzero(late & np.concatenate([edge[1:] | ~late[1:], [True]]))
        out.append((0, numbers[r], _pairs(place[lo], place[hi] + 1)))
    return entries_table(out)


def suffix_sql(width: int = WIDTH) -> str:
    """Every window as hex text."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, {2 * width}) AS k
      FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - {width - 1})) AS i FROM d)),
l AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY k) AS f FROM g) WHERE f < doc_id),
s AS (SELECT r, min(i) AS lo, max(i) + {width} AS hi FROM (
        SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS n FROM (
          SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {width} THEN 0 ELSE 1 END AS new FROM l))
      GROUP BY r, n),
p AS (SELECT r, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY r ORDER BY lo) AS before FROM s),
k AS (SELECT p.r, count(*) AS n, sum(hi - lo) AS gone, max(hi) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
      FROM p JOIN d USING (r) GROUP BY p.r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
