"""MinHash near-dedup with tensored banding.

A document's set holds the hashes of its different shingles (runs of words);
the shingle's length and the least similarity of a pair are parameters, ``SHINGLE``
and ``PERCENT`` unless given.  Two collections of ``side`` groups of ``pair``
minhashes each are computed (``2 * side * pair`` in all); table (i, j) is keyed by
group i of the first and group j of the second, so ``side * side`` tables of
``2 * pair`` minhashes cost about the square root of the minhashes they would need
if drawn singly.  At the threshold a pair is missed by all tables with a chance of
about ``2 * (1 - t^pair)^side``, 2.6e-4 at most (``rule_for``).

1. Documents with equal sets form one node (a 128-bit fingerprint of the set).
2. Table keys held by one node only are dropped; the rest carry the node's
   sketch.  Small buckets name all their pairs, larger ones the pairs with
   ``HUBS`` members.  A pair is named by the first table it shares, and only if
   the sizes and the sketches allow the threshold (a linked pair fails the
   sketch test, ``agree`` of the minhashes, with a chance below 1e-3).
3. Named pairs are confirmed on full sets; links give components.
4. In larger buckets that still hold several components the pairs between
   different components are compared too, block by block, so that nothing is
   lost where the hubs were not linked to all.  The full sets are sent to the
   blocks once per node, and a block gives out a tree of each component it
   finds, not its pairs.

No pairs inside a component are listed beyond the hubs', so a group of many
copies costs a multiple of its size.  Sets travel for named pairs only.

Defined results: NULL text and texts without words have the empty set and link
with nothing; under a shingle's words the whole sequence is the one shingle;
rows with a NULL id link with nothing, have a NULL component and are kept; rows
that share an id belong together; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from types import SimpleNamespace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import LOWER, UPPER, cut, id_text, release_memory
from starforge.llm.components import components, local_roots
from starforge.llm.passages import mixed
from starforge.llm.substring_dedup import Words, gram_hashes, grams

SHINGLE, PERCENT = 3, 85
PAIR = 2
MISSED, FAILED = 2.6e-4, 2e-4   # chances at the threshold: no common table, sketch test
ALL_PAIRS, HUBS = 12, 4     # buckets up to ALL_PAIRS name all pairs
BLOCK = 2048                # members of a large bucket compared at a time
GROUP_ROWS = 20_000
BROADCAST_ROWS = 100_000
CHECKED = 256               # pairs confirmed at a time in a task
HASH_BYTES = 8              # of a shingle's hash, in the sets that travel


class Rule(NamedTuple):
    """What links two sets, and the minhashes that find it."""
    shingle: int
    percent: int
    side: int
    pair: int
    agree: int                  # of ``minhashes``

    @property
    def minhashes(self) -> int:
        return 2 * self.side * self.pair


def rule_for(shingle: int, percent: int) -> Rule:
    """The fewest groups and the strictest sketch test that keep to ``MISSED``
    and ``FAILED`` at the threshold (7 groups and 16 of 28 at 85)."""
    t = percent / 100
    side = 1
    while 2 * (1 - t ** PAIR) ** side > MISSED:
        side += 1
    n = 2 * side * PAIR
    agree, below = 0, 0.0       # below: chance of fewer than agree equal minhashes
    while (below := below + math.comb(n, agree) * t ** agree * (1 - t) ** (n - agree)) <= FAILED:
        agree += 1
    return Rule(shingle, percent, side, PAIR, agree)


def shingle_sets(texts: list[str | None], shingle: int):
    """All texts' sets, one after the other (each sorted), and their sizes."""
    to_lower = bytes.maketrans(UPPER.encode(), LOWER.encode())
    raw = [(t or "").encode().translate(to_lower) for t in texts]
    lengths = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    w = Words(SimpleNamespace(bytes=flat, starts=(ends - lengths)[lengths > 0], ends=ends, ids=lengths))
    h = w.hashes(0)
    got, doc = [], []
    for n in range(1, shingle + 1):
        at = grams(w, n)
        if n < shingle:     # whole texts of n words
            at = at[w.n_words[w.doc[at]] == n]
        got.append(gram_hashes(h, n, n % 2)[at] + np.uint64(n))
        doc.append(w.doc[at])
    h, doc = np.concatenate(got), np.concatenate(doc)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.bincount(doc, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)


def portions(batch: pa.RecordBatch, size: int = 1 << 20):
    """The batch in runs of rows with about ``size`` bytes of text."""
    ends = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0)))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def sketches(h: np.ndarray, sizes: np.ndarray, minhashes: int) -> tuple[list, np.ndarray]:
    """Fingerprint (16 bytes, None for the empty set) and minhashes of each set."""
    some = np.flatnonzero(sizes)
    prints, mins = [None] * len(sizes), np.zeros((len(sizes), minhashes), np.uint32)
    if len(some):
        at = (np.cumsum(sizes) - sizes)[some]
        a = np.add.reduceat(mixed(h + np.uint64(0x632BE59BD9B4E019)), at)
        b = np.add.reduceat(mixed(h * np.uint64(0xC2B2AE3D27D4EB4F)), at) + sizes[some].astype(np.uint64)
        both = np.column_stack([a, b]).tobytes()
        for k, i in enumerate(some):
            prints[i] = both[16 * k:16 * k + 16]
        odd = np.random.default_rng(11).integers(0, 1 << 62, minhashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for j in range(minhashes):
            mins[some, j] = np.minimum.reduceat(((h ^ (h >> np.uint64(29))) * odd[j]) >> np.uint64(32), at)
    return prints, mins


def table_keys(mins: np.ndarray, rule: Rule) -> np.ndarray:
    """(nodes, side * side) table keys from the tensored collections."""
    side = rule.side
    groups = mins.reshape(len(mins), 2, side, rule.pair).astype(np.uint64)
    g = np.zeros((len(mins), 2, side), np.uint64)
    for p in range(rule.pair):
        g = mixed(g * np.uint64(0x9FB21C651E98DF25) + groups[..., p] + np.uint64(1))
    g += np.arange(2 * side, dtype=np.uint64).reshape(1, 2, side) * np.uint64(0xD6E8FEB86659FD93)
    key = mixed(g[:, 0, :, None] * np.uint64(0x9E3779B97F4A7C15) + g[:, 1, None, :])
    return key.reshape(len(mins), side * side)


def named(x: np.ndarray, y: np.ndarray, table: np.ndarray, n: np.ndarray, mins: np.ndarray,
          rule: Rule) -> np.ndarray:
    """Whether rows x and y (of a bucket of table ``table[x]``) are a pair to
    confirm, and this is the first table they share."""
    ok = 100 * np.minimum(n[x], n[y]) >= rule.percent * np.maximum(n[x], n[y])
    keep = np.flatnonzero(ok)
    for part in np.array_split(keep, len(keep) // 200_000 + 1):
        same = mins[x[part]] == mins[y[part]]
        side = same.reshape(len(part), 2, rule.side, rule.pair).all(3)
        first = side[:, 0].argmax(1) * rule.side + side[:, 1].argmax(1)
        ok[part] = (same.sum(1) >= rule.agree) & (first == table[x[part]])
    return ok


def bucket_pairs(starts: np.ndarray, sizes: np.ndarray, tie: np.ndarray):
    """Row numbers of the pairs named in buckets of consecutive rows."""
    xs, ys = [], []
    for m in range(2, ALL_PAIRS + 1):
        at = starts[sizes == m]
        for p in range(m):
            for q in range(p + 1, m):
                xs.append(at + p)
                ys.append(at + q)
    for at, m in zip(starts[sizes > ALL_PAIRS], sizes[sizes > ALL_PAIRS]):
        rows = np.arange(at, at + m)
        for k in range(HUBS):           # hubs by as many different orders
            hub = rows[mixed(tie[rows] + np.uint64(k)).argmin()]
            xs.append(np.full(m - 1, hub))
            ys.append(rows[rows != hub])
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.zeros(0, np.int64),) * 2


PAIRS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _pairs_table(nodes: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.Table:
    a, b = nodes[x], nodes[y]
    low = np.where(a < b, a, b) if len(a) else a
    high = np.where(a < b, b, a) if len(a) else b
    return pa.table([pa.array(low.tolist(), pa.binary()), pa.array(high.tolist(), pa.binary())], schema=PAIRS)


def _members(t: pa.Table, rule: Rule):
    """Rows of a group sorted by bucket: nodes, table, sizes, minhashes,
    starts and sizes of the buckets, and the table in that order."""
    t = t.sort_by([("key", "ascending"), ("bi", "ascending"), ("bj", "ascending"), ("node", "ascending")])
    key = np.column_stack([t.column(c).to_numpy() for c in ("key", "bi", "bj")])
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]).any(1)
    starts = np.flatnonzero(new)
    nodes = np.array(t.column("node").to_pylist(), object)
    mins = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint32).reshape(-1, rule.minhashes)
    return (nodes, t.column("t").to_numpy(), t.column("n").to_numpy(), mins, starts,
            np.diff(np.append(starts, len(key))), t)


def hashes_of(packed: bytes) -> np.ndarray:
    """The hashes of a packed set, ascending."""
    p = np.frombuffer(packed, np.uint8).reshape(HASH_BYTES, -1).T.astype(np.uint64)
    return sum(p[:, k] << np.uint64(8 * (HASH_BYTES - 1 - k)) for k in range(HASH_BYTES))


def full_sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(node, hashes) of the nodes in ``wanted``, from the texts."""
    ids = cut(wanted.join(nodes, "node").select("node", "doc_id"), "near-wanted")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids

    def full(batches):
        for b in (p for whole in batches for p in portions(whole)):
            h, sizes = shingle_sets(b.column("text").to_pylist(), rule.shingle)
            prints, _ = sketches(h, sizes, rule.minhashes)
            # the upper bytes of each hash, in byte planes (sorted: they compress)
            planes = h.byteswap().view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
            ends = np.cumsum(sizes)
            sets = [planes[e - s:e].T.tobytes() for s, e in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints, pa.binary()), b.column("node"), pa.array(sets, pa.binary())],
                names=["print", "node", "hashes"])
        release_memory()

    sets = (docs.join(side, "doc_id").select("text", "node")
            .mapInArrow(full, "print binary, node binary, hashes binary")
            .filter("print = node").groupBy("node").agg(F.first("hashes").alias("hashes")))
    return cut(sets, "near-sets")


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, nodes, rule)
    both = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")

    def check(batches):
        for b in (whole.slice(k, CHECKED) for whole in batches for k in range(0, whole.num_rows, CHECKED)):
            keep = []
            for i, (x, y) in enumerate(zip(b.column("ha").to_pylist(), b.column("hb").to_pylist())):
                x, y = hashes_of(x), hashes_of(y)
                s = np.sort(np.concatenate([x, y]))
                inter = int((s[1:] == s[:-1]).sum())
                if 100 * inter >= rule.percent * (len(x) + len(y) - inter):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.select("a", "b", "ha", "hb").mapInArrow(check, "a binary, b binary")


def linked(x: np.ndarray, y: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether the sets x and y of each pair reach the threshold."""
    order = np.argsort(x, kind="stable")
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets])
    start = np.cumsum(size) - size
    mark = np.zeros(int(flat.max()) + 1, bool)
    ok = np.zeros(len(x), bool)
    heads = np.flatnonzero(np.diff(x[order], prepend=-1))
    for lo, hi in zip(heads, np.append(heads[1:], len(x))):
        i, rows = x[order[lo]], order[lo:hi]
        mark[flat[start[i]:start[i] + size[i]]] = True
        for part in np.array_split(rows, size[y[rows]].sum() // 2_000_000 + 1):
            n = size[y[part]]
            first = np.cumsum(n) - n
            at = np.repeat(start[y[part]] - first, n) + np.arange(n.sum())
            inter = np.add.reduceat(mark[flat[at]], first, dtype=np.int64)
            ok[part] = 100 * inter >= percent * (size[i] + n - inter)
        mark[flat[start[i]:start[i] + size[i]]] = False
    return ok


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; documents link from
    ``percent`` of similarity of their sets of ``shingle``-word runs."""
    rule = rule_for(shingle, percent)
    d = id_text(docs, id_col, text_col)

    def sketch(batches):
        for b in (p for whole in batches for p in portions(whole)):
            h, sizes = shingle_sets(b.column("text").to_pylist(), rule.shingle)
            prints, mins = sketches(h, sizes, rule.minhashes)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array([m.tobytes() for m in mins], pa.binary())], names=["doc_id", "n", "node", "sketch"])
        release_memory()

    rows = cut(d.mapInArrow(sketch, "doc_id long, n long, node binary, sketch binary"), "near-sketches")
    able = rows.filter("doc_id is not null and node is not null")
    nodes = cut(able.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                           F.first("sketch").alias("sketch")), "near-nodes")

    def keys(batches):
        for b in batches:
            mins = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint32).reshape(-1, rule.minhashes)
            k = table_keys(mins, rule).astype(np.int64).ravel()
            tables = rule.side * rule.side
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(mins))),
                 b.column("node").take(pa.array(np.repeat(np.arange(len(mins)), tables)))],
                names=["key", "t", "node"])

    entries = nodes.select("node", "sketch").mapInArrow(keys, "key long, t int, node binary")
    held = entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = cut(entries.join(held, "key").join(nodes.drop("doc_id"), "node")
                  .select("key", "t", "node", "n", "sketch", "c"), "near-members")
    groups = max(1, -(-members.count() // GROUP_ROWS))
    at = F.pmod(F.hash("key", "bi", "bj"), F.lit(groups))

    def name_pairs(t: pa.Table) -> pa.Table:
        ids, table, n, mins, starts, sizes, _ = _members(t, rule)
        tie = np.frombuffer(b"".join(ids), np.uint64)[::2]
        x, y = bucket_pairs(starts, sizes, tie)
        ok = named(x, y, table, n, mins, rule)
        return _pairs_table(ids, x[ok], y[ok])

    # hubs need no blocks: a large bucket is dealt to parts, each with hubs of its own
    parts = F.ceil(F.col("c") / BLOCK).cast("int")
    dealt = members.withColumn("bi", F.pmod(F.hash("node"), parts)).withColumn("bj", F.lit(0))
    pairs = cut(dealt.withColumn("g", at).groupBy("g").applyInArrow(name_pairs, "a binary, b binary").distinct(),
                "near-pairs")
    # rows that share an id belong together
    low = able.groupBy("doc_id").agg(F.min("node").alias("b"))
    same_id = (able.select("doc_id", "node").distinct().join(low, "doc_id")
               .filter("node <> b").select(F.col("node").alias("a"), "b"))
    links = cut(confirm(pairs, d, nodes.select("node", "doc_id"), rule).unionByName(same_id), "near-links")
    comp = cut(components(links), "near-components")

    def link_between(t: pa.Table, full: pa.Table) -> pa.Table:
        ids, table, n, mins, starts, sizes, t = _members(t, rule)
        root = np.array(t.column("root").to_pylist(), object)
        block = t.column("block").to_numpy()
        bi, bj = t.column("bi").to_numpy(), t.column("bj").to_numpy()
        _, label = np.unique(root, return_inverse=True)
        xs, ys = [], []
        for s, m in zip(starts, sizes):
            r = np.arange(s, s + m)
            left, right = r[block[r] == bi[s]], r[block[r] == bj[s]]
            for p in np.array_split(left, len(left) * len(right) // 1_000_000 + 1):
                x, y = np.repeat(p, len(right)), np.tile(right, len(p))
                differ = (label[x] != label[y]) & ((x < y) | (bi[s] != bj[s]))
                x, y = x[differ], y[differ]
                ok = named(x, y, table, n, mins, rule)
                xs.append(x[ok])
                ys.append(y[ok])
        if not sum(map(len, xs)):
            return PAIRS.empty_table()
        # confirmed here, and only the way to each component's first node goes out
        names = full.column("node").to_pylist()
        number = {v: i for i, v in enumerate(names)}
        of = np.array([number[v] for v in ids], np.int64)
        x, y = of[np.concatenate(xs)], of[np.concatenate(ys)]
        ok = linked(x, y, [hashes_of(h) for h in full.column("hashes").to_pylist()], rule.percent)
        root = local_roots(x[ok], y[ok], len(names))
        moved = np.flatnonzero(root != np.arange(len(names)))
        return _pairs_table(np.array(names, object), moved, root[moved])

    # large buckets with several components left, by pairs of blocks
    open_rows = (members.filter(F.col("c") > ALL_PAIRS).join(comp, "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
    still = (open_rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .filter("lo <> hi").select("key"))
    open_rows = (open_rows.join(still, "key").withColumn("parts", parts)
                 .withColumn("block", F.pmod(F.hash("node"), F.col("parts"))))
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    open_rows = (open_rows.withColumn("o", others).withColumn("bi", F.least("block", "o"))
                 .withColumn("bj", F.greatest("block", "o")))
    open_rows = cut(open_rows.select("key", "t", "node", "n", "sketch", "root", "block", "bi", "bj"), "near-open")
    groups = max(1, -(-open_rows.count() // GROUP_ROWS))
    open_rows = open_rows.withColumn("g", F.pmod(F.hash("key", "bi", "bj"), F.lit(groups)))
    rest = cut(open_rows.select("g", "node").distinct(), "near-rest")
    sets = full_sets(rest.select("node").distinct(), d, nodes.select("node", "doc_id"), rule)
    more = cut(open_rows.groupBy("g").cogroup(rest.join(sets, "node").groupBy("g"))
               .applyInArrow(link_between, "a binary, b binary"), "near-between")
    if more.count():
        links = comp.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
        comp = cut(components(links), "near-components")

    labels = nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    small = labels.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(small, "root").select("node", "component_id")
    out = rows.select("doc_id", "n", "node").join(labels, "node", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.cast("long").alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def minhash_sql() -> str:
    """Exact: every pair of documents that share a shingle."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {SHINGLE} THEN array_to_string(w, ' ')
             ELSE array_to_string(list_slice(w, i + 1, i + {SHINGLE}), ' ') END AS k
      FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - {SHINGLE - 1}))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a),
m AS (SELECT x, min(y) AS c FROM r GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = doc_id
"""
