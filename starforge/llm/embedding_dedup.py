"""Embedding near-dedup on a robust-pruned flat graph.

* *Shards*: centroids fitted on a bounded sample (``SAMPLE`` vectors); every
  vector is a member of its ``OVERLAP`` nearest ones, so near vectors share a
  shard.  A shard over ``PART_ROWS`` members is dealt into parts by hash.
* *Build*: in a part each vector takes its nearest vectors and some drawn at
  random as candidates and keeps those that robust pruning (``ALPHA``) leaves,
  ``DEGREE`` at most.
* *Union*: the adjacency lists a vector got in its shards are united.
* *Search*: a vector is searched in its own shards and as a visitor in every
  other one whose centroid lies within twice the angle of a link: whatever links
  with it and lies within that angle of its nearest centroid is a member of one
  of them.  Vectors of a sparse region visit none, those of a dense group the
  shards of the group.  Each part is searched from the medoid, some fixed members
  and the vector's own place in the graph (itself and its neighbours there): a
  greedy beam until no closer vector turns up, then range expansion: every vector
  found with a cosine of ``EXPAND`` or more has its neighbours looked at, until
  none is new.
* *Verification*: cosines in double precision decide; a link is counted once, for
  both ends: in the first shard that has one end as a member and searches the other,
  between two parts of it in the task that a bit of the two vectors' hashes names.

Equal vectors are one node with a weight.  A task searches one part for one block
of queries (about ``PART_ROWS`` each), counts their links and joins them to
components there; no task holds more than a part and a block, whatever the size
of a group or shard, and no pairs leave it.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components link with nothing; shorter vectors count as filled with zeros; rows
that repeat an id with the same vector count once; NULL ids are kept with a
NULL component and link with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut
from starforge.llm.components import components

COSINE = 0.95
SAMPLE, SHARD_ROWS, MAX_SHARDS, OVERLAP = 16_384, 400, 2048, 3
PART_ROWS = 2048
NEAR, RANDOM, DEGREE, FAR, ALPHA = 32, 32, 16, 4, 1.2
BEAM, EXPAND, ENTRIES = 8, 0.90, 32
QUERIES, VISIT_ROWS = 512, 20_000   # searched in step; rows dealt out at a time
AUDIT_ROWS = 4096                   # queries of the audit held at a time, about
SEED = 5


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors (double) of equally long packed vectors, scaled by their
    largest component first: squares of finite numbers may leave the range."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    r = np.random.default_rng(SEED)
    c = x[np.sort(r.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(norm > 0, total / np.maximum(norm, 1e-300), c)
    return c


def robust_prune(x: np.ndarray, near: int = NEAR, random: int = RANDOM, degree: int = DEGREE,
                 far: int = FAR, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of every vector: from its nearest and some random vectors,
    the closest first, dropping those closer to a neighbour taken already (by
    ``alpha``) than to the vector."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64) for _ in range(n)]
    r = np.random.default_rng(SEED)
    near = min(near, n - 1)
    dist = np.maximum(0, 1 - x.astype(np.float32) @ x.T.astype(np.float32))
    np.fill_diagonal(dist, np.inf)
    cand = np.argpartition(dist, near - 1, axis=1)[:, :near]
    close = _prune(dist, cand, degree - far, alpha)
    # some of the random ones stay whatever the near ones: ways between clusters
    wide = _prune(dist, r.integers(0, n, (n, random)), far, alpha)
    return [np.unique(a + b).astype(np.int64) for a, b in zip(close, wide)]


def _prune(dist: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> list[list[int]]:
    n = len(dist)
    d = dist[np.arange(n)[:, None], cand]
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    alive = np.isfinite(d)
    out = [[] for _ in range(n)]
    for _ in range(degree):
        some = np.flatnonzero(alive.any(1))
        if not len(some):
            break
        first = alive[some].argmax(1)
        p = cand[some, first]
        for i, v in zip(some.tolist(), p.tolist()):
            out[i].append(v)
        between = dist[p[:, None], cand[some]]
        between[cand[some] == p[:, None]] = 0           # the diagonal of dist is infinite
        alive[some] &= alpha * between > d[some]
        alive[some, first] = False
    return out


def range_search(x: np.ndarray, adjacency: list[np.ndarray], q: np.ndarray,
                 own: list[np.ndarray], cosine: float = COSINE, beam: int = BEAM,
                 expand: float = EXPAND) -> np.ndarray:
    """(queries, vectors) whether a vector was looked at and has a cosine of
    ``cosine`` or more: greedy beam from the medoid, ``ENTRIES`` fixed vectors
    and the vectors ``own`` of each query (without repeats), then range
    expansion."""
    n, m = len(x), len(q)
    expand = min(expand, cosine)
    width = max((len(a) for a in adjacency), default=0)
    table = np.full((n, max(1, width)), -1, np.int64)
    for i, a in enumerate(adjacency):
        table[i, :len(a)] = a
    cos = np.full((m, n), -np.inf, np.float32)
    exact = np.zeros((m, n), bool)

    def look(i, j):
        if 8 * len(i) > m * n:      # many: as one product
            c = (q @ x.T)[i, j]
            cos[i, j], exact[i, j] = c, c >= cosine
            return
        for a in range(0, len(i), 50_000):
            s = slice(a, a + 50_000)
            c = np.einsum("ij,ij->i", q[i[s]], x[j[s]])
            cos[i[s], j[s]] = c
            exact[i[s], j[s]] = c >= cosine

    medoid = int((x @ x.mean(0)).argmax())
    every = np.arange(m)
    entries = np.unique(np.append(np.arange(0, n, -(-n // ENTRIES)), medoid))
    look(np.repeat(every, len(entries)), np.tile(entries, m))
    i, j = np.repeat(every, [len(o) for o in own]), np.concatenate(own) if m else every
    fresh = ~np.isin(j, entries)
    look(i[fresh], j[fresh])
    done = np.zeros((m, n), bool)
    active = every
    while len(active):                                  # greedy beam, all queries in step
        open_cos = np.where(done[active], -np.inf, cos[active])
        best = open_cos.argmax(1)
        top = open_cos[np.arange(len(active)), best]
        bar = np.partition(cos[active], n - beam, axis=1)[:, n - beam] if n > beam else np.full(len(active), -np.inf)
        go = np.isfinite(top) & (top >= bar)
        active, best = active[go], best[go]
        done[active, best] = True
        i, j = np.repeat(active, table.shape[1]), table[best].ravel()
        fresh = j >= 0
        fresh[fresh] = np.isneginf(cos[i[fresh], j[fresh]])
        look(i[fresh], j[fresh])
    link = np.zeros((n, n), np.float32)
    for i, a in enumerate(adjacency):
        link[i, a] = 1
    while True:                                         # range expansion, all frontiers at once
        front = (cos >= expand) & ~done
        some = np.flatnonzero(front.any(1))
        if not len(some):
            break
        reach = front[some].astype(np.float32) @ link > 0
        done |= front
        i, j = np.nonzero(reach & np.isneginf(cos[some]))
        look(some[i], j)
    return exact


def hit_roots(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest column of the component of each row (the number of columns
    for rows without hits) and of each column."""
    n = hit.shape[1]
    root = np.arange(n, dtype=np.int32)
    while True:
        of_rows = np.where(hit, root, np.int32(n)).min(1, initial=n)
        new = np.minimum(root, np.where(hit, of_rows[:, None], np.int32(n)).min(0, initial=n))
        new = new[new]
        if (new == root).all():
            return of_rows, root
        root = new


def weighted(hit: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The weights of the columns hit, summed for every row."""
    out = np.zeros(len(hit), np.int64)
    for s in range(0, len(hit), QUERIES):
        out[s:s + QUERIES] = hit[s:s + QUERIES] @ w
    return out


def blocks_of(dealt: DataFrame) -> DataFrame:
    """``dealt`` with the parts of each shard, the blocks of its visitors
    (``more``) and each row's own block: a part's members are the block of the
    same number, visitors fill the blocks after them."""
    rows = [F.ceil(F.sum(c.cast("int")) / PART_ROWS).cast("int") for c in (F.col("member"), ~F.col("member"))]
    sizes = dealt.groupBy("shard").agg(F.greatest(F.lit(1), rows[0]).alias("parts"), rows[1].alias("more"))
    dealt = dealt.join(F.broadcast(sizes), "shard")         # MAX_SHARDS rows at most
    home, guest = (F.pmod(F.hash("node"), F.greatest(F.lit(1), F.col(c))) for c in ("parts", "more"))
    return dealt.withColumn("own", F.when(F.col("member"), home).otherwise(F.col("parts") + guest))


def search_tasks(dealt: DataFrame, graph: DataFrame) -> DataFrame:
    """The rows of each task (shard, part, block): the part's members, and the
    block's vectors as queries."""
    asked = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda p: F.struct(p.alias("part"), F.col("own").alias("block")))
    held = F.transform(F.sequence(F.lit(0), F.col("parts") + F.col("more") - 1),
                       lambda k: F.struct(F.col("own").alias("part"), k.alias("block")))
    tasks = F.when(F.col("member"), F.array_distinct(F.concat(asked, held))).otherwise(asked)
    return (dealt.filter("member").join(graph, "node")
            .unionByName(dealt.filter("not member").withColumn("near", F.lit(None).cast("array<binary>")))
            .withColumn("task", F.explode(tasks))
            .select("node", "w", "raw", "shard", "shards", "seen", "member", "own", "near", "task.*"))


FOUND = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])


def packed_rows(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, raw: the vector's doubles as bytes, NULL where it cannot link)
    of every row, and the longest vector's length."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"),
                       vectors[vector_col].cast("array<double>").alias("v"))
    dim = v.agg(F.max(F.size("v"))).first()[0] or 1
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda c: c != 0)

    def packed(batches):
        for b in batches:
            raw = [None if not ok else np.pad(np.asarray(x, np.float64), (0, dim - len(x))).tobytes()
                   for x, ok in zip(b.column("v").to_pylist(), b.column("ok").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(raw, pa.binary())],
                                             names=["vec_id", "raw"])

    rows = v.select("vec_id", "v", F.coalesce(good & F.col("vec_id").isNotNull(), F.lit(False)).alias("ok"))
    return rows.mapInArrow(packed, "vec_id long, raw binary"), dim


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows, dim = packed_rows(vectors, id_col, vector_col)
    rows = cut(rows.withColumn("node", F.unhex(F.md5("raw"))), "vec-rows")
    nodes = (rows.filter("raw is not null").select("node", "vec_id", "raw").distinct()
             .groupBy("node").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("w"),
                                  F.first("raw").alias("raw")))
    nodes = cut(nodes, "vec-nodes")
    n = nodes.count()
    sample = nodes.select("node", "raw").orderBy("node").limit(SAMPLE).toPandas()
    if n:
        centroids = fit_centroids(unit([bytes(x) for x in sample["raw"]], dim),
                                  min(MAX_SHARDS, max(1, -(-n // SHARD_ROWS))))
    else:
        centroids = np.zeros((1, dim))
    overlap = min(OVERLAP, len(centroids))
    visit = np.cos(min(np.pi, 2 * np.arccos(np.clip(cosine, -1, 1))))

    def assign(batches):
        for b in (whole.slice(k, QUERIES) for whole in batches for k in range(0, whole.num_rows, QUERIES)):
            c = unit(b.column("raw").to_pylist(), dim) @ centroids.T
            near = np.sort(np.argsort(-c, axis=1, kind="stable")[:, :overlap], axis=1)
            member = np.zeros(c.shape, bool)
            np.put_along_axis(member, near, True, 1)
            seen = member | (c >= visit)
            i, shard = np.nonzero(seen)
            bits = pa.array([x.tobytes() for x in np.packbits(seen, axis=1)], pa.binary())
            shards = pa.array(near.tolist(), pa.list_(pa.int32()))
            for k in range(0, len(i), VISIT_ROWS):
                s = slice(k, k + VISIT_ROWS)
                at = pa.array(i[s])
                yield pa.RecordBatch.from_arrays(
                    [b.column(x).take(at) for x in ("node", "w", "raw")]
                    + [pa.array(shard[s], pa.int32()), shards.take(at), bits.take(at),
                       pa.array(member[i[s], shard[s]])],
                    names=["node", "w", "raw", "shard", "shards", "seen", "member"])

    dealt = nodes.select("node", "w", "raw").mapInArrow(
        assign, "node binary, w long, raw binary, shard int, shards array<int>, seen binary, member boolean")
    dealt = cut(dealt, "vec-shards")
    dealt = blocks_of(dealt)

    def build(t: pa.Table) -> pa.Table:
        ids = np.array(t.column("node").to_pylist(), object)
        lists = robust_prune(unit(t.column("raw").to_pylist(), dim))
        return pa.table({"node": pa.array(ids.tolist(), pa.binary()),
                         "near": pa.array([ids[a].tolist() for a in lists], pa.list_(pa.binary()))})

    graph = (dealt.filter("member").groupBy("shard", "own").applyInArrow(build, "node binary, near array<binary>")
             .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    graph = cut(graph, "vec-graph")
    queries = search_tasks(dealt, graph)

    def search(t: pa.Table) -> pa.Table:
        ids = t.column("node").to_pylist()
        own_block = t.column("own").to_numpy()
        here, part, block = (t.column(c)[0].as_py() for c in ("shard", "part", "block"))
        inside = np.flatnonzero((own_block == part) & t.column("member").to_numpy(zero_copy_only=False))
        asking = np.flatnonzero(own_block == block)
        if not len(asking):
            return FOUND.empty_table()
        raw = unit(t.column("raw").to_pylist(), dim)
        x, w = raw[inside], t.column("w").to_numpy()
        place = {ids[k]: i for i, k in enumerate(inside)}
        near = t.column("near").to_pylist()
        lists = [np.array([place[v] for v in near[k] if v in place], np.int64) for k in inside]
        hit = np.zeros((len(asking), len(inside)), bool)
        for s in range(0, len(asking) if len(inside) else 0, QUERIES):
            rows = asking[s:s + QUERIES]
            own = [np.array(sorted({place[v] for v in [*(near[k] or []), ids[k]] if v in place}), np.int64)
                   for k in rows]
            hit[s:s + QUERIES] = range_search(x, lists, raw[rows], own, cosine)
        if part == block:                                           # found from either side
            hit |= hit.T
            np.fill_diagonal(hit, False)
        of_rows, root = hit_roots(hit)
        # a link is counted in the first shard that has one end as a member and
        # searches the other, between two parts in one of their two tasks
        if part != block and t.column("member")[int(asking[0])].as_py():
            bit = np.array([v[0] & 1 for v in ids], np.uint8)
            hit &= (bit[asking][:, None] ^ bit[inside]) == (part < block)
        for near_rows, far_rows, of_near in ((inside, asking, hit.T), (asking, inside, hit)):
            shards = np.array(t.column("shards").take(pa.array(near_rows)).to_pylist(),
                              np.int64).reshape(len(near_rows), overlap)
            bits = b"".join(t.column("seen").take(pa.array(far_rows)).to_pylist())
            seen = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(len(far_rows), -1), axis=1).astype(bool)
            for k in range(overlap if len(far_rows) else 0):
                early = shards[:, k] < here
                of_near[early] &= ~seen[:, shards[early, k]].T
        links = weighted(hit, w[inside])
        back = weighted(hit.T, w[asking]) if part != block else np.zeros(len(inside), np.int64)
        name = [ids[k] for k in inside] + [None]
        told = np.flatnonzero((root != np.arange(len(inside))) | (back > 0))
        nodes = [ids[k] for k in asking] + [name[k] for k in told]
        roots = [name[r] or ids[k] for k, r in zip(asking, of_rows)] + [name[root[k]] for k in told]
        links = np.concatenate([links, back[told]])
        return pa.table([pa.array(nodes, pa.binary()), pa.array(links, pa.int64()),
                         pa.array(roots, pa.binary())], schema=FOUND)

    found = cut(queries.groupBy("shard", "part", "block")
                .applyInArrow(search, "node binary, links long, root binary"), "vec-found")
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    labels = nodes.select("node", "first", "w").join(comp, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    low = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = labels.join(low, "root").join(count, "node").select(
        "node", "component_id", (F.col("links") + F.col("w") - 1).alias("n_links"))
    out = rows.select("vec_id", "node").join(labels, "node", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, every: int = 50, cosine: float = COSINE,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[int, int]:
    """(links found, links there are) of all vectors whose id is divisible by
    ``every``, by brute force against all vectors, ``AUDIT_ROWS`` queries at a
    time.  The operator verifies every link, so found ones are true ones; vectors
    that cannot link are left out."""
    rows, dim = packed_rows(vectors, id_col, vector_col)
    rows = cut(rows.filter("raw is not null").distinct(), "vec-audit")
    asked = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-2 * asked.count() // AUDIT_ROWS))
    found = there = 0
    for k in range(blocks):
        of_block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k
        some = asked.filter(of_block).toPandas()
        if not len(some):
            continue
        ids, q = some["vec_id"].tolist(), unit([bytes(x) for x in some["raw"]], dim)

        def count(batches):
            total = np.zeros(len(ids), np.int64)
            for b in batches:
                if len(b):
                    total += ((q @ unit([bytes(x) for x in b["raw"]], dim).T) >= cosine).sum(1)
            yield pd.DataFrame({"vec_id": ids, "n": total})

        true = rows.mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
        mine = result.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
        r = true.join(mine, "vec_id").agg(F.sum(F.least("n", "n_links")), F.sum("n")).first()
        found, there = found + int(r[0] or 0), there + int(r[1] or 0)
    return found, there
