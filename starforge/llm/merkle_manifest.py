"""Merkle manifest of a dataset, with a proof for every row.

A row's leaf is the SHA-256 of its fields; the leaves of a group (a source), in
order, are hashed ``FANOUT`` at a time up to a subroot, and the subroots likewise
to the root.

1. Leaves are numbered in one range-partitioned pass (``dense_key``); a group of
   any size is spread over many partitions.
2. Levels are built in aligned blocks of ``FANOUT ** BLOCK_LEVELS`` nodes, one
   small task group each; every node states its siblings below its parent.
3. Proofs by pointer jumping.  Every node holds a segment: the siblings on the
   way to an ancestor 2^r levels up.  A self-join appends the ancestor's own
   segment, which doubles the distance; after each round only nodes whose level
   is a multiple of it are still pointed at, so the inner side shrinks to the
   power.  Leaves meet the nodes of levels 1, 2, 4, ... until they are at their
   subroot, whose way to the root comes from the same steps over the subroots.

A node of level 2^r is joined by at most FANOUT^(2^r) leaves; the levels where
that is many have few nodes and are broadcast once their size is observed small.

Defined results: NULL fields count as ``-``; NULL groups form a group of their
own, first; NULL ids come first in their group; rows with the same id are ordered
by their leaf, repeated rows are interchangeable and keep a place each.  A text
is hashed whole, in the JVM, however long.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut
from starforge.operators.keys import dense_key
from starforge.session import known_size

FANOUT = 3
BLOCK_LEVELS = 6            # levels built by one task group: 729 nodes and fewer
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SMALL_ROWS, SMALL_BYTES = 5_000, 8 << 20         # a side within both is broadcast

NODES_SQL = "tree long, level int, idx long, n long, hash binary, left binary, right binary, payload struct<{payload}>"


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the fields, each ``-`` or its byte count, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def hex_of(c: Column) -> Column:
    return F.lower(F.hex(c))


def _block(levels: int, fanout: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        """The nodes of a block and of the levels above it, up to the block's top
        or the tree's; the last one stands for the block in the next pass."""
        g = g.sort_values("idx")
        tree, level, n = int(g["tree"].iloc[0]), int(g["level"].iloc[0]), int(g["n"].iloc[0])
        at, hashes, payload = int(g["idx"].iloc[0]), [bytes(h) for h in g["hash"]], list(g["payload"])
        out = []
        for _ in range(levels):
            if n == 1:
                break
            above = []
            for k in range(0, len(hashes), fanout):
                part = hashes[k:k + fanout]
                above.append(hashlib.sha256("".join(h.hex() for h in part).encode()).digest())
                out += [(tree, level, at + k + j, n, part[j], b"".join(part[:j]), b"".join(part[j + 1:]),
                         payload[k + j] if payload else None) for j in range(len(part))]
            level, n, at, hashes, payload = level + 1, -(-n // fanout), at // fanout, above, []
        out += [(tree, level, at, n, hashes[0], None, None, payload[0] if payload else None)]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "n", "hash", "left", "right", "payload"])
    return run


def build(leaves: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots) of a forest.  ``leaves``: tree, idx (0..n-1 in its tree), n
    (leaves of the tree), hash, payload (a struct that stays with the leaf)."""
    inner = leaves.schema["payload"].dataType.simpleString()[len("struct<"):-1]
    schema, width = NODES_SQL.format(payload=inner), fanout ** block_levels
    layer = leaves.withColumn("level", F.lit(0))
    done = []
    top = 0
    while True:
        block = F.floor(F.col("idx") / width) if width < 1 << 50 else F.lit(0)
        nodes = cut(layer.select("tree", "level", "idx", "n", "hash", "payload")
                    .groupBy("tree", block.cast("long").alias("block")).applyInPandas(
                        _block(block_levels, fanout), schema), "merkle")
        top += block_levels
        above = nodes.filter(F.col("left").isNull() & (F.col("n") > 1))      # a block's top, not yet the tree's
        done.append(nodes.filter(F.col("left").isNotNull() | (F.col("n") == 1)))
        if above.isEmpty():
            break
        layer = above
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    return nodes, nodes.filter("n = 1").select("tree", "hash", F.col("level").alias("depth"))


def jump(nodes: DataFrame, depth: int, fanout: int = FANOUT) -> DataFrame:
    """tree, hash, payload and ``way`` (array of siblings left, right from the leaf
    to its root) of every leaf.  ``depth``: the deepest tree's."""
    one = F.when(F.col("left").isNull(), F.array().cast("array<struct<left:binary,right:binary>>")).otherwise(
        F.array(F.struct("left", "right")))
    steps = nodes.withColumn("way", one).withColumn("to", F.col("level") + F.size("way")).withColumn(
        "up", F.when(F.size("way") > 0, F.floor(F.col("idx") / fanout)).otherwise(F.col("idx")).cast("long"))
    leaves = steps.filter("level = 0").select("tree", "hash", "payload", "way", "to", "up")
    pointers = steps.filter("level > 0").select("tree", "level", "idx", "way", "to", "up")
    distance = 1
    while distance < depth:
        here = F.col("level") % (2 * distance)
        ends = cut(pointers.filter(here == distance).select(
            F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), F.col("way").alias("w"),
            F.col("to").alias("t2"), F.col("up").alias("u2")), "merkle-way")
        row = 100 + distance * (32 * fanout + 64)       # bytes: a segment holds ``distance`` steps at most
        pointers = _doubled(pointers.filter(here == 0), hinted(ends, ends, row))
        leaves = _doubled(leaves, hinted(ends.filter(F.col("l") == distance), ends, row))
        distance *= 2
    return leaves


def _doubled(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Every row that points at one of ``ends`` takes over its segment and its end."""
    met = rows.join(ends, (F.col("tree") == F.col("t")) & (F.col("to") == F.col("l")) & (F.col("up") == F.col("i")), "left")
    new = {"way": F.when(F.col("w").isNull(), F.col("way")).otherwise(F.concat("way", "w")),
           "to": F.coalesce("t2", "to"), "up": F.coalesce("u2", "up")}
    return met.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns])


def hinted(df: DataFrame, written: DataFrame, row_bytes: int) -> DataFrame:
    """Hint ``df`` for broadcast if ``written``, of which it takes rows, was seen to
    be small when it was written."""
    size = known_size(written)
    fits = size is not None and size.rows <= SMALL_ROWS and size.rows * row_bytes + sum(
        size.text_bytes.values()) <= SMALL_BYTES
    return F.broadcast(df) if fits else df


def merkle_manifest(docs: DataFrame, fields: list[str] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
                    claimed: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root (hex), siblings (array of left, right: binary
    hashes beside the row's own way, from the leaf up), claimed_leaf: the leaf of
    the row with the columns ``claimed`` in place of its own, else of the row."""
    new = claimed or {}
    rows = docs.select(docs[group_col].cast("string").alias("grp"), docs[id_col].cast("long").alias("doc_id"),
                       F.unhex(leaf_hash([docs[c] for c in fields])).alias("hash"),
                       (F.unhex(leaf_hash([new.get(c, docs[c]) for c in fields])) if new else
                        F.lit(None).cast("binary")).alias("other"))
    # a claimed leaf equal to the row's own takes no room
    rows = rows.withColumn("other", F.when(F.col("other") != F.col("hash"), F.col("other")))
    placed = dense_key(rows, "place", order_by=["grp", "doc_id", "hash"])
    groups = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = cut(dense_key(groups, "tree", order_by=["grp"], unique=True), "merkle-groups")
    one = hinted(groups.select(F.col("grp").alias("g"), "tree", "first", "n"), groups, 64)
    known = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    leaves = placed.join(one, F.col("grp").eqNullSafe(F.col("g"))).select(
        "tree", (F.col("place") - F.col("first")).alias("idx"), "n", "hash", F.struct("doc_id", "other").alias("payload"))
    nodes, subroots = build(leaves, fanout)
    inside = jump(nodes, levels(known[0] or 0, fanout), fanout)

    upper = subroots.select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"),
                            F.lit(known[1]).cast("long").alias("n"), "hash", F.struct("tree").alias("payload"))
    nodes, roots = build(upper, fanout)
    root = roots.first()
    deep = levels(known[1], fanout)
    above = cut(jump(nodes, deep, fanout).select(
        F.col("payload.tree").alias("of"), F.col("hash").alias("sub"), F.col("way").alias("above")), "merkle-above")
    return inside.join(hinted(above, above, 100 + deep * (32 * fanout + 64)), F.col("tree") == F.col("of")).select(
        F.col("payload.doc_id").alias("doc_id"), hex_of(F.col("hash")).alias("leaf"), hex_of(F.col("sub")).alias("subroot"),
        F.lit(root["hash"].hex() if root else None).alias("root"), F.concat("way", "above").alias("siblings"),
        hex_of(F.coalesce("payload.other", "hash")).alias("claimed_leaf"))


def levels(n: int, fanout: int = FANOUT) -> int:
    """Levels above ``n`` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf (hex) and its siblings give."""
    return F.aggregate(siblings, leaf, lambda acc, s: F.sha2(F.concat(hex_of(s["left"]), acc, hex_of(s["right"])), 256))


def proof_text(siblings: Column) -> Column:
    """All siblings as hex, level by level, left to right."""
    return F.array_join(F.transform(siblings, lambda s: hex_of(F.concat(s["left"], s["right"]))), "")


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest checked against rows of which every second loses its line
    breaks (those with an even CRC-32 of the id): doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified."""
    even = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tampered = F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    m = merkle_manifest(docs, claimed={"text": tampered})
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("siblings")), 256).alias("proof_sha256"),
                    folded(F.col("claimed_leaf"), F.col("siblings")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def manifest_sql() -> str:
    """The same rows in DuckDB: the levels of a tree as lists."""
    up = ("list_transform(range(0, (len(h) + 2) // 3), lambda i: sha256("
          "list_aggregate(h[3 * i + 1:3 * i + 3], 'string_agg', '')))")
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"     # noqa: E731
    fields = lambda text: " || ".join(field(text if c == "text" else c) for c in FIELDS)                # noqa: E731
    return f"""
WITH RECURSIVE
rowed AS (SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text FROM documents),
crc_table(b, c) AS (
  SELECT i, list_reduce(list_prepend(CAST(i AS UINTEGER), range(8)::UINTEGER[]),
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UINTEGER) ELSE a >> 1 END)
  FROM (SELECT unnest(range(256)) AS i)),
table_list AS (SELECT list(c ORDER BY b) AS t FROM crc_table),
hashed AS (
  SELECT r, doc_id, source, sha256({fields("text")}) AS leaf,
         sha256({fields("replace(text, chr(10), '')")}) AS cut_leaf,
         xor(4294967295::UINTEGER, list_reduce(list_prepend(4294967295::UINTEGER,
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::UINTEGER)),
           lambda a, d: xor(a >> 8, t[CAST(xor(a, d) % 256 AS INTEGER) + 1]))) % 2 = 0 AS even
  FROM rowed, table_list),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM hashed),
sub(source, level, h) AS (
  SELECT source, 0, list(leaf ORDER BY i) FROM placed GROUP BY source
  UNION ALL SELECT source, level + 1, {up} FROM sub WHERE len(h) > 1),
subroot AS (SELECT source, h[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i
            FROM sub WHERE len(h) = 1),
above(level, h) AS (
  SELECT 0, list(subroot ORDER BY i) FROM subroot
  UNION ALL SELECT level + 1, {up} FROM above WHERE len(h) > 1),
way(r, source, level, i, top, node, bad, proof) AS (
  SELECT r, source, 0, i, 0, leaf, CASE WHEN even THEN cut_leaf ELSE leaf END, '' FROM placed
  UNION ALL
  SELECT r, source, CASE WHEN last THEN 0 ELSE level + 1 END,
         CASE WHEN last THEN pos ELSE i // 3 END, CASE WHEN last THEN top + 1 ELSE top END,
         CASE WHEN last THEN node ELSE sha256(l || node || g) END,
         CASE WHEN last THEN bad ELSE sha256(l || bad || g) END, CASE WHEN last THEN proof ELSE proof || l || g END
  FROM (
    SELECT w.*, len(x.h) = 1 AS last, s.i AS pos,
           coalesce(list_aggregate(x.h[3 * (w.i // 3) + 1:w.i], 'string_agg', ''), '') AS l,
           coalesce(list_aggregate(x.h[w.i + 2:3 * (w.i // 3) + 3], 'string_agg', ''), '') AS g
    FROM way w JOIN subroot s ON w.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT source, level, 0 AS top, h FROM sub
          UNION ALL SELECT s2.source, a.level, 1, a.h FROM above a, subroot s2) x
      ON x.source IS NOT DISTINCT FROM w.source AND x.level = w.level AND x.top = w.top
    WHERE w.top < 2))
SELECT p.doc_id, p.leaf, s.subroot, a.h[1] AS root, sha256(w.proof) AS proof_sha256, w.bad AS folded_root,
       w.bad = a.h[1] AS verified
FROM way w JOIN placed p USING (r) JOIN subroot s ON p.source IS NOT DISTINCT FROM s.source
CROSS JOIN above a WHERE w.top = 2 AND len(a.h) = 1
"""
