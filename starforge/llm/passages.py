"""What the two passage operators share: texts packed into chunks, and the
search for fingerprints that occur in more than one place.

A chunk is one row with about ``CHUNK_BYTES`` of whole texts, compressed.  Work
on a chunk is vectorised over all its texts, and whatever repeats inside a
chunk is settled there: to the rest of the corpus a chunk states each
fingerprint once, so a passage shared by a third of all documents costs one
entry per chunk, not one per document.

Fingerprints travel packed, four bytes each, in one row per chunk and bucket;
the chunk can tell from its own order which entry a reply means.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut, release_memory

CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20      # text per bucket, about
NO_ID = np.iinfo(np.int64).max      # rows without an id come last
CODE_BITS = 31

CHUNK_SCHEMA = "chunk long, n_bytes long, ids binary, lengths binary, blob binary, rest binary"


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def pack(docs: DataFrame, name: str, keep: list[str] = (), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Write the texts as chunks to the shared folder.  Columns named in
    ``keep`` travel along, packed, and come back with the result."""
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                    F.struct(F.lit(0).alias("_"), *[docs[c].alias(c) for c in keep]).alias("rest"))

    def chunks(batches):
        import zstandard
        from pyspark import TaskContext
        squeeze = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush():
            nonlocal number, held, size
            t = pa.Table.from_batches(held).combine_chunks()
            texts = [x.encode() if x is not None else b"" for x in t.column("text").to_pylist()]
            ids = np.array([NO_ID if x is None else x for x in t.column("doc_id").to_pylist()], np.int64)
            rest = t.column("rest").combine_chunks()
            rest = pa.RecordBatch.from_arrays(rest.flatten(), [f.name for f in rest.type])
            row = {"chunk": number, "n_bytes": size, "ids": ids.tobytes(),
                   "lengths": np.array([len(x) for x in texts], np.int64).tobytes(),
                   "blob": squeeze(b"".join(texts)), "rest": squeeze(_ipc(rest))}
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_pylist([row], schema=OUT)

        for b in batches:
            sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0))
            start, run = 0, 0
            for i, s in enumerate(sizes):
                run += int(s)
                if size + run >= CHUNK_BYTES:
                    held.append(b.slice(start, i + 1 - start))
                    size += run
                    start, run = i + 1, 0
                    yield flush()
            if start < b.num_rows:
                held.append(b.slice(start))
                size += run
        if held:
            yield flush()
        release_memory()

    import pyarrow.compute  # noqa: F401  (pa.compute)
    OUT = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()),
                     ("lengths", pa.binary()), ("blob", pa.binary()), ("rest", pa.binary())])
    return cut(d.mapInArrow(chunks, CHUNK_SCHEMA), name)


def n_buckets(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return int(max(16, -(-total // BUCKET_BYTES)))


class Chunk:
    """The texts of a chunk row as one byte array."""

    def __init__(self, row: dict):
        import zstandard
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.blob = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=int(row["n_bytes"]) or 1)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.bytes = np.frombuffer(self.blob, np.uint8)
        self._rest = row["rest"]

    def rest(self) -> pa.Table:
        import zstandard
        return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompressobj().decompress(self._rest)).read_all()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit hashes (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket from the upper half of sorted hashes: non-decreasing."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


ENTRIES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])
ENTRIES_SQL = "bucket int, chunk long, data binary"


def coded(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of different hashes by bucket and code, first place of each bucket
    in it, and the codes.  Ascending codes compress in byte planes."""
    home, code = bucket_of(h, buckets), (h & np.uint64((1 << CODE_BITS) - 1)).astype(np.uint32)
    order = np.argsort((home << 32) | code)
    return order, np.searchsorted(home, np.arange(buckets + 1)), code[order]


def state_codes(chunks: DataFrame, fingerprints, buckets: int) -> DataFrame:
    """One row per chunk and bucket with the codes of the chunk's different
    fingerprints.  ``fingerprints(chunk)`` gives sorted unique 64-bit hashes
    and whether each may be an anchor."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                c = Chunk(row)
                h, anchor = fingerprints(c)
                order, at, code = coded(h, buckets)
                code = (anchor[order] << np.uint32(31)) | code
                full = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([c.number] * len(full), pa.int64()),
                     pa.array([code[at[k]:at[k + 1]].view(np.uint8).reshape(-1, 4).T.tobytes()
                               for k in full], pa.binary())], schema=ENTRIES)
        release_memory()
    return chunks.mapInArrow(run, ENTRIES_SQL)


def find_repeats(codes: DataFrame, hot: int) -> DataFrame:
    """Per chunk and bucket, which of its entries occur in other chunks too
    (and are an anchor somewhere): places with 1, or 2 where more than ``hot``
    chunks share the code."""
    def run(t: pa.Table) -> pa.Table:
        data = t.column("data").to_pylist()
        sizes = np.array([len(x) // 4 for x in data], np.int64)
        raw = np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T) for x in data])
        raw = raw.reshape(-1).view(np.uint32)
        code = raw & np.uint32((1 << CODE_BITS) - 1)
        order = np.argsort(code, kind="stable")
        s = code[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        n = np.diff(np.append(first, len(s)))
        anchor = np.maximum.reduceat(raw[order] >> np.uint32(31), first)
        mark = np.where((n > 1) & (anchor > 0), np.where(n > hot, 2, 1), 0).astype(np.uint8)
        marks = np.empty(len(s), np.uint8)
        marks[order] = np.repeat(mark, n)
        out, at = [], np.append(0, np.cumsum(sizes))
        for i in range(len(data)):
            m = marks[at[i]:at[i + 1]]
            k = np.flatnonzero(m)
            if len(k):
                out.append((t.column("bucket")[i].as_py(), t.column("chunk")[i].as_py(),
                            k.astype(np.uint32).tobytes() + m[k].tobytes()))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, ENTRIES)], schema=ENTRIES)
    return codes.groupBy("bucket").applyInArrow(run, ENTRIES_SQL)


def marks_of(h: np.ndarray, replies: pa.Table, buckets: int) -> np.ndarray:
    """The replies of :func:`find_repeats` laid over the chunk's own ``h``."""
    order, at, _ = coded(h, buckets)
    out = np.zeros(len(h), np.uint8)
    for bucket, data in zip(replies.column("bucket").to_pylist(), replies.column("data").to_pylist()):
        n = len(data) // 5
        k = np.frombuffer(data[:4 * n], np.uint32)
        out[order[at[bucket] + k.astype(np.int64)]] = np.frombuffer(data[4 * n:], np.uint8)
    return out


def with_chunks(chunks: DataFrame, rows: DataFrame, run, schema) -> DataFrame:
    """``run(chunk, replies)`` for every chunk, with the rows sent to it."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(Chunk(left.to_pylist()[0]), right)
    return (chunks.groupBy("chunk").cogroup(rows.groupBy("chunk"))).applyInArrow(both, schema)


def entries_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, ENTRIES)], schema=ENTRIES)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cover(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Mask of the places covered by windows of ``width`` at ``starts``."""
    d = np.zeros(size + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + width, -1)
    return np.cumsum(d[:-1]) > 0


def result_schema(docs: DataFrame, keep: list[str], columns: str) -> str:
    inner = ", ".join(["_: int", *[f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep]])
    return f"doc_id long, {columns}, rest struct<{inner}>"


def result_table(c: Chunk, columns: dict[str, pa.Array]) -> pa.Table:
    rest = c.rest().combine_chunks()
    packed = pa.StructArray.from_arrays([rest.column(i).combine_chunks() for i in range(rest.num_columns)],
                                        rest.column_names)
    ids = pa.array(c.ids, mask=c.ids == NO_ID)
    return pa.table({"doc_id": ids, **columns, "rest": packed})
