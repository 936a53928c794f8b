"""A training-corpus pipeline of five operators: toxic documents go, one
document of each near-duplicate group stays, repeated passages are cut out, the
sources are mixed to target weights, and the texts are encoded.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
Between stages the rows are written as Parquet to the shared folder and read
back.

Defined results: rows with a NULL id or text, empty texts and repeated rows pass
as the operators define; of rows that share an id one stays (the smallest text, NULL last);
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starforge.llm.common import cut, table
from starforge.llm.minhash_dedup import minhash_dedup
from starforge.llm.mixing import mix_rows
from starforge.llm.sentencepiece_codec import encode_udf, load_vocabulary
from starforge.llm.suffix_dedup import suffix_dedup
from starforge.llm.toxicity import drop_toxic
from starforge.session import known_size

SHINGLE, PERCENT = 5, 80    # near copies: words of a shingle, least similarity of the sets
FEW = 100_000               # ids in no more rows than this are broadcast (16 bytes each)


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts meet only the ids that are dropped or repeated; repeated ids alone are sorted."""
    found = minhash_dedup(docs, shingle=SHINGLE, percent=PERCENT)
    odd = cut(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__odd")).agg(
        F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__n")).filter("not __kept or __n > 1"), "pipeline-ids")
    few = F.broadcast(odd) if known_size(odd).rows <= FEW else odd
    met = docs.join(few, docs["doc_id"] == F.col("__odd"), "left")
    twin = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text")))
    twins = met.filter("__kept").withColumn("__twin", twin).filter("__twin = 1")
    return met.filter("__odd is null").select(docs.columns).unionByName(twins.select(docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    marked = docs.withColumn("__null", docs["text"].isNull())
    out = suffix_dedup(marked, keep=[c for c in marked.columns if c != "text"], as_text=True)
    text = F.when(~F.col("rest.__null"), F.col("kept"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in names])


def mix_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = docs.select("doc_id", "lang", "source", encode_udf(load_vocabulary())("text").alias("ids"))
    return d.withColumn("n_pieces", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("suffix_array_dedup", cut_repeated_passages),
    ("mixing", mix_to_target_weights),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None       # the scores and the pieces are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{name}")
    return docs
