"""Parquet scans of the silver and gold layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starforge.sources.layers import Layers


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_layer(spark: SparkSession, layers: Layers, layer: str, entity: str,
               schema: StructType | None = None) -> DataFrame:
    """``read_layer(spark, Layers(root), 'silver', 'tickets')``."""
    return read_parquet(spark, layers.path(layer, entity), schema)
