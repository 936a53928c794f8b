"""Extracts whose headers differ by file, and the parse audit."""

import gzip

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starforge.operators import ParseAudit
from starforge.plans import pipeline
from starforge.plans.silver import silver_contracts_12m
from starforge.sources import Layers, header_variants, read_csv_variants

SCHEMA = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("t", StringType())])


def _land(root, **files):
    for name, text in files.items():
        (root / name).mkdir()
        (root / name / "part-0.csv").write_text(text, encoding="utf-8")


def test_headers_that_differ(spark, tmp_path):
    _land(tmp_path, x_a="id;n;t\n1;5;a\n2;bad;b\n", x_b="﻿id;t\n3;c\n", x_c='"t;x";more;N ;ID\n"q;1";m;7;4\n',
          x_d="id;n;t\n", x_e="")
    with gzip.open(tmp_path / "x_f.csv.gz", "wt") as f:
        f.write("n;id;text\n9;6;z\n")
    df, variants = read_csv_variants(spark, str(tmp_path / "x_*"), SCHEMA, required=["id"], aliases={"text": "t"})
    assert df.dtypes == [("id", "string"), ("n", "int"), ("t", "string")]
    assert sorted(map(tuple, df.collect())) == [
        ("1", 5, "a"), ("2", None, "b"), ("3", None, "c"), ("4", 7, None), ("6", 9, "z")]
    by_missing = {v.missing: (len(v.files), v.extra) for v in variants}
    # the same header in two files is one scan
    assert len(variants) == 4 and {v.names: len(v.files) for v in variants}[("id", "n", "t")] == 2
    assert by_missing[("n", "t")[:1]] == (1, ()) and by_missing[("t",)] == (1, ("t;x", "more"))


def test_headers_that_cannot_be_read(spark, tmp_path):
    _land(tmp_path, a="n;t\n1;x\n")
    with pytest.raises(ValueError, match="no column"):
        read_csv_variants(spark, str(tmp_path / "a"), SCHEMA, required=["id"])
    _land(tmp_path, b="id;id\n1;2\n")
    with pytest.raises(ValueError, match="2 times"):
        header_variants(spark, str(tmp_path / "b"), SCHEMA)
    df, variants = read_csv_variants(spark, str(tmp_path / "none_*"), SCHEMA)
    assert df.count() == 0 and df.schema.names == SCHEMA.names and variants == []


def test_parse_audit_counts_text_that_became_null(spark, tmp_path):
    rows = [("1", "7.0", "1,5"), ("2", "x", "n/d"), ("3", None, ""), ("4", " ", "1.234,5"), ("5", "3", None)]
    bronze = spark.createDataFrame(
        rows, "CD_CLIENTE string, QTD_CONTRATACOES_12M string, VLR_CONTRATACOES_12M string")
    audit = ParseAudit()
    out = silver_contracts_12m(bronze, audit)
    assert out.columns == silver_contracts_12m(bronze).columns
    out.write.parquet(str(tmp_path / "out"))
    assert audit.failures() == {"qtd_contratacoes_12m": 1, "vlr_contratacoes_12m": 2}
    with pytest.raises(ValueError):
        silver_contracts_12m(bronze, audit)


def test_silver_jobs_report_unread_texts(spark, sf_small, tmp_path):
    layers = Layers(str(tmp_path / "lake"))
    pipeline.land_bronze(spark, sf_small, layers)
    report = pipeline.silver_job(spark, layers, "historico")
    assert report.unread["vl_desconto"] > 0 and report.unread["dt_upload"] > 0 and report.unread["qtd"] == 0
    assert pipeline.silver_job(spark, layers, "clientes").unread["vl_total_contrato"] > 0
