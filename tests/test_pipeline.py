"""The medallion run end to end: landed text -> silver -> gold, matching
the oracle, with stable keys on a rerun."""

from starforge import oracle as O
from starforge.compare import compare
from starforge.plans import pipeline
from starforge.sources import Layers

GOLD = [("dim_tempo", "g_dim_time"), ("dim_cliente", "g_dim_client"),
        ("dim_produto", "g_dim_product"), ("dim_prioridade", "g_dim_priority"),
        ("dim_ticket", "g_dim_ticket"), ("fato_contratacoes", "g_fact_contracts"),
        ("fato_tickets", "g_fact_tickets"), ("fato_nps", "g_fact_nps")]


def test_pipeline_gold_matches_oracle_and_is_stable(spark, con, sf_small, tmp_path):
    layers = Layers(str(tmp_path / "lake"))
    reports = pipeline.run_all(spark, sf_small, layers)
    assert all(r.seconds >= 0 for r in reports)
    by_step = {r.step: r for r in reports}
    assert by_step["gold:fato_contratacoes"].rows == pipeline.gold(
        spark, layers, "fato_contratacoes").count()
    for table, cte in GOLD:
        res = compare(pipeline.gold(spark, layers, table), con, O.select_all(cte))
        assert res["values_match"] and res["rows_match"], (table, res)
    first = sorted(tuple(r) for r in pipeline.gold(spark, layers, "fato_tickets").collect())
    pipeline.run_gold(spark, layers)
    again = sorted(tuple(r) for r in pipeline.gold(spark, layers, "fato_tickets").collect())
    assert first == again


def test_calendar_all_dates_keeps_every_survey_answer(spark, sf_small, tmp_path):
    layers = Layers(str(tmp_path / "lake2"))
    pipeline.land_bronze(spark, sf_small, layers)
    pipeline.run_silver(spark, layers)
    pipeline.dim_job(spark, layers, "dim_tempo", calendar_all_dates=True)
    cal = pipeline.gold(spark, layers, "dim_tempo")
    for e in pipeline.SURVEY_ENTITIES:
        dates = pipeline.silver(spark, layers, e).select("dt_resposta").dropna().distinct()
        assert dates.join(cal, dates.dt_resposta == cal.DATA, "left_anti").count() == 0


def test_fact_reports_count_dropped_rows(spark, sf_small, tmp_path):
    layers = Layers(str(tmp_path / "lake3"))
    pipeline.run_all(spark, sf_small, layers)
    r = pipeline.fact_job(spark, layers, "fato_contratacoes")
    hist = pipeline.silver(spark, layers, "historico").count()
    assert r.input_rows == hist and r.rows + r.dropped == hist
    assert r.dropped > 0          # the unparseable upload dates miss the calendar


def test_run_leaves_no_scratch_and_dimensions_can_be_appended(spark, sf_small, tmp_path):
    import os
    from starforge.session import scratch_path
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    layers = Layers(str(tmp_path / "lake4"))
    pipeline.run_all(spark, sf_small, layers)
    assert set(os.listdir(folder)) <= before
    n = pipeline.gold(spark, layers, "dim_ticket").count()
    pipeline.dim_job(spark, layers, "dim_ticket", parquet_mode="append")
    assert pipeline.gold(spark, layers, "dim_ticket").count() == 2 * n
    # the calendar's files are sorted by their key
    keys = spark.read.parquet(layers.gold("dim_tempo")).coalesce(1).select("SK_TEMPO", "_metadata.file_path").collect()
    for f in {r.file_path for r in keys}:
        mine = [r.SK_TEMPO for r in keys if r.file_path == f]
        assert mine == sorted(mine)
