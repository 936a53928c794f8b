"""The bronze extracts derived from the test tables really contain the odd
and bad text forms the parsers must handle, and the parsers turn exactly
the bad ones into NULL."""

from pyspark.sql import functions as F

from starforge.plans.silver import SILVER_JOBS
from starforge.sources import fixtures


def _count(df, cond):
    return df.filter(cond).count()


def test_bad_and_odd_forms_are_present_and_parsed(spark, sf_small):
    b = {e: fixtures.bronze(spark, sf_small, e) for e in fixtures.BUILDERS}
    s = {e: job(b[src]) for e, (src, job) in SILVER_JOBS.items()}

    thousands = F.col("VL_TOTAL_CONTRATO").rlike(r"^\d+\.\d{3},\d{2}$")
    n_thousands = _count(b["dados_clientes"], thousands)
    assert n_thousands > 0
    assert _count(s["clientes"], F.col("vl_total_contrato").isNull()) == n_thousands

    n_nd = _count(b["historico"], F.col("VL_DESCONTO") == "n/d")
    assert n_nd > 0 and _count(s["historico"], F.col("vl_desconto").isNull()) == n_nd
    n_timed = _count(b["historico"], F.col("DT_UPLOAD").contains(" "))
    assert n_timed > 0 and _count(s["historico"], F.col("dt_upload").isNull()) == n_timed

    acq = "nps_transacional_aquisicao"
    assert _count(b[acq], F.col("`Nota NPS`").endswith(".0")) > 0
    assert _count(s[acq], F.col("nota_nps").isNull()) == 0

    prod = "nps_transacional_produto"
    h24 = F.col("`Data da Resposta`").rlike(r" (1[3-9]|2[0-3]):\d\d:\d\d PM$")
    assert _count(b[prod], h24) > 0
    n_bad = _count(b[prod], F.col("`Data da Resposta`") == "bad")
    assert n_bad > 0 and _count(s[prod], F.col("dt_resposta").isNull()) == n_bad

    rel = "nps_relacional"
    assert _count(b[rel], F.col("resposta_unidade").isNull()) > 0
    assert _count(s[rel], F.col("nota_unidade") == -1.0) == \
        _count(b[rel], F.col("resposta_unidade").isNull())
