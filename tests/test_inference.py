"""Product-map inference without the pair join, against the literal one."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starforge.operators import inference
from starforge.operators import cooccurrence_pairs_per_client, infer_product_map

HIST, CLI = "cd_cliente string, cd_prod string", "cd_cliente string, ds_prod string, ds_lin_rec string"


def _inputs(spark):
    hist = spark.createDataFrame([
        ("c1", "P1"), ("c1", "P2"), ("c2", "P1"), ("c3", "P3"), ("c4", "P9"),
    ], HIST)
    clients = spark.createDataFrame([
        ("c1", "one", "L1"), ("c1", "two", "L2"), ("c2", "one", "L1"),
        ("c3", "three", "L3"), ("c3", "zzz", "L3"), ("c1", "aaa", "L0"),
    ], CLI)
    return hist, clients


def _argmax(hist, clients):
    """The literal pair join: largest count, then smallest text, NULLs first."""
    have = {}
    for x, d, l in set(clients):
        if x is not None:
            have.setdefault(x, []).append((d, l))
    n = {}
    for x, c in set(hist):
        for p in have.get(x, []) if c is not None else []:
            n.setdefault(c, Counter())[p] += 1
    text = lambda v: (v is not None, v or "")       # noqa: E731
    return {c: min(k, key=lambda p: (-k[p], text(p[0]), text(p[1]))) for c, k in n.items()}


def _got(spark, hist, clients, **more):
    rows = infer_product_map(spark.createDataFrame(hist, HIST), spark.createDataFrame(clients, CLI), **more).collect()
    assert len({r.CD_PRODUTO for r in rows}) == len(rows)
    return {r.CD_PRODUTO: (r.DS_PRODUTO, r.DS_LINHA_RECEITA) for r in rows}


def test_largest_overlap_then_text(spark):
    hist, clients = _inputs(spark)
    got = {r.CD_PRODUTO: (r.DS_PRODUTO, r.DS_LINHA_RECEITA)
           for r in infer_product_map(hist, clients).collect()}
    # P1 bought by {c1,c2}; "one" held by both
    assert got["P1"] == ("one", "L1")
    # P3 bought by {c3}; both "three" and "zzz" have client set {c3}: smallest
    assert got["P3"] == ("three", "L3")
    # P2 bought by {c1}: all of c1's descriptions have one client in common
    assert got["P2"] == ("aaa", "L0")
    # P9's client has no contract rows -> no co-occurring description
    assert "P9" not in got


def test_two_common_clients_beat_a_smaller_text(spark):
    hist = [("c1", "P"), ("c2", "P"), ("c3", "P")]
    clients = [("c1", "right", "L"), ("c2", "right", "L"), ("c3", "aaa", "L"), ("c9", "aaa", "L")]
    assert _got(spark, hist, clients) == {"P": ("right", "L")}


@pytest.mark.parametrize("light", [0, 30, 4096])
def test_unequal_sets_and_a_hot_client(spark, light):
    """Random sets, NULLs, repeated rows, and a client with a third of all rows;
    ``light`` = 0 counts every client by profiles."""
    r = np.random.default_rng(3)
    hist, clients = [], []
    for c in range(60):
        own = r.choice(40, r.integers(1, 12), replace=False)
        hist += [(f"c{x}", f"P{c}") for x in own] + ([("hot", f"P{c}")] if r.random() < 0.8 else [])
        for k in range(r.integers(1, 4)):           # descriptions that share some of the code's clients
            keep = [x for x in own if r.random() < 0.7]
            d = None if r.random() < 0.1 else f"d{r.integers(0, 50)}"
            clients += [(f"c{x}", d, None if k == 2 else "L") for x in keep]
            clients += [(f"c{r.integers(0, 60)}", d, "L")]
            if r.random() < 0.8:
                clients += [("hot", d, "L")] * 2
    hist += hist[:20] + [("c1", None), (None, "P1"), ("nobody", "P1"), ("nobody", "Q")]
    clients += [(None, "d1", "L"), ("c1", None, None)]
    want = _argmax(hist, clients)
    assert _got(spark, hist, clients, light_pairs=light) == want and len(want) == 60


def test_copies_of_a_hot_client_meet_once(spark):
    """1,500 codes and 1,500 descriptions of one client only: one set each, so
    no step sees their 2.25 million pairs."""
    hist = [("hot", f"P{i}") for i in range(1500)] + [("c", "P0")]
    clients = [("hot", f"d{i}", "L") for i in range(1500)] + [("c", "d9", "L")]
    got = _got(spark, hist, clients)
    assert got.pop("P0") == ("d9", "L") and set(got.values()) == {("d0", "L")} and len(got) == 1499


def test_floors_rule_out_pairs_and_lose_no_winner(spark):
    """Two families over 200 clients: only descriptions as large as a shared
    one are paired with a family, and the literal join's winners stay."""
    r = np.random.default_rng(5)
    hist = [(f"c{x}", f"F{f}") for f in range(2) for x in range(200) if r.random() < 0.8]
    clients = [(f"c{x}", f"d{d}", "L") for d in range(300) for x in r.choice(200, 2 + 28 * (d >= 294), replace=False)]
    want = _argmax(hist, clients)
    assert _got(spark, hist, clients) == want
    codes = spark.createDataFrame(hist, HIST).select("cd_cliente", F.col("cd_prod").alias("code"))
    descs = spark.createDataFrame(clients, CLI).select(
        "cd_cliente", F.struct(F.col("ds_prod").alias("d"), F.col("ds_lin_rec").alias("l")).alias("pair"))
    descs = descs.join(descs.groupBy("pair").agg(F.count("*").alias("n_d")), "pair")
    pairs = inference._light_counts(codes, descs).collect()
    every = codes.join(descs, "cd_cliente").select("code", "pair").distinct().count()
    assert every > 500 and len(pairs) <= 2 * 6
    best = {}
    for p in pairs:
        best[p.code] = min(best.get(p.code, (0,)), (-p.n, p.pair.d, p.pair.l))
    assert {c: b[1:] for c, b in best.items()} == want


def test_descriptions_that_share_a_hash_are_told_apart(spark, monkeypatch):
    """Texts go through the shuffles as hashes (NULLs in either column apart);
    hashes that collide are taken anew."""
    real, seeds = F.xxhash64, []

    def colliding(*cols):                       # the first seed hashes every description to one number
        if len(cols) == 5:
            seeds.append(len(seeds))
            return F.lit(7).cast("long") if len(seeds) == 1 else real(*cols)
        return real(*cols)
    hist = [("c1", "P1"), ("c2", "P1"), ("c2", "P2"), ("c3", "P3"), ("c4", "P3")]
    clients = [("c1", "x", None), ("c2", "x", None), ("c1", None, "x"), ("c2", None, "y"), ("c3", None, "x"),
               ("c3", "b", "L"), ("c4", "b", "L"), ("c3", "bL", ""), ("c2", None, None)]
    assert _got(spark, hist, clients) == _argmax(hist, clients)
    rows, names = inference._numbered(spark.createDataFrame(clients, CLI))
    assert dict(rows.dtypes) == {"cd_cliente": "string", "h": "bigint"} and names.count() == len({c[1:] for c in clients})
    monkeypatch.setattr(F, "xxhash64", colliding)
    assert _got(spark, hist, clients) == _argmax(hist, clients) and len(seeds) == 2


def test_choice_always_cooccurs(spark):
    hist, clients = _inputs(spark)
    chosen = infer_product_map(hist, clients)
    pairs = (hist.join(clients, "cd_cliente")
             .select(F.col("cd_prod").alias("CD_PRODUTO"), F.col("ds_prod").alias("DS_PRODUTO"))
             .distinct())
    assert chosen.join(pairs, ["CD_PRODUTO", "DS_PRODUTO"], "left_anti").count() == 0


def test_empty_tables(spark):
    hist, clients = _inputs(spark)
    assert infer_product_map(hist.filter("false"), clients).count() == 0
    assert infer_product_map(hist, clients.filter("false")).count() == 0


def test_pair_count_without_pairs(spark):
    hist, clients = _inputs(spark)
    got = {r.cd_cliente: r.n_pairs for r in cooccurrence_pairs_per_client(hist, clients).collect()}
    brute = {r.cd_cliente: r.n for r in hist.distinct().join(
        clients.distinct(), "cd_cliente").groupBy("cd_cliente").agg(F.count("*").alias("n"))
        .collect()}
    assert got == brute
