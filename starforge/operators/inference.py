"""Product code -> description inference.

The extracts never state which description belongs to a product code;
the only link is the client: proposal items carry (client, code) and
contract rows carry (client, description, revenue line).  Joining the two
on the client emits every code x description pair of a client, which is
quadratic in the client's size and explodes on a large client.  This
operator finds, for each code, the description with the largest
co-occurrence (clients that have both; ties: the smallest description,
then line, NULLs first) -- the pair join's argmax, without the pair join:

1. codes with equal client sets get equal answers, and of descriptions
   with equal client sets only the smallest can win: both sides are
   reduced to their different sets by order-free fingerprints (128 bits);
2. no overlap exceeds the code's own set, so a description that holds all
   its clients is certain to be a winner.  It stands among the
   descriptions of the set's rarest client (the prefix filter for full
   overlap); set sizes, bit signatures and the text of an equal set rule
   out nearly all others, and the rest are counted exactly.  Only rows of
   clients that are the rarest of some set are looked at for this;
3. sets that no description contains are counted exactly, split by degree.
   Clients with at most ``LIGHT_PAIRS`` pairs are joined: at most 32 pairs
   per input row.  The others ("heavy": at most one per 127 rows) are
   counted between the different heavy profiles -- the sets restricted to
   heavy clients -- so a client that holds a third of all rows adds one
   profile, not its codes times its descriptions.  An overlap is the light
   count plus that of the two profiles.  An overlap is at most the
   description's own set, so the largest descriptions are counted first:
   what a code shares with one of them (its floor) rules out every
   description with fewer clients, before a pair is emitted.

``cooccurrence_pairs_per_client`` reports how large the literal pair join
would be, without building it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.operators.lookup import BROADCAST_MAX_ROWS, broadcast_if_small, fits_broadcast
from starforge.session import known_size, materialize

LIGHT_PAIRS = 4096
LARGEST = 0.02              # share of the rows whose descriptions are counted first


def _fingerprint_aggs(member: str = "cd_cliente") -> list:
    h64 = F.xxhash64(F.col(member))
    h32 = F.hash(F.col(member)).cast("bigint")
    return [F.count(F.lit(1)).alias("_fp_n"), F.bit_xor(h64).alias("_fp_x64"),
            F.min(h64).alias("_fp_min"), F.max(h64).alias("_fp_max"),
            F.bit_xor(h32).alias("_fp_x32")]


def client_codes(history: DataFrame) -> DataFrame:
    """Distinct (client, code) pairs from proposal items."""
    return (history.select("cd_cliente", F.col("cd_prod").alias("CD_PRODUTO"))
                   .filter(F.col("cd_cliente").isNotNull() & F.col("CD_PRODUTO").isNotNull())
                   .distinct())


def _described(clients: DataFrame) -> DataFrame:
    return clients.select("cd_cliente", F.col("ds_prod").alias("DS_PRODUTO"),
                          F.col("ds_lin_rec").alias("DS_LINHA_RECEITA")).filter(F.col("cd_cliente").isNotNull())


def client_descriptions(clients: DataFrame) -> DataFrame:
    """Distinct (client, description, revenue line) from contract rows."""
    return _described(clients).distinct()


def _signature(member: str = "cd_cliente", words: int = 4) -> list:
    """Bit signature: a set inside another has no bit the other lacks."""
    return [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.col(member), F.lit(k)), F.lit(64))
                                     .cast("int"))).alias(f"_sig{k}") for k in range(words)]


def _set_key() -> list:
    """The fingerprint as two 64-bit columns."""
    return [F.col("_fp_x64").alias("s1"), F.xxhash64("_fp_n", "_fp_min", "_fp_max", "_fp_x32").alias("s2")]


def _numbered(clients: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The different (client, h) of the contract rows and the texts of each h: a 64-bit hash goes through
    the shuffles in place of the two texts.  Should two descriptions share a
    hash, it is taken anew from another seed."""
    # a hash skips NULLs, so whether they are NULL is hashed too
    h = F.xxhash64(F.lit(seed), F.isnull("DS_PRODUTO"), "DS_PRODUTO", F.isnull("DS_LINHA_RECEITA"), "DS_LINHA_RECEITA")
    rows = _described(clients).withColumn("h", h)
    names = materialize(rows.select("h", F.col("DS_PRODUTO").alias("d"), F.col("DS_LINHA_RECEITA").alias("l"))
                        .distinct(), "descriptions")
    if not names.groupBy("h").count().filter("count > 1").isEmpty():
        return _numbered(clients, seed + 1)
    return materialize(_clustered(rows.select("cd_cliente", "h").distinct(), "h"), "client_descriptions"), names


def _clustered(pairs: DataFrame, of: str) -> DataFrame:
    """The (client, ``of``) pairs laid out by ``of``, so that its sets are summed up
    where they are read: dealt out by chance, a set has a partial sum of ten
    numbers in nearly every task.  The client ends the sort key, so the members of a
    large set are spread."""
    return pairs.repartitionByRange(of, "cd_cliente").sortWithinPartitions(of, "cd_cliente")


def _shuffled(df: DataFrame) -> DataFrame:
    """Laid out by its sets, a table has files smaller than its rows: beyond the
    bound of a broadcast the planner shall not take it for a small one."""
    return df if known_size(df).rows <= BROADCAST_MAX_ROWS else df.hint("merge")


def infer_product_map(history: DataFrame, clients: DataFrame, light_pairs: int = LIGHT_PAIRS) -> DataFrame:
    """One row per product code: CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA."""
    sig = [f"_sig{k}" for k in range(4)]
    descs, names = _numbered(clients)
    # clients without descriptions add to no overlap: codes keep the others.
    # rank: a number that orders clients by rarity, then hash (a plain long, so
    # that its minimum is hash-aggregated; equal ranks only add candidates)
    rank = (F.least(F.count(F.lit(1)), F.lit((1 << 20) - 1)) * F.lit(1 << 43)
            + F.pmod(F.xxhash64("cd_cliente"), F.lit(1 << 43)))
    holders = descs.groupBy("cd_cliente").agg(rank.alias("rank"))
    codes = materialize(_clustered(client_codes(history).join(holders, "cd_cliente"), "CD_PRODUTO"), "client_codes")
    code_fp = codes.groupBy("CD_PRODUTO").agg(
        *_fingerprint_aggs(), *_signature(), F.min("rank").alias("rank"))
    code_of = materialize(code_fp.select("CD_PRODUTO", *_set_key(), "_fp_n", *sig, "rank"), "code_sets")
    alike = ["s1", "s2", "n_d", *[f"d{c}" for c in sig]]
    desc_sets = materialize(descs.groupBy("h").agg(*_fingerprint_aggs(), *_signature())
                 .select("h", *_set_key(), F.col("_fp_n").alias("n_d"), *[F.col(c).alias(f"d{c}") for c in sig])
                 .join(names, "h").groupBy(*alike).agg(F.min(F.struct("d", "l", "h")).alias("least"))
                 .select(*alike, F.struct("least.d", "least.l").alias("pair"), "least.h"), "description_sets")
    sets = (code_of.groupBy("s1", "s2", "rank", "_fp_n", *sig).agg(F.min("CD_PRODUTO").alias("code"))
            .join(desc_sets.select("s1", "s2", F.col("pair").alias("equal")), ["s1", "s2"], "left"))

    covers = [F.col(c).bitwiseAND(F.bitwise_not(F.col(f"d{c}"))) == 0 for c in sig]
    # only the sets' rarest clients can name a candidate: their rows alone go on
    rarest = holders.join(sets.select("rank").distinct(), "rank", "left_semi")
    named = descs.join(rarest, "cd_cliente").join(desc_sets.drop("s1", "s2", "pair"), "h")
    maybe = sets.join(named.drop("cd_cliente"), "rank").filter(F.col("n_d") > F.col("_fp_n"))
    for c in covers:
        maybe = maybe.filter(c)
    # the texts join the few that are left, as columns, whose size is known once they are written
    maybe = maybe.select("code", "h", "_fp_n", "equal").join(desc_sets.select("h", "pair"), "h").filter(
        F.col("equal").isNull() | (F.col("pair") < F.col("equal")))
    maybe = materialize(maybe.select("code", "h", "pair.d", "pair.l", "_fp_n").distinct(), "containing_sets")
    members = codes.select("cd_cliente", F.col("CD_PRODUTO").alias("code"))
    wanted = maybe.select("h").distinct()
    few = fits_broadcast(maybe, maybe.columns)      # then neither side is shuffled whole
    full = (broadcast_if_small(maybe).select("code", "h", "_fp_n").join(members, "code")
            .join(descs.join(F.broadcast(wanted), "h", "left_semi") if few else _shuffled(descs),
                  ["cd_cliente", "h"], "left_semi")
            .groupBy("code", "h", "_fp_n").agg(F.count(F.lit(1)).alias("n")).filter("n = _fp_n"))
    sure = (full.select("code", "h").join(broadcast_if_small(maybe), ["code", "h"])
            .groupBy("code").agg(F.min(F.struct("d", "l")).alias("inside")))
    known = materialize(sets.join(sure, "code", "left").select(
        "code", "s1", "s2", F.coalesce("inside", "equal").alias("pair")), "product_sets")
    answers = known.filter("pair is not null").select("s1", "s2", "pair")
    rest = known.filter("pair is null").select("code", "s1", "s2")
    if not rest.isEmpty():
        open_codes = materialize(rest, "open_codes")
        held = descs.join(desc_sets, "h").select("cd_cliente", "pair", "n_d")       # of the different sets
        best = _counted(members.join(broadcast_if_small(open_codes).select("code"), "code"), held, light_pairs)
        answers = answers.unionByName(rest.join(best, "code").select("s1", "s2", "pair"))
    return code_of.select("CD_PRODUTO", "s1", "s2").join(answers, ["s1", "s2"]).select(
        "CD_PRODUTO", F.col("pair.d").alias("DS_PRODUTO"), F.col("pair.l").alias("DS_LINHA_RECEITA"))


def _floors(codes: DataFrame, descs: DataFrame) -> DataFrame:
    """(code, floor): what each code shares with one of the descriptions that
    have the most clients, of the rows given: no more than its largest overlap.
    Where the cut between large and other descriptions is drawn decides only
    how much the floors rule out."""
    cut, top = descs.agg(F.percentile_approx("n_d", 1 - LARGEST, 1000), F.max("n_d")).first()
    least = min(cut + 1, top) if top else 1         # many may be as large as the largest
    return (codes.join(descs.filter(F.col("n_d") >= least), "cd_cliente")
            .groupBy("code", "pair").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("code").agg(F.max("n").alias("floor")))


def _light_counts(codes: DataFrame, descs: DataFrame) -> DataFrame:
    """(code, pair, n): clients in common, of the pairs that can be a code's
    largest; a description below the floor is none, one as large may tie."""
    floors = materialize(_floors(codes, descs), "floors")
    return (codes.join(broadcast_if_small(floors), "code", "left").withColumn("floor", F.coalesce("floor", F.lit(1)))
            .join(descs, "cd_cliente").filter(F.col("n_d") >= F.col("floor"))
            .groupBy("code", "pair").agg(F.count(F.lit(1)).alias("n")))


def _counted(codes: DataFrame, descs: DataFrame, light_pairs: int) -> DataFrame:
    """(code, pair): the largest overlap of each code, counted exactly;
    ``descs`` with the size of each description's set as ``n_d``."""
    first = lambda n: F.min(F.struct((-F.col(n)).alias("n"), "pair")).alias("best")     # noqa: E731
    degrees = codes.groupBy("cd_cliente").agg(F.count(F.lit(1)).alias("a")).join(
        descs.groupBy("cd_cliente").agg(F.count(F.lit(1)).alias("b")), "cd_cliente")
    heavy = materialize(degrees.filter(F.col("a") * F.col("b") > light_pairs).select("cd_cliente"), "heavy_clients")
    light_codes = codes.join(heavy, "cd_cliente", "left_anti")
    light = _light_counts(light_codes, descs)
    if heavy.isEmpty():
        return light.groupBy("code").agg(first("n")).select("code", "best.pair")

    def profiles(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """(name -> profile) and, per profile, its smallest member and the heavy clients."""
        own = rows.join(heavy, "cd_cliente", "left_semi")
        of = own.groupBy(name).agg(*_fingerprint_aggs()).select(name, *_set_key())
        lead = of.groupBy("s1", "s2").agg(F.min(name).alias("lead"))
        return materialize(of.join(lead, ["s1", "s2"]).select(name, "lead"), "profiles"), own
    code_profile, code_heavy = profiles(codes, "code")
    desc_profile, desc_heavy = profiles(descs, "pair")
    both = (code_heavy.join(code_profile.filter("code = lead").select("code"), "code")
            .join(desc_heavy.join(desc_profile.filter("pair = lead").select("pair"), "pair"), "cd_cliente")
            .groupBy(F.col("code").alias("c_lead"), F.col("pair").alias("d_lead")).agg(F.count(F.lit(1)).alias("m")))
    both = materialize(both, "profile_counts")
    alone = both.select("c_lead", F.col("d_lead").alias("pair"), "m").groupBy("c_lead").agg(first("m"))
    alone = code_profile.join(alone, code_profile["lead"] == F.col("c_lead")).select("code", "best")
    total = (light.join(code_profile.select("code", F.col("lead").alias("c_lead")), "code", "left")
             .join(desc_profile.select("pair", F.col("lead").alias("d_lead")), "pair", "left")
             .join(both, ["c_lead", "d_lead"], "left")
             .withColumn("n", F.col("n") + F.coalesce("m", F.lit(0))).groupBy("code").agg(first("n")))
    return alone.unionByName(total).groupBy("code").agg(F.min("best").alias("best")).select("code", "best.pair")


def cooccurrence_pairs_per_client(history: DataFrame, clients: DataFrame) -> DataFrame:
    """Per client: distinct codes, distinct descriptions, and the number of
    rows the literal client join would emit (their product) -- computed
    from two per-client counts, never by emitting the pairs."""
    nc = client_codes(history).groupBy("cd_cliente").agg(F.count(F.lit(1)).alias("n_codes"))
    nd = client_descriptions(clients).groupBy("cd_cliente").agg(
        F.count(F.lit(1)).alias("n_descriptions"))
    return (nc.join(nd, "cd_cliente", "inner")
              .select("cd_cliente", "n_codes", "n_descriptions",
                      (F.col("n_codes") * F.col("n_descriptions")).alias("n_pairs")))
