"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source.  Going down from the token budget,
each node shares its budget among its children in proportion to their weights,
up to what each subtree can give (its tokens times ``max_epochs``).  What a
short child leaves goes to its siblings first; only what a whole subtree cannot
give goes to the siblings of its ancestor.  A leaf whose budget is k epochs and
a rest gives every document k times and, in a seeded order of the next epoch,
the longest prefix of documents whose tokens fit the rest.

No document is moved to decide this: token counts are added up per leaf and per
range of the seeded hash; the rest of a leaf ends inside one range, whose
documents alone are added up one by one.  The node tables have a row per leaf
at most; they are broadcast when counted to be within ``BROADCAST_ROWS``, and
joined by shuffle (split by AQE if hot) beyond.

Defined results: NULL or empty text has no tokens and is taken with any prefix
that reaches its place; a NULL source or language is the node ``unknown``; rows
with the same id and text stand or fall together; nodes without a given weight
get ``OTHER_WEIGHT``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import WHITE, cut

# The target mix: a parameter of the operator, this is the registered one
DOMAIN_WEIGHTS = {"web": 0.5, "books": 0.3, "forums": 0.2}
LANG_WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
OTHER_WEIGHT = 0.1
BUDGET_SHARE, MAX_EPOCHS, SEED = 0.8, 2, 17
RANGE_DOCS = 1024               # documents in a hash range, about
BROADCAST_ROWS = 200_000        # leaves

HASH_BITS = 60


def domain_of() -> Column:
    """Domain of the source in column ``__s``: by its number, in turn."""
    n = F.expr("try_cast(regexp_extract(__s, '([0-9]+)$', 1) as bigint)")
    return F.when(n.isNull(), "unknown").otherwise(F.element_at(
        F.array(*[F.lit(d) for d in DOMAIN_WEIGHTS]), (n % len(DOMAIN_WEIGHTS)).cast("int") + 1))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its leaf, tokens and text digest."""
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                    F.coalesce(docs["text"].cast("string"), F.lit("")).alias("__t"),
                    F.coalesce(docs["source"].cast("string"), F.lit("unknown")).alias("__s"),
                    F.coalesce(docs["lang"].cast("string"), F.lit("unknown")).alias("lang"))
    tokens = F.size(F.filter(F.split("__t", WHITE), lambda x: x != "")).cast("long")
    return d.select("doc_id", domain_of().alias("domain"), "lang",
                    F.col("__s").alias("source"), tokens.alias("tokens"), F.md5("__t").alias("digest"))


def seeded_hash(seed: int, epoch: Column) -> Column:
    """Place of a document in an epoch's order: 60 bits of an md5."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest")
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _weight(col: str, weights: dict[str, float]) -> Column:
    pairs = [x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(col)), F.lit(OTHER_WEIGHT))


def share_out(nodes: DataFrame, parent: list[str], node: str, budget: str = "budget") -> DataFrame:
    """Share each parent's ``budget`` among its children (columns ``node``,
    ``weight``, ``capacity``): proportional to the weights, no child above its
    capacity.  Children fill up in the order of capacity per weight, so one
    running sum tells who is full."""
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = w.orderBy((F.col("capacity") / F.col("weight")), F.col(node))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = nodes.select("*", F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("__cap"),
                      F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("__w"),
                      F.sum("weight").over(w).alias("__all"))
    level = (F.col(budget) - F.col("__cap")) / (F.col("__all") - F.col("__w"))
    full = F.col("capacity") <= level * F.col("weight") * F.lit(1 + 1e-9)
    df = df.withColumn("__full", full).withColumn("__level", F.when(~full, level))
    first = F.first("__level", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = df.withColumn("__rest", first)
    return df.withColumn("share", F.when(F.col("__full"), F.col("capacity").cast("double")).otherwise(
        F.col("__rest") * F.col("weight"))).drop("__cap", "__w", "__all", "__full", "__level", "__rest")


def leaf_budgets(leaves: DataFrame, budget_share: float, max_epochs: int) -> DataFrame:
    """leaves (domain, lang, source, tokens, docs) with ``budget`` in tokens."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    total = leaves.agg(F.floor(F.sum("tokens") * budget_share)).first()[0] or 0
    d = domains.withColumn("budget", F.lit(float(total))).withColumn("weight", _weight("domain", DOMAIN_WEIGHTS))
    d = share_out(d, [], "domain").select("domain", F.col("share").alias("budget"))
    x = langs.join(d, "domain").withColumn("weight", _weight("lang", LANG_WEIGHTS))
    x = share_out(x, ["domain"], "lang").select("domain", "lang", F.col("share").alias("budget"))
    s = leaves.join(x, ["domain", "lang"]).withColumn("weight", F.lit(1.0))
    s = share_out(s, ["domain", "lang"], "source")
    return s.select("domain", "lang", "source", "tokens", "docs",
                    F.floor(F.col("share") + 1e-6).cast("long").alias("budget"))


def mixing_plan(docs: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS,
                seed: int = SEED) -> tuple[DataFrame, bool]:
    """Per leaf: ``full`` epochs, and the last place of the next epoch's prefix
    (``upto``, -1 for none).  Also whether the table may be broadcast."""
    leaf = ["domain", "lang", "source"]
    keyed = _keyed(docs)
    leaves = keyed.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    b = leaf_budgets(cut(leaves, "mix-leaves"), budget_share, max_epochs)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    b = b.withColumn("full", full).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
    # hash ranges of about RANGE_DOCS documents: the upper bits of the hash
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("docs"), F.lit(1)) / RANGE_DOCS))).cast("int")
    b = cut(b.withColumn("shift", F.lit(HASH_BITS) - bits), "mix-budgets")
    small = b.count() <= BROADCAST_ROWS
    side = F.broadcast(b) if small else b
    open_docs = (keyed.join(side.select(*leaf, "full", "rest", "shift"), leaf)
                 .withColumn("place", seeded_hash(seed, F.col("full")))
                 .withColumn("range", F.expr("shiftright(place, shift)")))
    open_docs = cut(open_docs.select(*leaf, "tokens", "rest", "place", "range"), "mix-places")
    ranges = open_docs.groupBy(*leaf, "range").agg(F.sum("tokens").alias("t"), F.max("rest").alias("rest"))
    up = Window.partitionBy(*leaf).orderBy("range")
    ranges = ranges.withColumn("before", F.sum("t").over(up) - F.col("t"))
    # the range in which the rest ends, and what is left of the rest there
    edge = (ranges.filter(F.col("before") <= F.col("rest")).groupBy(*leaf)
            .agg(F.max(F.struct("range", "before")).alias("e"))
            .select(*leaf, F.col("e.range").alias("range"), F.col("e.before").alias("before")))
    inside = (open_docs.join(F.broadcast(edge) if small else edge, [*leaf, "range"])
              .groupBy(*leaf, "range", "place").agg(F.sum("tokens").alias("t"),
                                                    F.max("rest").alias("rest"),
                                                    F.max("before").alias("before")))
    run = F.sum("t").over(Window.partitionBy(*leaf).orderBy("place"))
    inside = inside.withColumn("ok", F.col("before") + run <= F.col("rest"))
    upto = inside.groupBy(*leaf).agg(
        F.max(F.when(F.col("ok"), F.col("place"))).alias("last"), F.max("range").alias("range"))
    plan = b.join(upto, leaf, "left").select(
        *leaf, "full", "budget", F.coalesce(
            "last", F.expr("shiftleft(range, shift) - 1"), F.lit(-1)).cast("long").alias("upto"))
    return cut(plan, "mix-plan"), small


def select_docs(docs: DataFrame, plan: DataFrame, small: bool, seed: int = SEED) -> DataFrame:
    """Rows of ``_keyed(docs)``'s shape with ``epoch``: one per copy taken."""
    leaf = ["domain", "lang", "source"]
    d = docs.join(F.broadcast(plan) if small else plan, leaf)
    n = F.col("full") + F.when(seeded_hash(seed, F.col("full")) <= F.col("upto"), 1).otherwise(0)
    d = d.withColumn("n", n).filter(F.col("n") > 0)
    return d.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))))


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, domain, lang, source, tokens and epoch of every copy taken."""
    plan, small = mixing_plan(docs, **how)
    return select_docs(_keyed(docs), plan, small, how.get("seed", SEED)).select(
        "doc_id", "domain", "lang", "source", "tokens", "epoch")


def mix_rows(docs: DataFrame, **how) -> DataFrame:
    """The input's rows and columns, each as many times as it is taken.  The
    rows themselves are not shuffled while the leaves are few."""
    plan, small = mixing_plan(docs, **how)
    names = docs.columns
    s = F.coalesce(docs["source"].cast("string"), F.lit("unknown"))
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("__row"), s.alias("__s"))
    packed = packed.select(
        "__row", domain_of().alias("domain"), F.col("__s").alias("source"),
        F.coalesce(F.col("__row.lang").cast("string"), F.lit("unknown")).alias("lang"),
        F.col("__row.doc_id").cast("long").alias("doc_id"),
        F.md5(F.coalesce(F.col("__row.text").cast("string"), F.lit(""))).alias("digest"))
    return select_docs(packed, plan, small, how.get("seed", SEED)).select("__row.*")


def mix_sql() -> str:
    """The same selection in SQL: budgets level by level, then a running sum
    over every leaf."""
    def case(col, weights):
        return "CASE {} {} ELSE {} END".format(col, " ".join(
            f"WHEN '{k}' THEN {float(w)}" for k, w in weights.items()), OTHER_WEIGHT)

    def level(name, source, parent, node, weight):
        part = f"PARTITION BY {parent}" if parent else ""
        keys = f"{parent}, {node}" if parent else node
        return f"""
{name}_w AS (SELECT *, {weight} AS w FROM {source}),
{name}_s AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS c0, coalesce(sum(w) OVER b, 0) AS w0, sum(w) OVER ({part}) AS wa
    FROM {name}_w WINDOW b AS ({part} ORDER BY cap / w, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_f AS (SELECT *, (budget - c0) / (wa - w0) AS lv, cap <= (budget - c0) / (wa - w0) * w * (1 + 1e-9) AS isfull FROM {name}_s),
{name} AS (SELECT {keys}, cap, CASE WHEN isfull THEN cap ELSE w * first_value(CASE WHEN isfull THEN NULL ELSE lv END IGNORE NULLS)
    OVER ({part} ORDER BY cap / w, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS share FROM {name}_f)"""
    names = ", ".join(f"'{d}'" for d in DOMAIN_WEIGHTS)
    return f"""
WITH k AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
    TRY_CAST(regexp_extract(coalesce(source, 'unknown'), '([0-9]+)$', 1) AS BIGINT) AS num, md5(coalesce(text, '')) AS digest,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS tokens FROM documents),
d AS (SELECT *, CASE WHEN num IS NULL THEN 'unknown' ELSE [{names}][num % {len(DOMAIN_WEIGHTS)} + 1] END AS domain FROM k),
lf AS (SELECT domain, lang, source, sum(tokens) AS tokens, CAST(sum(tokens) * {MAX_EPOCHS} AS DOUBLE) AS cap FROM d GROUP BY ALL),
tot AS (SELECT floor(sum(tokens) * {BUDGET_SHARE}) AS budget FROM lf),
l1 AS (SELECT domain, sum(cap) AS cap, (SELECT budget FROM tot) AS budget FROM lf GROUP BY domain),{level("a1", "l1", "", "domain", case("domain", DOMAIN_WEIGHTS))},
l2 AS (SELECT lf.domain, lang, sum(lf.cap) AS cap, any_value(a1.share) AS budget FROM lf JOIN a1 USING (domain) GROUP BY lf.domain, lang),{level("a2", "l2", "domain", "lang", case("lang", LANG_WEIGHTS))},
l3 AS (SELECT lf.domain, lf.lang, source, lf.cap, a2.share AS budget FROM lf JOIN a2 USING (domain, lang)),{level("a3", "l3", "domain, lang", "source", "1.0")},
q AS (SELECT domain, lang, source, CAST(floor(share + 1e-6) AS BIGINT) AS budget, lf.tokens FROM a3 JOIN lf USING (domain, lang, source)),
e AS (SELECT *, CASE WHEN tokens > 0 THEN CAST(budget // tokens AS BIGINT) ELSE 0 END AS ep FROM q),
p AS (SELECT d.doc_id, domain, lang, source, d.tokens, ep, budget - ep * e.tokens AS rest,
    CAST('0x' || substr(md5('{SEED}|' || ep || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || digest), 1, {HASH_BITS // 4}) AS BIGINT) AS place
    FROM d JOIN e USING (domain, lang, source)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM p),
n AS (SELECT *, ep + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS n FROM r)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(unnest(range(1, n + 1)) AS BIGINT) AS epoch FROM n
"""
