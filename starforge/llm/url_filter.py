"""URL filter by association rules.

Given rules (host, path, verdict) decide the urls they fit.  The urls they leave
open are judged by what the decided ones teach:

1. A url becomes a set of tokens: host labels, path segments (digits as ``#``),
   query keys, a mark for a fragment.
2. The decided urls are labelled transactions.  Host labels that the given rules
   name are left out (every decided url has them because of its rule, so they
   teach nothing about the others), and so are tokens that stand in all of them;
   tokens that always stand together become one item.  Spark's
   FP-growth mines the item sets, each with the label as one more item.
3. A mined set with a label is a rule: it stays with enough support, confidence
   and lift, at most ``MAX_ITEMS`` items, and no shorter rule for the same label
   inside it that is as confident.
4. Rules match by an inverted index: each is listed under its rarest token, so a
   url meets the few rules of its tokens and is then tested for all of theirs.
   Urls with equal tokens are matched once.

The best rule decides: highest confidence, then most support, most tokens,
``block`` before ``allow``, first by its text.  No rule: ``allow``.

Bounds: at least ``MIN_COUNT`` and ``MIN_SUPPORT`` of the decided urls hold a
frequent token, so there are at most (tokens of a url) / ``MIN_SUPPORT`` of them
however many urls there are; mined sets and rules are bounded in the same way.

Defined results: a NULL url, or one without ``://``, has empty host and path, no
tokens, fits no rule and is allowed.  Given rules of equal length: the first by
its text.  NULL page ids and repeated rows keep their rows; repeated rows count
again.  Very long urls are split as a whole.  An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import ascii_lower, cut
from starforge.session import known_size

# fixed values: the given rules (host, path, verdict)
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
MIN_SUPPORT, MIN_COUNT = 0.002, 5       # of the decided urls; at least so many of them
MIN_CONFIDENCE = 0.9
MAX_ITEMS = 3                           # of a rule, without the label
INDEX_ROWS = 50_000                     # an index of at most so many rows is broadcast
LABEL = "="                             # no token begins so


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", k), F.lit(""))     # noqa: E731
    return ascii_lower(part(1)), part(2)


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest given rule that fits, NULL if none does."""
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Different tokens of a url, sorted: h: host labels, p: path segments,
    q: query keys, f: a fragment."""
    some = lambda c: F.filter(c, lambda x: x != "")      # noqa: E731
    query = F.regexp_extract(url, "://[^?#]*\\?([^#]*)", 1)
    tokens = F.concat(
        F.transform(some(F.split(host, "\\.")), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(some(F.split(path, "/")), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(some(F.split(query, "&")), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^[^=]*", 0))),
        F.when(F.regexp_extract(url, "://[^#]*(#)", 1) == "#", F.array(F.lit("f:"))).otherwise(
            F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.coalesce(tokens, F.array().cast("array<string>"))))


def mine_rules(decided: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
               min_confidence: float = MIN_CONFIDENCE, max_items: int = MAX_ITEMS) -> DataFrame:
    """Rules from ``decided`` (row, tokens, label): label, tokens (sorted),
    confidence, support (urls), rarest (token)."""
    spark = decided.sparkSession
    total = decided.count()
    least = max(min_count, ceil(min_support * total))
    rules = "label string, tokens array<string>, confidence double, support long, rarest string"
    if total < least:
        return spark.createDataFrame([], rules)
    # tokens with the same urls: equal counts and equal sums of the rows' hashes
    seen = decided.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("rows"))
    items = cut(seen.filter((F.col("n") >= least) & (F.col("n") < total)).groupBy("n", "rows").agg(
        F.array_sort(F.collect_list("token")).alias("together")).select(
        F.col("together")[0].alias("item"), "together", "n"), "url-items")
    part = cut(decided.select("row", "label", F.explode("tokens").alias("item")).join(items.select("item"), "item")
               .groupBy("row", "label").agg(F.collect_list("item").alias("items")).select(
        F.concat("items", F.array(F.concat(F.lit(LABEL), "label"))).alias("items")), "url-transactions")
    # FP-growth rounds its share of the transactions up to a count
    there = known_size(part).rows
    if there < least:
        return spark.createDataFrame([], rules)
    model = FPGrowth(minSupport=(least - 0.5) / there, minConfidence=min_confidence, itemsCol="items").fit(part)
    base = {r["label"]: r["n"] / total for r in decided.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(None).cast("double")
    for label, x in base.items():           # one entry per verdict
        share = F.when(F.col("label") == label, F.lit(x)).otherwise(share)
    mined = (model.associationRules.filter(F.col("consequent")[0].startswith(LABEL) & (F.size("antecedent") <= max_items)
                                           & (F.col("confidence") >= min_confidence))
             .select(F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("label"),
                     F.array_sort("antecedent").alias("set"), "confidence",
                     F.round(F.col("support") * there).cast("long").alias("support"))
             .filter(F.col("confidence") > share))
    mined = cut(mined, "url-rules")
    # a rule goes if a smaller set inside its own is as confident of the same label
    inside = F.transform(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("set")) - 2),
                         lambda m: F.filter("set", lambda x, k: F.call_function("shiftright", m, k) % 2 == 1))
    smaller = mined.filter(F.size("set") > 1).select("label", "set", "confidence", F.explode(inside).alias("part"))
    known = mined.select("label", F.col("set").alias("part"), F.col("confidence").alias("sure"))
    idle = smaller.join(known, ["label", "part"]).filter("sure >= confidence").select("label", "set").distinct()
    kept = mined.join(idle, ["label", "set"], "left_anti")
    # items back to all their tokens; the rarest one lists the rule
    full = kept.select("*", F.explode("set").alias("item")).join(items, "item").groupBy(
        "label", "set", "confidence", "support").agg(
        F.array_sort(F.flatten(F.collect_list("together"))).alias("tokens"), F.min(F.struct("n", "item")).alias("rare"))
    return cut(full.select("label", "tokens", "confidence", "support", F.col("rare.item").alias("rarest")), "url-rules")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, label, confidence, support, evidence (the rule's tokens) of every
    different token set of ``urls`` that a rule fits: its best rule."""
    size = known_size(rules)
    index = rules.select("rarest", F.col("tokens").alias("needed"), "label", "confidence", "support")
    if size is not None and size.rows <= INDEX_ROWS:
        index = F.broadcast(index)
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.size("needed")).alias("z"),
                          (F.col("label") != "block").alias("b"), F.array_join("needed", " ").alias("evidence"), "label"))
    return (urls.select("tokens").distinct().select("tokens", F.explode("tokens").alias("rarest"))
            .join(index, "rarest").filter(F.forall("needed", lambda t: F.array_contains("tokens", t)))
            .groupBy("tokens").agg(best.alias("x"))
            .select("tokens", "x.label", (-F.col("x.c")).alias("confidence"), (-F.col("x.s")).alias("support"), "x.evidence"))


def url_filter(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, id_col: str = "page_id",
               url_col: str = "url", **mining) -> DataFrame:
    """page_id, host, path, rule (the given rule that fits, or NULL), verdict,
    evidence (tokens of the mined rule that decided, or NULL), confidence.

    ``labels`` (page_id, label: allow or block) adds labelled urls to learn from
    where no given rule decides."""
    url = F.col("url")
    d = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"))
    if labels is not None:
        extra = labels.select(labels[id_col].cast("long").alias("page_id"), labels["label"].alias("extra")).dropna() \
            .groupBy("page_id").agg(F.max("extra").alias("extra"))
        d = d.join(extra, "page_id", "left")
    else:
        d = d.withColumn("extra", F.lit(None).cast("string"))
    host, path = host_and_path(url)
    d = d.withColumn("host", host).withColumn("path", path)
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    d = cut(d.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("given"), "extra",
                     url_tokens(url, F.col("host"), F.col("path")).alias("tokens"),
                     F.monotonically_increasing_id().alias("row")), "urls")
    named = F.array(*[F.lit(x) for x in sorted({f"h:{x}" for h, _, _ in rules for x in h.split(".")})]).cast("array<string>")
    found = mine_rules(d.select("row", F.array_except("tokens", named).alias("tokens"), F.coalesce(
        "given", "extra").alias("label")).filter("label is not null"), **mining)
    best = cut(match_rules(d.filter("given is null"), found), "url-verdicts")
    hint = F.broadcast(best) if known_size(best).rows <= INDEX_ROWS // 10 else best
    open_urls = d.filter("given is null").join(hint, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("label", F.lit("allow")).alias("verdict"), "evidence", "confidence")
    return d.filter("given is not null").select(
        "page_id", "host", "path", "rule", F.col("given").alias("verdict"), F.lit(None).cast("string").alias("evidence"),
        F.lit(None).cast("double").alias("confidence")).unionByName(open_urls)



def url_sql() -> str:
    """The same verdicts in DuckDB: item sets of up to three by joins."""
    least = f"greatest({MIN_COUNT}, CAST(ceil({MIN_SUPPORT} * (SELECT count(*) FROM decided)) AS BIGINT))"
    return f"""
WITH cut AS (
  SELECT page_id, url, row_number() OVER () AS r,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
base(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                         ('org', '/fr/', 'allow')),
fits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS given
  FROM cut JOIN base ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
u AS (
  SELECT cut.*, rule, given, list_sort(list_distinct(coalesce(list_concat(
      list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
      list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                     lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')),
      list_transform(list_filter(string_split(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> ''),
                     lambda x: 'q:' || regexp_extract(x, '^[^=]*')),
      CASE WHEN regexp_extract(url, '://[^#]*(#)', 1) = '#' THEN ['f:'] ELSE [] END), []))) AS tokens
  FROM cut LEFT JOIN fits USING (r)),
decided AS (SELECT r, tokens, given AS label FROM u WHERE given IS NOT NULL),
said AS (SELECT r, label, unnest(list_filter(tokens, lambda x: x NOT IN ('h:net', 'h:example', 'h:com', 'h:org'))) AS token
         FROM decided),
seen AS (SELECT token, count(*) AS n, string_agg(r, ',' ORDER BY r) AS urls FROM said GROUP BY token),
items AS (SELECT min(token) AS item, list(token ORDER BY token) AS together, n FROM seen
          WHERE n >= {least} AND n < (SELECT count(*) FROM decided) GROUP BY urls, n),
held AS (SELECT r, label, token AS item FROM said JOIN items ON token = item),
sets AS (
  SELECT [a.item] AS s, a.label, a.r FROM held a
  UNION ALL SELECT [a.item, b.item], a.label, a.r FROM held a JOIN held b ON a.r = b.r AND a.item < b.item
  UNION ALL SELECT [a.item, b.item, c.item], a.label, a.r FROM held a JOIN held b ON a.r = b.r AND a.item < b.item
            JOIN held c ON a.r = c.r AND b.item < c.item),
counts AS (SELECT s, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY s) AS total FROM sets GROUP BY s, label),
mined AS (
  SELECT s, label, n, n / total AS conf FROM counts
  WHERE n >= {least} AND n / total >= {MIN_CONFIDENCE}
    AND n / total > (SELECT count(*) FROM decided d WHERE d.label = counts.label) / (SELECT count(*) FROM decided)),
kept AS (
  SELECT m.s, label, n, conf, row_number() OVER () AS rule_no FROM mined m WHERE NOT EXISTS (
    SELECT 1 FROM mined k WHERE k.label = m.label AND len(k.s) < len(m.s) AND list_has_all(m.s, k.s) AND k.conf >= m.conf)),
rules AS (
  SELECT rule_no, label, n, conf, list_sort(flatten(list(together))) AS needed
  FROM (SELECT rule_no, label, n, conf, unnest(s) AS item FROM kept) JOIN (SELECT item, together FROM items) USING (item)
  GROUP BY rule_no, label, n, conf),
best AS (
  SELECT r, arg_min(label, (-conf, -n, -len(needed), label <> 'block', array_to_string(needed, ' '))) AS label,
         arg_min(array_to_string(needed, ' '), (-conf, -n, -len(needed), label <> 'block', array_to_string(needed, ' ')))
           AS evidence, max(conf) AS confidence
  FROM u JOIN rules ON list_has_all(tokens, needed) WHERE given IS NULL GROUP BY r)
SELECT page_id, host, path, rule, coalesce(given, best.label, 'allow') AS verdict, evidence, confidence
FROM u LEFT JOIN best USING (r)
"""
