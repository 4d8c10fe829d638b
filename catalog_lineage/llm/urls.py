"""URL filters (operator 3): given host and path rules first, then association rules mined from labels.

A page's URL is a set of tokens: scheme, host labels, path parts with digits as #, and query keys. Labelled pages (label of the
document with the page's id) are transactions, bad ones with one more token. Spark's FP-growth finds the frequent combinations; those
that imply a bad page with MIN_CONFIDENCE, in at least MIN_SUPPORT of the labelled pages, are rules of any length, less those that a
shorter rule already implies. Rules are found by an inverted index: each is filed under its rarest token, so a page only meets rules filed under one
of its own, and the rest of the rule is checked there. Mining and matching cover all rows and run as joins over distinct URLs.

Defined results: a null URL or one without :// has empty host and path, fits no rule and is allowed; without labels of both kinds no
rules are mined; several labels of a document count as bad if one is; repeated pages get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import cut, packed, table

MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.7
BAD = "!bad"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str


RULES = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where there is no ://."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def given_rule(host: Column, path: Column, rules: tuple[HostRule, ...] = RULES) -> Column:
    """The longest rule that fits, as struct<length, rule, verdict>, or null. A rule fits its host and all subdomains."""
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.host) + len(r.path)).alias("length"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    parts = lambda mark, values: F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    keys = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), F.lit(1))
    scheme = F.array(F.lower(F.substring_index(F.coalesce(url, F.lit("")), "://", 1)))
    found = F.concat(
        F.when(F.contains(url, F.lit("://")), parts("s:", scheme)).otherwise(F.array().cast("array<string>")), parts("h:", F.split(host, r"\.")),
        parts("p:", F.transform(F.split(F.lower(path), r"[/._-]+"), lambda x: F.regexp_replace(x, "[0-9]+", "#"))), parts("q:", keys),
    )
    return F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))


def mine(pages: DataFrame, labels: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, confidence, support, filed) from pages(page_id, url, tokens) and labels(doc_id, quality, toxic)."""
    spark = pages.sparkSession
    bad = F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False)))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_doc")).agg(bad.alias("_bad"))
    known = pages.where("page_id is not null").join(marked, F.col("page_id") == F.col("_doc"))
    items = cut(known.select(F.when(F.col("_bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items")).where("size(items) > 0"))
    empty = spark.createDataFrame([], "tokens array<string>, confidence double, support double, filed string")
    if items.where(F.array_contains("items", BAD)).isEmpty():
        return empty
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=parts).fit(items)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
    seen = items.select(F.explode("items").alias("filed")).groupBy("filed").agg(F.count("*").alias("n"))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    filed = rules.select("*", F.explode("tokens").alias("filed")).join(seen, "filed")
    return minimal(cut(filed.groupBy("tokens", "confidence", "support").agg(F.min_by("filed", F.struct("n", "filed")).alias("filed"))))


def minimal(rules: DataFrame) -> DataFrame:
    """The rules that hold no other rule's tokens. The shortest of those left are minimal; the longer ones that hold one of them go, and
    so on with the next length, so that only minimal rules are joined with the others."""
    kept, rest = rules.limit(0), rules
    while (size := rest.agg(F.min(F.size("tokens"))).first()[0]) is not None:
        level, longer = rest.where(F.size("tokens") == size), rest.where(F.size("tokens") > size)
        kept = kept.unionByName(level)
        met = longer.select("tokens", F.explode("tokens").alias("filed")).join(level.select("filed", F.col("tokens").alias("_part")), "filed")
        implied = met.where(F.size(F.array_except("_part", "tokens")) == 0).select("tokens").distinct()
        rest = cut(longer.join(implied, "tokens", "left_anti"))
    return kept


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url and the surest mined rule (its tokens, joined) for those of urls(url, tokens) that a rule fits."""
    filed = rules.select("filed", F.col("tokens").alias("rule_tokens"), "confidence", "support")
    met = urls.select("url", "tokens", F.explode("tokens").alias("filed")).join(filed, "filed")
    fit = met.where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("rule_tokens", " ").alias("rule")))
    return fit.groupBy("url").agg(best.alias("b")).select("url", F.col("b.rule").alias("mined_rule"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[HostRule, ...] = RULES) -> DataFrame:
    """Adds host, path, rule, verdict and mined_rule to every page."""
    own = pages.drop("host", "path", "rule", "verdict", "mined_rule")
    host, path = host_and_path(F.col("url"))
    tokens = url_tokens(F.col("url"), host, path)
    mined = mine(own.select("page_id", "url", tokens.alias("tokens")), labels)
    urls = own.select("url").where("url is not null").distinct().withColumn("tokens", tokens)
    given = packed(own, url=F.col("url"), host=host, path=path).withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    rows = given.where("url is not null").join(matched(urls, mined), "url", "left")
    rows = rows.unionByName(given.where("url is null").withColumn("mined_rule", F.lit(None).cast("string")))
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("mined_rule").isNotNull(), F.lit("block")), F.lit("allow"))
    return rows.select("_row.*", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), "mined_rule")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def _given_sql() -> str:
    """The given rules, longest first."""
    rules = sorted(RULES, key=lambda r: -len(r.host + r.path))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in rules) + " END"
    return f"{case(lambda r: r.host + r.path)} AS rule, {case(lambda r: r.verdict)} AS given"


#: Combinations grow by one token in ascending order, in all pages that hold them, from those that are frequent enough and no rule yet.
ORACLES = {
    "op3_url_filter": f"""
WITH RECURSIVE rest AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest, row_number() OVER () AS page FROM pages),
parsed AS (SELECT page_id, page, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
tokened AS (SELECT *, list_distinct(list_concat(
    CASE WHEN contains(url, '://') AND instr(url, '://') > 1 THEN ['s:' || lower(split_part(url, '://', 1))] ELSE [] END,
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split_regex(lower(path), '[/._-]+'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')),
    list_transform(regexp_extract_all(coalesce(url, ''), '[?&]([^=&#]+)', 1), lambda x: 'q:' || x))) AS tokens FROM parsed),
marked AS (SELECT doc_id, bool_or(coalesce(toxic = 1 OR quality = 0, false)) AS bad FROM labels GROUP BY doc_id),
known AS MATERIALIZED (SELECT page, bad, tokens FROM tokened JOIN marked ON page_id = doc_id WHERE bad OR len(tokens) > 0),
tokens AS MATERIALIZED (SELECT page, bad::INT AS bad, unnest(tokens) AS token FROM known),
total AS (SELECT count(*) AS n, greatest(ceil({MIN_SUPPORT} * count(*)), 1) AS least FROM known),
grown AS (
  SELECT page, bad, [token] AS items, token AS last, count(*) OVER w AS seen, sum(bad) OVER w AS hits FROM tokens WINDOW w AS (PARTITION BY token)
  UNION ALL
  SELECT page, bad, items, last, count(*) OVER w AS seen, sum(bad) OVER w AS hits
  FROM (SELECT g.page, g.bad, list_append(items, token) AS items, token AS last FROM grown g JOIN tokens t ON t.page = g.page AND token > last, total WHERE hits >= least AND hits / seen < {MIN_CONFIDENCE})
  WINDOW w AS (PARTITION BY items)
),
implying AS MATERIALIZED (SELECT DISTINCT items, hits / seen AS confidence, hits / n AS support FROM grown, total WHERE hits >= least AND hits / seen >= {MIN_CONFIDENCE}),
mined AS (SELECT * FROM implying i WHERE NOT EXISTS (SELECT 1 FROM implying o WHERE len(o.items) < len(i.items) AND list_has_all(i.items, o.items))),
best AS (SELECT page, max(ROW(confidence, support, array_to_string(items, ' '))) AS m FROM tokened JOIN mined ON list_has_all(tokens, items) GROUP BY page),
ruled AS (SELECT page_id, host, path, page, {_given_sql()} FROM parsed)
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN m IS NOT NULL THEN 'block' END, 'allow') AS verdict, m[3] AS mined_rule FROM ruled LEFT JOIN best USING (page)
""",
}
