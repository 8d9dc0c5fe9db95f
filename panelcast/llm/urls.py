"""URL filters by association rules.

Explicit host and path rules come first, the longest that fits deciding. Other
URLs are judged by token combinations that FP-growth finds to go with blocked
pages: a combination is kept if enough labelled pages hold it (support), if
enough of these are blocked (confidence), and if no shorter combination is at
least as sure. Each kept combination is indexed under its rarest token; the
distinct token sets of the URLs look up their tokens there and are checked for
the rest, so a popular host is matched once.

Defined cases: a null URL, or one without "://", has an empty host and path, no
tokens and so no rule; unlabelled and null-labelled pages aren't learnt from;
repeated rows are judged alike; without labels nothing is learnt and everything
without an explicit rule is allowed; an empty table gives an empty table; extra
columns stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

#: Fixed values: (verdict, host, path) of the explicit rules of the registered query.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
BLOCK, ALLOW = "=block", "=allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Mining:
    """Share of labelled pages that must hold a combination, and share of these that must be blocked."""

    min_support: float = 0.002
    min_confidence: float = 0.6


def parsed(pages: DataFrame) -> DataFrame:
    """pages with `host` (ASCII letters small) and `path`."""
    whole = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return pages.withColumns(
        {
            "host": F.expr(f"translate(regexp_extract(coalesce(url, ''), {whole}, 1), '{UPPER}', '{LOWER}')"),
            "path": F.expr(f"regexp_extract(coalesce(url, ''), {whole}, 2)"),
        }
    )


def explicit(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Parsed pages with `rule` and `rule_verdict` of the longest rule that fits, else null."""
    text, verdict = "CASE", "CASE"
    for what, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = f"(host = '{host}' OR endswith(host, '.{host}')) AND startswith(path, '{path}')"
        text += f" WHEN {fits} THEN '{host}{path}'"
        verdict += f" WHEN {fits} THEN '{what}'"
    return pages.withColumns({"rule": F.expr(f"{text} END"), "rule_verdict": F.expr(f"{verdict} END")})


def tokens(pages: DataFrame) -> DataFrame:
    """Parsed pages with `_items`: distinct tokens of host, path, query and fragment, in order."""
    lead = "transform(filter(split({0}, '{1}'), x -> x <> ''), x -> concat('{2}', x))"
    number = r"transform({0}, x -> regexp_replace(x, '[0-9]+', '#'))"
    query = r"regexp_extract(coalesce(url, ''), '^[^?#]*[?]([^#]*)', 1)"
    return pages.withColumn(
        "_items",
        F.expr(
            "CASE WHEN host = '' THEN CAST(array() AS array<string>) ELSE array_sort(array_distinct(concat("
            + lead.format("host", "[.]", "h:")
            + ", array(concat('host:', host)), "
            + number.format(lead.format("path", "/", "p:"))
            + ", "
            + number.format(lead.format(query, "&", "q:"))
            + ", CASE WHEN url LIKE '%#%' THEN array('fragment') ELSE CAST(array() AS array<string>) END))) END"
        ),
    )


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Kept combinations (`need`, confidence, support) from rows (_items, blocked); each held once."""
    spark = labelled.sparkSession
    baskets = stage(
        labelled.filter("size(_items) > 0 AND blocked IS NOT NULL").select(
            F.expr(f"concat(_items, array(CASE WHEN blocked THEN '{BLOCK}' ELSE '{ALLOW}' END))").alias("items")
        ),
        "url-baskets",
    )
    if baskets.isEmpty():
        return spark.createDataFrame([], "need array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=mining.min_support, minConfidence=mining.min_confidence).fit(baskets)
    rules = stage(
        model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCK))).select(
            F.array_sort("antecedent").alias("need"), "confidence", "support"
        ),
        "url-rules",
    )
    # A longer combination adds nothing to a part of it that is as sure.
    part = rules.select(F.explode("need").alias("t"), "need", "confidence")
    whole = rules.select(F.col("need")[0].alias("t"), F.col("need").alias("short"), F.col("confidence").alias("sure"))
    implied = (
        part.join(whole, "t")
        .filter("size(short) < size(need) AND sure >= confidence AND size(array_except(short, need)) = 0")
        .select("need")
        .distinct()
    )
    return rules.join(implied, "need", "left_anti")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (_items, matched): the surest combination each distinct token set holds; sets without one are absent."""
    counts = sets.select(F.explode("_items").alias("t")).groupBy("t").count()
    index = (
        rules.withColumn("t", F.explode("need"))
        .join(counts, "t")
        .groupBy("need", "confidence")
        .agg(F.min(F.struct("count", "t"))["t"].alias("t"))
    )
    return (
        sets.withColumn("t", F.explode("_items"))
        .join(index, "t")
        .filter("size(array_except(need, _items)) = 0")
        .groupBy("_items")
        .agg(F.max(F.struct("confidence", F.array_join("need", " ").alias("need")))["need"].alias("matched"))
    )


def filter_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    mining: Mining = Mining(),
) -> DataFrame:
    """pages with host, path, rule, `matched` and verdict.

    `labelled` has url and a boolean `blocked`.
    """
    learnt = stage(mine(tokens(parsed(labelled.select("url", "blocked"))), mining), "url-learnt")
    judged = tokens(explicit(parsed(pages), rules))
    sets = judged.filter("rule IS NULL AND size(_items) > 0").select("_items").distinct()
    hits = matched(stage(sets, "url-sets"), learnt)
    return (
        judged.join(hits, "_items", "left")
        .withColumn(
            "verdict",
            F.expr("CASE WHEN rule IS NOT NULL THEN rule_verdict WHEN matched IS NOT NULL THEN 'block' ELSE 'allow' END"),
        )
        .withColumn("matched", F.expr("CASE WHEN rule IS NULL THEN matched END"))
        .drop("_items", "rule_verdict")
    )


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of pages whose document (the number that ends the path) is labelled: bad quality or toxic is blocked."""
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max(F.expr("quality = 0 OR toxic = 1")).alias("blocked"))
    )
    pages = parsed(table(spark, sf_dir, "pages").select("url"))
    of = pages.withColumn("doc_id", F.expr(r"try_cast(regexp_extract(path, '/([0-9]{1,18})(?:[.][a-z]+)?/?$', 1) AS bigint)"))
    return of.join(labels, "doc_id").select("url", "blocked")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, labelled_pages(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict", "matched")


QUERIES = {"op8_url_filters": (op8, None)}
