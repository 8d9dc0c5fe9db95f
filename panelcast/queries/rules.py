"""Rules as data: the fixed labels and factors as rule tables, and a rule table that grows with the packs."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import rules as op
from panelcast.queries import adjust, deliver
from panelcast.queries import bindings as b
from panelcast.queries.registry import REGISTRY, query, total0, with_
from panelcast.sources.stages import stage

KEYS = ["city", "market", "molecule"]

# Every pack gives one rule. Rules with more keys come first, but some wide ones come before all.
_PACK_RULES = """pack_rules AS (
  SELECT CASE WHEN p_partkey % 389 = 0 THEN p_partkey
              ELSE p_partkey + CAST(1000000000 AS BIGINT) * CASE WHEN p_partkey % 7 = 6 THEN 4 WHEN p_partkey % 7 IN (3, 4) THEN 3
                                                 WHEN p_partkey % 7 IN (1, 2, 5) THEN 2 ELSE 1 END END AS priority,
         CASE WHEN p_partkey % 7 IN (0, 1, 3, 5) THEN 'NATION_' || CAST(p_partkey % 23 AS VARCHAR) END AS city,
         CASE WHEN p_partkey % 7 IN (0, 1, 2, 4) THEN p_type END AS market,
         CASE WHEN p_partkey % 7 IN (0, 2, 5) THEN p_brand END AS molecule,
         CAST(p_size % 10 AS DOUBLE) / 8 AS factor
  FROM part)"""


def pack_rules(spark, sf):
    key = F.col("p_partkey").cast("bigint")
    kind = key % 7
    level = F.when(kind == 6, 4).when(kind.isin(3, 4), 3).when(kind.isin(1, 2, 5), 2).otherwise(1)
    return b.table(spark, sf, "part").select(
        F.when(key % 389 == 0, key).otherwise(key + F.lit(1_000_000_000).cast("bigint") * level).alias("priority"),
        F.when(kind.isin(0, 1, 3, 5), F.concat(F.lit("NATION_"), (key % 23).cast("string"))).alias("city"),
        F.when(kind.isin(0, 1, 2, 4), F.col("p_type")).alias("market"),
        F.when(kind.isin(0, 2, 5), F.col("p_brand")).alias("molecule"),
        ((F.col("p_size") % 10).cast("double") / 8).alias("factor"),
    )


_FITS = " AND ".join(f"(r.{k} IS NULL OR r.{k} = c.{k})" for k in KEYS)
_DECIDED = f"""combos AS (SELECT DISTINCT city, market, molecule FROM panel),
firsts AS (
  SELECT c.city, c.market, c.molecule, min(r.priority) AS rule
  FROM combos c JOIN pack_rules r ON {_FITS} GROUP BY ALL),
decided AS (
  SELECT p.site, p.packid, p.date, p.city, p.market, p.molecule, p.sales, r.priority AS rule, r.factor
  FROM panel p LEFT JOIN firsts f USING (city, market, molecule) LEFT JOIN pack_rules r ON r.priority = f.rule)"""


def decided(spark, sf, rules):
    rows = b.panel(spark, sf).select("site", "packid", "date", *KEYS, "sales")
    return op.first_match(rows, rules, KEYS, ["factor"])


@query(with_(b.PANEL, _PACK_RULES, _DECIDED, "SELECT * REPLACE (sales * factor AS sales) FROM decided"))
def rules_applied(spark, sf):
    """Sales scaled by the first rule that fits, out of one rule per pack."""
    rules = stage(pack_rules(spark, sf), "rules")
    return decided(spark, sf, rules).withColumn("sales", F.col("sales") * F.col("factor"))


def _compatible(test: str) -> str:
    return " AND ".join(test.format(k=k) for k in KEYS)


@query(
    with_(
        b.PANEL, _PACK_RULES, _DECIDED,
        f"""covered AS (
  SELECT l.priority, min(e.priority) AS covered_by FROM pack_rules l JOIN pack_rules e
  ON e.priority < l.priority AND {_compatible('(e.{k} IS NULL OR e.{k} = l.{k})')} GROUP BY ALL)""",
        f"""crossed AS (
  SELECT l.priority, min(e.priority) AS overlapped_by FROM pack_rules l JOIN pack_rules e
  ON e.priority < l.priority AND {_compatible('(e.{k} IS NULL OR l.{k} IS NULL OR e.{k} = l.{k})')}
     AND NOT ({_compatible('(e.{k} IS NULL OR coalesce(e.{k} = l.{k}, false))')}) GROUP BY ALL)""",
        f"""used AS (SELECT rule AS priority, count(*) AS n_rows, {total0('sales')} AS sales FROM decided
                     WHERE rule IS NOT NULL GROUP BY ALL)""",
        """SELECT r.*, covered_by, overlapped_by, coalesce(n_rows, 0) AS n_rows, coalesce(u.sales, 0.0) AS sales,
                  CASE WHEN covered_by IS NOT NULL THEN 'unreachable' WHEN n_rows IS NULL THEN 'unused'
                       WHEN overlapped_by IS NOT NULL THEN 'partly' ELSE 'clear' END AS status
           FROM pack_rules r LEFT JOIN covered USING (priority) LEFT JOIN crossed USING (priority)
           LEFT JOIN used u USING (priority)""",
    )
)
def rule_report(spark, sf):
    """Rules that can't be reached, that overlap, and that decide no sale."""
    rules = stage(pack_rules(spark, sf), "rules")
    return op.usage(op.conflicts(rules, KEYS, ["factor"]), decided(spark, sf, rules), ["sales"])


@query(REGISTRY["therapeutic_class_rules"][1])
def class_rules_as_data(spark, sf):
    """Class labels from a rule table: the same rows as from conditions."""
    rows = b.panel(spark, sf).select(
        "packid", "site", "date", "market", "atc3",
        F.nullif(F.col("molecule"), F.lit("Brand#4")).alias("molecule"),
        (F.col("sales") * 0.125).alias("sales"),
        sem.half_even(F.col("units") * 0.5, 0).alias("units"),
    ).filter(F.col("molecule") != "Brand#6")
    keys = ["market", "atc3", "molecule"]
    rules = op.from_rows(rows, deliver.CLASS_RULES, keys, "class_label string")
    return op.first_match(rows, rules, keys, ["class_label"]).drop("rule")


@query(REGISTRY["scale_unobserved"][1])
def factor_rules_as_data(spark, sf):
    """Unobserved rows scaled by a rule table of cities and markets: the same rows as from the grid."""
    rows = adjust.flagged(spark, sf)
    rules = op.from_rows(rows, adjust.OVERRIDES, ["city", "market"], "factor double")
    rules = rules.filter(F.col("market").isNull() | F.col("market").isin(adjust.MARKETS))
    found = op.first_match(rows, rules, ["city", "market"], ["factor"])
    listed = (F.col("panel") != 1) & F.col("market").isin(adjust.MARKETS)
    factor = F.when(listed, F.coalesce("factor", F.lit(1.0))).otherwise(F.lit(1.0))
    return found.withColumns({m: F.col(m) * factor for m in ("sales", "units")}).drop("rule", "factor")
