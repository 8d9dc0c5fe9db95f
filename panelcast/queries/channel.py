"""Second channel on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import channel as op
from panelcast.queries import bindings as b
from panelcast.queries.adjust import ALLOCATION
from panelcast.operators.adjust import reassign_and_exclude, split_across_markets
from panelcast.queries.registry import in_, query, total0, values, with_

QUARTERS = ["2000Q1", "2000Q2"]
KEYS = ["year", "quarter", "province", "city", "market", "atc3", "molecule", "packid"]
CORP_BY_PRODUCT = {"small ring": "MERCK GROUP", "red widget": "ASTRAZENECA GROUP"}
FORMS = ["SMAL", "LARG", "MEDI"]
DROPPED = ["C05", "C07", "C08"]

_EXTRACT = f"""extract_ AS (
  SELECT n.year, n.quarter, n.province, n.city, p.market, p.atc3, p.molecule, n.packid,
         {total0('n.sales')} AS sales, {total0('n.units')} AS units
  FROM normalised n JOIN packs p ON p.packid = n.packid
  WHERE n.quarter IN {in_(QUARTERS)} AND n.province = 'AMERICA'
    AND regexp_matches(n.hospital, '[0-4]$')
  GROUP BY n.year, n.quarter, n.province, n.city, p.market, p.atc3, p.molecule, n.packid)"""
_NAMED = f"""named AS (
  SELECT e.*, substr(e.atc3, 1, 3) AS atc2, nullif(p.item, 'blue rod') AS product, p.pack_desc,
         p.pack_size,
         CASE nullif(p.item, 'blue rod') WHEN 'small ring' THEN 'MERCK GROUP'
              WHEN 'red widget' THEN 'ASTRAZENECA GROUP' ELSE c.corp_desc END AS corp_desc,
         p.pack_size * e.units AS dosage_units
  FROM extract_ e LEFT JOIN packs p ON p.packid = e.packid
  LEFT JOIN corporations c ON c.corp_id = p.corp_id)"""
_CHAIN = [b.FEED, b.NORMALISED, b.PACKS, b.CORPORATIONS, _EXTRACT, _NAMED]


def pack_details(spark, sf):
    packs = b.packs(spark, sf).select(
        "packid", "pack_desc", "pack_size", "corp_id",
        F.nullif(F.col("item"), F.lit("blue rod")).alias("product"),
    )
    return sem.lookup_join(packs, b.corporations(spark, sf), ["corp_id"], ["corp_desc"]).drop("corp_id")


def extract(spark, sf):
    markets = b.packs(spark, sf).select("packid", "market", "atc3", "molecule")
    return op.channel_extract(
        b.feed(spark, sf), b.FEED_COLUMNS, "[0-4]$", "AMERICA省", QUARTERS, markets, KEYS,
        b.FEED_RULES,
    )


def named(spark, sf):
    details = ["product", "pack_desc", "pack_size", "corp_desc"]
    out = op.dosage_units(extract(spark, sf), pack_details(spark, sf), details, CORP_BY_PRODUCT)
    return out.withColumn("atc2", F.substring("atc3", 1, 3))


@query(with_(*_CHAIN[:5], "SELECT * FROM extract_"))
def channel_extract(spark, sf):
    return extract(spark, sf)


@query(with_(*_CHAIN, "SELECT * FROM named"))
def dosage_units(spark, sf):
    return named(spark, sf)


@query(
    with_(
        *_CHAIN,
        "SELECT * FROM named WHERE substr(pack_desc, 1, 4) IN ('SMAL', 'LARG', 'MEDI')"
        " AND atc2 NOT IN ('C05', 'C07', 'C08') OR atc2 IN ('C07', 'C08')",
    )
)
def dosage_form_gate(spark, sf):
    return op.dosage_form_gate(named(spark, sf), FORMS, 4, DROPPED, bypass=["C07", "C08"])


@query(
    with_(
        *_CHAIN,
        values(ALLOCATION, ["class", "target", "share"], "allocation"),
        """moved AS (SELECT * REPLACE (CASE WHEN atc2 IN ('C07', 'C08') THEN 'PROMO' ELSE market END
                                       AS market) FROM named),
           kept AS (SELECT * FROM moved
                    WHERE (market = 'PROMO' AND product = 'new bolt') IS NOT TRUE)""",
        """SELECT k.* REPLACE (coalesce(a.target, k.market) AS market,
                  k.sales * coalesce(a.share, 1.0) AS sales, k.units * coalesce(a.share, 1.0) AS units,
                  k.dosage_units * coalesce(a.share, 1.0) AS dosage_units),
                  'CHS' AS channel
           FROM kept k LEFT JOIN allocation a ON a.class = k.atc2
           WHERE substr(pack_desc, 1, 4) IN ('SMAL', 'LARG', 'MEDI') AND atc2 <> 'C05'
              OR atc2 IN ('C07', 'C08')""",
    )
)
def second_channel(spark, sf):
    """Extract → dosage units → reassign, exclude, split → form gate."""
    rows = reassign_and_exclude(
        named(spark, sf).drop("atc2"), ["C07", "C08"], "PROMO", [("PROMO", "new bolt")], by="product"
    )
    rows = split_across_markets(rows, ALLOCATION, ["sales", "units", "dosage_units"])
    rows = op.dosage_form_gate(rows, FORMS, 4, DROPPED, bypass=["C07", "C08"])
    return rows.withColumn("channel", F.lit("CHS"))
