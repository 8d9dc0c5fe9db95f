"""The test tables seen as panel data: Spark DataFrames and the same in SQL.

Suppliers are the sites, parts the packs, lineitem the transactions. A site
reports to the sample from a certain size on; the other sites are the part of
the universe that has to be estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import semantics as sem

YEARS = ("1999", "2000")
PERIODS = ["2000Q1", "2000Q2"]
REPORTING_SIZE = 1500
OUTLIER_SIZE = 9000
NEW_SITES = (8000, 8500)
DOUBTFUL = ("PROMO", 6000, 8000)
SPLIT_CITY = "NATION_9"
EQUAL_SHARE_PROVINCE = "ASIA"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _places(spark: SparkSession, sf: str) -> DataFrame:
    """25 nations with their region: fixed-size tables."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def sites(spark: SparkSession, sf: str) -> DataFrame:
    places = _places(spark, sf)
    return (
        table(spark, sf, "supplier")
        .join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("site_key"),
            F.col("s_name").alias("site"),
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city"),
            F.concat("n_name", F.lit("-"), (F.col("s_suppkey") % 2).cast("string")).alias("district"),
            F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("est"),
            F.col("s_acctbal").alias("size"),
        )
    )


def packs(spark: SparkSession, sf: str) -> DataFrame:
    atc3 = F.concat(
        F.lit("C"),
        F.lpad(F.substring("p_brand", 7, 2), 2, "0"),
        F.substring("p_type", 1, 1),
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("pack_key"),
        sem.pad_id("p_partkey").alias("packid"),
        F.col("p_type").alias("market"),
        F.col("p_brand").alias("molecule"),
        atc3.alias("atc3"),
        F.concat(atc3, (F.col("p_size") % 4 + 1).cast("string")).alias("atc4"),
        F.col("p_name").alias("item"),
        F.col("p_size").cast("double").alias("pack_size"),
        F.concat(
            F.upper("p_type"), F.lit(" "), F.col("p_size").cast("string"), F.lit("MG "),
            (F.col("p_partkey") % 100).cast("string"),
        ).alias("pack_desc"),
        (F.col("p_size") % 25).cast("int").alias("corp_id"),
    )


def corporations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("corp_id"), F.col("n_name").alias("corp_desc")
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions with all site, pack and period attributes.

    Packs come last and by their padded id: if that join shuffles, the rows lie
    by packid, and what is summed or looked up by packid shuffles nothing more.
    """
    year = F.year("l_shipdate")
    return (
        table(spark, sf, "lineitem")
        .select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
        .filter(F.col("l_partkey").isNotNull())
        .join(sites(spark, sf), F.col("l_suppkey") == F.col("site_key"))
        .join(packs(spark, sf), sem.pad_id("l_partkey") == F.col("packid"))
        .select(
            "site", "province", "city", "district", "size", "market", "molecule", "atc3",
            "packid", "item",
            year.cast("string").alias("year"),
            F.concat(
                year.cast("string"), F.lit("Q"), F.quarter("l_shipdate").cast("string")
            ).alias("quarter"),
            (year * 100 + F.month("l_shipdate")).cast("string").alias("date"),
            F.col("l_quantity").alias("units"),
            F.col("l_extendedprice").alias("sales"),
        )
    )


def sample(spark: SparkSession, sf: str) -> DataFrame:
    return panel(spark, sf).filter(F.col("size") >= REPORTING_SIZE)


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions as a provincial feed would deliver them."""
    rows = table(spark, sf, "lineitem").join(
        sites(spark, sf), F.col("l_suppkey") == F.col("site_key")
    )
    return rows.select(
        F.year("l_shipdate").alias("Year"),
        F.concat(
            F.year("l_shipdate").cast("string"), F.lit("Q"), F.quarter("l_shipdate").cast("string")
        ).alias("Quarter"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("Month"),
        F.concat("province", F.lit("省")).alias("Province"),
        F.when(F.col("province") == "AFRICA", F.lit("市辖区"))
        .otherwise(F.concat("city", F.lit("市")))
        .alias("City"),
        F.col("district").alias("County"),
        F.col("site").alias("Hospital_Name"),
        F.col("l_partkey").alias("packcode"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Price"),
        F.col("l_extendedprice").alias("Value"),
    )


FEED_COLUMNS = {
    "year": "Year",
    "quarter": "Quarter",
    "date": "Month",
    "province": "Province",
    "city": "City",
    "district": "County",
    "hospital": "Hospital_Name",
    "packid": "packcode",
    "price": "Price",
    "sales": "Value",
}
FEED_RULES = {
    "province_suffix": "省|市",
    "city_suffix": "市",
    "municipal_label": "市辖区",
    "municipal_city": "北京",
}

SITES = """sites AS (
  SELECT s_suppkey AS site_key, s_name AS site, r_name AS province, n_name AS city,
         n_name || '-' || CAST(s_suppkey % 2 AS VARCHAR) AS district,
         CASE WHEN s_acctbal > 0 THEN s_acctbal END AS est, s_acctbal AS size
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

PACKS = """packs AS (
  SELECT p_partkey AS pack_key,
         CASE WHEN p_partkey > 9999999 THEN CAST(p_partkey AS VARCHAR)
              ELSE lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS packid,
         p_type AS market, p_brand AS molecule,
         'C' || lpad(substr(p_brand, 7, 2), 2, '0') || substr(p_type, 1, 1) AS atc3,
         'C' || lpad(substr(p_brand, 7, 2), 2, '0') || substr(p_type, 1, 1)
             || CAST(p_size % 4 + 1 AS VARCHAR) AS atc4,
         p_name AS item, CAST(p_size AS DOUBLE) AS pack_size,
         upper(p_type) || ' ' || CAST(p_size AS VARCHAR) || 'MG '
             || CAST(p_partkey % 100 AS VARCHAR) AS pack_desc,
         CAST(p_size % 25 AS INTEGER) AS corp_id
  FROM part)"""

PANEL = (
    SITES
    + ",\n"
    + PACKS
    + """,
panel AS (
  SELECT site, province, city, district, size, market, molecule, atc3, packid, item,
         CAST(year(l_shipdate) AS VARCHAR) AS year,
         CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS quarter,
         strftime(l_shipdate, '%Y%m') AS date,
         l_quantity AS units, l_extendedprice AS sales
  FROM lineitem JOIN packs ON l_partkey = pack_key JOIN sites ON l_suppkey = site_key)"""
)

SAMPLE = PANEL + f",\nsample AS (SELECT * FROM panel WHERE size >= {REPORTING_SIZE})"

FEED = (
    SITES
    + """,
feed AS (
  SELECT year(l_shipdate) AS Year,
         CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS Quarter,
         CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS Month,
         province || '省' AS Province,
         CASE WHEN province = 'AFRICA' THEN '市辖区' ELSE city || '市' END AS City,
         district AS County, site AS Hospital_Name, l_partkey AS packcode,
         l_extendedprice / l_quantity AS Price, l_extendedprice AS Value
  FROM lineitem JOIN sites ON l_suppkey = site_key)"""
)

NORMALISED = """normalised AS (
  SELECT DISTINCT CAST(Year AS VARCHAR) AS year, Quarter AS quarter,
         CAST(Month AS VARCHAR) AS date,
         regexp_replace(Province, '省|市', '', 'g') AS province,
         CASE WHEN City = '市辖区' THEN '北京' ELSE regexp_replace(City, '市', '', 'g') END AS city,
         County AS district, Hospital_Name AS hospital,
         CASE WHEN length(CAST(packcode AS VARCHAR)) >= 7 THEN CAST(packcode AS VARCHAR)
              ELSE lpad(CAST(packcode AS VARCHAR), 7, '0') END AS packid,
         Price AS price, Value AS sales, Value / nullif(Price, 0) AS units
  FROM feed)"""

CORPORATIONS = """corporations AS (
  SELECT n_nationkey AS corp_id, n_name AS corp_desc FROM nation)"""
