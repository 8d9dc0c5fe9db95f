"""Ingest and conform on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import conform as op
from panelcast.queries import bindings as b
from panelcast.queries.registry import in_, query, total0, with_
from panelcast.sources import rejects, schemas
from panelcast.sources.runs import OTHER, Run
from panelcast.sources.stages import stage

PANEL_KEYS = [
    "year", "date", "quarter", "province", "city", "district", "site", "market", "atc3",
    "molecule", "packid",
]
_KEYS = ", ".join(PANEL_KEYS)


@query(
    """SELECT r_name AS province, n_name AS city, nullif(c_mktsegment, 'MACHINERY') AS hospital,
              min(c_name) AS code
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey
       WHERE nullif(c_mktsegment, 'MACHINERY') IS NOT NULL AND c_acctbal > 0
       GROUP BY 1, 2, 3"""
)
def lookup_first_by_key(spark, sf):
    rows = (
        b.table(spark, sf, "customer")
        .join(F.broadcast(b._places(spark, sf)), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city"),
            F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("hospital"),
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("code"),
        )
    )
    return op.lookup_first_by_key(rows, ["province", "city", "hospital"], "code")


@query(
    with_(
        b.SITES,
        """SELECT province, city, district, site AS hospital, site FROM sites
           UNION
           SELECT province, city, district,
                  CASE WHEN size > 5000 THEN replace(site, 'Supplier#', 'Centre ') ELSE site END, site
           FROM sites""",
    )
)
def lookup_union_distinct(spark, sf):
    sites = b.sites(spark, sf)
    place = ["province", "city", "district"]
    alternative = F.when(
        F.col("size") > 5000, F.replace("site", F.lit("Supplier#"), F.lit("Centre "))
    ).otherwise(F.col("site"))
    return op.lookup_union_distinct(
        sites.select(*place, F.col("site").alias("hospital"), "site"),
        sites.select(*place, alternative.alias("hospital"), "site"),
    )


_HOLES = """holes AS (
  SELECT site, packid, date, units, sales, nullif(market, 'PROMO') AS market,
         CASE WHEN market = 'PROMO' THEN NULL ELSE province END AS province,
         CASE WHEN market IN ('PROMO', 'SMALL') THEN NULL ELSE city END AS city,
         nullif(molecule, 'Brand#1') AS molecule,
         CASE WHEN market = 'LARGE' THEN 0 ELSE 1 END AS source_rank
  FROM panel)"""


def _holes(spark, sf):
    market = F.col("market")
    return b.panel(spark, sf).select(
        "site", "packid", "date", "units", "sales",
        F.nullif(market, F.lit("PROMO")).alias("market"),
        F.when(market != "PROMO", F.col("province")).alias("province"),
        F.when(~market.isin("PROMO", "SMALL"), F.col("city")).alias("city"),
        F.nullif(F.col("molecule"), F.lit("Brand#1")).alias("molecule"),
        F.when(market == "LARGE", 0).otherwise(1).alias("source_rank"),
    )


@query(
    with_(
        b.PANEL, _HOLES,
        """SELECT site, min(province) AS province, min(city) AS city,
                  (min({'r': source_rank, 'v': molecule}) FILTER (WHERE molecule IS NOT NULL)).v
                      AS molecule
           FROM (SELECT site, source_rank, province, city, molecule FROM holes) GROUP BY site""",
    )
)
def first_valid_by_key(spark, sf):
    return op.first_valid_by_key(
        _holes(spark, sf), ["site"], ["province", "city", "molecule"], "source_rank"
    )


@query(
    with_(
        b.PANEL, _HOLES,
        """SELECT site, packid, date, units, sales,
                  min(province) OVER (PARTITION BY site) AS province,
                  min(city) OVER (PARTITION BY site) AS city
           FROM holes""",
    )
)
def fill_attrs_within_key(spark, sf):
    rows = _holes(spark, sf).select(
        "site", "packid", "date", "units", "sales", "province", "city"
    )
    return op.fill_attrs_within_key(rows, ["site"], ["province", "city"])


@query(
    with_(
        b.PACKS,
        """SELECT DISTINCT packid, substr(atc4, 1, 4) AS atc3, substr(atc4, 1, 3) AS atc2, molecule
           FROM packs""",
    )
)
def conform_pack_reference(spark, sf):
    return op.conform_pack_reference(b.packs(spark, sf), "pack_key", "atc4", "molecule")


@query(
    with_(
        b.PACKS,
        """defined AS (SELECT DISTINCT molecule, CASE WHEN market <> 'PROMO' AND pack_size > 45 THEN market END AS market
                       FROM packs)""",
        """SELECT p.molecule, d.market, p.packid, p.atc3, substr(p.atc3, 1, 3) AS atc2
           FROM defined d JOIN packs p ON d.molecule = p.molecule WHERE d.market IS NOT NULL""",
    )
)
def market_definition(spark, sf):
    packs = b.packs(spark, sf)
    known = (F.col("market") != "PROMO") & (F.col("pack_size") > 45)
    markets = packs.select("molecule", F.when(known, F.col("market")).alias("market"))
    reference = op.conform_pack_reference(packs, "pack_key", "atc4", "molecule")
    return op.market_definition(markets, reference)


@query(
    with_(
        b.FEED, b.NORMALISED,
        """SELECT year, quarter, date, province, city, district, hospital, packid,
                  price, sales, units FROM normalised""",
    )
)
def normalise_transactions(spark, sf):
    return op.normalise_transactions(b.feed(spark, sf), b.FEED_COLUMNS, **b.FEED_RULES)


_FEED_COLS = ["site", "packid", "quarter", "year", "item", "sales", "source_rank"]


@query(
    with_(
        b.PANEL,
        """SELECT site, packid, quarter, year, item, sales, 0 AS source_rank
           FROM panel WHERE year = '1999'
           UNION ALL SELECT site, packid, quarter, year, item, sales, 1 FROM panel WHERE year = '2000'
           UNION ALL SELECT site, packid, quarter, year, NULL, sales, 2 FROM panel
           WHERE year NOT IN ('1999', '2000')""",
    )
)
def union_feeds(spark, sf):
    rows = b.panel(spark, sf).select(*[c for c in _FEED_COLS if c != "source_rank"])
    previous = rows.filter(F.col("year") == "1999").withColumn("year", F.col("year").cast("int"))
    current = rows.filter(F.col("year") == "2000")
    others = rows.filter(~F.col("year").isin("1999", "2000")).drop("item")
    return op.union_feeds(previous, current, others, text=["year"]).select(*_FEED_COLS)


@query(
    """WITH raw AS (
         SELECT CASE l_returnflag
                  WHEN 'A' THEN CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(month(l_shipdate) AS VARCHAR)
                  WHEN 'R' THEN strftime(l_shipdate, '%Y%m%d')
                  ELSE CAST(year(l_shipdate) AS VARCHAR) || CASE WHEN l_linestatus = 'O' THEN '' ELSE '-99' END
                END AS period,
                CASE WHEN l_returnflag <> 'N' THEN month(l_shipdate) END AS m,
                CAST(year(l_shipdate) AS VARCHAR) AS year,
                l_returnflag = 'N' AND l_linestatus <> 'O' AS unknown
         FROM lineitem)
       SELECT period, year,
              year || CASE WHEN m IS NOT NULL THEN lpad(CAST(m AS VARCHAR), 2, '0')
                           WHEN unknown THEN '99' ELSE '' END AS date,
              CASE WHEN m IS NULL THEN year ELSE year || 'Q' || CAST((m + 2) // 3 AS VARCHAR) END AS quarter,
              count(*) AS n
       FROM raw GROUP BY ALL"""
)
def derive_periods(spark, sf):
    year = F.year("l_shipdate").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(year, F.lit("-"), F.month("l_shipdate").cast("string")))
        .when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "yyyyMMdd"))
        .when(F.col("l_linestatus") == "O", year)
        .otherwise(F.concat(year, F.lit("-99")))
    )
    rows = b.table(spark, sf, "lineitem").select(text.alias("period"))
    counted = rows.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    return op.derive_periods(counted, "period").select("period", "year", "date", "quarter", "n")


@query(
    with_(
        b.PANEL, _HOLES,
        """SELECT h.site, h.packid, h.date, h.sales, coalesce(h.province, s.province) AS province,
                  coalesce(h.city, s.city) AS city, s.district
           FROM holes h LEFT JOIN sites s ON h.site = s.site""",
    )
)
def coalesce_join(spark, sf):
    left = _holes(spark, sf).select("site", "packid", "date", "sales", "province", "city")
    return op.coalesce_join(
        left, b.sites(spark, sf), ["site"], ["province", "city", "district"]
    )


_PREFIXES = {"00007": "90007", "00012": "90012"}
_CODES = {"Supplier#000000003": "Supplier#000000005"}


@query(
    with_(
        b.PANEL,
        """SELECT CASE WHEN site = 'Supplier#000000003' THEN 'Supplier#000000005' ELSE site END AS site,
                  CASE substr(packid, 1, 5) WHEN '00007' THEN '90007' || substr(packid, 6, 2)
                       WHEN '00012' THEN '90012' || substr(packid, 6, 2) ELSE packid END AS packid,
                  date, sales
           FROM panel""",
    )
)
def recode_ids(spark, sf):
    rows = b.panel(spark, sf).select("site", "packid", "date", "sales")
    return op.recode_ids(rows, whole={"site": _CODES}, prefix={"packid": _PREFIXES})


@query(
    with_(
        b.PANEL, _HOLES,
        """SELECT site, packid, date, market, units, sales FROM holes
           WHERE market IS NOT NULL AND molecule IS NOT NULL AND units > 0 AND sales > 0
             AND site <> 'Supplier#000000004' AND substr(date, 1, 4) IN ('1999', '2000')""",
    )
)
def validity_gate(spark, sf):
    rows = _holes(spark, sf).select(
        "site", "packid", "date", "market", "molecule", "units", "sales",
        F.substring("date", 1, 4).alias("quarter"),
    )
    return op.validity_gate(
        rows,
        required=["site", "market", "molecule"],
        positive=["units", "sales"],
        invalid={"site": "Supplier#000000004"},
        quarters=list(b.YEARS),
    ).drop("molecule", "quarter")


@query(
    with_(
        b.PANEL,
        f"""SELECT {_KEYS}, {total0('units')} AS units, {total0('sales')} AS sales,
                   {total0('sales')} / nullif({total0('units')}, 0) AS price
            FROM panel GROUP BY {_KEYS}""",
    )
)
def canonical_panel(spark, sf):
    return op.canonical_panel(b.panel(spark, sf), PANEL_KEYS)


@query(
    with_(
        b.PANEL,
        f"""SELECT city, market, quarter, packid, {total0('sales')} AS sales, {total0('units')} AS units
            FROM panel GROUP BY ALL ORDER BY ALL""",
    )
)
def qc_totals(spark, sf):
    return op.qc_totals(
        b.panel(spark, sf), ["city", "market", "quarter", "packid"], ["sales", "units"]
    )


@query(
    with_(
        b.FEED, b.NORMALISED, b.PACKS,
        """conformed AS (
             SELECT n.year, n.date, n.quarter, n.province, n.city, n.district, n.hospital AS site,
                    p.market, p.atc3, p.molecule,
                    CASE substr(n.packid, 1, 5) WHEN '00007' THEN '90007' || substr(n.packid, 6, 2)
                         WHEN '00012' THEN '90012' || substr(n.packid, 6, 2) ELSE n.packid END AS packid,
                    n.units, n.sales
             FROM normalised n JOIN packs p ON p.packid = n.packid
             WHERE n.units > 0 AND n.sales > 0 AND n.quarter IN ('1999Q1','1999Q2','2000Q1','2000Q2'))""",
        f"""SELECT {_KEYS}, {total0('units')} AS units, {total0('sales')} AS sales,
                   {total0('sales')} / nullif({total0('units')}, 0) AS price
            FROM conformed GROUP BY {_KEYS}""",
    )
)
def panel_from_feed(spark, sf):
    """Feed → conformed → gated → recoded → canonical panel."""
    rows = op.normalise_transactions(b.feed(spark, sf), b.FEED_COLUMNS, **b.FEED_RULES)
    attrs = ["market", "atc3", "molecule"]
    rows = sem.lookup_join(rows, b.packs(spark, sf), ["packid"], attrs)
    rows = rows.withColumnRenamed("hospital", "site").drop("price")
    rows = op.validity_gate(
        rows, ["site", "market"], ["units", "sales"], {"site": "#N/A"},
        ["1999Q1", "1999Q2", "2000Q1", "2000Q2"],
    )
    rows = op.recode_ids(rows, prefix={"packid": _PREFIXES})
    return op.canonical_panel(rows, PANEL_KEYS)


_MARKETS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
_PANEL_TOTALS = {"year": [str(y) for y in range(1997, 2001)], "market": _MARKETS}


def _totals_sql(source: str, stage_name: str) -> str:
    cells = [("", "", "true")]
    for column, listed in _PANEL_TOTALS.items():
        cells += [(column, v, f"{column} = '{v}'") for v in listed]
        cells.append((column, OTHER, f"coalesce({column} NOT IN {in_(listed)}, true)"))
    return " UNION ALL ".join(
        f"SELECT '{stage_name}' AS stage, '{c}' AS \"column\", '{v}' AS value, count_if({t}) AS n_rows, "
        f"'{m}' AS measure, {total0(f'CASE WHEN {t} THEN {m} END')} AS total FROM {source}"
        for c, v, t in cells
        for m in ("units", "sales")
    )


@query(
    with_(
        b.PANEL,
        f"""canonical AS (
             SELECT {_KEYS}, {total0('units')} AS units, {total0('sales')} AS sales FROM panel GROUP BY {_KEYS})""",
        _totals_sql("panel", "rows") + " UNION ALL " + _totals_sql("canonical", "panel"),
    )
)
def stage_totals(spark, sf):
    """Control totals that were counted while two stages were written."""
    with Run(spark) as run:
        rows = run.stage(b.panel(spark, sf), "rows", ["units", "sales"], _PANEL_TOTALS)
        run.stage(op.canonical_panel(rows, PANEL_KEYS), "panel", ["units", "sales"], _PANEL_TOTALS)
        return stage(run.totals(), "totals")


_TEXT_FEED = """text_feed AS (
  SELECT nullif(Hospital_Name, 'Supplier#000000002') AS hospital, Quarter AS quarter,
         CASE WHEN packcode % 11 = 0 THEN 'n/a' WHEN packcode % 13 = 0 THEN ''
              ELSE CAST(CAST(Value AS DECIMAL(18, 2)) AS VARCHAR) END AS value_text,
         CASE WHEN packcode % 17 = 0 THEN '-1.5' WHEN packcode % 19 = 0 THEN '1,5'
              ELSE CAST(CAST(Price AS DECIMAL(18, 4)) AS VARCHAR) END AS price_text
  FROM feed),
read_ AS (
  SELECT *, TRY_CAST(value_text AS DOUBLE) AS sales, TRY_CAST(price_text AS DOUBLE) AS price FROM text_feed)"""


@query(
    with_(
        b.FEED, _TEXT_FEED,
        """judged AS (
             SELECT sales,
                    CASE WHEN price IS NULL AND trim(price_text) <> '' THEN 'price unreadable'
                         WHEN sales IS NULL AND trim(value_text) <> '' THEN 'sales unreadable'
                         WHEN hospital IS NULL THEN 'hospital missing'
                         WHEN price IS NULL THEN 'price missing'
                         WHEN sales IS NULL THEN 'sales missing'
                         WHEN price <= 0 THEN 'price not positive'
                         WHEN sales <= 0 THEN 'sales not positive'
                         WHEN hospital = 'Supplier#000000003' THEN 'hospital not available'
                         WHEN quarter NOT LIKE '1999%' AND quarter NOT LIKE '2000%' THEN 'other quarter' END AS reason
             FROM read_)""",
        f"SELECT reason, count(*) AS n_rows, {total0('sales')} AS sales FROM judged GROUP BY reason",
    )
)
def feed_rejects(spark, sf):
    """Every row of a feed delivered as text: kept (reason NULL) or rejected, by its first reason."""
    code, text = F.col("packcode"), F.col("Value").cast("decimal(18,2)").cast("string")
    price = F.col("Price").cast("decimal(18,4)").cast("string")
    raw = b.feed(spark, sf).select(
        F.nullif("Hospital_Name", F.lit("Supplier#000000002")).alias("Hospital_Name"),
        "Quarter",
        F.when(code % 17 == 0, "-1.5").when(code % 19 == 0, "1,5").otherwise(price).alias("Price"),
        F.when(code % 11 == 0, "n/a").when(code % 13 == 0, "").otherwise(text).alias("Value"),
    )
    columns = {c: k for c, k in schemas.PROVINCIAL_FEED.items() if c in raw.columns}
    rows = rejects.canonical_with_reasons(raw, columns)
    quarters = [f"{y}Q{q}" for y in b.YEARS for q in range(1, 5)]
    rules = rejects.gate_rules(["hospital"], ["price", "sales"], {"hospital": "Supplier#000000003"}, quarters)
    return rejects.balance(rejects.with_rules(rows, rules), "sales")
