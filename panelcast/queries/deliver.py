"""Delivery on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import deliver as op
from panelcast.queries import bindings as b
from panelcast.queries.channel import pack_details
from panelcast.queries.registry import half_even, in_, query, total0, values, with_
from panelcast.sources import tables
from panelcast.sources.stages import stage, stage_folder

KEYS = ["province", "city", "year", "quarter", "market", "atc3", "molecule", "packid"]
CURRENT = ["2000Q2"]
FORMS = ["SMAL", "LARG", "MEDI", "PROM"]
CHANNEL = "RETAIL"
ROUNDING = {"sales": 2, "units": 0, "dosage_units": 0}
DELIVERY_KEYS = [
    "packid", "channel", "province", "city", "quarter", "atc3", "market", "molecule", "product",
    "corp_desc", "package", "quantity",
]


def _list(keys):
    return ", ".join(keys)


_FLAGS = """flags AS (
  SELECT site, CASE WHEN size > 4000 THEN 1 WHEN size > 2500 THEN 0 END AS zs_flag FROM sites)"""


@query(
    with_(
        b.PANEL, _FLAGS,
        """SELECT p.site, p.city, p.packid, p.date, p.quarter, p.sales, f.zs_flag
           FROM panel p LEFT JOIN flags f ON f.site = p.site
           WHERE p.quarter = '2000Q2' AND (p.city NOT IN ('NATION_1', 'NATION_9') OR f.zs_flag = 1)""",
    )
)
def flagged_site_filter(spark, sf):
    size = F.col("size")
    flags = b.sites(spark, sf).select(
        "site", F.when(size > 4000, 1).when(size > 2500, 0).alias("zs_flag")
    )
    rows = b.panel(spark, sf).select("site", "city", "packid", "date", "quarter", "sales")
    return op.flagged_site_filter(
        rows, flags, ["site"], "zs_flag", ["NATION_1", "NATION_9"], CURRENT
    )


_CORP_PACK = """corp_pack AS (
  SELECT DISTINCT packid, pack_desc, pack_size,
         CASE c.corp_desc WHEN 'NATION_3' THEN 'NATION_THREE' ELSE c.corp_desc END AS corp_desc
  FROM packs p LEFT JOIN (SELECT corp_id, CASE WHEN corp_id <> 8 THEN corp_desc END AS corp_desc
                          FROM corporations) c USING (corp_id))"""


@query(with_(b.PACKS, b.CORPORATIONS, _CORP_PACK, "SELECT * FROM corp_pack"))
def corp_pack_reference(spark, sf):
    named = F.when(F.col("corp_id") != 8, F.col("corp_desc"))
    corporations = b.corporations(spark, sf).withColumn("corp_desc", named)
    return op.corp_pack_reference(
        b.packs(spark, sf), corporations, {"NATION_3": "NATION_THREE"}
    )


def delivered_sql(name: str, source: str, forms: bool) -> str:
    """Joins first, then the sum, then the floor and zero rules."""
    form = f"WHERE substr(pack_desc, 1, 4) IN {in_(FORMS)}" if forms else ""
    return f"""{name} AS (
  SELECT {_list(KEYS)}, pack_desc, corp_desc, product, '{CHANNEL}' AS channel, dosage_units,
         CASE WHEN u <= 0 OR s < 0 THEN 0.0 ELSE s END::DOUBLE AS sales,
         CASE WHEN u < 0 OR s <= 0 THEN 0.0 ELSE u END::DOUBLE AS units
  FROM (
    SELECT {_list('f.' + k for k in KEYS)}, d.pack_desc, d.corp_desc, d.product,
           {total0('f.units')} AS u, {total0('f.sales')} AS s,
           coalesce(any_value(d.pack_size) * {total0('f.units')}, 0.0) AS dosage_units
    FROM {source} f LEFT JOIN details d ON d.packid = f.packid {form}
    GROUP BY {_list('f.' + k for k in KEYS)}, d.pack_desc, d.corp_desc, d.product))"""


_DETAILS = """details AS (
  SELECT packid, pack_desc, pack_size, c.corp_desc, nullif(item, 'blue rod') AS product
  FROM packs LEFT JOIN corporations c USING (corp_id))"""
# Two cities get returns only, so that the floor and zero rules have an effect.
_SIGNED = """signed AS (
  SELECT * REPLACE (CASE WHEN city = 'NATION_2' THEN -sales ELSE sales END AS sales,
                    CASE WHEN city = 'NATION_4' THEN -units ELSE units END AS units)
  FROM panel),
current_ AS (SELECT * FROM signed WHERE quarter = '2000Q2')"""
_MAIN = delivered_sql("main_", "current_", True)
_EXTRA = delivered_sql("extra_all", "one_class", True)
_SUPPLEMENT = f"""one_class AS (SELECT * FROM signed WHERE atc3 = 'C10S'),
{_EXTRA},
extra AS (SELECT * FROM extra_all)"""
_DELIVERY = [b.PANEL, b.CORPORATIONS, _DETAILS, _SIGNED, _MAIN, _SUPPLEMENT]


def signed(spark, sf):
    rows = b.panel(spark, sf).withColumns(
        {
            "sales": F.when(F.col("city") == "NATION_2", -F.col("sales")).otherwise(F.col("sales")),
            "units": F.when(F.col("city") == "NATION_4", -F.col("units")).otherwise(F.col("units")),
        }
    )
    return rows.select(*KEYS, "sales", "units")


class Delivery:
    """Main part and supplement from one stored set of signed totals."""

    def __init__(self, spark, sf):
        sums = [sem.sum0(m).alias(m) for m in ("sales", "units")]
        self.rows = stage(signed(spark, sf).groupBy(*KEYS).agg(*sums), "signed")
        self.details = stage(pack_details(spark, sf), "details")
        self.main = main_part(op.without_class(self.rows, "C10S"), self.details)

    def supplement(self):
        return op.class_supplement(
            self.rows, self.details, self.details, KEYS, CHANNEL, "C10S", FORMS
        )


def main_part(rows, details):
    return op.delivery_aggregate(
        rows.filter(F.col("quarter").isin(CURRENT)), details, details, KEYS, CHANNEL, FORMS
    )


@query(with_(*_DELIVERY[:5], "SELECT * FROM main_"))
def delivery_aggregate(spark, sf):
    return main_part(signed(spark, sf), pack_details(spark, sf))


@query(with_(*_DELIVERY, "SELECT * FROM extra"))
def class_supplement(spark, sf):
    return Delivery(spark, sf).supplement()


NAMES = {
    "packid": "Pack_ID", "channel": "Channel", "province": "Province", "city": "City",
    "quarter": "Date", "atc3": "ATC3", "market": "MKT", "molecule": "Molecule_Desc",
    "product": "Prod_Desc", "pack_desc": "Pck_Desc", "corp_desc": "Corp_Desc",
    "sales": "Sales", "units": "Units", "dosage_units": "DosageUnits",
}
_RENAMED = _list(f"{c} AS {n}" for c, n in NAMES.items())


@query(
    with_(
        *_DELIVERY,
        f"SELECT {_RENAMED} FROM (SELECT * FROM main_ WHERE atc3 <> 'C10S' OR atc3 IS NULL "
        "UNION ALL BY NAME SELECT * FROM extra)",
    )
)
def channel_union(spark, sf):
    parts = Delivery(spark, sf)
    return op.channel_union(parts.main, parts.supplement(), names=NAMES)


_BIDS = """bids AS (
  SELECT packid, molecule, CASE WHEN pack_size < 10 THEN 'L1' WHEN pack_size < 30 THEN 'L2' END AS name1,
         CASE WHEN pack_size < 20 THEN 'won-1' WHEN pack_size < 40 THEN 'lost-2' END AS name2,
         CASE market WHEN 'PROMO' THEN 'listed' WHEN 'SMALL' THEN 'unlisted' WHEN 'LARGE' THEN 'own-1'
         END AS name3
  FROM packs),
clean AS (
  SELECT DISTINCT substr(packid, 1, 5) AS product_code, name1,
         regexp_replace(name2, '-2|-1', '', 'g') AS name2,
         regexp_replace(CASE WHEN name3 IN ('listed', 'unlisted') THEN 'generic' ELSE name3 END,
                        '-2|-1', '', 'g') AS name3
  FROM bids),
first_bid AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY product_code
                             ORDER BY name1 NULLS LAST, name2 NULLS LAST, name3 NULLS LAST) = 1)"""


def bids(spark, sf):
    size, market = F.col("pack_size"), F.col("market")
    return b.packs(spark, sf).select(
        "packid", "molecule",
        F.when(size < 10, "L1").when(size < 30, "L2").alias("name1"),
        F.when(size < 20, "won-1").when(size < 40, "lost-2").alias("name2"),
        F.when(market == "PROMO", "listed").when(market == "SMALL", "unlisted")
        .when(market == "LARGE", "own-1").alias("name3"),
    )


@query(
    with_(
        b.PANEL, _BIDS,
        """cities AS (SELECT n_name AS city, 'policy city' AS policy FROM nation WHERE n_regionkey IN (0, 2))""",
        f"""totals AS (SELECT city, quarter, packid, {total0('sales')} AS sales FROM panel GROUP BY ALL)""",
        """SELECT t.*, c.policy, substr(t.packid, 1, 5) AS product_code, f.name1, f.name2, f.name3
           FROM totals t LEFT JOIN cities c USING (city)
           LEFT JOIN first_bid f ON f.product_code = substr(t.packid, 1, 5)""",
    )
)
def policy_flags(spark, sf):
    nation = b.table(spark, sf, "nation")
    cities = nation.filter(F.col("n_regionkey").isin(0, 2)).select(
        F.col("n_name").alias("city"), F.lit("policy city").alias("policy")
    )
    rows = b.panel(spark, sf).groupBy("city", "quarter", "packid").agg(sem.sum0("sales").alias("sales"))
    clean = op.clean_bid_labels(bids(spark, sf), ["listed", "unlisted"], "generic", "-2|-1")
    return op.policy_flags(rows, cities, clean)


# Descriptions with and without digits, blanks and a numeric tail.
_TEXTS = """texts AS (
  SELECT packid,
         CASE market WHEN 'PROMO' THEN 'PROMO' WHEN 'SMALL' THEN replace(pack_desc, ' ', '  ')
              WHEN 'LARGE' THEN 'LARGE ' || CAST(corp_id AS VARCHAR)
              WHEN 'MEDIUM' THEN pack_desc || ' X' ELSE pack_desc END AS pack_desc
  FROM packs)"""
_DIGIT_TO_BLANK = r"regexp_extract(pack_desc, '^[^0-9]*([0-9].*)\s\S*$', 1)"


def texts(spark, sf):
    market = F.col("market")
    text = (
        F.when(market == "PROMO", "PROMO")
        .when(market == "SMALL", F.replace("pack_desc", F.lit(" "), F.lit("  ")))
        .when(market == "LARGE", F.concat(F.lit("LARGE "), F.col("corp_id").cast("string")))
        .when(market == "MEDIUM", F.concat("pack_desc", F.lit(" X")))
        .otherwise(F.col("pack_desc"))
    )
    return b.packs(spark, sf).select("packid", text.alias("pack_desc"))


_PARSED = rf"""parsed AS (
  SELECT packid, pack_desc,
         CASE WHEN regexp_matches(pack_desc, '[0-9]')
              THEN trim(regexp_replace(regexp_extract(pack_desc, '^([^0-9]*)[0-9]', 1), '\s+', ' ', 'g'))
         END AS package,
         CASE WHEN regexp_matches(pack_desc, '[0-9]') AND regexp_matches(pack_desc, '\s')
              THEN trim(regexp_replace({_DIGIT_TO_BLANK}, '\s+', ' ', 'g')) END AS dosage,
         CASE WHEN regexp_matches(pack_desc, '\s')
              THEN try_cast(regexp_extract(pack_desc, '\s(\S*)$', 1) AS INTEGER) END AS quantity
  FROM texts)"""


@query(with_(b.PACKS, _TEXTS, _PARSED, "SELECT * FROM parsed"))
def parse_pack_description(spark, sf):
    return op.parse_pack_description(texts(spark, sf), "pack_desc")


@query(
    with_(
        b.PACKS, _TEXTS, _PARSED,
        """SELECT packid, pack_desc, coalesce(CASE WHEN quantity > 50 THEN 'given' END, dosage) AS dosage
           FROM parsed""",
    )
)
def fill_dosage(spark, sf):
    parsed = op.parse_pack_description(texts(spark, sf), "pack_desc")
    given = parsed.select(
        "packid", "pack_desc", F.when(F.col("quantity") > 50, "given").alias("dosage")
    )
    return op.fill_dosage(given, "pack_desc")


_NATURE = """nature AS (
  SELECT c.corp_desc, CASE p.market WHEN 'PROMO' THEN 'Imported' WHEN 'SMALL' THEN 'Joint Venture'
                           WHEN 'LARGE' THEN 'Local' END AS maker_type,
         p.atc3, 'class ' || p.item AS class_name, p.molecule, 'name ' || p.item AS molecule_name
  FROM packs p LEFT JOIN corporations c USING (corp_id))"""


def nature(spark, sf):
    packs = sem.lookup_join(
        b.packs(spark, sf), b.corporations(spark, sf), ["corp_id"], ["corp_desc"]
    )
    market = F.col("market")
    return packs.select(
        "corp_desc",
        F.when(market == "PROMO", "Imported").when(market == "SMALL", "Joint Venture")
        .when(market == "LARGE", "Local").alias("maker_type"),
        "atc3",
        F.concat(F.lit("class "), "item").alias("class_name"),
        "molecule",
        F.concat(F.lit("name "), "item").alias("molecule_name"),
    )


PARTS = {
    "maker": ("corp_desc", "maker_type"),
    "class": ("atc3", "class_name"),
    "molecule": ("molecule", "molecule_name"),
}


@query(
    with_(
        b.PACKS, b.CORPORATIONS, _NATURE,
        "\nUNION ALL ".join(
            f"SELECT '{n}' AS part, {k} AS code, min({v}) AS label FROM nature "
            f"WHERE {k} IS NOT NULL AND {v} IS NOT NULL GROUP BY {k}"
            for n, (k, v) in PARTS.items()
        ),
    )
)
def reference_split(spark, sf):
    parts = op.reference_split(nature(spark, sf), PARTS)
    out = None
    for name, (key, value) in PARTS.items():
        part = parts[name].select(
            F.lit(name).alias("part"), F.col(key).alias("code"), F.col(value).alias("label")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    with_(
        b.PACKS, b.CORPORATIONS, _NATURE,
        """SELECT corp_desc,
                  CASE WHEN min(maker_type) IN ('Imported', 'Joint Venture') THEN 'MNC'
                       ELSE coalesce(min(maker_type), 'Local') END AS maker_type
           FROM (SELECT corp_desc, CASE WHEN corp_desc <> 'NATION_2' THEN maker_type END AS maker_type FROM nature)
           GROUP BY corp_desc""",
    )
)
def maker_type_bucket(spark, sf):
    known = F.when(F.col("corp_desc") != "NATION_2", F.col("maker_type"))
    makers = nature(spark, sf).withColumn("maker_type", known)
    return op.maker_type_bucket(
        makers, {"Imported": "MNC", "Joint Venture": "MNC"}, "Local"
    )


@query(
    with_(
        b.PACKS, b.CORPORATIONS, _BIDS, _NATURE,
        """molecules AS (SELECT molecule, min(molecule_name) AS molecule_name FROM nature GROUP BY 1),
           flagged AS (SELECT DISTINCT molecule, name1 FROM
                         (SELECT molecule, CASE WHEN molecule < 'Brand#2' THEN name1 END AS name1 FROM bids)
                       WHERE name1 = 'L1')""",
        """SELECT m.molecule, CASE WHEN m.molecule_name IN ('name blue bolt', 'name blue gear') THEN 'L1'
                                   ELSE f.name1 END AS name1
           FROM molecules m LEFT JOIN flagged f USING (molecule)""",
    )
)
def molecule_flag(spark, sf):
    molecules = nature(spark, sf).groupBy("molecule").agg(F.min("molecule_name").alias("molecule_name"))
    labelled = F.when(F.col("molecule") < "Brand#2", F.col("name1"))
    some = bids(spark, sf).withColumn("name1", labelled)
    return op.molecule_flag(some, molecules, "L1", ["name blue bolt", "name blue gear"])


@query(
    with_(
        b.PANEL, _BIDS, b.CORPORATIONS, _NATURE,
        """sold AS (SELECT DISTINCT molecule, substr(packid, 1, 5) AS product_code FROM panel),
           labels AS (SELECT DISTINCT s.molecule, c.name1 FROM sold s JOIN clean c USING (product_code))""",
        """SELECT molecule,
                  max(CASE WHEN molecule_name IN ('name blue bolt', 'name blue gear')
                             OR molecule IN (SELECT molecule FROM labels WHERE name1 = 'L2') THEN 'L2' END) AS name1
           FROM nature GROUP BY molecule""",
    )
)
def molecule_flag_all(spark, sf):
    """Several labels per product code, several names per molecule: any of them decides."""
    rows = b.panel(spark, sf).select("molecule", "packid")
    clean = op.clean_bid_labels(bids(spark, sf), ["listed", "unlisted"], "generic", "-2|-1")
    molecules = nature(spark, sf).select("molecule", "molecule_name").distinct()
    return op.molecule_flag(
        op.bid_labels(rows, clean), molecules, "L2", ["name blue bolt", "name blue gear"]
    )


@query(
    with_(
        b.PACKS,
        """labelled AS (
             SELECT packid, nullif(pack_desc, 'PROMO 20MG 50') AS pack_desc,
                    CASE WHEN pack_size < 20 THEN 'won' WHEN pack_size < 40 THEN 'lost' END AS name2,
                    CASE market WHEN 'LARGE' THEN ' given ' END AS name3,
                    CASE WHEN corp_id < 10 THEN ' MNC' WHEN corp_id < 15 THEN 'Local' END AS maker_type,
                    CASE WHEN corp_id < 20 THEN 'Local' END AS maker_type1
             FROM packs)""",
        """SELECT packid, pack_desc, nullif(name2, 'lost') AS name2,
                  coalesce(trim(name3), CASE trim(coalesce(maker_type, maker_type1))
                                        WHEN 'MNC' THEN 'original' WHEN 'Local' THEN 'generic' END) AS name3,
                  trim(coalesce(maker_type, maker_type1)) AS maker_type
           FROM labelled WHERE coalesce(regexp_matches(pack_desc, 'ECO'), false) = false""",
    )
)
def origin_classification(spark, sf):
    size, corp = F.col("pack_size"), F.col("corp_id")
    rows = b.packs(spark, sf).select(
        "packid",
        F.nullif(F.col("pack_desc"), F.lit("PROMO 20MG 50")).alias("pack_desc"),
        F.when(size < 20, "won").when(size < 40, "lost").alias("name2"),
        F.when(F.col("market") == "LARGE", " given ").alias("name3"),
        F.when(corp < 10, " MNC").when(corp < 15, "Local").alias("maker_type"),
        F.when(corp < 20, "Local").alias("maker_type1"),
    )
    return op.origin_classification(rows, {"MNC": "original", "Local": "generic"}, "lost", "ECO")


@query(
    with_(
        b.PANEL,
        """profile AS (SELECT packid, substr(packid, 1, 5) AS product_code,
                              CASE WHEN market <> 'SMALL' AND pack_size < 25 THEN atc4 END AS atc4,
                              CASE WHEN market <> 'SMALL' AND pack_size > 15 THEN item END AS product_cn
                       FROM packs),
           by_product AS (SELECT product_code, min(atc4) AS atc4, min(product_cn) AS product_cn
                          FROM profile GROUP BY 1)""",
        f"""totals AS (SELECT packid, quarter, {total0('sales')} AS sales FROM panel GROUP BY ALL)""",
        """SELECT t.packid, t.quarter, t.sales, coalesce(p.atc4, q.atc4) AS atc4,
                  coalesce(p.product_cn, q.product_cn) AS product_cn
           FROM totals t LEFT JOIN profile p USING (packid)
           LEFT JOIN by_product q ON q.product_code = substr(t.packid, 1, 5)""",
    )
)
def two_level_code_fallback(spark, sf):
    size, known = F.col("pack_size"), F.col("market") != "SMALL"
    profile = b.packs(spark, sf).select(
        "packid",
        F.when(known & (size < 25), F.col("atc4")).alias("atc4"),
        F.when(known & (size > 15), F.col("item")).alias("product_cn"),
    )
    rows = b.panel(spark, sf).groupBy("packid", "quarter").agg(sem.sum0("sales").alias("sales"))
    return op.two_level_code_fallback(rows, profile, ["atc4", "product_cn"])


CLASS_RULES = [
    ("PROMO", "C07P", None, "BB"),
    ("PROMO", "C08P", None, "CCB"),
    ("SMALL", "C01S", None, "NITRITES"),
    ("SMALL", "C10S", None, "GLP-1"),
    ("LARGE", "C09L", None, "RAASi Plain"),
    ("LARGE", "C02L", "Brand#2", "TMZ"),
    ("LARGE", "C02L", None, "OTHERS"),
]
_RULES = values(
    [(i, *r) for i, r in enumerate(CLASS_RULES)],
    ["nr", "market", "atc3", "molecule", "class_label"], "rules",
)


@query(
    with_(
        b.PANEL, _RULES,
        """rows_ AS (SELECT row_number() OVER () AS id, packid, site, date, market, atc3,
                            nullif(molecule, 'Brand#4') AS molecule, sales * 0.125 AS sales,
                            units * 0.5 AS units FROM panel),
           labelled AS (SELECT r.*, (SELECT min({'n': nr, 'l': class_label}).l FROM rules u
                                     WHERE u.market = r.market AND u.atc3 = r.atc3
                                       AND (u.molecule IS NULL OR u.molecule = r.molecule)) AS class_label
                        FROM rows_ r)""",
        """SELECT packid, site, date, market, atc3, molecule, class_label,
                  sales, round_even(units, 0) AS units
           FROM labelled WHERE molecule <> 'Brand#6'""",
    )
)
def therapeutic_class_rules(spark, sf):
    rows = b.panel(spark, sf).select(
        "packid", "site", "date", "market", "atc3",
        F.nullif(F.col("molecule"), F.lit("Brand#4")).alias("molecule"),
        (F.col("sales") * 0.125).alias("sales"),
        (F.col("units") * 0.5).alias("units"),
    )
    return op.therapeutic_class_rules(rows, CLASS_RULES, "Brand#6", {"units": 0})


_HISTORY = f"""history AS (
  SELECT *, CASE market WHEN 'PROMO' THEN NULL ELSE dose END AS dosage,
         units * quantity AS dosage_units
  FROM (
    SELECT p.packid, '{CHANNEL}' AS channel, p.province, p.city, p.quarter, p.atc3, p.market, p.molecule,
           k.item AS product, k.pack_desc, c.corp_desc, k.market AS package,
           CAST(k.pack_size AS INTEGER) AS quantity, CAST(k.pack_size AS INTEGER)::VARCHAR || 'MG' AS dose,
           {total0('p.sales')} AS sales, {total0('p.units')} AS units
    FROM panel p JOIN packs k ON k.packid = p.packid
    LEFT JOIN corporations c ON c.corp_id = k.corp_id
    GROUP BY ALL))"""
HISTORY_COLUMNS = [
    *DELIVERY_KEYS, "pack_desc", "dosage", "sales", "units", "dosage_units",
]


def history(spark, sf):
    """Delivered history: summed per pack, then joined to the pack attributes."""
    keys = ["packid", "province", "city", "quarter", "atc3", "market", "molecule"]
    totals = b.panel(spark, sf).groupBy(*keys).agg(
        sem.sum0("sales").alias("sales"), sem.sum0("units").alias("units")
    )
    packs = sem.lookup_join(
        b.packs(spark, sf), b.corporations(spark, sf), ["corp_id"], ["corp_desc"]
    ).select(
        "packid", F.col("item").alias("product"), "pack_desc", "corp_desc",
        F.col("market").alias("package"), F.col("pack_size").cast("int").alias("quantity"),
    )
    # No id is missing on the left: a plain join, which finds the totals in their places.
    out = totals.join(packs, "packid")
    dose = F.concat(F.col("quantity").cast("string"), F.lit("MG"))
    return out.withColumns(
        {
            "channel": F.lit(CHANNEL),
            "dosage": F.when(F.col("market") != "PROMO", dose),
            "dosage_units": F.col("units") * F.col("quantity"),
        }
    ).select(*HISTORY_COLUMNS)


OVERRIDE_CITIES = ["NATION_6", "NATION_7", "NATION_9", "NATION_11", "NATION_14", "NATION_19"]
OVERRIDE_FACTORS = [
    (f"{p:07d}", q, f)
    for p, f in ((7, 1.25), (12, 1.4), (25, 1.15), (41, 1.7), (77, 1.3))
    for q in ("1999Q1", "1999Q2", "1999Q3", "1999Q4")
]
_CITY_LIST = ", ".join(f"'{c}'" for c in OVERRIDE_CITIES)
_FACTORS = values(OVERRIDE_FACTORS, ["packid", "quarter", "factor"], "factors")
_OVERRIDE = f"""scaled AS (
  SELECT h.*, CAST(f.factor AS DECIMAL(12, 8)) AS factor,
         CASE WHEN h.sales <> 0 AND h.units <> 0
              THEN CAST(h.units AS DECIMAL(16, 6)) * CAST(f.factor AS DECIMAL(12, 8)) END AS new_units
  FROM history h JOIN factors f ON f.packid = h.packid AND f.quarter = h.quarter
  WHERE h.channel = '{CHANNEL}' AND h.city IN ({_CITY_LIST})),
override_ AS (
  SELECT {_list(c for c in HISTORY_COLUMNS if c not in ('quarter', 'sales', 'units', 'dosage_units'))},
         CAST(CAST(substr(quarter, 1, 4) AS INTEGER) + 1 AS VARCHAR) || substr(quarter, 5, 2) AS quarter,
         CAST(round_even(CAST(sales AS DECIMAL(20, 6)) * factor, 2) AS DOUBLE) AS sales,
         CAST(round_even(new_units, 0) AS DOUBLE) AS units,
         CAST(round_even(new_units * quantity, 0) AS DOUBLE) AS dosage_units
  FROM scaled)"""
_BASE = [b.PANEL, b.CORPORATIONS, _HISTORY]


def override(rows):
    scope = (F.col("channel") == CHANNEL) & F.col("city").isin(OVERRIDE_CITIES)
    return op.pack_period_override(rows, scope, OVERRIDE_FACTORS)


@query(with_(*_BASE, _FACTORS, _OVERRIDE, "SELECT * FROM override_"))
def pack_period_override(spark, sf):
    return override(history(spark, sf))


_PACK_LIST = ", ".join(sorted({f"'{p}'" for p, _, _ in OVERRIDE_FACTORS}))
RESTATED = ["2000Q2"]
_RESTATED = f"""restated AS (
  SELECT {_list(HISTORY_COLUMNS)} FROM (
    SELECT * FROM history WHERE quarter < '2000Q2'
    UNION ALL SELECT * REPLACE (sales * 1.5 AS sales) FROM history WHERE quarter = '2000Q2')
  WHERE sales > 0 AND units > 0 AND dosage_units > 0
    AND NOT (market IN ('PROMO', 'SMALL') AND substr(package, 1, 3) NOT IN ('PRO'))
    AND NOT (channel = '{CHANNEL}' AND city IN ({_CITY_LIST}) AND packid IN ({_PACK_LIST})
             AND quarter = '2000Q2')
  UNION ALL SELECT {_list(HISTORY_COLUMNS)} FROM override_ WHERE quarter = '2000Q2')"""


def restated(spark, sf, runs=1):
    rows = stage(history(spark, sf), "history")
    old = rows.filter(F.col("quarter") < "2000Q2")
    new = rows.filter(F.col("quarter") >= "2000Q2").withColumn("sales", F.col("sales") * 1.5)
    slice_ = (
        (F.col("channel") == CHANNEL)
        & F.col("city").isin(OVERRIDE_CITIES)
        & F.col("packid").isin(sorted({p for p, _, _ in OVERRIDE_FACTORS}))
    )
    form_ok = sem.not_in("market", ["PROMO", "SMALL"]) | F.substring("package", 1, 3).isin("PRO")
    changed = override(rows)
    for _ in range(runs):
        old = op.restate_history(
            old, new, changed, RESTATED, slice_, ["sales", "units", "dosage_units"], form_ok
        )
    return old


@query(with_(*_BASE, _FACTORS, _OVERRIDE, _RESTATED, "SELECT * FROM restated"))
def restate_history(spark, sf):
    return restated(spark, sf)


@query(with_(*_BASE, _FACTORS, _OVERRIDE, _RESTATED, "SELECT * FROM restated"))
def restate_twice(spark, sf):
    """A run on the result of a run gives the same rows."""
    return restated(spark, sf, runs=2)


_MAT = values(
    [(f"{y}Q{q}", f"MAT{(y if q <= 2 else y + 1) % 100:02d}Q2")
     for y in range(1997, 2001) for q in range(1, 5)
     if (1997, 3) <= (y, q) <= (2000, 2)],
    ["quarter", "period_mat"], "mat",
)


@query(
    with_(
        *_BASE, _MAT,
        """SELECT h.packid, h.city, h.quarter, h.sales, m.period_mat
           FROM history h LEFT JOIN mat m USING (quarter)""",
    )
)
def mat_label(spark, sf):
    rows = history(spark, sf).select("packid", "city", "quarter", "sales")
    return op.mat_label(rows, "2000Q2")


# The channels of a pack are merged into one; description and dosage are the last ones.
_COARSE = [k for k in DELIVERY_KEYS if k not in ("packid", "quantity", "corp_desc")]


@query(
    with_(
        *_BASE,
        f"""SELECT {_list(_COARSE)}, max(pack_desc) AS pack_desc, max(dosage) AS dosage,
                   {half_even(total0('sales'), 2)} AS sales, {half_even(total0('units'), 0)} AS units,
                   {half_even(total0('dosage_units'), 0)} AS dosage_units
            FROM history GROUP BY {_list(_COARSE)}""",
    )
)
def consolidate_delivery(spark, sf):
    return op.consolidate_delivery(
        history(spark, sf), _COARSE, ["pack_desc", "dosage"], ROUNDING
    )


ORDER = ["channel", "quarter", "province", "city", "market", "packid"]


@query(
    with_(
        *_BASE, _FACTORS, _OVERRIDE, _RESTATED,
        f"SELECT {_list(HISTORY_COLUMNS)} FROM restated ORDER BY {_list(ORDER)}",
    )
)
def ordered_delivery(spark, sf):
    return op.ordered_delivery(restated(spark, sf), HISTORY_COLUMNS, ORDER)


@query(
    with_(
        *_BASE, _FACTORS, _OVERRIDE, _RESTATED,
        f"""SELECT {_list(HISTORY_COLUMNS)},
                   row_number() OVER (ORDER BY {', '.join(f'{c} NULLS LAST' for c in [*ORDER, 'product', 'corp_desc'])}) AS position
            FROM restated""",
    )
)
def delivered_files(spark, sf):
    """The delivered order after writing and reading back: the place of each row in the files."""
    path = f"{stage_folder(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    tables.write_ordered(restated(spark, sf).select(*HISTORY_COLUMNS), path, [*ORDER, "product", "corp_desc"])
    return tables.read_ordered(spark, path)


#: Two quarters are restated at once, one of them with other packs' sales raised and some rows gone.
TWO_PERIODS = ["2000Q1", "2000Q2"]
_CHANGES = f"""fresh AS (
  SELECT * REPLACE (CASE WHEN market = 'LARGE' THEN sales + 1 ELSE sales END AS sales)
  FROM history WHERE quarter IN {in_(TWO_PERIODS)} AND NOT (quarter = '2000Q1' AND market = 'SMALL')),
old_ AS (
  SELECT * FROM history WHERE NOT (quarter = '2000Q2' AND market = 'MEDIUM')),
new_ AS (
  SELECT * FROM old_ WHERE quarter NOT IN {in_(TWO_PERIODS)} UNION ALL SELECT * FROM fresh)"""


def two_versions(spark, sf):
    """History, and the same with two quarters restated."""
    rows = stage(history(spark, sf), "history")
    old = rows.filter((F.col("quarter") != "2000Q2") | (F.col("market") != "MEDIUM"))
    new = rows.filter(F.col("quarter").isin(TWO_PERIODS) & ((F.col("quarter") != "2000Q1") | (F.col("market") != "SMALL")))
    new = new.withColumn("sales", F.when(F.col("market") == "LARGE", F.col("sales") + 1).otherwise(F.col("sales")))
    nothing = rows.filter("false")
    every = F.lit(True)
    return old, op.restate_history(old, new, nothing, TWO_PERIODS, F.lit(False), [], every)


@query(
    with_(
        *_BASE, _CHANGES,
        f"""SELECT coalesce(n.quarter, o.quarter) AS quarter, coalesce(n.market, o.market) AS market,
                   CASE WHEN o.packid IS NULL THEN 'inserted' WHEN n.packid IS NULL THEN 'removed' ELSE 'changed' END AS change,
                   coalesce(n.packid, o.packid) AS packid, coalesce(n.city, o.city) AS city,
                   coalesce(n.sales, o.sales) AS sales, CASE WHEN n.packid IS NOT NULL THEN o.sales END AS sales_before
            FROM old_ o FULL JOIN new_ n ON {' AND '.join(f'o.{k} IS NOT DISTINCT FROM n.{k}' for k in DELIVERY_KEYS)}
            WHERE o.packid IS NULL OR n.packid IS NULL OR o.sales IS DISTINCT FROM n.sales
               OR o.units IS DISTINCT FROM n.units""",
    )
)
def restated_changes(spark, sf):
    """Two restated quarters as inserted, changed and removed rows."""
    old, new = two_versions(spark, sf)
    changes = op.change_set(old, new, DELIVERY_KEYS, ["quarter"])
    return changes.select("quarter", "market", "change", "packid", "city", "sales", F.col("before.sales").alias("sales_before"))


@query(with_(*_BASE, _CHANGES, f"SELECT {_list(HISTORY_COLUMNS)} FROM new_"))
def changes_applied(spark, sf):
    """History with the change set of two restated quarters applied."""
    old, new = two_versions(spark, sf)
    changes = stage(op.change_set(old, new, DELIVERY_KEYS, ["quarter"]), "changes")
    return op.apply_changes(old, changes, DELIVERY_KEYS, ["quarter"]).select(*HISTORY_COLUMNS)


@query(
    with_(
        b.PANEL,
        """SELECT * FROM (SELECT site, packid, quarter, market, sales,
                                 count(*) OVER (PARTITION BY site, packid, quarter, market) AS n FROM panel)
           WHERE n > 1""",
    )
)
def duplicate_key_check(spark, sf):
    keys = ["site", "packid", "quarter", "market"]
    return op.duplicate_key_check(b.panel(spark, sf).select(*keys, "sales"), keys)
