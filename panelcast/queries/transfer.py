"""Growth transfer on the test tables: EUROPE is the donor of ASIA, item is the pack."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.operators import price as price_op
from panelcast.operators import transfer as op
from panelcast.queries import bindings as b
from panelcast.queries.registry import query, rounded, total, total0, with_
from panelcast.sources.stages import stage

DONOR, TARGET = "EUROPE", "ASIA"
BEFORE, AFTER = "1999Q1", "2000Q1"
START = "199701"
#: The months of the test tables from the start on; the engine finds the last one itself.
MONTHS = [f"{y}{m:02d}" for y in range(1997, 2002) for m in range(1, 13) if (y, m) <= (2001, 11)]
OVERRIDES = {"0000007": 88.5, "0000012": 41.25}
SLICE = ["quarter", "market", "atc3", "molecule", "packid"]

_REGION = "region_panel AS (SELECT * REPLACE (province AS city) FROM panel)"
_TARGET = f"""target AS (
  SELECT {', '.join(SLICE)}, min(province) AS province, min(city) AS city,
         {total0('units')} AS units, {total0('sales')} AS sales,
         {total0('sales')} / nullif({total0('units')}, 0) AS price
  FROM region_panel WHERE province = '{TARGET}' AND quarter = '{BEFORE}' AND sales > 0
  GROUP BY {', '.join(SLICE)})"""
_OWN = f"""own AS (
  SELECT * FROM (
    SELECT '{TARGET}' AS city, packid,
           coalesce({total0(f"CASE WHEN quarter = '{AFTER}' THEN sales END")}
             / nullif({total0(f"CASE WHEN quarter = '{BEFORE}' THEN sales END")}, 0), 1.0) AS growth
    FROM region_panel
    WHERE province = '{DONOR}' AND quarter IN ('{BEFORE}', '{AFTER}')
      AND packid IN (SELECT packid FROM target)
    GROUP BY packid)
  WHERE growth <= 1.5 AND growth > 0)"""
_CELLS = ", ".join(f"""{total0(f"CASE WHEN date = '{m}' THEN sales END")} AS "{m}\"""" for m in MONTHS)
_MATRIX = f"""matrix AS (
  SELECT packid, {_CELLS}, CAST(packid IN (SELECT packid FROM own) AS INTEGER) AS train_flag
  FROM region_panel WHERE date >= '{START}' GROUP BY packid)"""


def knn_sql(source: str, id_: str, vector: str, k: int = 3) -> str:
    """Every pair of test and train items, then the k best."""
    return f"""vectors AS (
  SELECT {id_} AS item, train_flag, CAST({vector} AS DOUBLE[]) AS v FROM {source}),
positions AS (
  SELECT i AS pos, stddev_samp(v[i]) AS sd
  FROM vectors, (SELECT unnest(range(1, (SELECT max(len(v)) + 1 FROM vectors))) AS i)
  WHERE train_flag = 1 GROUP BY i),
deviations AS (
  SELECT list(coalesce(nullif(sd, 0), 1.0) ORDER BY pos) AS sds FROM positions),
scaled AS (
  SELECT item, train_flag, list_transform(list_zip(v, sds), lambda p: p[1] / p[2]) AS v
  FROM vectors, deviations),
gaps AS (
  SELECT a.item, t.item AS neighbour, list_distance(a.v, t.v) AS distance
  FROM scaled a JOIN scaled t ON a.train_flag = 0 AND t.train_flag = 1),
neighbours AS (
  SELECT item AS {id_}, neighbour, distance, knn_level FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY distance, neighbour) AS knn_level
    FROM gaps)
  WHERE knn_level <= {k})"""


_VECTOR = "[" + ", ".join(f'"{m}"' for m in MONTHS) + "]"
_KNN = knn_sql("matrix", "packid", _VECTOR)
_WEIGHTS = """weights AS (
  SELECT packid, neighbour, knn_level,
         (1 / (distance + 1)) / sum(1 / (distance + 1)) OVER (PARTITION BY packid) AS weight
  FROM neighbours)"""
_NEIGHBOUR = """neighbour_growth AS (
  SELECT o.city, w.packid, coalesce(sum(o.growth * w.weight), 0) AS growth
  FROM weights w LEFT JOIN own o ON o.packid = w.neighbour GROUP BY o.city, w.packid)"""
_CASCADE = f"""cascade_ AS (
  SELECT city, packid, growth, 0 AS flag FROM own
  UNION ALL SELECT city, packid, growth, 1 FROM neighbour_growth
  UNION ALL SELECT DISTINCT '{TARGET}', packid, 1.0, 2 FROM target
  WHERE packid NOT IN (SELECT packid FROM own) AND packid NOT IN (SELECT packid FROM matrix))"""
_OWN_CHAIN = [b.PANEL, _REGION, _TARGET, _OWN]
_KNN_CHAIN = [*_OWN_CHAIN, _MATRIX, _KNN]
_GROWTH_CHAIN = [*_KNN_CHAIN, _WEIGHTS, _NEIGHBOUR, _CASCADE]


def region_panel(spark, sf):
    """Monthly sums per region and pack, stored: every step of the transfer reads them."""
    rows = b.panel(spark, sf).withColumns(
        {"city": F.col("province"), "sampled": F.col("size") >= b.REPORTING_SIZE}
    )
    keys = ["year", "date", "province", "city", "sampled", *SLICE]
    sums = [sem.sum0(m).alias(m) for m in ("units", "sales")]
    return stage(rows.groupBy(*keys).agg(*sums), "region_panel")


def target(panel):
    scope = (F.col("province") == TARGET) & (F.col("quarter") == BEFORE)
    return op.history_slice(panel, scope, SLICE, ["province", "city"], ["units", "sales"])


def own_growth(panel, items):
    donor = F.col("province") == DONOR
    return op.donor_growth(panel, donor, TARGET, (BEFORE, AFTER), items, "packid")


class Transfer:
    """The chain from the target slice to the cascade; shared inputs are stored once."""

    def __init__(self, spark, sf):
        self.panel = region_panel(spark, sf)
        self.target = stage(target(self.panel), "target")
        self.own = stage(own_growth(self.panel, self.target), "own_growth")
        self.months = op.months_from(self.panel, "date", START)
        self.matrix = stage(
            op.item_period_matrix(self.panel, "packid", "date", "sales", self.months, self.own),
            "matrix",
        )

    def neighbours(self):
        return op.knn_items(op.as_vector(self.matrix, self.months), "packid")

    def weights(self):
        return op.inverse_distance_weights(self.neighbours(), "packid").drop("distance")

    def neighbour_growth(self):
        return op.neighbour_weighted_growth(self.weights(), self.own, "packid")

    def cascade(self):
        return op.growth_cascade(
            self.target, self.own, self.neighbour_growth(), self.matrix, "packid", TARGET
        )


@query(with_(*_OWN_CHAIN[:3], "SELECT * FROM target"))
def history_slice(spark, sf):
    rows = b.panel(spark, sf).withColumn("city", F.col("province"))
    return target(rows)


@query(
    with_(
        *_OWN_CHAIN[:3],
        """SELECT packid, market, sales,
                  CAST(packid IN (SELECT packid FROM panel
                                  WHERE province IN ('ASIA', 'EUROPE') AND year BETWEEN '1997' AND '1999')
                       AS INTEGER) AS known
           FROM target""",
    )
)
def split_known_missing(spark, sf):
    panel = region_panel(spark, sf)
    history = panel.filter(F.col("province").isin(TARGET, DONOR) & F.col("year").between("1997", "1999"))
    known, missing = op.split_known_missing(target(panel), history, "packid")
    both = known.withColumn("known", F.lit(1)).unionByName(missing.withColumn("known", F.lit(0)))
    return both.select("packid", "market", "sales", "known")


@query(with_(*_OWN_CHAIN, "SELECT * FROM own"))
def donor_growth(spark, sf):
    panel = region_panel(spark, sf)
    return own_growth(panel, target(panel))


@query(with_(*_OWN_CHAIN, _MATRIX, "SELECT * FROM matrix"))
def item_period_matrix(spark, sf):
    panel = region_panel(spark, sf)
    own = own_growth(panel, target(panel))
    months = op.months_from(panel, "date", START)
    return op.item_period_matrix(panel, "packid", "date", "sales", months, own)


@query(with_(*_KNN_CHAIN, "SELECT * REPLACE (round(distance, 6) AS distance) FROM neighbours"))
def knn_items(spark, sf):
    return rounded(Transfer(spark, sf).neighbours(), 6, "distance")


@query(
    with_(
        "flagged AS (SELECT vec_id, embedding, CAST(label < 5 AS INTEGER) AS train_flag FROM embeddings)",
        knn_sql("flagged", "vec_id", "embedding"),
        "SELECT * REPLACE (round(distance, 6) AS distance) FROM neighbours",
    )
)
def knn_vectors(spark, sf):
    """The same operator on ready-made vectors."""
    rows = b.table(spark, sf, "embeddings").withColumn(
        "train_flag", (F.col("label") < 5).cast("int")
    )
    return rounded(op.knn_items(rows, "vec_id", vector="embedding"), 6, "distance")


@query(
    with_(
        *_KNN_CHAIN, _WEIGHTS,
        "SELECT packid, neighbour, knn_level, round(weight, 8) AS weight FROM weights",
    )
)
def inverse_distance_weights(spark, sf):
    return rounded(Transfer(spark, sf).weights(), 8, "weight")


@query(
    with_(
        *_GROWTH_CHAIN[:-1],
        "SELECT city, packid, round(growth, 8) AS growth FROM neighbour_growth",
    )
)
def neighbour_weighted_growth(spark, sf):
    return rounded(Transfer(spark, sf).neighbour_growth(), 8, "growth")


@query(
    with_(*_GROWTH_CHAIN, "SELECT city, packid, round(growth, 8) AS growth, flag FROM cascade_")
)
def growth_cascade(spark, sf):
    return rounded(Transfer(spark, sf).cascade(), 8, "growth")


@query(
    with_(
        *_GROWTH_CHAIN,
        f"""grown AS (
             SELECT t.market, t.atc3, t.molecule, t.packid, t.province, t.city,
                    t.sales * c.growth AS sales,
                    CASE t.packid WHEN '0000007' THEN 88.5 WHEN '0000012' THEN 41.25
                         ELSE t.price END::DOUBLE AS price
             FROM target t JOIN cascade_ c ON c.city = t.city AND c.packid = t.packid)""",
        f"""SELECT market, atc3, molecule, packid, province, city, '{AFTER}' AS quarter,
                   '{AFTER[:4]}' AS year, round(sales, 4) AS sales, price,
                   round(sales / nullif(price, 0), 4) AS units
            FROM grown WHERE sales > 0""",
    )
)
def apply_growth(spark, sf):
    t = Transfer(spark, sf)
    out = op.apply_growth(t.target, t.cascade(), OVERRIDES, "packid", AFTER)
    return rounded(out, 4, "sales", "units")


def _donor_price(scope: str) -> str:
    return f"{total(f'CASE WHEN {scope} THEN sales END')} / nullif({total(f'CASE WHEN {scope} THEN units END')}, 0)"


_BORROWED = f"""prices AS (
  SELECT packid,
         coalesce({_donor_price(f"province = '{DONOR}' AND quarter = '{AFTER}'")},
                  {_donor_price(f"province = '{DONOR}'")},
                  {_donor_price(f"quarter = '{AFTER}'")},
                  {_donor_price("true")}) AS price
  FROM sample WHERE year = '{AFTER[:4]}' AND sales > 0 AND units > 0 GROUP BY packid)"""


@query(
    with_(
        b.SAMPLE, *[c for c in _GROWTH_CHAIN if c is not b.PANEL], _BORROWED,
        f"""grown AS (
             SELECT t.market, t.atc3, t.molecule, t.packid, t.province, t.city,
                    '{AFTER}' AS quarter, '{AFTER[:4]}' AS year, t.sales * c.growth AS sales
             FROM target t JOIN cascade_ c ON c.city = t.city AND c.packid = t.packid
             WHERE t.sales * c.growth > 0)""",
        """SELECT g.* REPLACE (round(g.sales, 4) AS sales), p.price,
                  round(g.sales / nullif(p.price, 0), 4) AS units
           FROM grown g LEFT JOIN prices p ON p.packid = g.packid""",
    )
)
def borrowed_price_ladder(spark, sf):
    t = Transfer(spark, sf)
    sampled = t.panel.filter(F.col("sampled") & (F.col("year") == "2000"))
    grains = price_op.relabel_grains(price_op.price_grains(sampled), DONOR, DONOR, TARGET, TARGET)
    grown = stage(op.grow(t.target, t.cascade(), "packid", AFTER), "grown")
    return rounded(op.borrowed_price_ladder(grown, grains), 4, "sales", "units")


