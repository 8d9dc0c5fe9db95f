"""The stored history on the test tables: restating, slicing and comparing years."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.functions import semantics as sem
from panelcast.queries import deliver
from panelcast.queries.registry import REGISTRY, query, total0, with_
from panelcast.sources.history import History
from panelcast.sources.stages import stage, stage_folder

KEYS = ("packid", "city")
BUCKETS = 4
#: A bucket is written and read by one task, all periods together.
BUCKET_ROWS = 500_000


def stored(spark, df, keys=KEYS, bucket_rows=BUCKET_ROWS):
    """The history stored in as many buckets as its rows need."""
    df = stage(df, "unstored")
    buckets = max(BUCKETS, -(-df.count() // bucket_rows))
    name = f"history_{uuid.uuid4().hex}"
    return History(spark, name, f"{stage_folder(spark).rstrip('/')}/{name}", keys, buckets).create(df)


@query(
    with_(
        *deliver._BASE, deliver._CHANGES,
        f"SELECT {', '.join(deliver.HISTORY_COLUMNS)} FROM new_",
    )
)
def history_restated_in_store(spark, sf):
    """Two quarters of the stored history replaced, one of them by fewer rows."""
    old, new = deliver.two_versions(spark, sf)
    store = stored(spark, old)
    store.replace(new, deliver.TWO_PERIODS)
    return store.rows().select(*deliver.HISTORY_COLUMNS)


def _year(year: str) -> str:
    return f"""SELECT packid, city, {total0('sales')} AS sales, {total0('units')} AS units
               FROM history WHERE substr(quarter, 1, 4) = '{year}' GROUP BY packid, city"""


@query(
    with_(
        *deliver._BASE, f"now_ AS ({_year('2000')})", f"then_ AS ({_year('1999')})",
        """SELECT packid, city, n.sales, t.sales AS sales_before, n.units, t.units AS units_before,
                  n.sales / nullif(t.sales, 0) AS growth
           FROM now_ n FULL JOIN then_ t USING (packid, city)""",
    )
)
def history_growth(spark, sf):
    """Two years of each pack and city side by side, from slices of the stored history."""
    return growth(stored(spark, deliver.history(spark, sf)))


def growth(store: History):
    def year(y: str, suffix: str):
        sums = [sem.sum0(m).alias(m + suffix) for m in ("sales", "units")]
        return store.rows([f"{y}Q{q}" for q in range(1, 5)]).groupBy(*KEYS).agg(*sums)

    both = year("2000", "").join(year("1999", "_before"), list(KEYS), "full")
    return both.withColumn("growth", sem.ratio("sales", "sales_before"))


@query(REGISTRY["consolidate_delivery"][1])
def consolidate_from_store(spark, sf):
    """The final grain from a history stored by product and city: groups lie in one bucket, nothing is shuffled."""
    return consolidated(stored(spark, deliver.history(spark, sf), ("product", "city")))


def consolidated(store: History):
    return deliver.op.consolidate_delivery(
        store.rows(), deliver._COARSE, ["pack_desc", "dosage"], deliver.ROUNDING
    )
