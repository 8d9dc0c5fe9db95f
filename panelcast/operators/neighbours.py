"""Exact nearest neighbours with pruning by the triangle inequality.

Train rows fall into cells around pivots, test rows into cells around the same
pivots; a cell knows how far its farthest row lies from its pivot. A test row is
first compared with the nearest cells that hold k train rows together. The k-th
distance found bounds what may still be nearer: a cell whose pivot is farther
from the row than this bound plus the cell's radius can't hold such a row and is
never visited. Every other cell is, so the result is exact.

Pivots are a bounded sample of the train rows; they decide the cost, not the
result. What is collected is one row per cell. Rows are packed into blocks of
bounded size and compared on a grid of tasks: a row is sent to one line of the
grid, however many cells it has open. A task holds the train rows of its place
and runs its test blocks past them. Products in single precision rule out pairs
by a bound that allows for their rounding; distances come from the differences
in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.stages import stage


@dataclass(frozen=True)
class Search:
    """``cell_rows`` train rows per pivot are aimed at, with at most ``max_cells`` pivots.

    Blocks are compared by ``grid`` times ``grid`` tasks at least; a task holds train blocks of about the budget.
    """

    k: int = 3
    block_rows: int = 4096
    cell_rows: int = 512
    max_cells: int = 512
    budget_bytes: int = 64 << 20
    grid: int = 8


@dataclass(frozen=True)
class Cells:
    """Pivots, and per cell the radius and number of its train rows."""

    pivots: np.ndarray
    radius: np.ndarray
    train: np.ndarray

    def gaps(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each point to each pivot, and how far rounding may have moved it."""
        squares = (points * points).sum(axis=1)[:, None], (self.pivots * self.pivots).sum(axis=1)[None, :]
        gap = np.sqrt(np.maximum(squares[0] + squares[1] - 2 * (points @ self.pivots.T), 0.0))
        return gap, 1e-6 * (1 + np.sqrt(squares[0]) + np.sqrt(squares[1]))

    def first(self, k: int) -> np.ndarray:
        """Per cell which cells are compared first: the nearest that hold k train rows together."""
        gap, _ = self.gaps(self.pivots)
        np.fill_diagonal(gap, 0.0)
        order = np.argsort(gap, axis=1, kind="stable")
        held = np.cumsum(self.train[order], axis=1)
        out = np.zeros(order.shape, dtype=bool)
        wanted = (held - self.train[order] < k) & (self.train[order] > 0)
        np.put_along_axis(out, order, wanted, axis=1)
        return out


def train_scale(train: DataFrame, vector: str) -> DataFrame:
    """One row: the sample standard deviation of each vector position.

    A zero or undefined deviation scales by 1.
    """
    deviation = F.coalesce(F.nullif(F.stddev_samp("value"), F.lit(0.0)), F.lit(1.0))
    per_position = (
        train.select(F.posexplode(F.col(vector).cast("array<double>")).alias("pos", "value"))
        .groupBy("pos")
        .agg(deviation.alias("sd"))
    )
    # As many elements as a vector has positions: bounded by its dimension.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "sd")))
    return per_position.agg(F.transform(ordered, lambda x: x["sd"]).alias("sd"))


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def place(scaled: DataFrame, search: Search) -> tuple[DataFrame, Cells] | None:
    """scaled with each row's cell, stored, and the cells; nothing without train and test rows."""
    counted = {r["train"]: r["count"] for r in scaled.groupBy("train").count().collect()}
    if not counted.get(True) or not counted.get(False):
        return None
    wanted = min(search.max_cells, -(-counted[True] // search.cell_rows))
    sample = scaled.filter("train").orderBy(F.xxhash64("item"), "item").limit(wanted)
    pivots = np.stack([np.asarray(r["vector"], dtype=np.float64) for r in sample.select("vector").collect()])
    bare = Cells(pivots, np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64))
    rows_at_once = max(1, search.budget_bytes // (16 * len(pivots)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _chunks(batches, rows_at_once):
            gap, slack = bare.gaps(_stacked(part["vector"]))
            cell = gap.argmin(axis=1)
            at = np.arange(len(cell)), cell
            yield part.assign(cell=cell.astype(np.int32), gap=gap[at] + slack[at])

    schema = T.StructType([*scaled.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType())])
    placed = stage(scaled.mapInPandas(deal, schema), "knn_cells")
    radius, train = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for r in placed.filter("train").groupBy("cell").agg(F.max("gap").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], train[r["cell"]] = r["r"], r["n"]
    return placed, Cells(pivots, radius, train)


def first_visits(placed: DataFrame, cells: Cells, search: Search) -> DataFrame:
    """Rows (item, vector, at): each test row with the cells it is compared with first."""
    return _visits(_first_open(placed, cells, search))


def further_visits(placed: DataFrame, found: DataFrame, cells: Cells, search: Search) -> DataFrame:
    """Rows (item, vector, at): the other cells that may hold a row as near as the k-th found."""
    return _visits(_further_open(placed, found, cells, search))


def _visits(opened: DataFrame) -> DataFrame:
    return opened.select("item", "vector", F.explode("open").alias("at"))


def _first_open(placed: DataFrame, cells: Cells, search: Search) -> DataFrame:
    """Test rows (item, vector, cell, bound, open) with the cells they are compared with first, and no bound yet."""
    first = cells.first(search.k)
    rows = [(i, np.flatnonzero(first[i]).tolist()) for i in range(len(first))]
    visits = placed.sparkSession.createDataFrame(rows, "cell int, open array<int>")
    test = placed.filter(~F.col("train")).select("item", "vector", "cell")
    return test.join(F.broadcast(visits), "cell").select("item", "vector", "cell", F.lit(float("inf")).alias("bound"), "open")


def _bounded(placed: DataFrame, found: DataFrame, search: Search) -> DataFrame:
    """Test rows (item, vector, cell, bound) with the k-th distance found."""
    full = F.count(F.lit(1)) >= search.k
    bound = found.groupBy("item").agg(F.when(full, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound"))
    test = placed.filter(~F.col("train")).select("item", "vector", "cell")
    return test.join(bound, test["item"].eqNullSafe(bound["item"])).select(test["item"], "vector", "cell", "bound")


def _needed(cells: Cells, search: Search) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Of points, their cells and bounds: which cells were not compared first and may hold a row within the bound."""
    first = cells.first(search.k)

    def needed(points: np.ndarray, cell: np.ndarray, bound: np.ndarray) -> np.ndarray:
        gap, slack = cells.gaps(points)
        return (gap - slack - cells.radius <= bound[:, None] * (1 + 1e-12)) & (cells.train > 0) & ~first[cell]

    return needed


def _further_open(placed: DataFrame, found: DataFrame, cells: Cells, search: Search) -> DataFrame:
    """Test rows (item, vector, cell, bound, open): the k-th distance found, and the other cells within it."""
    rows = _bounded(placed, found, search)
    needed = _needed(cells, search)
    rows_at_once = max(1, search.budget_bytes // (16 * len(cells.pivots)))

    def open_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _chunks(batches, rows_at_once):
            marks = needed(_stacked(part["vector"]), part["cell"].to_numpy(), part["bound"].to_numpy())
            some = part[marks.any(axis=1)]
            opened = [np.flatnonzero(row).astype(np.int32) for row in marks if row.any()]
            if opened:
                yield some.assign(open=pd.Series(opened, index=some.index, dtype=object))

    schema = T.StructType([*rows.schema.fields, T.StructField("open", T.ArrayType(T.IntegerType()))])
    return rows.mapInPandas(open_cells, schema)


def _blocks(
    rows: DataFrame, by: str, names: str, rows_per_block: int, needed: Callable | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Rows packed as one row per block: ``by``, its ids, matrix, bounds and the cells that any of its rows has open.

    Rows have ``names``, vector and ``by``; ``bound`` and ``open`` are those of test rows. Without ``open``, ``needed``
    finds the open cells of a block, and rows without any are left out. Rows of one block have the same ``by``, and are
    dealt to as many blocks as keep it within ``rows_per_block`` or so; ``counted`` has the rows to count, if not rows.
    """
    sizes = (rows if counted is None else counted).groupBy(by)
    sizes = sizes.agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("_blocks"))
    parts = max(1, sizes.agg(F.sum("_blocks")).first()[0] or 0)
    kind = rows.schema[names].dataType
    test = "bound" in rows.columns

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(names, kind="stable")
        matrix = _stacked(part["vector"])
        if needed is not None:
            marks = needed(matrix, part[by].to_numpy(), part["bound"].to_numpy(dtype=np.float64))
            part, matrix = part[marks.any(axis=1)], matrix[marks.any(axis=1)]
            if part.empty:
                return pd.DataFrame(columns=[f.name for f in fields])
        row = {by: part[by].iloc[0], "part": part["part"].iloc[0], "ids": part[names].tolist(), "matrix": matrix.tobytes()}
        if test:
            row["bounds"] = part["bound"].to_numpy(dtype=np.float64).tobytes()
            row["open"] = np.flatnonzero(marks.any(axis=0)) if needed is not None else np.unique(np.concatenate(part["open"].to_numpy()))
        # One element each: pandas would take the lists for columns.
        return pd.DataFrame({c: pd.Series([v], dtype=object) for c, v in row.items()})

    fields = [
        T.StructField(by, T.IntegerType()), T.StructField("part", T.IntegerType()),
        T.StructField("ids", T.ArrayType(kind)), T.StructField("matrix", T.BinaryType()),
    ]
    if test:
        fields += [T.StructField("bounds", T.BinaryType()), T.StructField("open", T.ArrayType(T.IntegerType()))]
    dealt = rows.join(F.broadcast(sizes), by).withColumn("part", F.pmod(F.xxhash64(names, "vector"), "_blocks").cast("int"))
    dealt = dealt.drop("_blocks").repartition(min(parts, 2000), by, "part")
    return dealt.groupBy(by, "part").applyInPandas(pack, T.StructType(fields))


def _named(ids: pa.Array) -> np.ndarray:
    """Ids as numbers or text that numpy sorts itself; missing ones come from ``ids`` alone."""
    if pa.types.is_string(ids.type) or pa.types.is_large_string(ids.type):
        return np.array(ids.fill_null("").to_pylist(), dtype=str)
    return np.array(ids.fill_null(0).to_pylist()) if ids.null_count else ids.to_numpy(zero_copy_only=False)


def _places(row: np.ndarray) -> np.ndarray:
    """Place of each element within its run of equal rows."""
    begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, dtype=np.int64)
    return np.arange(len(row)) - np.repeat(begins, np.diff(np.r_[begins, len(row)]))


class _Held:
    """The train rows of one place of the grid, in id order."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, pa.Array, np.ndarray]] = []

    def add(self, cell: int, ids: pa.Array, train: np.ndarray) -> None:
        self.parts.append((cell, ids, train))

    def close(self) -> None:
        """To be called when all rows are there."""
        self.cells = np.repeat([p[0] for p in self.parts], [len(p[1]) for p in self.parts])
        ids = pa.concat_arrays([p[1] for p in self.parts])
        order = np.lexsort((_named(ids), ids.is_null().to_numpy(zero_copy_only=False)))
        self.ids, self.cells = ids.take(pa.array(order)), self.cells[order]
        self.rows = np.concatenate([p[2] for p in self.parts])[order]
        self.parts = []
        with np.errstate(all="ignore"):
            self.squares = (self.rows * self.rows).sum(axis=1)
            #: Rows that single precision can't stand for.
            self.odd = ~(self.squares < 1e30)
            fine = self.rows[~self.odd]
            self.centre = fine.mean(axis=0) if len(fine) else np.zeros(self.rows.shape[1])
            # Half the square as one more position: one product gives all that depends on both rows.
            self.single = np.empty((len(self.rows), self.rows.shape[1] + 1), dtype=np.float32)
            longest = 0.0
            for lo in range(0, len(self.rows), 4096):
                moved = self.rows[lo : lo + 4096] - self.centre
                half = (moved * moved).sum(axis=1) / 2
                self.single[lo : lo + 4096, :-1] = moved
                self.single[lo : lo + 4096, -1] = -half
                longest = max(longest, np.sqrt(2 * half[~self.odd[lo : lo + 4096]].max(initial=0.0)))
        self.longest = longest
        self.widest = np.sqrt(self.squares[~self.odd].max(initial=0.0))


class _Nearest:
    """The k nearest train rows found so far of each row of one test block."""

    def __init__(self, points: np.ndarray, bounds: np.ndarray, k: int, budget_bytes: int, held: _Held):
        self.points, self.bounds, self.k, self.budget, self.held = points, bounds.copy(), k, budget_bytes, held
        n, positions = points.shape
        with np.errstate(all="ignore"):
            self.squares = (points * points).sum(axis=1)
            moved = points - held.centre
            self.moved = (moved * moved).sum(axis=1)
            self.single = np.ones((n, positions + 1), dtype=np.float32)
            self.single[:, :-1] = moved
            # How far the product in single precision may be from the exact one, and the move from the rows as they are.
            unit = 1.2 * 2.0**-24 * (positions + 8)
            longest = np.sqrt(self.moved) * held.longest + held.longest**2 / 2
            self.margin = unit * longest + 1e-13 * (np.sqrt(self.squares) + 2 * held.widest) ** 2 + 1e-30
        self.even = (self.squares < 1e30) & (self.moved < 1e30)
        #: Distance and place in held of the rows found, nearest first; -1 where there is none.
        self.gap, self.at = np.full((n, k), np.inf), np.full((n, k), -1, dtype=np.int64)

    def search(self, cells: np.ndarray) -> None:
        """Train rows of the given cells."""
        among = np.flatnonzero(np.isin(self.held.cells, cells))
        odd = self.held.odd[among]
        self._wide(np.arange(len(self.points)), among[odd])
        among = among[~odd]
        columns = 1024
        for lo in range(0, len(among), columns):
            self._add(among[lo : lo + columns])

    def _add(self, among: np.ndarray) -> None:
        single = self.even & np.isfinite(self.bounds)
        self._wide(np.flatnonzero(~single), among)
        rows = np.flatnonzero(single)
        if not len(rows):
            return
        run = among[-1] - among[0] + 1 == len(among)
        train = self.held.single[among[0] : among[-1] + 1] if run else self.held.single[among]
        least = (self.moved[rows] - self.bounds[rows] ** 2 * (1 + 1e-9)) / 2
        least = (least - self.margin[rows] - 2.0**-22 * np.abs(least)).astype(np.float32)
        step = max(1, (2 << 20) // (4 * len(among)))
        hits = []
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            points = self.single[start : start + step] if len(rows) == len(self.points) else self.single[some]
            hit = np.flatnonzero(points @ train.T >= least[start : start + step, None])
            if len(hit) > 0.05 * len(some) * len(among) + 100:  # single precision can't tell them apart
                self._wide(some, among)
            elif len(hit):
                row, col = np.divmod(hit, len(among))
                hits.append((some[row], among[col]))
        if hits:
            self._exact(*(np.concatenate(h) for h in zip(*hits, strict=True)))

    def _wide(self, rows: np.ndarray, among: np.ndarray) -> None:
        """Rows against train rows in double precision.

        A product of matrices bounds the distances from below; pairs that may lie within the row's bound get theirs
        from the differences.
        """
        if not len(rows) or not len(among):
            return
        train, squares = self.held.rows[among], self.held.squares[among]
        slack = 1e-9 * (1 + squares.max())
        step = max(1, min(self.budget, 8 << 20) // max(1, 8 * len(train)))
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            near = squares[None, :] - 2 * (self.points[some] @ train.T)
            margin = slack + 1e-9 * self.squares[some]
            far = self.bounds[some] * self.bounds[some] * (1 + 1e-9) - self.squares[some]
            free = ~np.isfinite(far)
            if free.any():  # no bound yet: that of the rows themselves
                at = min(self.k, len(train)) - 1
                own = np.partition(near[free], at, axis=1)[:, at] + margin[free]
                far[free] = np.where(np.isnan(own), np.inf, own)
            # Not a number counts as in reach, as sorting puts it last and not out.
            row, col = np.divmod(np.flatnonzero(~(near > (far + margin)[:, None])), len(train))
            self._exact(some[row], among[col])

    def _exact(self, row: np.ndarray, at: np.ndarray) -> None:
        """Pairs whose distances count, if within the row's bound."""
        at_once = max(1, min(self.budget, 16 << 20) // max(1, 16 * self.points.shape[1]))
        for lo in range(0, len(row), at_once):
            r, c = row[lo : lo + at_once], at[lo : lo + at_once]
            diff = self.points[r] - self.held.rows[c]
            gap = np.sqrt(np.einsum("ik,ik->i", diff, diff))
            near = ~(gap > self.bounds[r] * (1 + 1e-12))
            self._merge(r[near], gap[near], c[near])

    def _merge(self, row: np.ndarray, gap: np.ndarray, at: np.ndarray) -> None:
        if not len(row):
            return
        hit = np.zeros(len(self.points), dtype=bool)
        hit[row] = True
        touched = np.flatnonzero(hit)
        old = self.at[touched] >= 0
        row = np.concatenate([np.repeat(touched, old.sum(axis=1)), row])
        gap = np.concatenate([self.gap[touched][old], gap])
        at = np.concatenate([self.at[touched][old], at])
        order = np.lexsort((at, gap, row))
        place = _places(row[order])
        order, place = order[place < self.k], place[place < self.k]
        self.gap[row[order], place], self.at[row[order], place] = gap[order], at[order]
        last = order[place == self.k - 1]
        self.bounds[row[last]] = np.fmin(self.bounds[row[last]], gap[last])

    def rows(self, ids: pa.Array) -> pa.RecordBatch:
        """Rows (item, neighbour, distance); ``ids`` are those of the test rows."""
        row, place = np.nonzero(self.at >= 0)
        found = [ids.take(pa.array(row)), self.held.ids.take(pa.array(self.at[row, place])), pa.array(self.gap[row, place])]
        return pa.RecordBatch.from_arrays(found, names=["item", "neighbour", "distance"])


def _rows_per_block(cells: Cells, search: Search) -> int:
    return max(1, min(search.block_rows, (4 << 20) // max(1, 8 * cells.pivots.shape[1])))


def _train_blocks(placed: DataFrame, cells: Cells, search: Search) -> DataFrame:
    train = placed.filter("train").select("cell", "item", "vector")
    return stage(_blocks(train, "cell", "item", _rows_per_block(cells, search)), "knn_train")


def _compared(
    opened: DataFrame, placed: DataFrame, cells: Cells, search: Search, train: DataFrame | None = None
) -> DataFrame:
    """Rows (item, neighbour, distance): of each test row the k nearest train rows of its open cells.

    Test rows without ``open`` have all cells open that may hold a row within their bound. Blocks of either side are
    dealt to the lines of a grid of tasks, so that a test block is sent once to each column that holds a cell it has
    open, and a train block once to each row. A task keeps the train rows of its place and runs its test blocks past them.
    """
    train = _train_blocks(placed, cells, search) if train is None else train
    needed, counted = (None, None) if "open" in opened.columns else (_needed(cells, search), placed.filter(~F.col("train")))
    test = stage(_blocks(opened, "cell", "item", _rows_per_block(cells, search), needed, counted), "knn_test")
    held, sent = (df.agg(F.sum(F.length("matrix"))).first()[0] or 0 for df in (train, test))
    budget, k = search.budget_bytes, search.k
    across = max(1, -(-held // budget))
    down = max(search.grid, -(-search.grid**2 // across), -(-sent // (4 * budget)))
    train = train.withColumn("_column", F.expr(f"CAST(pmod(xxhash64(cell, part, 2), {across}) AS int)"))
    # At most the cells times the columns.
    columns: dict[int, list[int]] = {}
    for r in train.select("cell", "_column").distinct().collect():
        columns.setdefault(r["cell"], []).append(r["_column"])
    of_cell = F.create_map(*[F.lit(x) for cell, at in sorted(columns.items()) for x in (cell, sorted(at))])
    none = F.array().cast("array<int>")
    wanted = F.array_distinct(F.flatten(F.transform("open", lambda c: F.coalesce(F.try_element_at(of_cell, c), none))))
    line = F.expr(f"CAST(pmod(xxhash64(cell, part, 1), {down}) AS int)")
    test = test.withColumn("_column", F.explode(wanted)).select(
        (F.lit(across) * line + F.col("_column")).alias("place"), F.lit(1).alias("test"), "cell", "ids", "matrix", "bounds", "open"
    )
    lines = F.explode(F.sequence(F.lit(0), F.lit(down - 1)))
    train = train.select(lines.alias("_line"), "*").select(
        (F.lit(across) * F.col("_line") + F.col("_column")).alias("place"), F.lit(0).alias("test"), "cell", "ids", "matrix",
        F.lit(None).cast("binary").alias("bounds"), F.lit(None).cast("array<int>").alias("open"),
    )
    dealt = train.unionByName(test).repartitionById(down * across, "place").sortWithinPartitions("place", "test")
    kind = placed.schema["item"].dataType

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, _Held()
        for batch in batches:
            for i in range(batch.num_rows):
                place, test, cell = (batch.column(c)[i].as_py() for c in range(3))
                if place != now:
                    now, held = place, _Held()
                ids = batch.column(3)[i].values
                points = np.frombuffer(batch.column(4)[i].as_buffer()).reshape(len(ids), -1)
                if not test:
                    held.add(cell, ids, points)
                    continue
                if held.parts:
                    held.close()
                best = _Nearest(points, np.frombuffer(batch.column(5)[i].as_buffer()), k, budget, held)
                best.search(np.asarray(batch.column(6)[i].values))
                yield best.rows(ids)

    schema = T.StructType(
        [T.StructField("item", kind), T.StructField("neighbour", kind), T.StructField("distance", T.DoubleType())]
    )
    return dealt.mapInArrow(nearest, schema)


def compare(visits: DataFrame, placed: DataFrame, cells: Cells, search: Search) -> DataFrame:
    """Rows (item, neighbour, distance): the k nearest train rows of each visited cell."""
    opened = visits.select("item", "vector", F.col("at").alias("cell"), F.lit(float("inf")).alias("bound"), F.array("at").alias("open"))
    return _compared(opened, placed, cells, search)


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("item").orderBy("distance", "neighbour")
    return found.withColumn("knn_level", F.row_number().over(nearest)).filter(F.col("knn_level") <= k)


def knn_items(
    items: DataFrame,
    item: str,
    vector: str = "vector",
    train_flag: str = "train_flag",
    k: int = 3,
    block_rows: int = 4096,
    search: Search | None = None,
) -> DataFrame:
    """The k nearest train items of every other item (exact).

    Euclidean distance on positions divided by the deviation in the train set;
    ties go to the smaller id.
    """
    search = search or Search(k=k, block_rows=block_rows)
    is_train = F.coalesce(F.col(train_flag) == 1, F.lit(False))
    scale = train_scale(items.filter(is_train), vector).scalar()
    divided = F.zip_with(F.col(vector).cast("array<double>"), "_scale", lambda v, s: v / s)
    scaled = items.withColumn("_scale", scale).select(
        F.col(item).alias("item"), is_train.alias("train"), F.coalesce(divided, F.array().cast("array<double>")).alias("vector")
    )
    scaled = stage(scaled, "knn_points")
    at = place(scaled, search)
    if at is None:
        none = scaled.filter("false").select("item", F.col("item").alias("neighbour"))
        found = none.select("*", F.lit(0.0).alias("distance"), F.lit(1).alias("knn_level"))
        return found.withColumnRenamed("item", item)
    placed, cells = at
    train = _train_blocks(placed, cells, search)
    found = _best(_compared(_first_open(placed, cells, search), placed, cells, search, train), search.k)
    if len(cells.pivots) > 1:
        found = stage(found, "knn_first")
        more = _compared(_bounded(placed, found, search), placed, cells, search, train)
        found = _best(found.drop("knn_level").unionByName(more), search.k)
    return found.withColumnRenamed("item", item)
