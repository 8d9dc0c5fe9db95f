"""Nearest neighbours: exact whatever the cells, and few pairs of cells compared."""

import numpy as np
import pytest

from panelcast.operators import neighbours as op
from panelcast.operators.neighbours import Search

SCHEMA = "item string, vector array<double>, train_flag int"


def clustered(seed, train=900, test=300, groups=12, d=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, d)) * 40
    x = centre[rng.integers(groups, size=train + test)] + rng.normal(size=(train + test, d))
    x[5] = x[6] = x[7]  # ties
    return [(f"i{n:04d}", [float(v) for v in x[n]], int(n < train)) for n in range(train + test)]


def brute(data, k):
    train = sorted((i, v) for i, v, t in data if t)
    points = np.array([v for _, v in train])
    sd = points.std(axis=0, ddof=1)
    sd = np.where(sd > 0, sd, 1.0)
    out = {}
    for i, v, t in data:
        if not t:
            gap = np.sqrt((((points - np.array(v)) / sd) ** 2).sum(axis=1))
            for level, j in enumerate(np.argsort(gap, kind="stable")[:k], 1):
                out[i, level] = (train[j][0], round(float(gap[j]), 9))
    return out


@pytest.mark.parametrize("search", [Search(), Search(cell_rows=20, block_rows=16), Search(k=40, cell_rows=5, block_rows=7), Search(k=1, cell_rows=1, max_cells=64)])
def test_exact_for_any_cells(spark, search):
    data = clustered(1, 300, 80)
    data += [(f"far{n}", [1000.0 * n * n] * 5, n % 2) for n in range(4)] + [("same", data[5][1], 0)]
    out = op.knn_items(spark.createDataFrame(data, SCHEMA), "item", search=search)
    got = {(r.item, r.knn_level): (r.neighbour, round(r.distance, 9)) for r in out.collect()}
    assert got == brute(data, search.k)


def test_under_half_of_the_cell_pairs_are_compared(spark):
    data = clustered(2)
    rows = [(i, bool(t), v) for i, v, t in data]
    scaled = spark.createDataFrame(rows, "item string, train boolean, vector array<double>")
    search = Search(cell_rows=30)
    placed, cells = op.place(scaled, search)
    first = op.first_visits(placed, cells, search)
    found = op._best(op.compare(first, placed, cells, search), search.k)
    more = op.further_visits(placed, found, cells, search)
    of = placed.filter("NOT train").select("item", "cell")
    pairs = first.select("item", "at").union(more.select("item", "at")).join(of, "item")
    assert len(cells.pivots) == 30
    assert pairs.select("cell", "at").distinct().count() < 0.5 * len(cells.pivots) ** 2
    assert pairs.count() < 0.25 * 300 * len(cells.pivots)


def test_no_train_no_test_and_empty(spark):
    for data in ([("a", [1.0], 1)], [("a", [1.0], 0)], []):
        out = op.knn_items(spark.createDataFrame(data, SCHEMA), "item")
        assert out.count() == 0 and set(out.columns) == {"item", "neighbour", "distance", "knn_level"}


def test_fewer_train_rows_than_k(spark):
    data = [("a", [0.0], 1), ("b", [4.0], 1), ("q", [1.0], 0), ("r", [9.0], None)]
    out = op.knn_items(spark.createDataFrame(data, SCHEMA), "item", search=Search(cell_rows=1))
    assert sorted((r.item, r.neighbour, r.knn_level) for r in out.collect()) == [("q", "a", 1), ("q", "b", 2), ("r", "a", 2), ("r", "b", 1)]


def test_comparing_repeats_no_row_for_an_open_cell(spark):
    """Every cell is open to every row of noise: what is stored for comparing stays one row each."""
    rng = np.random.default_rng(3)
    rows = [(f"i{n:04d}", n < 200, [float(v) for v in rng.normal(size=30)]) for n in range(300)]
    scaled = spark.createDataFrame(rows, "item string, train boolean, vector array<double>")
    search = Search(cell_rows=10, block_rows=16)
    placed, cells = op.place(scaled, search)
    found = op._best(op._compared(op._first_open(placed, cells, search), placed, cells, search), search.k)
    opened = op._further_open(placed, found, cells, search)
    assert opened.count() == 100
    assert opened.selectExpr("sum(size(open))").first()[0] > 1500
    stored = op._blocks(opened, "cell", "item", search.block_rows).selectExpr("sum(length(matrix))", "max(size(ids))").first()
    assert stored[0] == 100 * 30 * 8 and stored[1] < 4 * search.block_rows
    got = op._best(found.drop("knn_level").unionByName(op._compared(opened, placed, cells, search)), search.k).collect()
    points = np.array([v for _, t, v in rows if t])
    for r in got:
        gap = np.sqrt(((points - np.array(rows[int(r.item[1:])][2])) ** 2).sum(axis=1))
        assert f"i{np.argsort(gap, kind='stable')[r.knn_level - 1]:04d}" == r.neighbour
    assert len(got) == 300


def test_blocks_meet_without_a_join_and_hard_numbers_stay_exact(spark):
    """A block is sent once per line of the grid, not once per pair; single precision only rules out."""
    rng = np.random.default_rng(8)
    x = 1e8 + rng.normal(size=(260, 4))  # single precision sees one point
    x[:20] = x[40:60] + rng.normal(size=(20, 4)) * 1e-3
    x[30:35] = x[100:105]  # equal rows: ties go to the smaller id
    data = [(f"i{n:04d}", [float(v) for v in x[n]], int(n >= 40)) for n in range(260)]
    out = op.knn_items(spark.createDataFrame(data, SCHEMA), "item", search=Search(cell_rows=30, block_rows=16))
    got = {(r.item, r.knn_level): (r.neighbour, r.distance) for r in out.collect()}
    expected = brute(data, 3)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert all(np.isclose(got[k][1], expected[k][1], rtol=1e-6, atol=1e-6) for k in got)
    scaled = spark.createDataFrame([(i, bool(t), v) for i, v, t in data], "item string, train boolean, vector array<double>")
    placed, cells = op.place(scaled, Search())
    plan = op._compared(op._first_open(placed, cells, Search()), placed, cells, Search())._jdf.queryExecution().toString()
    assert "Join" not in plan and "MapInArrow" in plan
