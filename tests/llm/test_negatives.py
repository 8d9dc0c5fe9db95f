"""Hard negatives against all pairs, and the bounds of the tree."""

import numpy as np
import pytest

from panelcast.llm import negatives as op
from panelcast.llm.negatives import Mining

SCHEMA = "vec_id long, label int, vector array<long>, is_anchor boolean, score int, slot int"


def brute(rows, pos=5, neg=3, low=50, high=95):
    ok = [(k, r) for k, r in enumerate(rows) if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for k, a in ok:
        if not a[3] or a[0] is None:
            continue
        scored = [(dot(a[2], r[2]), r[0], r[1]) for j, r in ok if j != k]
        others = sorted((s for s in scored if s[2] != a[1]), key=order)
        for p in sorted((s for s in scored if s[2] == a[1]), key=order)[:pos]:
            inside = [n for n in others if low * p[0] <= 100 * n[0] <= high * p[0]][:neg]
            out += [(a[0], p[1], i + 1, n[1], p[0], n[0]) for i, n in enumerate(inside)]
    return sorted(out, key=repr)


def found(spark, rows, rule):
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    return sorted(map(tuple, op.hard_negatives(df, rule).collect()), key=repr)


def clustered(seed, n=260, d=6, scale=40):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, d)) * scale
    x = np.floor(centre[rng.integers(4, size=n)] + rng.normal(size=(n, d)) * scale / 6).astype(int)
    return [(int(i), int(rng.integers(3)), [int(c) for c in x[i]], bool(i % 9 == 0)) for i in range(n)]


@pytest.mark.parametrize("rule", [Mining(), Mining(group=7, block=50, chunk=16), Mining(positives=2, negatives=1, group=3, block=1000, chunk=5)])
def test_equal_to_all_pairs(spark, rule):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rows = clustered(1) + [
        (900, None, [1] * 6, True), (901, 1, None, True), (902, 1, [1, None, 1, 1, 1, 1], True), (903, 1, [], True), (904, 1, [50, 60], True),
        (None, 1, [30] * 6, True), (None, 2, [30] * 6, False), (905, 77, [10] * 6, True), (906, 2, [0] * 6, True), (907, 2, [-90] * 6, True),
    ]
    rows += [(9, 1, [20] * 6, True)] * 3 + [(2000 + i, 2, [31, 30, 30, 30, 30, 30], False) for i in range(8)]
    want = brute(rows, rule.positives, rule.negatives)
    assert len(want) > 50 and found(spark, rows, rule) == want


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(5)
    big = op.LARGEST
    rows = [(i, int(i % 2), [int(c) for c in rng.integers(-big, big, 24)], i % 4 == 0) for i in range(60)]
    rows += [(100 + i, int(i % 2), [big - int(c) for c in rng.integers(0, 9, 24)], i % 4 == 0) for i in range(20)]
    assert found(spark, rows, Mining(least_percent=-100, most_percent=100)) == brute(rows, low=-100, high=100)


def test_tree_bounds_leave_most_pairs_unscored():
    rows = clustered(2, 2000, 16, 200)

    def packed(some):
        import pandas as pd

        frame = pd.DataFrame([(r[0], r[0], r[1], r[2]) for r in some], columns=["rid", "vec_id", "label", "vector"])
        return op._Rows(op._pack(frame))

    anchors = rows[:120]
    order, parent, length = op.spanning_tree(packed(anchors).x)
    tree, all_rows = packed([anchors[i] for i in order]), packed(rows)
    assert sorted(order) == list(range(120)) and all(p < i for i, p in enumerate(parent) if i)
    best = op.best_positives(tree, parent, length, all_rows, Mining())
    least = [-b[-1][0] for b in best]
    seen = []
    scored = op.walk(tree, parent, length, all_rows, 512, lambda i, part: (least[i], np.inf, np.ones(part.stop - part.start, bool)), lambda i, at, s: seen.append((i, int((s >= least[i]).sum()))))
    x, t = all_rows.x.astype(float), tree.x.astype(float)
    exact = t @ x.T
    assert scored < 0.5 * tree.n * all_rows.n
    assert all(sum(n for j, n in seen if j == i) == (exact[i] >= least[i]).sum() for i in range(tree.n))


def test_query_and_empty_table(spark, tmp_path):
    rng = np.random.default_rng(3)
    schema = "vec_id long, embedding array<float>, label int, vector string, rid int"
    data = [(i, [float(np.float32(v)) for v in rng.normal(size=8)], int(rng.integers(10)), "x", 0) for i in range(300)]
    data += [(350, [float("nan")] * 8, 1, "", 0), (400, [float("inf")] * 8, 1, "", 0), (450, None, 1, "", 0), (500, [1.0] * 8, None, "", 0), (550, [1e30] + [0.0] * 7, 1, "", 0)]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    fine = [r for r in data if r[1] and np.isfinite(r[1]).all()]
    cut = lambda x: int(max(-op.LARGEST, min(op.LARGEST, np.floor(256 * x))))
    rows = [(r[0], None if r[2] is None else (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], [cut(x) for x in r[1]], r[0] % 50 == 0) for r in fine]
    assert sorted(map(tuple, op.op12(spark, str(tmp_path)).collect()), key=repr) == brute(rows)
    assert found(spark, [], Mining()) == []
