"""Mixes against weights computed in plain Python, and the passes that realise them."""

import math
from collections import Counter

import pytest

from panelcast.llm import mixing
from panelcast.llm.mixing import Mix

SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")


def corpus(spark, sizes, extra=()):
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + k % 7)), source))
            i += 1
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def tokens(out):
    got = Counter()
    for r in out:
        got[r["source"]] += r["n_tokens"]
    return got


SIZES = {"hot": 700, "mid": 210, "small": 70, None: 140}


def test_repetition_limit_keeps_all_and_repeats_small_sources(spark):
    docs = corpus(spark, SIZES)
    out = mixing.mixed(docs, Mix(block_tokens=100)).collect()
    total = tokens(docs.selectExpr("source", "size(split(text, ' ')) AS n_tokens").collect())
    got = tokens(out)
    assert got["hot"] == total["hot"] and got["small"] == 2 * total["small"]
    assert {r["doc_id"] for r in out} == set(range(1120))
    share = {k: v / sum(total.values()) for k, v in total.items()}
    x = 1 - math.log(2) / math.log(share["hot"] / share["small"])
    for s in ("mid", None):
        aim = total[s] * (share[s] / share["hot"]) ** (x - 1)
        assert aim - 7 - 1 <= got[s] <= aim + 1
    seen = Counter((r["doc_id"], r["epoch"]) for r in out)
    assert max(seen.values()) == 1 and all(0 <= r["position"] < 1 for r in out)


def test_budget_is_not_exceeded_and_entropy_met(spark):
    docs = corpus(spark, SIZES)
    sizes = docs.selectExpr("coalesce(source, 'n') AS _source", "size(split(text, ' ')) AS t").groupBy("_source").sum("t").toDF("_source", "tokens")
    w = mixing.weights(sizes, Mix(budget=1000, entropy_bits=1.5)).collect()
    assert -sum(r["weight"] * math.log2(r["weight"]) for r in w) == pytest.approx(1.5, abs=1e-6)
    assert sum(r["weight"] for r in w) == pytest.approx(1)
    out = mixing.mixed(docs, Mix(budget=1000, entropy_bits=1.5, block_tokens=50)).collect()
    target = {r["_source"]: r["target"] for r in w}
    for s, n in tokens(out).items():
        assert target[s or "n"] - 7 <= n <= target[s or "n"]


def test_one_source_empty_table_nulls_and_repeats(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, None, "s"), (2, "", "t")]
    out = mixing.mixed(spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", epoch int")).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["epoch"]) for r in out) == [(0, 0, 0), (1, 2, 0), (1, 2, 0), (2, 0, 0)]
    empty = spark.createDataFrame([(1, "", "s"), (2, None, None)], SCHEMA)
    assert {r["doc_id"] for r in mixing.mixed(empty).collect()} == {1, 2}


def test_clashing_columns_stay(spark):
    names = ["blocks", "_order", "_source", "last_", "n_tokens", "epoch", "block", "position", "room", "tokens", "_doc", "x.y"]
    schema = SCHEMA + ", " + ", ".join(f"`{n}` int" for n in names)
    rows = [(i, "a b c", "s" if i % 3 else "t", *range(len(names))) for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    out = mixing.remixed(df, Mix(budget=40, block_tokens=6))
    assert out.columns == df.columns and {tuple(r)[3:] for r in out.collect()} == {tuple(range(len(names)))}
    extra = mixing.mixed(df, Mix(budget=40, block_tokens=6))
    assert extra.columns == [*[c for c in df.columns if c not in mixing.ADDED], *mixing.ADDED]


def test_same_seed_same_mix(spark):
    docs = corpus(spark, SIZES)
    mix = Mix(budget=900, block_tokens=60)
    a, b = (sorted((r["doc_id"], r["epoch"], r["block"]) for r in mixing.mixed(d, mix).collect()) for d in (docs, docs.repartition(5)))
    assert a == b
