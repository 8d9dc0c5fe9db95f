"""Quality rules against a brute-force count, and their defined cases."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def measured(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    out = quality.quality_rules(df).select("doc_id", "_base.*", "base_failed", "kept").collect()
    return {r["doc_id"]: r for r in out}


TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c ",
    "of the f f",
    "a b c d e f g h " * 30,
    "one\ntwo\none\n\n \none|two#\x1cx y",
    "ä é ñ 日本 " * 300 + "x" * 100_000,
    " ".join(f"w{i}" for i in range(30_000)),
    "N of " * 48,
]


def test_counts_equal_brute_force(spark):
    got = measured(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert tuple(got[i])[1:6] == brute(t)
        n, _, _, _, repeated = brute(t)
        assert got[i]["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert not (got[i]["base_failed"] and got[i]["kept"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=120), min_size=1, max_size=8))
def test_any_text(spark, texts):
    got = measured(spark, texts)
    assert [tuple(got[i])[1:6] for i in range(len(texts))] == [brute(t) for t in texts]


def test_divergent_text_is_rejected_and_clean_kept(spark):
    clean = [" ".join(["the", "of", f"word{i}", "and", f"thing{j}", "to", "is"] * 1) for i in range(3) for j in range(3)]
    docs = []
    for d in range(30):
        docs.append((d, " ".join(f"the hotel{d}x{k} of and season{k} in it was" for k in range(40)), "en", "s", 0))
    docs.append((100, " ".join(f"ab{k}$$$ cd{k}### ef{k}%%%" for k in range(60)), "en", "s", 0))
    docs.append((101, " ".join(f"ab{k}$$$ cd{k}### ef{k}%%%" for k in range(60)), None, "s", 0))
    out = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(out[d]["kept"] for d in range(30)) and clean
    assert not out[100]["kept"] and out[100]["class_distance"] > 0.35
    assert out[101]["kept"] and out[101]["class_distance"] is None


def test_empty_table_repeated_rows_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA + ", kept_by string")
    assert quality.quality_rules(none).count() == 0
    two = spark.createDataFrame([(1, "x y", "en", "s", 0, "k")] * 2, SCHEMA + ", kept_by string")
    assert [r["kept_by"] for r in quality.quality_rules(two).collect()] == ["k", "k"]


def test_distance_is_bounded(spark):
    same = spark.sql(f"SELECT {quality.js_distance('array(1L, 3L)', [0.25, 0.75])} AS d").first()["d"]
    other = spark.sql(f"SELECT {quality.js_distance('array(0L, 3L)', [1.0, 0.0])} AS d").first()["d"]
    assert same == pytest.approx(0) and other == pytest.approx(1)
