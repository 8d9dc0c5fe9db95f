"""Line dedup against a plain dictionary of lines."""

import hashlib
import random
from collections import Counter

from panelcast.llm import line_dedup as op

SCHEMA = "doc_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(texts, min_docs, min_chars=1):
    lines = [(t or "").split("\n") for t in texts]
    docs = Counter(k for ls in lines for k in {key(x) for x in ls})
    gone = {k for k, n in docs.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for ls in lines]


def got(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()}


def test_equal_to_brute_force(spark):
    rng = random.Random(11)
    pool = ["Menu", " menu\t", "MENU\r", "É lan", "é lan", "İx", "ix", "", "  ", "a b", "\x0bfoot\x0c", "foot", "日本", "x" * 300, " menu", "\\n", "K"]
    pool += [f"line {i}" for i in range(40)]
    texts = [None, "", "\n", "\n\n", "menu", "menu\n", "\nmenu"]
    texts += ["\n".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(150)]
    texts += ["only\nonly"] * 12 + ["twice\ntwice\ntwice"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for docs, chars in ((10, 1), (3, 4), (1, 1)):
        want = dict(enumerate(brute(texts, docs, chars)))
        assert got(op.scan(df, op.Common(min_docs=docs, min_chars=chars))) == want
    assert brute(texts, 10)[-1][1] == 0 and brute(texts, 10)[-2][1:] == (2, "")


def test_long_text_with_many_dropped_lines(spark):
    shared = [f"shared {i}" for i in range(60_000)]
    long = "\n".join(x for i, s in enumerate(shared) for x in (s, f"own {i}"))
    df = spark.createDataFrame([(1, long), (2, "\n".join(shared))], SCHEMA)
    rows = got(op.scan(df, op.Common(min_docs=2)))
    assert rows[2] == (60_000, 60_000, "")
    assert rows[1] == (120_000, 60_000, "\n".join(f"own {i}" for i in range(60_000)))


def test_nulls_repeats_clashing_columns_and_empty_table(spark):
    schema = "doc_id long, text string, _rest int, _rest_r int, lines int, a int, pos int, `x.y` int"
    rows = [(None, None, 1, 2, 3, 4, 5, 6), (7, "Foot\nown", 1, 2, 3, 4, 5, 6), (7, "Foot\nown", 1, 2, 3, 4, 5, 6), (None, "foot", 1, 2, 3, 4, 5, 6)]
    out = op.drop_common_lines(spark.createDataFrame(rows, schema), op.Common(min_docs=3))
    assert out.columns == ["doc_id", "text", "_rest", "_rest_r", "lines", "a", "pos", "x.y"]
    assert sorted((str(r[0]), str(r[1])) + tuple(r)[2:] for r in out.collect()) == sorted(
        [("None", "None", 1, 2, 3, 4, 5, 6), ("7", "own", 1, 2, 3, 4, 5, 6), ("7", "own", 1, 2, 3, 4, 5, 6), ("None", "", 1, 2, 3, 4, 5, 6)]
    )
    empty = spark.createDataFrame([], SCHEMA)
    assert op.scan(empty).count() == 0 and op.drop_common_lines(empty).count() == 0


def test_query_digest(spark, tmp_path):
    rows = [(i, f"Footer\n{i}") for i in range(10)] + [(10, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in op.op11(spark, str(tmp_path)).collect()}
    assert out[3]["kept_sha256"] == hashlib.sha256(b"3").hexdigest() and out[3]["n_dropped"] == 1
    assert (out[10]["n_lines"], out[10]["n_dropped"], out[10]["kept_sha256"]) == (1, 0, hashlib.sha256(b"").hexdigest())
