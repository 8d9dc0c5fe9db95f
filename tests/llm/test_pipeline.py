"""The pipeline: every stage on its predecessor's rows, against brute force."""

import random

import corpus_pipeline
import pytest
from test_ngram_join import brute
from test_quality import brute as counts
from test_secrets import brute as spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in ("lor", "em", "ip", "dol", "sit") for b in range(60)]
    base = [" ".join(rng.choices(["the", "of", "and"] + vocabulary, k=rng.randint(40, 120))) for _ in range(40)]
    texts = [None, "", "too short", "ab cd " * 200]
    for b in base:
        texts.append(b)
        if rng.random() < 0.4:
            texts.append(b + " end")
        if rng.random() < 0.3:
            texts.append(b + " password=hunter2hunter2 é")
    return [(i, t, rng.choice(["xx", None]), rng.choice(["a", "a", "a", "b", None]), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, folder).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return folder, [d.collect() for d in out], [d.columns for d in out]


def test_stages_equal_brute_force(spark, stages):
    _, (kept, single, clean, mixed, packed), columns = stages
    rows = documents()
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(c == names for c in columns[:4])
    good = [r for r in rows if counts(r[1])[0] >= 20 and 100 * counts(r[1])[4] <= 30 * counts(r[1])[0]]
    assert sorted(r["doc_id"] for r in kept) == [r[0] for r in good]
    first = {good[i][0] for i, (_, c) in enumerate(brute([r[1] for r in good])) if c == i}
    assert {r["doc_id"] for r in single} == first and len(single) == len(first) < len(good)
    text = {r[0]: r[1] for r in rows}
    for r in clean:
        expected, shift = text[r["doc_id"]], 0
        for s, _, _, e in spans(expected)[1]:
            expected = expected[: s + shift] + "[secret]" + expected[e + shift :]
            shift += 8 - (e - s)
        assert r["text"] == expected and r["n_chars"] == len(expected)
    assert {r["doc_id"] for r in mixed} == first and len(mixed) > len(first)
    assert sorted(r["doc_id"] for r in packed if r["start"] == 0) == sorted(r["doc_id"] for r in mixed)


def test_run_gives_the_last_stage(spark, stages):
    folder, out, _ = stages
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(out[-1])


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_ids_are_told_apart_by_text(spark):
    rows = [(None, "one text", "en", "s", 8), (None, "one text", "en", "s", 8), (None, "other", "en", "s", 5), (3, "x", "en", "s", 1)]
    out = corpus_pipeline.one_of_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r["text"] for r in out) == ["one text", "other", "x"]
