"""The join against all pairs of sets, and the word hashes against words."""

import random
import re

import numpy as np
import pyarrow as pa

from panelcast.llm import hashing, ngram_join
from panelcast.llm.common import components
from panelcast.llm.ngram_join import Join

SCHEMA = "doc_id long, text string, n int, prefix string"


def small(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", small(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(texts, percent=75):
    sets, up = [brute_set(t) for t in texts], list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def corpus(rng):
    base = [[f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([3, 4, 5, 6, 30, 60, 200]))] for _ in range(25)]
    passage = [f"p{i}" for i in range(25)]
    texts = [None, "", " \n", "ÉA b", "éA b", "a b c d e f g h " * 20]
    for b in base:
        for _ in range(rng.randint(1, 8)):
            w = list(b)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 999)}"
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w[at:at] = passage
            if rng.random() < 0.2:
                w = [x.upper() for x in w]
            texts.append((" " if rng.random() < 0.7 else "\n\t").join(w))
    return texts


def test_words_and_bounds():
    texts = ["The the\x1fx", "", None, "a\n  B\t", "no\xa0break", "end", "end", "x" * 3000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(1)
    hashes, bounds = hashing.words(*hashing.texts(batch.column(0)))
    words = [w for t in texts[1:] for w in re.findall(r"[^\x20\x09-\x0D]+", small(t))]
    assert len(hashes) == len(words) and bounds.tolist() == [0, 0, 0, 2, 3, 4, 5, 6]
    assert [list(hashes).index(h) for h in hashes] == [words.index(w) for w in words]
    assert [len(p) for p in hashing.slices(batch, 0, 4)] and sum(len(p) for p in hashing.slices(batch, 0, 4)) == 7


def test_components_equal_brute_force(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    for seed in (1, 2):
        texts = corpus(random.Random(seed))
        docs = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA).repartition(3)
        out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
        assert out == dict(enumerate(brute(texts)))
        assert len({c for _, c in out.values()}) < len(texts) - 20


def test_common_list_changes_no_result(spark):
    texts = corpus(random.Random(3))
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA)
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs, Join(common=3, most_matches=2)).collect()}
    assert out == {i: c for i, (_, c) in enumerate(brute(texts))}


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"), (None, "alone here"), (7, None)]
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in out)
    assert got == [(0, 1, 0), (0, 2, 4), (4, 2, 4), (4, 2, 4), (7, 0, 7)]
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(20)] + [(205, 90), (7, 7)]
    out = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 90 for i in [90, 100, *range(200, 220)]}
    assert np.array_equal(hashing.powers(5)[:3], hashing.powers(3))


def test_one_row_of_each_group_stays_with_null_and_repeated_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, base, 1), (None, base + " x", 2), (None, base + " y", 3),  # linked, none with an id
        (5, "other " + base.replace("w", "v"), 4), (5, "quite different words in this text of mine", 5), (4, base.replace("w", "v"), 6),
        (None, None, 7), (None, None, 8), (None, "", 9), (9, "", 10), (9, "", 11),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    out = ngram_join.one_of_copies(df).collect()
    kept = sorted(r["key"] for r in out)
    assert len([k for k in kept if k in (1, 2, 3)]) == 1 and [k for k in kept if k in (4, 5, 6)] == [5, 6]
    assert len([k for k in kept if k in (7, 8)]) == 1 and 9 in kept and len([k for k in kept if k > 9]) == 1


def test_repeated_rows_of_near_copies_are_compared_once(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base)] * 300 + [(2, base + " end")] * 300 + [(3, "some other text that is alone here")]
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 601 and {(r["doc_id"], r["component_id"]) for r in out} == {(1, 1), (2, 1), (3, 3)}


def test_family_around_one_text_links_without_its_copies_linking(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(170)]
    texts = [" ".join(base)]
    for _ in range(120):
        some = list(base)
        for at in rng.sample(range(170), rng.choice([2, 4, 6])):
            some[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(some))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for join in (ngram_join.Join(), ngram_join.Join(attempts=3, members_at_once=7)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df, join).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts)


def _join_rows(df):
    """Rows of df, and the most rows that one of its joins made."""

    def plans(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
            yield from plans(p.executedPlan() if name == "AdaptiveSparkPlanExec" else p.plan())
            return
        yield p
        for i in range(p.children().size()):
            yield from plans(p.children().apply(i))

    rows = df.collect()
    joins = [p for p in plans(df._jdf.queryExecution().executedPlan()) if "Join" in p.getClass().getSimpleName()]
    return rows, max((p.metrics().apply("numOutputRows").value() for p in joins), default=0)


def test_those_who_share_little_with_a_family_do_not_meet_its_members(spark, monkeypatch):
    def held(cls, component, first, k):
        return [(i + 1, cls, 146, 4, first + i, k, component) for i in range(k)]

    family = [r for c in range(40) for r in held(c, 0, 10, 6)]
    few = [r for c in range(100, 140) for r in held(c, c, 21, 3)]  # too late for the first of 4 matches
    three = held(300, 300, 18, 3)  # early enough, but without a fourth
    schema = "shingle long, cls long, n int, k int, pos int, central long, component long"
    found = spark.createDataFrame(family + few + three + held(200, 200, 18, 4), schema)
    made, keep = [], ngram_join.stage

    def stage(df, name):
        made.append(_join_rows(df)[1])
        return keep(df, name)

    monkeypatch.setattr(ngram_join, "stage", stage)
    rows, most = _join_rows(ngram_join.cross_pairs(found, Join()))
    assert sorted((r["cls"], r["cls2"]) for r in rows) == [(c, 200) for c in range(40)]
    assert max([most, *made]) < 1000  # 40 * 40 pairs share 3 shingles each
