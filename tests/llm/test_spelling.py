"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import spelling as op
from panelcast.llm.spelling import Spelling

SCHEMA = "doc_id long, text string, word int, n int, m int"
SMALL = {c: c + 32 for c in range(65, 91)}


def counted(docs, rule):
    out = Counter()
    for id_, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % rule.damage == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= rule.min_length:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= rule.min_count}


def edits(word, letters):
    cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    new = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return (cut | put | new) - {word}


def brute(docs, rule):
    n = counted(docs, rule)
    letters = sorted({c for w in n for c in w})
    near = {w: [v for v in edits(w, letters) if v in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= rule.ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def documents(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdéñÿ", k=rng.randint(6, 12))) for _ in range(25)] + ["aaaaaaaa", "abababab", "Großkreuz", "naïveté", "×÷ÀÿÑabc"]

    def changed(w):
        i, c = rng.randrange(len(w)), rng.choice("abcdxyzé")
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w + c, c + w])

    docs = [(None, None), (1, ""), (2, None), (3, "x" * 60_000), (3, "x" * 60_000), (4, "x" * 59_999 + "Y"), (4, "x" * 59_999 + "y")]
    for i in range(400):
        some = [w if rng.random() < 0.8 else changed(w) if rng.random() < 0.7 else changed(changed(w)) for w in rng.choices(base, weights=range(1, 31), k=30)]
        some = [w.upper() if rng.random() < 0.05 else w for w in some]
        docs.append((10 + i if i % 50 else None, rng.choice([" ", "-", "1", "\n", "_日"]).join(some)))
    return docs + docs[20:40]


@pytest.mark.parametrize("rule", [Spelling(), Spelling(tile=2, cells=2, bytes_at_once=200, rows_at_once=50), Spelling(ratio=2, tile=5, cells=1, damage=3)])
def test_equal_to_all_edits(spark, rule):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    docs = documents(13)
    want = brute([d for d in docs if len(d[1] or "") < 50_000], rule)
    rows = [(*d, 0, 0, 0) for d in docs]
    out = got(op.variants(spark.createDataFrame(rows, SCHEMA), rule))
    long = {w: out.pop(w) for w in list(out) if len(w) > 50_000}
    assert out == want and len(want) > 300
    assert sum(v[0] is not None for v in want.values()) > 20
    assert any(v[1] not in (w, v[0]) for w, v in want.items()) or rule.ratio == 10
    assert len(long) == len({w for w in counted([d for d in docs if len(d[1] or "") > 50_000], rule)})
    if rule.damage == 31:
        assert {v[3] for v in long.values()} == {len(long) - 1}


def test_hot_front_is_cut_until_few_words_meet(spark):
    rng = np.random.default_rng(2)
    some = sorted({"commonfront" + "".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000)})
    rows = spark.createDataFrame([(w, 2 + i % 7) for i, w in enumerate(some)], "word string, n long")
    rule = Spelling(tile=100)
    sizes = [r["count"] for r in op.cells(rows, rule).groupBy("m", "low", "high", "key").count().collect()]
    assert max(sizes) <= 100
    near = {r["word"]: r["n_near"] for r in op.near_words(rows, rule).collect()}
    known = set(some)
    assert all(near.get(w, 0) == sum(v in known for v in edits(w, "abcdefghij")) for w in some)


def test_empty_table(spark):
    assert op.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert op.variants(spark.createDataFrame([(1, "no long word", 0, 0, 0)], SCHEMA)).count() == 0
