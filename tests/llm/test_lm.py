"""Scores against a plain count of words and pairs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import hashing, lm
from panelcast.llm.lm import Lm

SCHEMA = "doc_id long, text string, words int, kind string"


def small(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def listed(text):
    return re.findall(r"[^\x20\x09-\x0D]+", small(text)) + ["</s>"]


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [None, "", "É é W1 w1", "unseen words only here"]
    for _ in range(120):
        w, text = 0, []
        for _ in range(rng.randint(1, 60)):
            w = (w * 3 + rng.randint(0, 2)) % 60 if rng.random() < 0.8 else rng.randint(0, 59)
            text.append(vocabulary[w])
        texts.append(" ".join(text))
    return texts


def brute(texts):
    """(counts of words and pairs, tokens, weights) from exact estimates, by EM without rounding."""
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    words, pairs = Counter(), Counter()
    for t, h in zip(texts, held, strict=True):
        if not h:
            w = listed(t)
            words.update(w)
            pairs.update(zip(["<s>", *w], w, strict=False))
    return held, words, pairs


def test_base_score_and_counts(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    texts = corpus()
    held, words, pairs = brute(texts)
    total, distinct = sum(words.values()), len(words)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], SCHEMA)
    small_parts = Lm(chunk_docs=30, range_docs=40)
    out = {r["doc_id"]: r for r in lm.score_documents(docs, small_parts).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        w = listed(t)
        assert out[i]["held_out"] == held[i] and out[i]["n_tokens"] == len(w) and out[i]["train_tokens"] == total
        assert out[i]["n_known"] == sum(words[x] > 0 for x in w)
        base = sum(math.log10((words[x] + 1) / (total + distinct + 1)) for x in w)
        assert out[i]["base_score"] == pytest.approx(base, rel=1e-9)
    # The model's score from its own weights and plain counts.
    rows = lm.counted(docs, Lm())
    documents = rows.filter(f"kind = {lm.DOCUMENT}")
    weight = lm.learned(lm.held_out_counts(documents, total, distinct), Lm().rounds)
    assert np.allclose(weight.sum(axis=1), 1)
    better = 0
    for i, t in enumerate(texts):
        score, before = 0.0, "<s>"
        for x in listed(t):
            context = words["</s>"] if before == "<s>" else words[before]
            a, b, c = weight[int(lm.bucket(np.array([float(context)]))[0])]
            score += math.log10(a * (pairs[before, x] / context if context else 0) + b * words[x] / total + c / (distinct + 1))
            before = x
        assert out[i]["score"] == pytest.approx(score, rel=1e-9)
        better += held[i] and out[i]["score"] > out[i]["base_score"]
    assert better > 0.8 * sum(held)


def test_em_finds_the_mixture_of_a_known_source():
    import pandas as pd

    rows = pd.DataFrame({"bucket": [3, 3, 3], "pair": [8.0, 0.0, 0.0], "word": [1.0, 4.0, 0.0], "n": [600.0, 300.0, 100.0]})
    w = lm.learned(rows, 500)[3]
    like = lambda w: sum(n * math.log(w[0] * p + w[1] * q + w[2]) for p, q, n in zip(rows["pair"], rows["word"], rows["n"], strict=True))
    rng = np.random.default_rng(1)
    assert all(like(w) >= like(x) - 1e-9 for x in rng.dirichlet([1, 1, 1], 500))


def test_planes_round_trip():
    x = np.array([0, 1, 2**63 + 5, 2**64 - 1], dtype=np.uint64)
    assert np.array_equal(hashing.unplaned(hashing.planes(x, 8), 8), x)
    assert np.array_equal(hashing.unplaned(hashing.planes(x, 6), 6), x & ~np.uint64(0xFFFF))


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]
    out = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 4 and all(math.isfinite(r["score"]) for r in out)
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm.score_documents(spark.createDataFrame([(held, "x y")], "doc_id long, text string")).first()
    assert only["held_out"] and only["train_tokens"] == 0 and only["base_score"] == pytest.approx(0)
