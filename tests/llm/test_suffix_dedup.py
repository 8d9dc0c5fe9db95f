"""Removed bytes against a count of all strings, and the suffix array against a plain sort."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import suffix_dedup
from panelcast.llm.suffix_dedup import Dedup

SCHEMA = "doc_id long, text string, key int, s int"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(d, gone[1:], strict=False) if not g)
        out.append((len(d), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, length):
    words = [f"w{i}é" for i in range(400)]
    parts = [" ".join(rng.choices(words, k=rng.randint(length // 8, length))) for _ in range(12)]
    texts = [None, "", "short", "a" * (3 * length), "ab" * (2 * length), "line of text\n" * length, "日本語" * length]
    for _ in range(60):
        t = "\n".join([" ".join(rng.choices(words, k=rng.randint(0, length // 3))), rng.choice(parts), rng.choice(parts)])
        at = rng.randrange(len(t))
        texts.append(t if rng.random() < 0.3 else t[:at] + rng.choice(words) + t[at:])
    return texts + [texts[10], texts[11][3:]]


def run(spark, texts, dedup):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = suffix_dedup.remove_repeats(docs, dedup).collect()
    out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in rows}
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize("dedup", [Dedup(), Dedup(length=40, anchor=4, block_runs=2, block_bytes=500, longest_run=16, task_bytes=3000)])
def test_removed_bytes_equal_brute_force(spark, dedup):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    texts = corpus(random.Random(dedup.length), dedup.length)
    expected = brute(texts, dedup.length)
    assert run(spark, texts, dedup) == expected
    assert sum(e[1] > 0 for e in expected) > 40 and any(e[2] > 1 for e in expected)


def test_two_stage_order_equals_plain_sort():
    rng = random.Random(2)
    for alphabet in (b"ab", b"a", b"abcdefgh\x00\xfe", bytes(range(200))):
        for _ in range(20):
            data = bytes(rng.choices(alphabet, k=rng.randint(1, 300))) + b"\xff"
            wanted = np.array([rng.random() < 0.6 for _ in data[:-1]] + [False])
            got = suffix_dedup.sorted_suffixes(data, wanted, 400)
            plain = sorted(np.flatnonzero(wanted).tolist(), key=lambda i: data[i:])
            assert [data[i:] for i in got] == [data[i:] for i in plain] and sorted(got) == sorted(plain)
            lengths = suffix_dedup.common_prefixes(data, got, 40)
            for a, b, n in zip(got[:-1], got[1:], lengths[1:], strict=True):
                x, y = data[a : a + 40], data[b : b + 40]
                same = next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))
                assert n == same


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(200))
    rows = [(None, text, 0, 0), (1, text, 0, 0), (1, text, 0, 0), (None, None, 0, 0)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in out) == [(0, 0)] + [(len(text), len(text))] * 3
    alone = suffix_dedup.remove_repeats(spark.createDataFrame(rows[1:2], SCHEMA)).first()
    assert alone["n_removed"] == 0 and bytes(alone["kept"]) == text.encode()


@pytest.mark.parametrize("around", [False, True])
def test_a_single_run_that_repeats_itself(spark, around):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rng = random.Random(17)

    def letters(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))

    texts = ["a" * 450, *[letters(unit) * 20 for unit in (60, 200, 300)]]
    texts = [texts[0], *[t[:n] for t in texts[1:] for n in (480, 600, 700, 800, 900)], letters(900)]
    # A passage twice, apart and overlapping with its end; and one whose anchor alone occurs twice.
    part, end = letters(430), letters(16)
    texts += [part + letters(60) + part, end + letters(100) + end + letters(500)]
    if around:
        texts = [letters(700) + t + letters(700) for t in texts]
    for dedup in (Dedup(), Dedup(tried_places=1), Dedup(longest_run=64)):
        assert run(spark, texts, dedup) == brute(texts, dedup.length)
    assert sum(e[1] > 0 for e in brute(texts, 400)) >= 13
