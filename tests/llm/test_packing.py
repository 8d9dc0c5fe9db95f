"""Packing: ids against the whole-text tokenizer, and the exact cover of all ids."""

import random
import zlib
from itertools import product

import numpy as np
from tokenizers import Tokenizer

from panelcast.llm import packing
from panelcast.llm.packing import Pack

SCHEMA = "doc_id long, text string, extra int"


def documents(spark):
    rng = random.Random(3)
    odd = ["<|endoftext|>", "it's", "ÉCOLE", "éa", "日本語", "\t", "a\x1cb", " ", "naïve123", "x" * 300, "ΣΑΣ", "\xa0", "\r\n", "we'll", "Straße", "ÀÉÎ's", "x\u0301", "½µª", "'the", ",'s", "a\x7fb", "<|", "×÷"]
    texts = [None, "", " \n", "word " * 9000] + [
        " ".join(rng.choices(odd + ["the", "of", "house,", "\n"], k=rng.randint(1, 700))) for _ in range(150)
    ]
    texts.append(texts[5])
    return texts, spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], SCHEMA)


def test_pieces_cover_all_ids_and_sequences_have_no_gaps(spark):
    texts, docs = documents(spark)
    tokenizer = Tokenizer.from_file(Pack().tokenizer)
    out = packing.pack_documents(docs).toPandas()
    assert len(docs.columns) == 3 and list(out.columns)[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes()
        rows = out[out.doc_id == i].sort_values("start")
        at = 0
        for r in rows.itertuples():
            assert r.start == at and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert 4 * at == len(ids)
    for _, rows in out.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert list(rows.offset) == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048
    assert out.length.sum() > 0.97 * 2048 * (out.sequence_id.nunique() - 1)


def test_best_fill_is_optimal():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        capacity = rng.randint(0, 30)
        sums = [sum(k * n for k, n in zip(counts, take, strict=True)) for take in product(*(range(v + 1) for v in counts.values()))]
        used = packing.best_fill(counts, capacity)
        assert all(0 < n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= capacity)


def test_ids_small_groups_and_empty_table(spark):
    _, docs = documents(spark)
    out = packing.pack_documents(docs, Pack(group=20, cached_words=10), with_ids=True).toPandas()
    assert all(len(r.ids) == r.length for r in out.itertuples())
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack_documents(docs.limit(0)).count() == 0
