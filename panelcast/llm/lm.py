"""Language-model scoring by deleted interpolation of bigrams.

The probability of a word after its predecessor mixes three maximum-likelihood
estimates, of the pair, of the word and of any word alike. The weights depend on
how often the predecessor was seen, in buckets of powers of two. They are
learned by expectation-maximisation on held-out counts: every training token is
deleted from the counts before its own estimates are taken, over all training
tokens. EM reads a histogram of these estimates, whose ratios are rounded to a
quarter of a power of two, so that what reaches the driver has a bounded size.

Counting runs as an exchange of n-gram hashes: documents are dealt to chunks;
a chunk asks for each of its distinct n-grams once, in one sorted block for each
range of hashes; the task of a range adds up what all chunks have and answers
with totals in the order asked. Blocks are short where there are many ranges, so
a range, like a chunk, keeps its size when the corpus grows.

Word counts use 64-bit hashes, pair counts the upper 48 bits.

Defined cases: null and empty texts are one end token; a null doc_id trains;
repeated rows count as often as they occur; without training tokens every
token has the probability of any word alike; an empty table gives an empty
table; extra columns aren't returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import hashing
from panelcast.llm.common import stage, table

END = np.uint64(0x5EED5EED5EED5EED)
START = np.uint64(0x0123456789ABCDEF)
WORD, PAIR, DOCUMENT, TOTALS = 1, 2, 3, 4
#: Bytes of a hash that are sent, by kind.
WIDTH = {WORD: 8, PAIR: 6}
BUCKETS = 40
QUARTERS = 4


@dataclass(frozen=True)
class Lm:
    """Production parameters: documents per chunk and per range of hashes, rounds of EM."""

    chunk_docs: int = 1_500
    range_docs: int = 2_000
    rounds: int = 60
    modulus: int = 7
    held_out: int = 2


def held_out(doc_id, lm: Lm) -> bool:
    return not pd.isna(doc_id) and zlib.crc32(str(int(doc_id)).encode()) % lm.modulus == lm.held_out


def tokens(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and its end, and the number of tokens of each text."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, type=pa.large_string(), from_pandas=True)], names=["text"])
    found, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for part in hashing.slices(batch, 0):
        words, bounds = hashing.words(*hashing.texts(part.column(0)))
        found.append(np.insert(words, bounds[1:], END))
        sizes.append(np.diff(bounds) + 1)
    return np.concatenate(found), np.concatenate(sizes)


def grams(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, pairs, sizes): a pair's hash has its lower 16 bits cleared."""
    words, sizes = tokens(texts)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = START
    pairs = hashing.mix(before * np.uint64(3) + hashing.mix(words ^ np.uint64(0x9E3779B97F4A7C15)))
    return words, pairs & ~np.uint64(0xFFFF), sizes


def counted(docs: DataFrame, lm: Lm = Lm()) -> DataFrame:
    """Rows (kind, doc_id, words, pairs): per document the training counts of its tokens, in order.

    Rows of kind TOTALS hold [training tokens, distinct training words] of a range in `words`.
    """
    rows = docs.count()
    chunks, ranges = max(1, -(-rows // lm.chunk_docs)), max(1, -(-rows // lm.range_docs))
    dealt = docs.select(
        F.expr("CAST(CAST(doc_id AS bigint) AS string)").alias("doc_id"), "text", F.expr(f"pmod(xxhash64(doc_id, text), {chunks})").alias("chunk")
    )
    edges = hashing.edges(ranges)

    def ask(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        words, pairs, sizes = grams(part["text"])
        train = np.repeat([not held_out(d, lm) for d in part["doc_id"]], sizes)
        out = []
        for kind, found in ((WORD, words), (PAIR, pairs)):
            distinct, place = np.unique(found, return_inverse=True)
            n = np.bincount(place, weights=train, minlength=len(distinct)).astype(np.uint64)
            cuts = [0, *np.searchsorted(distinct, edges), len(distinct)]
            for r, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if hi > lo:
                    out.append((r, key[0], kind, hashing.planes(distinct[lo:hi], WIDTH[kind]), hashing.planes(n[lo:hi], 8)))
        return pd.DataFrame(out, columns=["range", "chunk", "kind", "grams", "n"])

    def answer(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out, totals = [], (0, 0)
        for kind, rows in part.groupby("kind"):
            asked = [hashing.unplaned(x, WIDTH[kind]) for x in rows["grams"]]
            distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([hashing.unplaned(x, 8) for x in rows["n"]]), minlength=len(distinct))
            n = n.astype(np.uint64)
            if kind == WORD:
                totals = (int(n.sum()), int((n > 0).sum()))
            ends = np.cumsum([len(x) for x in asked])
            for chunk, got in zip(rows["chunk"], np.split(n[place], ends[:-1]), strict=True):
                out.append((chunk, key[0], kind, hashing.planes(got, 8)))
        out.append((-1, key[0], TOTALS, np.array(totals, dtype=np.int64).tobytes()))
        return pd.DataFrame(out, columns=["chunk", "range", "kind", "n"])

    def count(key: tuple, part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            rows = [(TOTALS, None, np.frombuffer(x, dtype=np.int64), np.empty(0, np.int64)) for x in answers["n"]]
            return pd.DataFrame(rows, columns=["kind", "doc_id", "words", "pairs"])
        words, pairs, sizes = grams(part["text"])
        totals = {}
        for kind, found in ((WORD, words), (PAIR, pairs)):
            distinct = np.unique(found)
            n = np.concatenate([hashing.unplaned(x, 8) for x in answers[answers["kind"] == kind].sort_values("range")["n"]])
            totals[kind] = np.split(n[np.searchsorted(distinct, found)].astype(np.int64), np.cumsum(sizes)[:-1])
        return pd.DataFrame({"kind": DOCUMENT, "doc_id": pd.array([None if pd.isna(d) else int(d) for d in part["doc_id"]], dtype="Int64"), "words": totals[WORD], "pairs": totals[PAIR]})

    spread = dealt.repartition("chunk")
    asked = spread.groupBy("chunk").applyInPandas(ask, "range long, chunk long, kind int, grams binary, n binary")
    answers = asked.groupBy("range").applyInPandas(answer, "chunk long, range long, kind int, n binary")
    return (
        spread.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(count, "kind int, doc_id long, words array<long>, pairs array<long>")
    )


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, pair and predecessor counts of all tokens; first token of each document) of rows (doc_id, words, pairs)."""
    words, pairs = batch.column(1), batch.column(2)
    starts = np.asarray(words.offsets)[:-1].astype(np.int64) - words.offsets[0].as_py()
    c1, c2 = (np.asarray(x.flatten()).astype(np.float64) for x in (words, pairs))
    before = np.empty_like(c1)
    before[1:] = c1[:-1]
    ends = np.append(starts[1:], len(c1)) - 1
    before[starts] = c1[ends]  # a text's start was seen as often as its end
    return c1, c2, before, starts


def _small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole part of its count's logarithm to base 2."""
    return np.where(context > 0, np.minimum(np.frexp(context)[1], BUCKETS - 1), 0).astype(np.int64)


def _rounded(ratio: np.ndarray) -> np.ndarray:
    """Logarithm to base 2 in quarters, moved to be positive; 0 for a ratio of 0."""
    with np.errstate(divide="ignore"):
        logs = np.log2(ratio)
    return np.where(ratio > 0, np.clip(np.round(np.where(ratio > 0, logs, 0) * QUARTERS), -400, 600) + 401, 0).astype(np.int64)


def held_out_counts(documents: DataFrame, total: int, distinct: int, lm: Lm = Lm()) -> pd.DataFrame:
    """Histogram (bucket, pair, word, n) of training tokens' estimates after the token itself is deleted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            batch = batch.filter(pa.array([not held_out(d, lm) for d in batch.column(0).to_pylist()], pa.bool_()))
            if not batch.num_rows:
                continue
            c1, c2, before, _ = _counts(batch)
            context = before - 1
            pair = np.divide(c2 - 1, context, out=np.zeros_like(c1), where=context > 0) * (distinct + 1)
            word = (c1 - 1) / max(1, total - 1) * (distinct + 1)
            key = (bucket(context) * 1024 + _rounded(pair)) * 1024 + _rounded(word)
            keys, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["key", "n"])

    rows = documents.select("doc_id", "words", "pairs").mapInArrow(run, "key long, n long")
    out = rows.groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    key = out["key"].to_numpy(dtype=np.int64)
    value = lambda x: np.where(x > 0, 2.0 ** ((x - 401) / QUARTERS), 0.0)
    return pd.DataFrame(
        {"bucket": key >> 20, "pair": value((key >> 10) & 1023), "word": value(key & 1023), "n": out["n"].to_numpy(dtype=float)}
    )


def learned(histogram: pd.DataFrame, rounds: int) -> np.ndarray:
    """Weights (pair, word, any) by bucket, by EM; buckets without held-out tokens take the weights of all."""

    def em(rows: pd.DataFrame) -> np.ndarray:
        estimates = np.stack([rows["pair"], rows["word"], np.ones(len(rows))], axis=1)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = estimates * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * rows["n"].to_numpy()[:, None]).sum(axis=0) / rows["n"].sum()
            w = np.maximum(w, 1e-9) / np.maximum(w, 1e-9).sum()  # an unseen word keeps a probability
        return w

    rows = histogram.sort_values(["bucket", "pair", "word"])
    every = em(rows) if len(rows) else np.full(3, 1 / 3)
    out = np.tile(every, (BUCKETS, 1))
    for b, part in rows.groupby("bucket"):
        out[b] = em(part)
    out[0] = [0.0, out[0][1] + out[0][0], out[0][2]]  # no estimate of a pair after an unseen word
    return out


def score_documents(docs: DataFrame, lm: Lm = Lm()) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per row of docs."""
    rows = stage(counted(docs, lm), "lm-counts")
    parts = rows.filter(F.col("kind") == TOTALS).agg(F.sum(F.expr("words[0]")), F.sum(F.expr("words[1]"))).first()
    total, distinct = int(parts[0] or 0), int(parts[1] or 0)
    documents = rows.filter(F.col("kind") == DOCUMENT)
    weight = learned(held_out_counts(documents, total, distinct, lm), lm.rounds)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            c1, c2, before, starts = _counts(batch)
            w = weight[bucket(before)]
            pair = np.divide(c2, before, out=np.zeros_like(c1), where=before > 0)
            p = w[:, 0] * pair + w[:, 1] * c1 / max(1, total) + w[:, 2] / (distinct + 1)
            add = lambda x: np.add.reduceat(x, starts)
            ids = batch.column(0)
            columns = [
                ids,
                pa.array([held_out(d, lm) for d in ids.to_pylist()], pa.bool_()),
                pa.array(np.diff(np.append(starts, len(c1)))),
                pa.array(add((c1 > 0).astype(np.int64))),
                pa.array(np.full(len(starts), total, dtype=np.int64)),
                pa.array(add(np.log10((c1 + 1) / (total + distinct + 1)))),
                pa.array(add(np.log10(p))),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return documents.select("doc_id", "words", "pairs").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op7_lm_scores": (op7, None)}
