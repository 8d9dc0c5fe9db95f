"""Spelling variant grouping by dense prefix-suffix tiling.

Words are counted over all texts, combined before the shuffle. Two words are one
edit apart if the code points they share at the front and at the back reach the
longer length minus one. Let M be that longer length and p the shared front:
some p from 0 to M - 1. A cell (M, low, high) holds the words of length M and
M - 1 under the key made of their first `low` and last M - `high` code points;
the pairs with low <= p < high meet under one key of one cell, and nowhere else.
Cells begin as quarters of 0..M. A key with more than `tile` words is cut at the
middle of its cell, again and again; a cell of width one leaves one code point
open, so that its words are bounded by the alphabet. Each key's words are laid
out as matrices of code points, padded at the back for fronts and at the front
for backs, and compared in blocks; a word gives back one row: how many words are
near, and the best of them.

A word's form is the most frequent near word, if that is clearly more frequent;
forms are followed to the last one by doubling. Counts rise by the ratio at each
step, so there are no loops.

Defined cases: null texts hold no words; rows count as often as they occur, so
repeated rows add up; a null doc_id reads as an empty text in the hash; equal
counts go to the word that is smaller in code-point order; words of any length
are compared, a text of one long word too; empty tables give empty tables; extra
columns aren't used or returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of a run.
LETTERS = r"[A-Za-zÀ-ÿ]"


@dataclass(frozen=True)
class Spelling:
    """Production parameters. `tile` words of a key are compared at once; it exceeds the words one open place allows."""

    min_length: int = 7
    min_count: int = 2
    ratio: int = 10
    damage: int = 31
    tile: int = 1_024
    cells: int = 4
    bytes_at_once: int = 32 << 20
    rows_at_once: int = 20_000


#: Keys of up to so many words are compared together.
SMALL_KEY = 48


def words(docs: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """Rows (word, n): runs of letters in small letters, some of them without one letter, and their occurrences.

    Runs shorter than the least length can't become words and are left out by the pattern itself.
    """
    pattern = LETTERS.replace("\\", "\\\\") + f"{{{rule.min_length},}}"
    runs = docs.select(
        F.expr("concat(coalesce(CAST(doc_id AS string), ''), ':')").alias("id"),
        F.expr(f"explode(regexp_extract_all(text, '{pattern}', 0))").alias("run"),
    )
    runs = runs.select("id", F.expr(f"translate(run, '{_UPPER}', '{_LOWER}')").alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", "run").cast("binary")).alias("h"))
    at = "CAST(h % char_length(run) AS int)"
    cut = f"concat(substring(run, 1, {at}), substring(run, {at} + 2))"
    found = runs.select(F.expr(f"CASE WHEN h % {rule.damage} = 0 THEN {cut} ELSE run END").alias("word"))
    counts = found.filter(f"char_length(word) >= {rule.min_length}").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= rule.min_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (m, low, high) with the key of their cell; keys that meet by chance only share a group."""
    key = "xxhash64(substring(word, 1, low), right(word, m - high))"
    return rows.withColumn("key", F.expr(key))


def cells(counted: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """Rows (m, low, high, key, word, n): each word under its keys. No key has more than `tile` words
    unless only one place is open."""
    by = ["m", "low", "high", "key"]
    edges = f"transform(sequence(0, {rule.cells}), i -> CAST(i * m DIV {rule.cells} AS int))"
    rows = counted.withColumn("length", F.char_length("word"))
    rows = rows.select("word", "n", F.expr("explode(array(length, length + 1)) AS m"))
    rows = rows.withColumn("edges", F.expr(edges))
    rows = rows.select(
        "word", "n", "m",
        F.expr(f"inline(transform(sequence(0, {rule.cells - 1}), i -> named_struct('low', edges[i], 'high', edges[i + 1])))"),
    ).filter("low < high")
    rows, done = _keyed(rows), None
    while True:
        sizes = rows.filter("high - low > 1").groupBy(*by).agg(F.count(F.lit(1)).alias("size"))
        large = stage(sizes.filter(F.col("size") > rule.tile).select(*by), "spelling-large")
        if large.isEmpty():
            return rows.select(*by, "word", "n") if done is None else done.unionByName(rows).select(*by, "word", "n")
        ready = rows.join(large, by, "left_anti")
        done = ready if done is None else done.unionByName(ready)
        split = rows.join(large, by, "left_semi").withColumn("half", F.expr("CAST((low + high) DIV 2 AS int)"))
        split = split.select(
            "word", "n", "m",
            F.expr("inline(array(named_struct('low', low, 'high', half), named_struct('low', half, 'high', high)))"),
        )
        rows = stage(_keyed(split), "spelling-cells")


def padded(some: list[str], width: int, back: bool, filler: int) -> np.ndarray:
    """Code points, one row a word, filled up at the end, or at the start if `back`."""
    out = np.full((len(some), width), filler, dtype=np.int32)
    for i, word in enumerate(some):
        points = np.frombuffer(word.encode("utf-32-le"), dtype="<i4")
        out[i, width - len(points) :] = 0 if back else filler
        out[i, slice(width - len(points), width) if back else slice(len(points))] = points
    return out


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns from the first on are equal, for each row of a and each of b."""
    differs = np.ones((len(a), len(b), a.shape[1] + 1), dtype=bool)
    np.not_equal(a[:, None, :], b[None, :, :], out=differs[:, :, :-1])
    return differs.argmax(axis=2)


def near_in_cell(m: int, low: int, high: int, some: list[str], counts: np.ndarray, limit: int = 32 << 20):
    """For each word how many words of its key are one edit apart with low <= shared front < high, and the best one's place.

    The best has the largest count, then is the smallest; -1 if there is none. Words are in code-point order.
    """
    n = len(some)
    lengths = np.array([len(w) for w in some])
    front, front_other = padded(some, m, False, -1), padded(some, m, False, -2)
    back = padded(some, m, True, -1)[:, ::-1]
    back, back_other = np.where(back > 0, back, -1), np.where(back > 0, back, -2)
    near, best = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    # The first word by count, then by order, has the smallest rank.
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((np.arange(n), -counts))] = np.arange(n)
    by_rank = np.argsort(rank)
    step = max(1, int((limit / (m + 1)) ** 0.5))
    for i in range(0, n, step):
        first = np.full(min(step, n - i), n, dtype=np.int64)
        for j in range(0, n, step):
            a, b = slice(i, min(i + step, n)), slice(j, min(j + step, n))
            p, s = shared(front[a], front_other[b]), shared(back[a], back_other[b])
            longest = np.maximum(lengths[a][:, None], lengths[b][None, :])
            hit = (longest == m) & (p >= low) & (p < high) & (p + s >= m - 1)
            hit &= np.arange(a.start, a.stop)[:, None] != np.arange(b.start, b.stop)[None, :]
            near[a] += hit.sum(axis=1)
            first = np.minimum(first, np.where(hit, rank[b][None, :], n).min(axis=1))
        best[a] = np.where(first < n, by_rank[np.minimum(first, n - 1)], -1)
    return near, best


def near_in_batch(m: int, keys: np.ndarray, low: np.ndarray, high: np.ndarray, words: np.ndarray, counts: np.ndarray, limit: int = 32 << 20):
    """near_in_cell for many keys of one longer length m at once; rows are in order of key, then word.

    Small keys stand below each other in one matrix that is compared with itself moved by one row, two rows
    and so on, within keys; each larger key is compared in blocks.
    """
    n = len(words)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    size, place = np.repeat(sizes, sizes), np.arange(n) - np.repeat(starts, sizes)
    points = words.view(np.uint32).reshape(n, m)
    lengths = (points > 0).sum(axis=1)
    turned = lengths[:, None] - 1 - np.arange(m)
    back = np.where(turned >= 0, np.take_along_axis(points, np.maximum(turned, 0), axis=1), 0)
    order = np.lexsort((np.unique(words, return_inverse=True)[1], -counts))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    near, first = np.zeros(n, dtype=np.int64), np.full(n, n, dtype=np.int64)

    def front(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differs = np.ones((len(a), m + 1), dtype=bool)
        np.not_equal(a, b, out=differs[:, :-1])
        return differs.argmax(axis=1)

    step = max(1, limit // (16 * (m + 1)))
    small = np.flatnonzero(size <= SMALL_KEY)
    for gap in range(1, int(size[small].max(initial=0))):
        small = small[place[small] + gap < size[small]]
        for at in range(0, len(small), step):
            i = small[at : at + step]
            j = i + gap
            p = front(points[i], points[j])
            hit = (np.maximum(lengths[i], lengths[j]) == m) & (p >= low[i]) & (p < high[i]) & (p < m)
            i, j, p = i[hit], j[hit], p[hit]
            hit = p + front(back[i], back[j]) >= m - 1
            i, j = i[hit], j[hit]
            near[i] += 1
            near[j] += 1
            first[i] = np.minimum(first[i], rank[j])
            first[j] = np.minimum(first[j], rank[i])
    best = np.where(first < n, order[np.minimum(first, n - 1)], -1)
    for start, count in zip(starts[sizes > SMALL_KEY], sizes[sizes > SMALL_KEY]):
        part = slice(start, start + count)
        near[part], inside = near_in_cell(m, int(low[start]), int(high[start]), words[part].tolist(), counts[part], limit)
        best[part] = np.where(inside >= 0, inside + start, -1)
    return near, best


def _pieces(m: int, keys: np.ndarray, limit: int) -> list[slice]:
    """Whole keys together as far as their matrices stay within the limit."""
    ends = np.r_[np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
    rows, out, start = max(1, limit // (16 * m)), [], 0
    while start < len(keys):
        fits = ends[(ends > start) & (ends <= start + rows)]
        stop = int(fits[-1]) if len(fits) else int(ends[ends > start][0])
        out.append(slice(start, stop))
        start = stop
    return out


def near_words(counted: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """Rows (word, n_near, near_n, near): the near words of each word that has any, and the most frequent of them.

    Keys are dealt to groups of about `rows_at_once` rows and `bytes_at_once` code points; all rows of a key are in one.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for m, part in rows.groupby("m"):
            words = np.array(part["word"].tolist(), dtype=f"U{m}")
            cell = np.stack([part[c].to_numpy(np.int64) for c in ("low", "high", "key")])
            order = np.lexsort((np.unique(words, return_inverse=True)[1], *cell[::-1]))
            words, counts, (low, high, key) = words[order], part["n"].to_numpy(np.int64)[order], cell[:, order]
            keys = np.cumsum(np.r_[0, (cell[:, order][:, 1:] != cell[:, order][:, :-1]).any(axis=0)])
            for piece in _pieces(int(m), keys, rule.bytes_at_once):
                some, n = words[piece], counts[piece]
                near, best = near_in_batch(int(m), keys[piece], low[piece], high[piece], some, n, rule.bytes_at_once)
                at = np.flatnonzero(near)
                out.append((some[at].tolist(), near[at], n[best[at]], some[best[at]].tolist()))
        merged = [[x for o in out for x in o[k]] for k in range(4)]
        word, best = (pd.Series(merged[k], dtype=object) for k in (0, 3))
        return pd.DataFrame({"word": word, "n_near": merged[1], "near_n": merged[2], "near": best})

    rows, points = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("word")), F.lit(0))).first()
    groups = 1 + 2 * rule.cells * max(rows // rule.rows_at_once, points // rule.bytes_at_once)
    group = F.pmod(F.xxhash64("m", "low", "high", "key"), F.lit(groups)).alias("group")
    rows = cells(counted, rule).select("m", "low", "high", "key", "word", "n", group)
    found = rows.groupBy("group").applyInPandas(compare, "word string, n_near long, near_n long, near string")
    # Code-point order is the order of UTF-8 bytes.
    best = F.min(F.struct((-F.col("near_n")).alias("o"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.o")).alias("near_n"), F.col("best.near").alias("near")
    )


def roots(forms: DataFrame, rounds: int = 8) -> DataFrame:
    """Rows (word, root) from rows (word, form): the end of each chain of forms, by doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        at = stage(at, "spelling-roots")
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root")
        if moved.isEmpty():
            return at
        at = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    raise RuntimeError("chains of forms are longer than counts of 64 bits allow")


def variants(docs: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per word."""
    counted = stage(words(docs, rule), "spelling-words")
    near = stage(near_words(counted, rule), "spelling-near")
    chosen = near.join(counted, "word").filter(F.col("near_n") >= rule.ratio * F.col("n"))
    forms = stage(chosen.select("word", F.col("near").alias("form"), F.col("near_n").alias("form_n")), "spelling-forms")
    out = counted.join(near.select("word", "n_near"), "word", "left").join(forms, "word", "left")
    out = out.join(roots(forms), "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: crc32 is beyond SQL; the tests compare with brute force.
QUERIES = {"op13_spelling_variants": (op13, None)}
