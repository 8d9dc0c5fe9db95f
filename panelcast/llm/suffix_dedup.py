"""Suffix-array dedup: removal of byte strings that occur more than once.

Every string of `length` bytes has an anchor, the least hash of the shorter
strings within it; equal strings have equal anchors. So a text falls into runs of
positions with one anchor, and a string repeats only in runs that share an anchor
or within one run. Runs with equal bytes count as repeated at once. Where an
anchor has runs with different bytes, one of each is taken to a suffix array, and
so is a run without a like that holds its anchor at several places and may repeat
itself, as a passage with a period does.

The suffix array is built in two stages: suffixes smaller than their successors
are sorted directly; all others follow from a scan over the buckets of first
bytes, in which each suffix puts its predecessor next in that one's bucket. Then
common prefixes of neighbours are computed, up to `length`.

A block of runs that is sorted together has a bounded size. An anchor with more
runs is spread over several blocks, and the strings found once in a block are
compared over its blocks by digest.

Defined cases: null text is empty; matches never cross documents; texts shorter
than `length` lose nothing; repeated rows are repeated text; an empty table gives
an empty table; extra columns aren't returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import hashing
from panelcast.llm.common import stage, table

#: Ends a text within a block; no byte of UTF-8 has this value.
STOP = 0xFF


@dataclass(frozen=True)
class Dedup:
    """Production parameters: bytes of a repeated string, of an anchor, of a block; runs of one anchor in a block.

    `tried_places` affects the cost only: up to so many places of an anchor in a run are compared at once.
    """

    length: int = 400
    anchor: int = 16
    longest_run: int = 512
    block_bytes: int = 250_000
    block_runs: int = 12_000
    task_bytes: int = 4_000_000
    tried_places: int = 8


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def anchor_hashes(data: np.ndarray, dedup: Dedup) -> tuple[np.ndarray, int]:
    """Hash of the short string that starts at each byte, and how many bytes it has."""
    hashes, width = hashing.mix(data.astype(np.uint64) + np.uint64(1)), 1
    while width < dedup.anchor:
        hashes = hashing.mix(hashes[:-width] * np.uint64(5) + hashes[width:])
        width *= 2
    return hashes, width


def repeats_within(data: np.ndarray, places: np.ndarray, n: int, dedup: Dedup) -> bool:
    """Whether the bytes of a run of n positions may hold a string twice; `places` has its anchor's.

    Two equal strings are as far apart as two places of their anchor. A few
    distances are tried; a run with many goes to the suffix array as it is.
    """
    if len(places) < 2 or np.diff(places).min() >= n:
        return False
    if len(places) > dedup.tried_places:
        return True
    apart = np.unique(places[:, None] - places[None, :])
    for d in apart[(apart > 0) & (apart < n)].tolist():
        differ = np.flatnonzero(data[:-d] != data[d:])
        if np.diff(np.concatenate([[-1], differ, [len(data) - d]])).max() > dedup.length:
            return True
    return False


def runs_of(data: np.ndarray, offsets: np.ndarray, dedup: Dedup) -> tuple[np.ndarray, ...]:
    """(text, start in it, positions, anchor, may repeat itself) of each run of positions with one anchor."""
    if len(data) < dedup.length:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    hashes, width = anchor_hashes(data, dedup)
    least = window_least(hashes, dedup.length - width + 1)
    position = np.arange(len(least))
    text = np.searchsorted(offsets, position, side="right") - 1
    ok = np.flatnonzero(position + dedup.length <= offsets[text + 1])
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (ok[1:] != ok[:-1] + 1) | (least[ok[1:]] != least[ok[:-1]])
    begin = np.flatnonzero(new)
    within = np.arange(len(ok)) - begin[np.cumsum(new) - 1]
    begin = np.flatnonzero(within % dedup.longest_run == 0)
    first, n = ok[begin], np.diff(np.append(begin, len(ok)))
    inner = np.zeros(len(first), dtype=bool)
    for i, (a, m, anchor) in enumerate(zip(first.tolist(), n.tolist(), least[first], strict=True)):
        places = np.flatnonzero(hashes[a : a + m + dedup.length - width] == anchor)
        inner[i] = len(places) > 1 and repeats_within(data[a : a + m + dedup.length - 1], places, m, dedup)
    return text[first], first - offsets[text[first]], n, least[first], inner


def runs(docs: DataFrame, dedup: Dedup) -> DataFrame:
    """Rows (key, start, n, anchor, same, inner): runs of n positions; `same` is a digest of their bytes, `inner`
    tells that they may repeat themselves."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch, 1):
                data, offsets = hashing.texts(part.column(1))
                text, start, n, anchor, inner = runs_of(data, offsets, dedup)
                whole, first = data.tobytes(), offsets[text] + start
                digests = [
                    int.from_bytes(hashlib.blake2b(whole[a:b], digest_size=8).digest(), "little", signed=True)
                    for a, b in zip(first.tolist(), (first + n + dedup.length - 1).tolist(), strict=True)
                ]
                keys = part.column(0).take(pa.array(text)) if len(text) else pa.array([], pa.int64())
                columns = [keys, pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(anchor.astype(np.uint64).view(np.int64)), pa.array(digests, pa.int64()), pa.array(inner.astype(bool))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n", "anchor", "same", "inner"])

    return docs.select("key", "text").mapInArrow(find, "key long, start long, n int, anchor long, same long, inner boolean")


def words_at(data: bytes, more: int = 0) -> np.ndarray:
    """The eight bytes from each position on as a number; zeros follow the data."""
    text = np.frombuffer(data + bytes(8 + more), dtype=np.uint8)
    word = np.zeros(len(text) - 7, dtype=np.uint64)
    for i in range(8):
        word <<= np.uint64(8)
        word |= text[i : i + len(word)]
    return word


def sorted_directly(data: bytes, positions: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the `depth` bytes that start there.

    Eight bytes decide first; only positions that are equal in these are compared
    further, so that few strings are held at a time.
    """
    head = words_at(data)[positions]
    order = np.argsort(head, kind="stable")
    positions, head = positions[order], head[order]
    begin = np.flatnonzero(np.append(True, head[1:] != head[:-1])) if len(head) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(head)))
    for b, n in zip(begin[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        tied = sorted(positions[b : b + n].tolist(), key=lambda i: data[i : i + depth])
        positions[b : b + n] = tied
    return positions


def sorted_suffixes(data: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Positions marked in `wanted` in the order of their suffixes' first `depth` bytes; data ends with STOP."""
    text = np.frombuffer(data, dtype=np.uint8)
    step = np.zeros(len(text), dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    change = np.flatnonzero(step)
    smaller = step[change[np.searchsorted(change, np.arange(len(text)))]] > 0  # than its successor
    # A suffix that is larger than its successor needs that one, and so on up to a smaller one.
    after = wanted.copy()
    chain = np.flatnonzero(wanted & ~smaller)
    while len(chain):
        chain = chain[chain + 1 < len(text)] + 1
        chain = chain[~after[chain]]
        after[chain] = True
        chain = chain[~smaller[chain]]
    induced = after & ~smaller
    direct = sorted_directly(data, np.flatnonzero(after & smaller), depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    if induced[-1]:  # nothing follows the last byte, so that it comes first among its like
        waiting[text[-1]].append(np.array([len(text) - 1]))
    for byte in range(256):
        new = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, np.int64)
        bucket = [new]
        while len(new):  # predecessors with the same first byte
            before = new[new > 0] - 1
            new = before[induced[before] & (text[before] == byte)]
            bucket.append(new)
        bucket.append(direct[cuts[byte] : cuts[byte + 1]])
        here = np.concatenate(bucket)
        order.append(here)
        before = here[here > 0] - 1
        before = before[induced[before] & (text[before] > byte)]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            first, before = first[by], before[by]
            edges = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, edges):
                waiting[text[part[0]]].append(part)
    found = np.concatenate(order)
    return found[wanted[found]]


def common_prefixes(data: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each position with the one before it in `order`, up to `most` bytes; 0 for the first."""
    word = words_at(data, most)
    out = np.zeros(len(order), dtype=np.int64)
    alive = np.arange(1, len(order))
    for at in range(0, most, 8):
        differ = word[order[alive] + at] ^ word[order[alive - 1] + at]
        stopped = differ != 0
        high = np.frexp(differ[stopped].astype(np.float64))[1]
        # A number just below a power of two may round up to it; the byte counted then is the one above.
        high = np.where((differ[stopped] >> (np.minimum(high, 64) - 1).astype(np.uint64)) == 0, high - 1, high)
        out[alive[stopped]] = np.minimum(most, at + (64 - np.minimum(high, 64)) // 8)
        alive = alive[~stopped]
    out[alive] = most
    return out


def repeated(texts: list[bytes], counts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the strings of `length` bytes in texts that each start at one of the first `counts` bytes:
    (text, position, class) in suffix order; equal strings have the same class."""
    data = b"".join(t + bytes([STOP]) for t in texts)
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    wanted = np.zeros(len(data), dtype=bool)
    for b, n in zip(begin[:-1].tolist(), counts, strict=True):
        wanted[b : b + n] = True
    order = sorted_suffixes(data, wanted, length)
    classes = np.cumsum(common_prefixes(data, order, length) < length) if len(order) else order
    text = np.searchsorted(begin, order, side="right") - 1
    return text, order - begin[text], classes


def _spans(position: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by strings of `length` bytes at the given positions."""
    position = np.sort(position)
    cut = np.flatnonzero(np.diff(position) > length) + 1
    return [(int(p[0]), int(p[-1]) + length) for p in np.split(position, cut)] if len(position) else []


def sort_blocks(texts: DataFrame, dedup: Dedup) -> DataFrame:
    """Spans (s, e) that repeat, and with `across` the strings of anchors with several blocks, and their digests.

    texts: (task, anchor, block, blocks, key, start, n, single, text). `single`
    runs occur once, so that only the suffix array can tell what of them repeats.
    """
    columns = ["key", "s", "e", "across", "hi", "lo", "single"]

    def block(rows: pd.DataFrame) -> list[tuple]:
        text, position, classes = repeated(rows["text"].tolist(), rows["n"].tolist(), dedup.length)
        size = np.bincount(classes)[classes] if len(classes) else classes
        spread = (rows["blocks"].to_numpy() > 1)[text]
        single = rows["single"].to_numpy()
        out = []
        hit = np.flatnonzero((size > 1) & single[text])
        hit = hit[np.argsort(text[hit], kind="stable")]
        keys, starts = rows["key"].tolist(), rows["start"].tolist()
        for part in np.split(hit, np.flatnonzero(np.diff(text[hit])) + 1) if len(hit) else []:
            t = text[part[0]]
            out += [(keys[t], starts[t] + a, starts[t] + b, False, 0, 0, True) for a, b in _spans(position[part], dedup.length)]
        if spread.any():
            first = np.ones(len(classes), dtype=bool)
            first[1:] = classes[1:] != classes[:-1]
            raw = rows["text"].tolist()
            for i in np.flatnonzero(first & spread).tolist():
                t, p = text[i], int(position[i])
                digest = hashlib.blake2b(raw[t][p : p + dedup.length], digest_size=16).digest()
                hi, lo = (int.from_bytes(digest[a : a + 8], "little", signed=True) for a in (0, 8))
                out.append((keys[t], starts[t] + p, starts[t] + p + dedup.length, True, hi, lo, bool(size[i] == 1 and single[t])))
        return out

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["anchor", "block"], kind="stable").reset_index(drop=True)
        unit = ((part["anchor"] != part["anchor"].shift()) | (part["block"] != part["block"].shift())).cumsum()
        size = part["text"].map(len).groupby(unit).sum()
        # Neighbouring units share a block while it has room.
        at = (size.cumsum() - size) // dedup.block_bytes
        out = []
        for _, rows in part.groupby(unit.map(at)):
            out += block(rows.reset_index(drop=True))
        return pd.DataFrame(out, columns=columns)

    return texts.groupBy("task").applyInPandas(
        sort, "key long, s long, e long, across boolean, hi long, lo long, single boolean"
    )


def duplicate_spans(docs: DataFrame, dedup: Dedup = Dedup()) -> DataFrame:
    """Rows (key, s, e): byte spans covered by strings that repeat; they may overlap. docs has key and text."""
    found = stage(runs(docs, dedup), "runs")
    kinds = found.groupBy("anchor", "same").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "start", "n")).alias("one"), F.expr("bool_or(inner)").alias("inner")
    )
    kinds = stage(kinds, "run-kinds")
    # A run with equal ones is whole a repeat; of the others, those that share an anchor or may repeat themselves are asked.
    several = kinds.groupBy("anchor").agg(
        F.sum("copies").alias("all"), F.count("*").alias("kinds"), F.expr("bool_or(inner)").alias("inner")
    )
    several = several.filter("kinds > 1 OR (all = 1 AND inner)").select("anchor", "kinds")
    several = stage(several, "run-anchors")
    whole = found.join(kinds.filter("copies > 1").select("anchor", "same"), ["anchor", "same"]).select(
        "key", F.col("start").alias("s"), F.expr(f"start + n + {dedup.length - 1}").alias("e")
    )
    # One run of each kind asked for: its bytes are cut out of its document.
    ask = (
        kinds.join(several, "anchor")
        .withColumn("blocks", F.expr(f"CAST(ceil(kinds / {dedup.block_runs}) AS bigint)"))
        .select("anchor", F.expr("pmod(same, blocks)").alias("block"), "blocks", F.expr("copies = 1").alias("single"), "one.*")
    )
    ask = stage(ask, "run-asked")
    bytes_ = ask.agg(F.sum(F.expr(f"n + {dedup.length}"))).first()[0] or 0
    tasks = max(1, -(-bytes_ // dedup.task_bytes))
    by_text = ask.groupBy("key").agg(F.collect_list(F.struct("anchor", "block", "blocks", "single", "start", "n")).alias("r"))
    texts = (
        docs.select("key", "text")
        .join(by_text.hint("merge"), "key")
        .dropDuplicates(["key"])
        .select("key", F.expr("CAST(text AS binary)").alias("b"), F.explode("r").alias("r"))
        .select(
            "key", "r.*", F.expr(f"substring(b, CAST(r.start AS int) + 1, r.n + {dedup.length - 1})").alias("text")
        )
        .withColumn("task", F.expr(f"pmod(xxhash64(anchor, block), {tasks})"))
    )
    sorted_ = stage(sort_blocks(texts, dedup), "run-sorted")
    inside = sorted_.filter("NOT across").select("key", "s", "e")
    across = sorted_.filter("across")
    again = across.groupBy("hi", "lo").count().filter("count > 1").select("hi", "lo")
    between = across.filter("single").join(again, ["hi", "lo"]).select("key", "s", "e")
    return whole.union(inside).union(between)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a key that equal rows share."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"))


def merged(spans: DataFrame) -> DataFrame:
    """Rows (key, spans): disjoint spans (s, e) in order, touching ones joined."""
    joined = (
        "aggregate(array_sort(collect_set(struct(s, e))), CAST(array() AS array<struct<s:bigint,e:bigint>>), (a, x) -> "
        "CASE WHEN size(a) > 0 AND element_at(a, -1).e >= x.s THEN "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e)))) "
        "ELSE concat(a, array(x)) END)"
    )
    return spans.groupBy("key").agg(F.expr(joined).alias("spans"))


def remove_repeats(docs: DataFrame, dedup: Dedup = Dedup()) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, spans, kept), one per row of docs; kept holds the remaining bytes."""
    docs = keyed(docs)
    spans = stage(merged(duplicate_spans(docs, dedup)), "repeat-spans")
    none = "CAST(array() AS array<struct<s:bigint,e:bigint>>)"
    whole = docs.join(spans.hint("merge"), "key", "left").select(
        "doc_id", F.expr("CAST(coalesce(text, '') AS binary)").alias("b"), F.expr(f"coalesce(spans, {none})").alias("spans")
    )
    keep = (
        "aggregate(spans, named_struct('at', 0L, 'out', CAST('' AS binary)), (a, x) -> named_struct('at', x.e, "
        "'out', concat(a.out, substring(b, CAST(a.at AS int) + 1, CAST(x.s - a.at AS int)))), "
        "a -> concat(a.out, substring(b, CAST(a.at AS int) + 1)))"
    )
    return whole.select(
        "doc_id",
        F.expr("CAST(octet_length(b) AS bigint)").alias("n_bytes"),
        F.expr("aggregate(spans, 0L, (a, x) -> a + x.e - x.s)").alias("n_removed"),
        "spans",
        F.expr(f"CASE WHEN size(spans) = 0 THEN b ELSE {keep} END").alias("kept"),
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.expr("CAST(size(spans) AS bigint)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op1_suffix_dedup": (op1, None)}
