"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds its distinct word shingles. All sets are put in one order,
common shingles last. Two sets that are similar enough share at least k shingles
within their prefixes of n - least overlap + k shingles, so that with a longer
prefix a pair must match more often to be a candidate. Each set takes the k for
which the matches it has to read and the candidates it has to verify are
estimated to cost least, given how many sets hold each shingle of its prefix; a
pair must match as often as the smaller k of the two, within the shorter
prefixes that suffice for the two sizes, its first match before the others.

Equal sets are one class before the join. Pairs are proposed in two steps: first
each class with that holder of its shingles, out of another component, that it
shares most with; the holder offered is the one with most matches, mostly the
text a family was copied from. Once these links have made components, only pairs
of different components, by the places where their first match may lie. So a
family of copies of any size proposes about one pair per member, those who share
a little with all of it hardly any, and no link between components is missed. All
candidates are verified on whole sets.

Which shingles count as common affects the cost only, never the result: they are
the `common` most frequent of those that occur twice or more within a batch.

Defined cases: a text with fewer words than a shingle has its whole sequence as
one; null, empty and blank texts have an empty set and no link; rows with equal
sets are linked, repeated rows included; sets are told apart by 64 bits of a
digest, rows by 64 bits of a hash of id and text, and two shingles of a set that
agree in 48 bits count as one match; the component of a class is its
smallest non-null id (null if it has none); an empty table gives an empty table;
extra columns aren't returned.
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
from panelcast.llm.common import components, stage, table


@dataclass(frozen=True)
class Join:
    """Production parameters. `common` bounds the list of common shingles that every task gets (8 bytes each).

    Lists of texts to read again are broadcast up to `broadcast_rows` (32 bytes each). `attempts` rounds link
    components before all that is left is compared; their number changes the cost only.
    """

    width: int = 5
    percent: int = 75
    most_matches: int = 4
    common: int = 200_000
    verify_cost: int = 8
    range_docs: int = 4_000
    broadcast_rows: int = 500_000
    members_at_once: int = 500
    attempts: int = 1


def shingle_sets(batch: pa.RecordBatch, index: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of a batch."""
    row = 0
    for part in hashing.slices(batch, index):
        words, bounds = hashing.words(*hashing.texts(part.column(index)))
        runs = hashing.windows(words, width)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= width:
                yield row, np.unique(runs[lo : hi - width + 1])
            elif hi > lo:
                yield row, hashing.windows(words[lo:hi], hi - lo) ^ np.uint64(hi - lo)
            else:
                yield row, np.empty(0, dtype=np.uint64)
            row += 1


def class_of(found: np.ndarray) -> int:
    """A signed 64-bit digest of a set; 0 for the empty one."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True) if len(found) else 0


def common_shingles(docs: DataFrame, join: Join) -> np.ndarray:
    """The most frequent shingles, rarest first; join.common at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for _, s in shingle_sets(batch, 0, join.width)]
            shingles, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, int))
            keep = n > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingles[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["shingle", "n"]
            )

    rows = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "shingle").limit(join.common).toArrow()  # 16 bytes a row, no row objects
    shingles, counts = (top.column(c).to_numpy().astype(np.int64) for c in ("shingle", "n"))
    return shingles[np.lexsort((shingles, counts))].view(np.uint64)


def measured(docs: DataFrame, common: np.ndarray, join: Join) -> DataFrame:
    """Rows (key, doc_id, cls, n, prefix): the longest prefix in the global order, as the upper 48 bits of hashes."""
    order = np.argsort(common)
    listed = common[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, prefixes = [], [], []
            for _, found in shingle_sets(batch, 2, join.width):
                n = len(found)
                classes.append(class_of(found))
                sizes.append(n)
                if n and len(listed):
                    at = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
                    hit = listed[at] == found
                    if hit.any():
                        last = found[hit][np.argsort(order[at[hit]])]
                        found = np.concatenate([found[~hit], last])
                least = -(-join.percent * n // 100)
                found = found[: n - least + min(join.most_matches, least)]
                prefixes.append((found >> np.uint64(16)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["key", "doc_id", "cls", "n", "prefix"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(
        run, "key long, doc_id long, cls long, n int, prefix array<long>"
    )


def repeated_shingles(rows: DataFrame, join: Join) -> DataFrame:
    """Rows (shingle): those that occur in several prefixes, copies of a text included.

    Batches send each of their shingles once with its count, in one sorted block
    per range of hashes, so that a range's size doesn't depend on how common its
    shingles are.
    """
    ranges = max(1, -(-rows.count() // join.range_docs))
    edges = hashing.edges(ranges) >> np.uint64(16)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, n = np.unique(np.asarray(batch.column(0).flatten()).view(np.uint64), return_counts=True)
            cuts = [0, *np.searchsorted(shingles, edges), len(shingles)]
            spans = [(r, lo, hi) for r, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo]
            columns = [
                pa.array([r for r, _, _ in spans], pa.int64()),
                pa.array([hashing.planes(shingles[lo:hi] << np.uint64(16), 6) for _, lo, hi in spans], pa.binary()),
                pa.array([np.minimum(n[lo:hi], 2).astype(np.uint8).tobytes() for _, lo, hi in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "shingles", "n"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        found, place = np.unique(np.concatenate([hashing.unplaned(x, 6) for x in part["shingles"]]), return_inverse=True)
        n = np.bincount(place, weights=np.frombuffer(b"".join(part["n"]), dtype=np.uint8), minlength=len(found))
        return pd.DataFrame({"shingle": (found[n > 1] >> np.uint64(16)).view(np.int64)})

    sent = rows.select("prefix").mapInArrow(send, "range long, shingles binary, n binary")
    return sent.groupBy("range").applyInPandas(add, "shingle long")


def matches(rows: DataFrame, join: Join) -> DataFrame:
    """Rows (shingle, cls, n, k, pos, central) of prefix shingles that several classes hold, with each class's chosen k,
    the shingle's place in the order and the matches that the class has with others."""
    least = f"CAST(ceil({join.percent} * n / 100) AS int)"
    enters = F.expr(f"CAST(greatest(1, pos + 2 - (n - {least} + 1)) AS tinyint)")
    tokens = rows.select("cls", "n", F.posexplode("prefix").alias("pos", "shingle")).select("shingle", "cls", "pos", enters.alias("enters"))
    again = stage(repeated_shingles(rows, join), "join-repeated")
    once = stage(
        tokens.join(again, "shingle").groupBy("shingle", "cls").agg(F.min("enters").alias("enters"), F.min("pos").alias("pos")), "join-postings"
    )
    held = once.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    sizes = rows.groupBy("cls").agg(F.first("n").alias("n"))
    shared = stage(once.join(held, "shingle").join(sizes, "cls"), "join-shared")
    costs = [f"sum(CASE WHEN enters <= {k} THEN df - 1 ELSE 0 END) AS s{k}" for k in range(1, join.most_matches + 1)]
    cost = [
        f"named_struct('c', CASE WHEN {k} <= {least} THEN s{k} + {join.verify_cost} * s{k} / {k} END, 'k', {k})"
        for k in range(1, join.most_matches + 1)
    ]
    chosen = (
        shared.groupBy("cls", "n")
        .agg(*[F.expr(c) for c in costs])
        .select("cls", "s1", F.expr(f"array_min(filter(array({', '.join(cost)}), x -> x.c IS NOT NULL)).k").alias("k"))
    )
    rows = shared.join(chosen, "cls").filter("enters <= k")
    return stage(rows.select("shingle", "cls", "n", "k", "pos", F.col("s1").alias("central")), "join-matches")


def _overlap(join: Join, n: str, n2: str) -> str:
    """SQL of the least number of shingles that similar sets of these sizes share."""
    return f"(({join.percent} * ({n} + {n2}) + {join.percent + 99}) DIV {100 + join.percent})"


def _near(join: Join, k: str = "least(k, k2)") -> str:
    """A match that counts: the sizes allow the pair, and the shingle lies in the prefixes that suffice for k matches.

    Similar sets share at least o of their shingles, by their sizes. At most n - o of a set's shingles then aren't
    shared, so the first k shared ones lie before place n - o + k in either set.
    """
    place = [f"{pos} < {n} - {_overlap(join, 'n', 'n2')} + {k}" for pos, n in (("pos", "n"), ("pos2", "n2"))]
    return f"100 * least(n, n2) >= {join.percent} * greatest(n, n2) AND {' AND '.join(place)}"


def star_pairs(found: DataFrame, join: Join, attempt: int) -> DataFrame:
    """For each class, the pair with that holder of its shingles, out of another component, that it matches most often.

    Each shingle offers the holder that comes first in an order, and the first one outside of its component. The
    first attempt goes by how many matches a class has, as the text that a family was copied from has most; later
    ones go by hashes of components and classes, which change with the attempt.
    """
    by = F.struct(F.lit(0), "central", "cls") if not attempt else F.struct(F.xxhash64("component", F.lit(attempt)), F.xxhash64("cls", F.lit(attempt)), "cls")
    holder = F.struct(by.alias("by"), "cls", "n", "k", "pos", "component")
    mixed = found.groupBy("shingle").agg(F.max(holder).alias("one"), F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = found.join(mixed.filter("a <> b").select("shingle", "one"), "shingle").withColumn("same", F.expr("component = one.component"))
    others = mixed.filter("NOT same").groupBy("shingle").agg(F.max(holder).alias("two"))
    offered = mixed.join(others, "shingle").withColumn("h", F.when(F.col("same"), F.col("two")).otherwise(F.col("one")))
    offered = offered.select("cls", "n", "k", "pos", *[F.col(f"h.{c}").alias(f"{c}2") for c in ("cls", "n", "k", "pos")])
    return (
        offered.filter(_near(join))
        .groupBy("cls", "cls2", "n", "n2", "k", "k2")
        .agg(F.count("*").alias("m"))
        .filter("m >= least(k, k2)")
        .groupBy("cls", "n")
        .agg(F.max(F.struct("m", "cls2", "n2")).alias("best"))
        .select("cls", F.col("best.cls2").alias("cls2"), "n", F.col("best.n2").alias("n2"))
    )


def cross_pairs(found: DataFrame, join: Join) -> DataFrame:
    """All pairs of classes of different components that match often enough; found has `component`.

    A pair is proposed by a place where its first match may lie, which comes before those of the other k - 1:
    classes that share a few shingles with all of a family do so late in their prefixes, and don't meet its members.
    The matches of the pairs proposed are counted in the lists of both.
    """
    smallest = f"greatest(smallest, ({join.percent} * n + 99) DIV 100)"  # of the sizes that n can meet here
    mixed = (
        found.groupBy("shingle")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("smallest"))
        .filter("lo <> hi")
        .select("shingle", "smallest")
    )
    found = found.join(mixed, "shingle")
    left = found.filter(f"pos < n - {_overlap(join, 'n', smallest)} + 1").select("shingle", "cls", "n", "k", "pos", "component")
    right = left.select("shingle", *[F.col(c).alias(f"{c}2") for c in left.columns[1:]])
    first = F.expr(f"cls < cls2 AND component <> component2 AND {_near(join, '1')}")
    pairs = left.join(right, (left.shingle == right.shingle) & first).select("cls", "cls2", "n", "n2", "k", "k2")
    pairs = stage(pairs.distinct(), "join-proposed")
    held = found.groupBy("cls").agg(F.collect_list(F.struct("pos", "shingle")).alias("held"))
    both = pairs.join(held, "cls").join(held.select(F.col("cls").alias("cls2"), F.col("held").alias("held2")), "cls2")
    overlap = _overlap(join, "n", "n2")
    counted = [f"transform(filter({h}, x -> x.pos < {n} - {overlap} + least(k, k2)), x -> x.shingle)" for h, n in (("held", "n"), ("held2", "n2"))]
    return both.filter(f"size(array_intersect({', '.join(counted)})) >= least(k, k2)").select("cls", "cls2", "n", "n2")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, join: Join) -> DataFrame:
    """The pairs (cls, cls2) whose whole sets are similar enough.

    The texts of both ends are read once more and their sets sent to the second
    one's group, where each member is compared with it. A group with many members
    is dealt to several places, each with the second one's set. The list of what
    is read is broadcast if it is short, and joined by shuffling else.
    """
    pairs = stage(pairs.select("cls", "cls2").distinct(), "join-pairs")
    places = F.ceil(F.count("*") / join.members_at_once).cast("long")
    sizes = pairs.groupBy("cls2").agg(places.alias("places"))
    firsts = pairs.join(sizes, "cls2").select("cls", F.col("cls2").alias("group"), F.expr("pmod(xxhash64(cls), places)").alias("place"))
    seconds = sizes.select(F.col("cls2").alias("cls"), F.col("cls2").alias("group"), F.expr("explode(sequence(0L, places - 1))").alias("place"))
    ends = stage(firsts.union(seconds).join(classes.select("cls", "key"), "cls"), "join-ends")
    if ends.count() <= join.broadcast_rows:
        ends = F.broadcast(ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.view(np.int64) for _, s in shingle_sets(batch, 3, join.width)]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "place", "cls", "shingles"])

    sets = docs.select("key", "text").join(ends, "key").select("group", "place", "cls", "text")
    sets = sets.mapInArrow(run, "group long, place long, cls long, shingles array<long>").repartition("group", "place")
    second = sets.filter("cls = group").select(F.col("group").alias("cls2"), F.col("place").alias("place2"), F.col("shingles").alias("shingles2"))
    both = sets.filter("cls <> group").join(second, F.expr("group = cls2 AND place = place2"))
    both = both.withColumn("o", F.expr("size(array_intersect(shingles, shingles2))"))
    return both.filter(f"100 * o >= {join.percent} * (size(shingles) + size(shingles2) - o)").select("cls", "cls2").distinct()


def _once(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs with one row per key: where keys repeat, the copies are merged before their shuffle."""
    again = stage(rows.groupBy("key").count().filter("count > 1").select("key"), "join-repeated-rows")
    if again.isEmpty():
        return docs
    merged = docs.join(again, "key", "left_semi").groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    return stage(docs.join(again, "key", "left_anti").select("key", "doc_id", "text").unionByName(merged), "join-single-rows")


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, class_id, component, key), one per row of docs.

    `component` names the group of linked rows also where none of them has an id (null for empty sets); `key` is
    the row's hash of id and text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    rows = stage(measured(docs, common_shingles(docs, join), join), "join-rows")
    classes = stage(
        rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key")), "join-classes"
    )
    docs = _once(docs, rows)
    found = matches(rows.filter("n > 0"), join).withColumn("component", F.col("cls"))
    links = None
    for attempt in range(join.attempts):
        new = stage(verified(docs, classes, star_pairs(found, join, attempt), join), "join-links")
        links = new if links is None else links.union(new)
        if new.isEmpty():
            break
        parts = components(links, "cls", "cls2").withColumnRenamed("id", "cls")
        found = found.drop("component").join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        found = stage(found, "join-parts")
    links = links.union(verified(docs, classes, cross_pairs(found, join), join))
    parts = stage(components(links, "cls", "cls2").withColumnRenamed("id", "cls"), "join-components")
    named = classes.select("cls", "doc_id").join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("cls", "component", "component_id")
    return rows.select("doc_id", "key", "cls", "n").join(named, "cls", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.expr("CASE WHEN n = 0 THEN doc_id ELSE component_id END").alias("component_id"),
        F.expr("CASE WHEN n > 0 THEN cls END").alias("class_id"),
        "component",
        "key",
    )


def one_of_copies(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row of each group of linked rows: the one with the smallest id, rows without id last.

    Rows of one id and different texts, and rows without id, are told apart by
    the hash of id and text, the smaller first; rows with an empty set link with
    nothing and stay; equal rows become one. All columns stay, whatever their names.
    """
    found = stage(near_duplicates(docs, join), "join-found")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    first = found.filter("component IS NOT NULL").groupBy("component").agg(best.alias("best")).select("best.key")
    first = stage(first.union(found.filter("component IS NULL").select("key")).distinct(), "first-of-copies")
    small = first.count() <= join.broadcast_rows
    again = stage(found.groupBy("key").count().filter("count > 1").select("key").join(first, "key", "left_semi"), "repeated-rows")
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    kept = docs.join(F.broadcast(first) if small else first, key == first["key"], "left_semi")
    if again.isEmpty():
        return kept
    same = key == again["key"]
    return kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op2_ngram_join": (op2, None)}
