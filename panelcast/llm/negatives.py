"""Hard-negative mining with anchor spanning-tree bounds.

Anchors fall into groups of bounded size by the signs of fixed projections, near
ones together, and the anchors of a group are joined by a minimum spanning tree.
The scores of a tree's root with a block of candidates are computed; a child's
score with a candidate then lies within edge length times candidate norm of its
parent's score. Only candidates whose interval meets the window that still
matters for the child are scored again; the others hand the interval down.

Two rounds walk the trees. The first looks for each anchor's best rows of its
own label: its window is open above and begins at the worst of the best found so
far. The second looks, for each of these positives, for the best rows of other
labels between a lower and an upper percentage of the positive's score, and its
windows shrink as they fill. Scores are inner products of whole numbers and
exact. Candidates and trees are packed into one row per block and per group;
each pair of a block and a slot of groups is one task's work, of bounded memory,
and returns a bounded number of rows per anchor.

Anchors are a stated query set against all rows, so the pairs of blocks and
slots grow with both; nothing is broadcast or collected but counts.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; an empty vector scores 0; shorter vectors count as filled
with zeros; components beyond 8,388,607 in either direction count as that bound;
vectors hold up to 65,536 components; each row is a row of its own, so repeated
rows are each other's positives and repeated anchors give repeated results; a
row without id is no anchor and comes after all ids on ties; ties go to the
smaller id; an anchor without positives, and a positive without negatives in its
window, gives no rows; an empty table gives an empty table; extra columns aren't
returned, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

#: Components are cut to this bound, so that a score of 65,536 of them fits 64 bits.
LARGEST = (1 << 23) - 1


@dataclass(frozen=True)
class Mining:
    """Production parameters. Percentages of the positive's score bound its negatives, ends included.

    Memory of a task: `chunk` candidates times `group` anchors, 16 bytes each, and a block of `block` vectors.
    """

    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95
    group: int = 512
    block: int = 4_096
    chunk: int = 2_048
    tasks: int = 2_000


PACKED = "n int, rids binary, ids binary, known binary, labels binary, x binary"
FOUND = "anchor long, anchor_id long, rid long, id long, score long"


def _pack(rows: pd.DataFrame) -> dict:
    dim = max((len(v) for v in rows["vector"]), default=0)
    x = np.zeros((len(rows), dim), dtype="<i4")
    for i, v in enumerate(rows["vector"]):
        x[i, : len(v)] = v
    known = rows["vec_id"].notna().to_numpy()
    return {
        "n": len(rows),
        "rids": rows["rid"].to_numpy("<i8").tobytes(),
        "ids": rows["vec_id"].astype(object).where(known, 0).astype("int64").to_numpy("<i8").tobytes(),
        "known": known.tobytes(),
        "labels": rows["label"].to_numpy("<i8").tobytes(),
        "x": x.tobytes(),
    }


class _Rows:
    """A packed block or group, with its vectors in the given number of dimensions."""

    def __init__(self, row):
        self.n = int(row["n"])
        self.rids, self.ids, self.labels = (np.frombuffer(row[c], dtype="<i8") for c in ("rids", "ids", "labels"))
        self.known = np.frombuffer(row["known"], dtype=bool)
        self.x = np.frombuffer(row["x"], dtype="<i4").reshape(self.n, -1)
        wide = self.x.astype(np.float64)
        self.norm = np.sqrt((wide * wide).sum(axis=1))

    def vectors(self, dim: int, kind) -> np.ndarray:
        out = np.zeros((self.n, dim), dtype=kind)
        out[:, : self.x.shape[1]] = self.x
        return out


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order from the root on, and the place of each row's parent in that order with the edge's length.

    The root is the row nearest to the mean; rows join in order of their distance to the tree.
    """
    x = x.astype(np.float64)
    n = len(x)
    squares = (x * x).sum(axis=1)
    at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order, parent, length = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, via, out = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    for step in range(n):
        order[step], out[at] = at, False
        gap = squares + squares[at] - 2 * (x @ x[at])
        closer = out & (gap < near)
        near[closer], via[closer] = gap[closer], step
        if step + 1 < n:
            at = int(np.where(out, near, np.inf).argmin())
            parent[step + 1] = via[at]
            length[step + 1] = np.sqrt(((x[at] - x[order[via[at]]]) ** 2).sum())
    return order, parent, length


def _best(rows: _Rows, at: np.ndarray, scores: np.ndarray, most: int, kept: list[tuple]) -> list[tuple]:
    """The first `most` of kept and new rows: (-score, id unknown, id, rid)."""
    if len(at) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        at, scores = at[scores >= least], scores[scores >= least]
        if len(at) > most:  # ties at the last place
            first = np.lexsort((rows.rids[at], rows.ids[at], ~rows.known[at], -scores))[:most]
            at, scores = at[first], scores[first]
    new = zip((-scores).tolist(), (~rows.known[at]).tolist(), rows.ids[at].tolist(), rows.rids[at].tolist())
    return sorted([*kept, *new])[:most]


def walk(tree: _Rows, parent: np.ndarray, length: np.ndarray, rows: _Rows, chunk: int, window, take) -> int:
    """Scores the candidates of each anchor that `window` doesn't rule out, and hands them to `take`.

    window(anchor, chunk's rows) gives the lowest and highest score that matter and the rows that may have them;
    take(anchor, places of rows, their scores) is called in the order of the tree. Returns how many were scored.
    """
    dim = max(tree.x.shape[1], rows.x.shape[1])
    # Sums of products stay whole numbers in double precision up to 2 ** 53, beyond that in 64 bits.
    exact = np.float64 if tree.norm.max(initial=0) * rows.norm.max(initial=0) < 2.0**52 else np.int64
    anchors, points = tree.vectors(dim, exact), rows.vectors(dim, exact)
    scored = 0
    for start in range(0, rows.n, chunk):
        part = slice(start, min(start + chunk, rows.n))
        x, norm = points[part], rows.norm[part]
        low, high = np.empty((tree.n, len(x))), np.empty((tree.n, len(x)))
        for i in range(tree.n):
            if i:
                reach = length[i] * norm
                reach += 1e-9 * (tree.norm[i] + length[i]) * norm + 0.5
                np.subtract(low[parent[i]], reach, out=low[i])
                np.add(high[parent[i]], reach, out=high[i])
            least, most, may = window(i, part)
            if i:
                at = np.flatnonzero(may & (high[i] >= least) & (low[i] <= most))
                if not len(at):
                    continue
                exactly = x[at] @ anchors[i]
                low[i, at] = high[i, at] = exactly
            else:
                exactly = x @ anchors[0]
                low[0] = high[0] = exactly
                at = np.flatnonzero(may)
                exactly = exactly[at]
            scored += len(at)
            take(i, at + start, exactly.astype(np.int64))
    return scored


def best_positives(tree, parent, length, rows: _Rows, rule: Mining) -> list[list[tuple]]:
    """Per anchor the best rows of its label in a block, without itself."""
    best: list[list[tuple]] = [[] for _ in range(tree.n)]

    def window(i, part):
        may = (rows.labels[part] == tree.labels[i]) & (rows.rids[part] != tree.rids[i])
        return (-best[i][-1][0] if len(best[i]) == rule.positives else -np.inf), np.inf, may

    def take(i, at, scores):
        best[i] = _best(rows, at, scores, rule.positives, best[i])

    walk(tree, parent, length, rows, rule.chunk, window, take)
    return best


def bounds(score: int, rule: Mining) -> tuple[int, int]:
    """Lowest and highest whole score between the percentages of a positive's score."""
    return -((-rule.least_percent * score) // 100), (rule.most_percent * score) // 100


def best_negatives(tree, parent, length, wanted: dict, rows: _Rows, rule: Mining) -> dict:
    """Per anchor and positive score the best rows of other labels in a block within the score's bounds.

    wanted: the place of an anchor → its distinct positive scores.
    """
    windows = {i: {p: bounds(p, rule) for p in scores} for i, scores in wanted.items()}
    windows = {i: {p: w for p, w in ws.items() if w[0] <= w[1]} for i, ws in windows.items()}
    best = {i: {p: [] for p in ws} for i, ws in windows.items()}
    nothing = (np.inf, -np.inf)

    def window(i, part):
        ws = windows.get(i)
        least, most = (min(w[0] for w in ws.values()), max(w[1] for w in ws.values())) if ws else nothing
        return least, most, (rows.labels[part] != tree.labels[i])

    def take(i, at, scores):
        for p, (least, most) in windows.get(i, {}).items():
            inside = (scores >= least) & (scores <= most)
            if inside.any():
                found = best[i][p] = _best(rows, at[inside], scores[inside], rule.negatives, best[i][p])
                if len(found) == rule.negatives:
                    windows[i][p] = (max(least, -found[-1][0]), most)

    walk(tree, parent, length, rows, rule.chunk, window, take)
    return best


def _valid(rows: DataFrame) -> DataFrame:
    """Usable rows as (rid, vec_id, label, vector, is_anchor), written once, so that row ids stay."""
    cut = f"transform(vector, x -> CAST(greatest(-{LARGEST}, least({LARGEST}, x)) AS int))"
    usable = rows.filter("label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    return stage(
        usable.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.expr(cut).alias("vector"),
            F.expr("coalesce(is_anchor, false) AND vec_id IS NOT NULL").alias("is_anchor"),
        ),
        "mining-rows",
    )


def _trees(anchors: DataFrame, count: int, slots: int, rule: Mining) -> DataFrame:
    """Rows (slot, packed anchors in tree order, parent, length): groups of at most rule.group anchors."""
    bits = max(0, math.ceil(math.log2(max(1, 2 * count / rule.group))))

    @F.pandas_udf("long")
    def side(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), dtype=np.int64)
        for i, v in enumerate(vectors):
            # Fixed directions, the same in every task and for vectors of any length.
            draws = np.random.default_rng(12).standard_normal((len(v), bits)) if not i or len(v) != len(vectors[i - 1]) else draws
            out[i] = ((np.asarray(v, dtype=np.float64) @ draws > 0) << np.arange(bits)).sum() if bits else 0
        return pd.Series(out)

    placed = stage(anchors.withColumn("cell", side("vector")), "mining-anchors")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rule.group).alias("parts"))
    grouped = placed.join(sizes, "cell").withColumn("part", F.expr("pmod(xxhash64(rid), parts)"))
    # A hash deals unevenly: parts are of about the size asked for; the tree cuts those that are larger.

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for start in range(0, len(rows), rule.group):
            some = rows.iloc[start : start + rule.group]
            packed = _Rows(_pack(some))
            order, parent, length = spanning_tree(packed.x)
            packed = _pack(some.iloc[order])
            out.append(
                {"slot": int(hash((int(key[0]), int(key[1]), start)) % slots), "tree": int(some["rid"].iloc[order[0]]), **packed}
                | {"parent": parent.astype("<i8").tobytes(), "length": length.astype("<f8").tobytes()}
                | {"members": some["rid"].to_numpy()}
            )
        return pd.DataFrame(out)

    schema = f"slot int, tree long, {PACKED}, parent binary, length binary, members array<long>"
    return stage(grouped.groupBy("cell", "part").applyInPandas(build, schema), "mining-trees")


def _opened(row) -> tuple[_Rows, np.ndarray, np.ndarray]:
    return _Rows(row), np.frombuffer(row["parent"], dtype="<i8"), np.frombuffer(row["length"], dtype="<f8")


def _rows_of(tree: _Rows, i: int, kept: list[tuple], extra: tuple = ()) -> list[tuple]:
    return [(int(tree.rids[i]), int(tree.ids[i]), rid, None if unknown else id_, -negated, *extra) for negated, unknown, id_, rid in kept]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    out["id"] = out["id"].astype("Int64")
    return out


def hard_negatives(rows: DataFrame, rule: Mining = Mining()) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows: vec_id, label, vector (array<bigint>) and is_anchor.
    """
    valid = _valid(rows)
    total, anchors = valid.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks, slots = max(1, -(-total // rule.block)), max(1, -(-2 * anchors // rule.group))
    tasks = max(1, min(blocks * slots, rule.tasks))
    trees = _trees(valid.filter("is_anchor"), anchors, slots, rule)

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        some = [part.iloc[i : i + rule.block] for i in range(0, len(part), rule.block)]
        return pd.DataFrame([{"block": int(key[0]), **_pack(s)} for s in some])

    dealt = valid.drop("is_anchor").withColumn("block", F.expr(f"CAST(pmod(xxhash64(rid), {blocks}) AS int)"))
    packed = stage(dealt.groupBy("block").applyInPandas(pack, f"block int, {PACKED}"), "mining-blocks")

    def pairs(right: DataFrame, match, schema: str) -> DataFrame:
        """match(blocks, trees) for each block and slot; every pair is a group of its own."""
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = packed.withColumn("slot", each(slots)).repartition(tasks, "block", "slot")
        right = right.withColumn("block", each(blocks)).repartition(tasks, "block", "slot")
        return left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot")).applyInPandas(match, schema)

    names = ["anchor", "anchor_id", "rid", "id", "score"]

    def positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in left.iterrows():
            candidates = _Rows(block)
            for _, row in right.iterrows():
                tree, parent, length = _opened(row)
                for i, kept in enumerate(best_positives(tree, parent, length, candidates, rule)):
                    out += _rows_of(tree, i, kept)
        return _frame(out, names)

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    first = pairs(trees, positives, FOUND).withColumn("place", F.row_number().over(best))
    first = stage(first.filter(F.col("place") <= rule.positives), "mining-positives")

    # Positives of equal score share their negatives: one list per anchor and distinct score.
    members = trees.select("tree", F.explode("members").alias("rid"))
    asked = first.select("anchor", "score").distinct().join(members, F.col("anchor") == F.col("rid"))
    asked = asked.groupBy("tree").agg(F.collect_list("anchor").alias("of"), F.collect_list("score").alias("scores"))
    ready = trees.join(asked, "tree")

    def negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in left.iterrows():
            candidates = _Rows(block)
            for _, row in right.iterrows():
                tree, parent, length = _opened(row)
                place, wanted = {rid: i for i, rid in enumerate(tree.rids.tolist())}, {}
                for rid, score in zip(row["of"], row["scores"]):
                    wanted.setdefault(place[rid], []).append(int(score))
                found = best_negatives(tree, parent, length, wanted, candidates, rule)
                for i, lists in found.items():
                    for score, kept in lists.items():
                        out += _rows_of(tree, i, kept, (score,))
        return _frame(out, [*names, "positive"])

    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    second = pairs(ready, negatives, FOUND + ", positive long").withColumn("rank", F.row_number().over(best))
    second = second.filter(F.col("rank") <= rule.negatives).select(
        "anchor", F.col("positive").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return first.join(second, ["anchor", "score"]).select(
        "anchor_id",
        F.col("id").alias("positive_id"),
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def quantised(vectors: DataFrame, anchor_step: int = 50, relabel_step: int = 7) -> DataFrame:
    """embeddings as rows to mine: components floor(256 x), some labels moved on by one, anchors by id."""
    fine = "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(CAST(x AS double)) = double('inf'))"
    return vectors.filter(fine).select(
        "vec_id",
        F.expr(f"CASE WHEN vec_id % {relabel_step} = 0 THEN (label + 1) % 10 ELSE label END").alias("label"),
        F.expr("transform(embedding, x -> floor(256 * CAST(x AS double)))").alias("vector"),
        F.expr(f"vec_id % {anchor_step} = 0").alias("is_anchor"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(quantised(table(spark, sf_dir, "embeddings")))


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same
   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

QUERIES = {"op12_hard_negatives": (op12, SQL)}
