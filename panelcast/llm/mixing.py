"""Mixing sources to target weights by temperature.

A source with share p of all tokens (words) gets a weight in proportion to
p ** exponent: 1 keeps the natural mix, 0 gives all sources the same. The
exponent is found by bisection, so that the mix has a target entropy, or is the
flattest that repeats no source more often than a limit. Weights times budget
are tokens per source. They are realised as passes over the source's blocks
(documents dealt by a seeded hash to blocks of about `block_tokens`), each pass
in an order of its own; the last pass ends at the budget, inside one block.

Defined cases: a null source is a source of its own; null and empty texts have
no tokens and go with their block; repeated rows stay repeated; sources without
tokens cost nothing and get one whole pass; an empty table gives an empty mix;
extra columns stay in `remixed`, whatever their names, and in `mixed`, unless
they have the names of the columns added there (n_tokens, epoch, block, position).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table, words


@dataclass(frozen=True)
class Mix:
    """Production parameters. Budget None: as many tokens as give every source one whole pass."""

    budget: int | None = None
    max_repeats: float | None = 2.0
    entropy_bits: float | None = None
    block_tokens: int = 200_000
    seed: int = 7


HALVINGS, PASSES = 5, 7


def _exponent(shares: DataFrame, low: float, high: float, ok: Callable[[float, float, float, float], bool]) -> float:
    """The boundary between exponents that are not ok (low side) and ok (high side).

    Each pass over the table of sources does several halvings at once, by
    evaluating all the midpoints that these could need.
    """
    for _ in range(PASSES):
        n = 2**HALVINGS
        grid = [low + (high - low) * i / n for i in range(n + 1)]
        sums = []
        for i, x in enumerate(grid):
            sums.append(F.sum(F.pow("p", F.lit(x))).alias(f"z{i}"))
            sums.append(F.sum(F.pow("p", F.lit(x)) * F.log2("p")).alias(f"m{i}"))
            sums.append(F.max(F.pow("p", F.lit(x - 1))).alias(f"r{i}"))
            sums.append(F.min(F.pow("p", F.lit(x - 1))).alias(f"q{i}"))
        row = shares.agg(*sums).first()
        good = [ok(grid[i], row[f"z{i}"], row[f"m{i}"], (row[f"r{i}"], row[f"q{i}"])) for i in range(n + 1)]
        first = good.index(True) if True in good else n
        if first == 0:
            return low
        low, high = grid[first - 1], grid[first]
    return high


def weights(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Rows (_source, tokens, weight, target): from rows (_source, tokens), one per source."""
    sizes = sizes.filter("tokens > 0")
    total = sizes.agg(F.sum("tokens")).first()[0]
    if not total:
        return sizes.select("_source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("target"))
    shares = sizes.withColumn("p", F.col("tokens") / F.lit(int(total)))

    def budget_of(z: float, least: float) -> float:
        return mix.budget if mix.budget is not None else total * z / least

    if mix.entropy_bits is not None:  # entropy falls as the exponent grows
        x = _exponent(shares, 0.0, 16.0, lambda e, z, m, _: math.log2(z) - e * m / z <= mix.entropy_bits)
    elif mix.max_repeats is not None:
        x = _exponent(
            shares, 0.0, 1.0, lambda e, z, m, r: budget_of(z, r[1]) / total * r[0] / z <= mix.max_repeats * (1 + 1e-12)
        )
    else:
        x = 1.0
    z, least = shares.agg(F.sum(F.pow("p", F.lit(x))), F.min(F.pow("p", F.lit(x - 1)))).first()
    budget = budget_of(z, least)
    return shares.select(
        "_source",
        "tokens",
        (F.pow("p", F.lit(x)) / F.lit(z)).alias("weight"),
        # Rounded to a part in 10**9 first, so that a whole pass stays whole.
        F.expr(f"CAST(round(tokens * round({budget!r}D * (pow(p, {x!r}D) / {z!r}D) / tokens, 9)) AS bigint)").alias("target"),
    )


def dealt(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """docs with _source, n_tokens and _order, a seeded hash; the hash also deals to blocks."""
    return docs.withColumns(
        {
            "_source": F.coalesce(F.col("source").cast("string"), F.lit("\x00null")),
            "n_tokens": F.expr(f"CAST(size({words('text')}) AS bigint)"),
            "_order": F.xxhash64(F.lit(mix.seed), "doc_id", "text"),
        }
    )


def schedule(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Passes over blocks: rows (_source, block, blocks, epoch, position, room) from rows (_source, n_tokens, _order).

    `room` is null for a whole block, else the tokens that the budget leaves for
    it. `position` in [0, 1) interleaves the sources evenly.
    """
    # Sums by a fine slice of the hash first: the number of blocks follows from the size of the source.
    sizes = stage(sized.groupBy("_source").agg(F.sum("n_tokens").alias("tokens")), "mix-sizes")
    plan = stage(
        weights(sizes, mix).withColumn("blocks", F.expr(f"CAST(greatest(1, ceil(tokens / {mix.block_tokens})) AS bigint)")),
        "mix-weights",
    )
    blocks = (
        sized.join(plan, "_source")
        .withColumn("block", F.expr("pmod(_order, blocks)"))
        .groupBy("_source", "block", "blocks", "tokens", "target")
        .agg(F.sum("n_tokens").alias("size"))
    )
    blocks = stage(blocks, "mix-blocks")
    passes = blocks.withColumn("epoch", F.expr("explode(sequence(0, CAST(div(target, tokens) AS int)))"))
    passes = passes.withColumn("left_", F.expr("target - tokens * epoch")).filter("left_ > 0")
    passes = passes.withColumn("shuffle_", F.xxhash64(F.lit(mix.seed), "_source", "epoch", "block"))
    before = "(PARTITION BY _source, epoch ORDER BY shuffle_, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    passes = passes.withColumn("begin", F.expr(f"coalesce(sum(size) OVER {before}, 0)")).filter("begin < left_")
    # Sources of empty texts only: no budget to spend, one pass.
    empty = sizes.filter("coalesce(tokens, 0) = 0").selectExpr(
        "_source", "0L AS block", "1L AS blocks", "0 AS epoch", "0D AS position", "CAST(NULL AS bigint) AS room"
    )
    return stage(
        passes.select(
            "_source",
            "block",
            "blocks",
            "epoch",
            ((F.col("tokens") * F.col("epoch") + F.col("begin")) / F.col("target")).alias("position"),
            F.expr("CASE WHEN begin + size > left_ THEN left_ - begin END").alias("room"),
        ).union(empty),
        "mix-schedule",
    )


ADDED = ["n_tokens", "epoch", "block", "position"]


def _taken(docs: DataFrame, mix: Mix) -> DataFrame:
    """Rows (_doc, a struct of all columns of docs, and the added columns).

    In the block in which the budget ends, documents are taken in the order of
    their hash while they fit whole.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = dealt(docs.select(held, "doc_id", "text", "source"), mix).select("_doc", "_source", "n_tokens", "_order")
    sized = stage(rows.select("_source", "n_tokens", "_order"), "mix-sized")
    plan = schedule(sized, mix)
    blocks = stage(plan.select("_source", "blocks").distinct(), "mix-blocks")
    rows = rows.join(blocks, "_source").withColumn("block", F.expr("pmod(_order, blocks)")).drop("blocks")
    whole = plan.filter("room IS NULL").select("_source", "block", "epoch", "position")
    cut = plan.filter("room IS NOT NULL").select("_source", "block", "epoch", "position", "room")
    # Where the budget ends: the hash up to which documents of the block fit.
    parts = sized.join(blocks, "_source").withColumn("block", F.expr("pmod(_order, blocks)"))
    parts = parts.join(cut, ["_source", "block"]).groupBy("_source", "block", "epoch", "room", "position", "_order").agg(
        F.sum("n_tokens").alias("n")
    )
    upto = "(PARTITION BY _source, block, epoch ORDER BY _order)"
    ends = (
        parts.withColumn("sum_", F.expr(f"sum(n) OVER {upto}"))
        .filter("sum_ <= room")
        .groupBy("_source", "block", "epoch", "position")
        .agg(F.max("_order").alias("last_"))
    )
    taken = stage(
        whole.withColumn("last_", F.lit(2**63 - 1)).union(ends.select(*whole.columns, "last_")), "mix-taken"
    )
    return (
        rows.join(taken, ["_source", "block"])
        .filter("_order <= last_")
        .select("_doc", *ADDED)
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """docs as often as the mix takes them, with n_tokens, epoch, block and position."""
    kept = [F.col(f"_doc.`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return _taken(docs, mix).select(*kept, *ADDED)


def remixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """docs as often as the mix takes them, with their own columns only."""
    return _taken(docs, mix).select("_doc.*")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "source", "n_tokens", "epoch", "block", "position")


QUERIES = {"op9_mix_sources": (op9, None)}
