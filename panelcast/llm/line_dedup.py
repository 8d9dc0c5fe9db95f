"""Line dedup: lines that many documents share leave all of them.

Texts are split at line feeds. A line's key is the line without blanks at its
ends and with A-Z in small letters; keys are compared by a 128-bit digest. Each
document gives each of its keys once, so that one aggregation, combined before
the shuffle, counts the documents of a key. Lines whose key is in the table of
common keys are found by a join that carries positions and no text. What a text
loses is worked out once for all copies of it and joined back by a 128-bit
digest of the text; the remaining lines keep their order.

Both joins are left to Spark, which broadcasts a written table it measures below
its threshold and else sorts both sides, splitting a hot line or a hot text.

Defined cases: each row is a document, also where doc_id is null or repeated;
null text is one empty line and stays null in `drop_common_lines`, whose result
is otherwise an empty text if every line goes; texts that end with a line feed
have an empty last line; a key counts once per document however often it is
repeated; a very long text is one row of lines, and its work grows with its
length only; empty tables give empty tables; extra columns are kept by
`drop_common_lines`, whatever their names, and not returned by `scan`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' \\u0009\\u000a\\u000b\\u000c\\u000d'"


@dataclass(frozen=True)
class Common:
    """Keys of at least `min_chars` code points in at least `min_docs` documents are dropped."""

    min_chars: int = 1
    min_docs: int = 10


def _key(line: str) -> str:
    """SQL key of a line. Lines in ASCII take the plain function for small letters, which gives the same."""
    cut = f"trim(BOTH {_BLANKS} FROM {line})"
    return (
        f"CASE WHEN octet_length({line}) = char_length({line}) THEN lower({cut}) "
        f"ELSE translate({cut}, '{_UPPER}', '{_LOWER}') END"
    )


def _digest(value: str, *names: str) -> list[Column]:
    """128 bits as two numbers."""
    return [F.xxhash64(F.lit(i), F.expr(value)).alias(n) for i, n in enumerate(names)]


def _lines(text: str = "text") -> str:
    return f"split(coalesce({text}, ''), '\\n', -1)"


def common_keys(docs: DataFrame, rule: Common = Common()) -> DataFrame:
    """Rows (a, b, n_docs): digests of the keys to drop and the documents that hold them."""
    keys = docs.select(F.expr(f"explode(array_distinct(transform({_lines()}, x -> {_key('x')})))").alias("key"))
    counts = (
        keys.filter(F.expr(f"char_length(key) >= {rule.min_chars}"))
        .select(*_digest("key", "a", "b"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    return counts.filter(F.col("n_docs") >= rule.min_docs)


def dropped_lines(docs: DataFrame, common: DataFrame) -> DataFrame:
    """Rows (c, d, dropped): digest of a text and the places of the lines it loses, one row per text."""
    lines = docs.select(*_digest("coalesce(text, '')", "c", "d"), F.expr(f"posexplode({_lines()}) AS (pos, line)"))
    places = lines.select("c", "d", "pos", *_digest(_key("line"), "a", "b"))
    hits = places.join(common.select("a", "b"), ["a", "b"])
    return hits.groupBy("c", "d").agg(F.collect_set("pos").alias("dropped"))


def _with_rest(docs: DataFrame, rule: Common, name: str) -> DataFrame:
    """docs without text, and a struct of the given name: `was_null`, `lines` and `dropped` (null: none)."""
    common = stage(common_keys(docs, rule), "common-lines")
    dropped = stage(dropped_lines(docs, common), "dropped-lines")
    # The lines are an array on this side of the join: later steps take them by place, without splitting again.
    left = docs.withColumn(
        name,
        F.struct(
            F.col("text").isNull().alias("was_null"),
            F.expr(_lines()).alias("lines"),
            *_digest("coalesce(text, '')", "c", "d"),
        ),
    ).drop("text")
    right = dropped.select(F.struct("c", "d", "dropped").alias(f"{name}r"))
    joined = left.join(right, (F.col(f"{name}.c") == F.col(f"{name}r.c")) & (F.col(f"{name}.d") == F.col(f"{name}r.d")), "left")
    return joined.withColumn(
        name, F.struct(f"{name}.was_null", f"{name}.lines", F.col(f"{name}r.dropped").alias("dropped"))
    ).drop(f"{name}r")


def _kept(name: str) -> Column:
    """The remaining lines, joined."""
    lines, dropped = f"{name}.lines", f"{name}.dropped"
    rest = f"array_except(sequence(0, size({lines}) - 1), {dropped})"
    return F.expr(
        f"CASE WHEN {dropped} IS NULL THEN array_join({lines}, '\\n') "
        f"ELSE array_join(transform({rest}, i -> {lines}[i]), '\\n') END"
    )


def _free(docs: DataFrame) -> str:
    """A name that no column of docs begins with."""
    name = "_rest"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def drop_common_lines(docs: DataFrame, rule: Common = Common()) -> DataFrame:
    """docs without the lines that at least `min_docs` of them share; null text stays null."""
    name = _free(docs)
    df = _with_rest(docs, rule, name)
    text = F.when(~F.col(f"{name}.was_null"), _kept(name))
    return df.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def scan(docs: DataFrame, rule: Common = Common()) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and `kept`, the remaining text."""
    df = _with_rest(docs.select("doc_id", "text"), rule, "_rest")
    return df.select(
        "doc_id",
        F.expr("CAST(size(_rest.lines) AS bigint)").alias("n_lines"),
        F.expr("CAST(coalesce(size(_rest.dropped), 0) AS bigint)").alias("n_dropped"),
        _kept("_rest").alias("kept"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (
  SELECT r, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
  FROM lines),
common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (
  SELECT r, pos, line, k IN (SELECT k FROM common) AS gone FROM keyed),
texts AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN texts USING (r)
"""

QUERIES = {"op11_line_dedup": (op11, SQL)}
