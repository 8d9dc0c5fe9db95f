"""Secret scans by multipart credential linking.

Strong spans stand alone: assignments of a long value, access identifiers and
long hex runs. Weak candidates (user-name assignments, mixed-case token runs,
endpoints) are common in clean text; each is reported only when the parts that
complete it lie within `scope` code points of it: an identifier needs a secret,
a token run needs an identifier, an endpoint needs both. That interval join runs
as a sweep over each text's parts in order of start: the largest end before and
the smallest start after decide whether a complementary part is in scope, so a
text with many parts costs a sort and no pairs.

Defined cases: null text is empty and has no spans; positions are code points,
end exclusive; spans of one kind don't overlap, and weak candidates that touch a
strong span are dropped; repeated rows get the same spans; empty tables give
empty tables; extra columns aren't returned by `scan` and are kept by `redact`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

#: Pattern, group whose length counts, least length; in the order in which kinds sort.
STRONG = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Weak candidates; a run counts as `key` only with a digit, a small and a capital letter.
WEAK = {
    "id": (r"(?i)(?<![a-z0-9_])(?:client_?id|user_?name|user_?id|account|login)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9@._+-]{3,}", 0, 3),
    "key": (
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[A-Z])"
        r"[A-Za-z0-9+/_=-]{20,}",
        0,
        20,
    ),
    "endpoint": (r"(?i)(?<![a-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D\"'<>]{4,}", 0, 7),
}
KINDS = [*STRONG, *WEAK]
#: The role that each kind plays in a credential, and the roles that must be in scope of a weak one.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "id": "id", "key": "secret", "endpoint": "endpoint"}
NEEDS = {"id": ["secret"], "key": ["id"], "endpoint": ["id", "secret"]}


@dataclass(frozen=True)
class Scope:
    """Code points between a weak candidate and the parts that complete it."""

    reach: int = 200


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL of body with a name for a value that is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def spans_of(kind: str, text: str = "_text", found: str | None = None) -> str:
    """SQL array of (kind number, kind, start, end) of a pattern's matches that are long enough.

    Texts with a match are read once more for the gaps before the matches, each
    from the end of the one before; starts are the running sum of gaps and matches.
    Building an array by appending costs the square of its length. So the n
    matches are cut into blocks of n^(1/3): the sums of whole blocks, and then
    the places within each block, are appended apart, and the blocks joined once.
    """
    pattern, group, least = {**STRONG, **WEAK}[kind]
    found = found or f"regexp_extract_all({text}, {_quoted(pattern)}, 0)"
    flags = "(?i)" if pattern.startswith("(?i)") else ""
    gaps = f"regexp_extract_all({text}, {_quoted(flags + r'\G((?s:.*?))' + pattern.removeprefix('(?i)'))}, 1)"
    length = f"char_length(regexp_extract(m, {_quoted(pattern)}, {group}))" if group else "char_length(m)"
    number = KINDS.index(kind)
    none = "CAST(array() AS array<struct<n:int,kind:string,s:int,e:int>>)"
    sizes = f"zip_with({gaps}, {found}, (g, m) -> named_struct('g', char_length(g), 'm', char_length(m), 'ok', {length} >= {least}))"
    blocks = (
        "transform(sequence(0, CAST((size(z) - 1) DIV width AS int)), "
        "i -> slice(z, CAST(i * width + 1 AS int), CAST(width AS int)))"
    )
    starts = (
        "aggregate(transform(blocks, b -> aggregate(b, 0, (a, x) -> a + x.g + x.m)), "
        "named_struct('at', 0, 'out', CAST(array() AS array<int>)), "
        "(a, n) -> named_struct('at', a.at + n, 'out', concat(a.out, array(a.at))), a -> a.out)"
    )
    spans = (
        "flatten(zip_with(blocks, starts, (b, start) -> aggregate(b, "
        f"named_struct('at', start, 'out', {none}), (a, x) -> named_struct('at', a.at + x.g + x.m, 'out', "
        f"CASE WHEN x.ok THEN concat(a.out, array(named_struct('n', {number}, 'kind', '{kind}', "
        "'s', a.at + x.g, 'e', a.at + x.g + x.m))) ELSE a.out END), a -> a.out)))"
    )
    placed = _let(blocks, "blocks", _let(starts, "starts", spans))
    placed = _let(sizes, "z", _let("CAST(ceil(cbrt(size(z))) AS bigint)", "width", placed))
    return f"CASE WHEN size({found}) > 0 THEN {placed} ELSE {none} END"


def _row_key(docs: DataFrame):
    """Equal for equal rows only, also where doc_id is null or repeated."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))


def parts(docs: DataFrame) -> DataFrame:
    """Rows (_key, doc_id, _strong, _weak): the spans of each text, in order of start, then kind."""
    df = docs.select(_row_key(docs).alias("_key"), "doc_id", F.expr("coalesce(text, '')").alias("_text"))
    for kind, (pattern, _, _) in {**STRONG, **WEAK}.items():
        df = df.withColumn(f"_m_{kind}", F.expr(f"regexp_extract_all(_text, {_quoted(pattern)}, 0)"))
    for kind in KINDS:
        df = df.withColumn(f"_s_{kind}", F.expr(spans_of(kind, found=f"_m_{kind}")))

    def ordered(kinds: list[str]) -> str:
        rows = f"concat({', '.join(f'_s_{k}' for k in kinds)})"
        return f"array_sort(transform({rows}, x -> named_struct('s', x.s, 'n', x.n, 'kind', x.kind, 'e', x.e)))"

    return df.select(
        "_key",
        "doc_id",
        F.expr(ordered(list(STRONG))).alias("_strong"),
        F.expr(ordered(list(WEAK))).alias("_weak"),
    )


def link(found: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Rows (_key, _linked): the weak candidates whose complementary parts are in scope."""
    rows = (
        found.filter("size(_weak) > 0")
        .groupBy("_key")
        .agg(F.first("_strong").alias("_strong"), F.first("_weak").alias("_weak"))
        .select("_key", F.explode(F.concat("_strong", "_weak")).alias("p"))
        .select("_key", "p.*")
    )
    number = {k: i for i, k in enumerate(KINDS)}
    role = " ".join(f"WHEN {number[k]} THEN '{ROLE[k]}'" for k in KINDS)
    rows = rows.withColumn("role", F.expr(f"CASE n {role} END")).withColumn("strong", F.expr(f"n < {len(STRONG)}"))
    before = "(PARTITION BY _key ORDER BY s, n, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "(PARTITION BY _key ORDER BY s, n, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    # A part counts as complementary if it is strong, or weak and clear of strong spans.
    rows = rows.withColumn("touch", F.expr(
        f"NOT strong AND (coalesce(max(CASE WHEN strong THEN e END) OVER {before} > s, false) "
        f"OR coalesce(min(CASE WHEN strong THEN s END) OVER {after} < e, false))"
    )).filter("NOT touch")
    for r in ("id", "secret"):
        rows = rows.withColumn(
            f"near_{r}",
            F.expr(
                f"coalesce(max(CASE WHEN role = '{r}' THEN e END) OVER {before} >= s - {scope.reach}, false) "
                f"OR coalesce(min(CASE WHEN role = '{r}' THEN s END) OVER {after} <= e + {scope.reach}, false)"
            ),
        )
    needs = " ".join(
        f"WHEN {number[k]} THEN {' AND '.join(f'near_{r}' for r in roles)}" for k, roles in NEEDS.items()
    )
    return (
        rows.filter(F.expr(f"CASE n {needs} ELSE false END"))
        .groupBy("_key")
        .agg(F.array_sort(F.collect_list(F.struct("s", "n", "kind", "e"))).alias("_linked"))
    )


def scan(docs: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """One row per document: _key, doc_id, `base` and `spans`, arrays of (s, n, kind, e) in order."""
    found = stage(parts(docs), "secret-parts")
    linked = stage(link(found, scope), "secret-links")
    none = "CAST(array() AS array<struct<s:int,n:int,kind:string,e:int>>)"
    return found.join(linked, "_key", "left").select(
        "_key",
        "doc_id",
        F.col("_strong").alias("base"),
        F.expr(f"array_sort(concat(_strong, coalesce(_linked, {none})))").alias("spans"),
    )


def _may_link(matches: dict[str, str]) -> str:
    """SQL test, per row, for weak candidates that can have complements: an identifier and a secret are there."""
    some = {k: f"size({m}) > 0" for k, m in matches.items()}
    by_role = {r: " OR ".join(some[k] for k in KINDS if ROLE[k] == r) for r in ("id", "secret")}
    weak = " OR ".join(some[k] for k in WEAK)
    return f"({weak}) AND ({by_role['id']}) AND ({by_role['secret']})"


def _free(docs: DataFrame, name: str = "_w") -> str:
    """A name that no column of docs begins with."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def redact(docs: DataFrame, scope: Scope = Scope(), mark: str = "[secret]") -> DataFrame:
    """docs with each run of overlapping spans in the text replaced by a mark, and n_chars to match.

    Texts without a span, null included, stay as they are. Only rows that hold
    both an identifier and a secret, one of the parts weak, meet the result of
    the sweep, by a join; all others are finished where they are read.
    """
    w = _free(docs)
    number = {k: i for i, k in enumerate(KINDS)}
    found = parts(docs).filter("size(_weak) > 0")
    roles = {r: ", ".join(str(number[k]) for k in KINDS if ROLE[k] == r) for r in ("id", "secret")}
    both = [f"exists(concat(_strong, _weak), x -> x.n IN ({listed}))" for listed in roles.values()]
    linked = stage(link(stage(found.filter(" AND ".join(both)), "secret-parts"), scope), "secret-links")

    df = docs.withColumn(f"{w}t", F.expr("coalesce(text, '')"))
    matches = {kind: f"{w}m{kind}" for kind in KINDS}
    for kind, (pattern, _, _) in {**STRONG, **WEAK}.items():
        df = df.withColumn(matches[kind], F.expr(f"regexp_extract_all({w}t, {_quoted(pattern)}, 0)"))
    df = df.withColumn(f"{w}link", F.expr(_may_link(matches))).drop(*[matches[k] for k in WEAK])
    spans = ", ".join(spans_of(k, f"{w}t", matches[k]) for k in STRONG)
    none = "CAST(array() AS array<struct<s:int,n:int,kind:string,e:int>>)"

    def marked(rows: DataFrame, more: str) -> DataFrame:
        ordered = f"transform(concat({spans}), x -> named_struct('s', x.s, 'n', x.n, 'kind', x.kind, 'e', x.e))"
        rows = rows.withColumn(f"{w}s", F.expr(f"array_sort(concat({ordered}, {more}))"))
        pieces = (
            f"aggregate({w}s, named_struct('at', 0, 'out', ''), (a, x) -> named_struct("
            "'at', greatest(a.at, x.e), 'out', CASE WHEN x.s < a.at THEN a.out ELSE "
            f"concat(a.out, substring({w}t, a.at + 1, x.s - a.at), '{mark}') END), "
            f"a -> concat(a.out, substring({w}t, a.at + 1)))"
        )
        rows = rows.withColumn("text", F.expr(f"CASE WHEN size({w}s) = 0 THEN text ELSE {pieces} END"))
        if "n_chars" in docs.columns:
            rows = rows.withColumn("n_chars", F.expr(f"CASE WHEN size({w}s) = 0 THEN n_chars ELSE char_length(text) END"))
        return rows.select(*[F.col(f"`{c}`") for c in docs.columns])

    plain = marked(df.filter(f"NOT {w}link"), none)
    keyed = df.filter(f"{w}link").withColumn(f"{w}key", _row_key(docs))
    linked = linked.select(F.col("_key").alias(f"{w}k"), F.col("_linked").alias(f"{w}l"))
    joined_rows = keyed.join(linked, F.col(f"{w}key") == F.col(f"{w}k"), "left")
    return plain.union(marked(joined_rows, f"coalesce({w}l, {none})"))


def joined(spans: str) -> str:
    """SQL text kind:start:end, comma-joined."""
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [f"CAST(size(filter(base, x -> x.kind = '{k}')) AS bigint) AS n_{k}" for k in STRONG]
    return scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", *counts, f"sha2({joined('base')}, 256) AS base_sha256", f"{joined('spans')} AS spans"
    )


QUERIES = {"op5_secret_scans": (op5, None)}
