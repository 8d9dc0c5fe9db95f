"""Quality rules by distribution divergence.

Two histograms of a text, of character classes and of common words, are compared
with those of its language over the whole corpus by the Jensen-Shannon distance
(square root of the divergence to base 2, so between 0 and 1). A text that is
long enough for a histogram to mean something is rejected when the distance is
above the threshold; a shorter one isn't judged by it. Texts of fewer than
`min_words` words, or mostly made of repeated word windows, are rejected before.

Defined cases: null text is empty and so rejected; null or unknown language has
no reference and is judged by the base rules alone; repeated rows are judged
alike; an empty table gives an empty table; extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table, words

#: Common words of each language that has a reference.
COMMON_WORDS = {
    "en": "the of and to in is it that for was on are with as be by this from or at an",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "le la les de des du et en un une que qui dans pour par sur avec au est pas il",
    "es": "el la de que y en un ser se no los del las por con una su para es al lo",
}
#: Character classes besides lower-case ASCII letters and blanks, in the order in which they are taken out.
CLASSES = {
    "upper": r"\\p{Lu}+",
    "other_letter": r"[\\p{L}\\p{M}]+",
    "digit": r"\\p{N}+",
    "stop": "[.,;:!?\"()-]+",
    "symbol": "[#*$%&|<>]+",
}


@dataclass(frozen=True)
class Rules:
    """Production parameters; distances lie between 0 (alike) and 1."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    class_min_chars: int = 200
    class_distance: float = 0.35
    word_min_words: int = 100
    word_distance: float = 0.29


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add `_base` (the counts of the base rules) and the histograms `_classes` and `_common`."""
    df = docs.withColumn("_text", F.expr("coalesce(text, '')"))
    df = df.withColumn("_n", F.expr("char_length(_text)")).withColumn("_words", F.expr(words("_text")))
    df = df.withColumn("_word_chars", F.expr("char_length(array_join(_words, ''))"))
    # Runs of small letters and blanks go first, so that the other classes see a short rest.
    df = df.withColumn("_rest", F.expr(r"regexp_replace(_text, '[a-z\\x20\\x09-\\x0D]+', '')"))
    df = df.withColumn("_left", F.expr("char_length(_rest)"))
    counts, rest, before = ["_word_chars - _left", "_n - _word_chars"], "_rest", "_left"
    for name, pattern in CLASSES.items():
        df = df.withColumn(f"_r_{name}", F.expr(f"regexp_replace({rest}, '{pattern}', '')"))
        df = df.withColumn(f"_l_{name}", F.expr(f"char_length(_r_{name})"))
        counts.append(f"{before} - _l_{name}")
        rest, before = f"_r_{name}", f"_l_{name}"
    counts.append(before)
    df = df.withColumn("_classes", F.expr(f"transform(array({', '.join(counts)}), x -> CAST(x AS bigint))"))
    df = df.withColumn("_lines", F.expr(r"filter(split(_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    k = rules.window
    df = df.withColumn("_windows", F.expr("transform(_words, w -> xxhash64(w))"))
    width = 1
    while width < k:  # a window's hash comes from those of two shorter ones
        step = min(width, k - width)
        df = df.withColumn(
            "_windows",
            F.expr(
                f"CASE WHEN size(_windows) > {step} THEN zip_with(slice(_windows, 1, size(_windows) - {step}), "
                f"slice(_windows, {step + 1}, size(_windows) - {step}), (x, y) -> xxhash64(x, y)) "
                "ELSE CAST(array() AS array<bigint>) END"
            ),
        )
        width += step
    # Starts of windows found twice or more, then the words that they cover.
    df = df.withColumn(
        "_sorted",
        F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN "
            "array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"
        ),
    )
    df = df.withColumn(
        "_starts",
        F.expr(
            "array_sort(transform(filter(_sorted, (s, j) -> (j > 0 AND _sorted[greatest(j - 1, 0)].h = s.h) OR "
            "(j < size(_sorted) - 1 AND _sorted[least(j + 1, size(_sorted) - 1)].h = s.h)), s -> s.i))"
        ),
    )
    df = df.withColumn(
        "_covered",
        F.expr(
            "coalesce(aggregate(_starts, named_struct('n', 0L, 'last', -1), (a, s) -> named_struct("
            f"'n', a.n + CASE WHEN a.last < 0 THEN {k} ELSE least({k}, s - a.last) END, 'last', s), a -> a.n), 0L)"
        ),
    )
    df = df.withColumn(
        "_base",
        F.expr(
            "named_struct('n_words', CAST(size(_words) AS bigint), "
            "'word_chars', CAST(_word_chars AS bigint), 'n_symbols', _classes[6], "
            "'n_dup_lines', CAST(size(_lines) - size(array_distinct(_lines)) AS bigint), "
            "'n_repeat_words', _covered)"
        ),
    )
    by_language = " ".join(
        f"WHEN '{lang}' THEN transform(array({', '.join(repr(w) for w in listed.split())}), "
        "c -> CAST(coalesce(_bag[c], 0) AS bigint))"
        for lang, listed in COMMON_WORDS.items()
    )
    every = sorted({w for listed in COMMON_WORDS.values() for w in listed.split()})
    member = ", ".join(f"'{w}'" for w in every)
    # The few listed words of the text give the count of each.
    df = df.withColumn("_listed", F.expr(f"filter(_words, w -> w IN ({member}))"))
    df = df.withColumn(
        "_bag",
        F.expr("map_from_entries(transform(array_distinct(_listed), w -> struct(w, size(filter(_listed, x -> x = w)))))"),
    )
    df = df.withColumn("_hits", F.expr(f"CASE lang {by_language} END"))
    df = df.withColumn(
        "_common",
        F.expr("concat(_hits, array(CAST(size(_words) AS bigint) - aggregate(_hits, 0L, (a, x) -> a + x)))"),
    )
    return df.select(*docs.columns, "_base", "_classes", "_common")


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of character classes and common words per listed language, over all of its texts.

    At most one row per language of COMMON_WORDS is read.
    """
    n_classes = len(CLASSES) + 3
    n_words = max(len(x.split()) for x in COMMON_WORDS.values()) + 1
    sums = [F.sum(F.expr(f"CAST(_classes[{i}] AS decimal(38,0))")).alias(f"c{i}") for i in range(n_classes)]
    sums += [F.sum(F.expr(f"CAST(get(_common, {i}) AS decimal(38,0))")).alias(f"w{i}") for i in range(n_words)]
    out = {}
    for row in measured.filter(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang").agg(*sums).collect():
        classes = [int(row[f"c{i}"] or 0) for i in range(n_classes)]
        common = [int(row[f"w{i}"] or 0) for i in range(len(COMMON_WORDS[row["lang"]].split()) + 1)]
        if sum(classes) and sum(common):
            out[row["lang"]] = ([x / sum(classes) for x in classes], [x / sum(common) for x in common])
    return out


def js_distance(counts: str, reference: list[float]) -> str:
    """SQL of the Jensen-Shannon distance of an array of counts to fixed shares."""
    total = f"aggregate({counts}, 0L, (a, x) -> a + x)"
    shares = f"zip_with(transform({counts}, x -> x / {total}), array({', '.join(f'{x!r}D' for x in reference)}), "
    term = (
        "(p, q) -> CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0D END"
        " + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0D END)"
    )
    return f"CASE WHEN {total} > 0 THEN sqrt(greatest(0D, aggregate({shares}{term}, 0D, (a, x) -> a + x) / 2)) END"


def judge(measured: DataFrame, refs: dict[str, tuple[list[float], list[float]]], rules: Rules = Rules()) -> DataFrame:
    """Add the distances (null where a guard or a missing reference forbids one) and the verdict `kept`."""

    def distance(i: int, counts: str, guard: str) -> Column:
        cases = " ".join(f"WHEN lang = '{k}' THEN {js_distance(counts, v[i])}" for k, v in sorted(refs.items()))
        return F.expr(f"CASE WHEN NOT ({guard}) THEN CAST(NULL AS double) {cases} END")

    df = measured.withColumns(
        {
            "class_distance": distance(
                0, "_classes", f"aggregate(_classes, 0L, (a, x) -> a + x) >= {rules.class_min_chars}"
            ),
            "word_distance": distance(1, "_common", f"_base.n_words >= {rules.word_min_words}"),
            "base_failed": F.expr(
                f"_base.n_words < {rules.min_words} OR "
                f"100 * _base.n_repeat_words > {rules.max_repeat_percent} * _base.n_words"
            ),
        }
    )
    return df.withColumn(
        "kept",
        F.expr(
            f"NOT base_failed AND coalesce(class_distance <= {rules.class_distance}D, true) "
            f"AND coalesce(word_distance <= {rules.word_distance}D, true)"
        ),
    )


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """docs with `_base`, distances, base_failed and kept; reads docs twice, without a shuffle of texts."""
    measured = measure(docs, rules)
    return judge(measured, references(measured), rules)


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep.

    The condition also names the number of the partition, which isn't a function
    of the row: the optimiser then leaves the filter above the measurement,
    instead of repeating all of it within the condition.
    """
    judged = quality_rules(docs, rules).withColumn("_part", F.spark_partition_id())
    return judged.filter("kept AND _part >= 0").select(*docs.columns)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stage(
        measure(table(spark, sf_dir, "documents")).select("doc_id", "lang", "_base", "_classes", "_common"), "quality"
    )
    return judge(measured, references(measured)).select(
        "doc_id", "_base.*", "base_failed", "kept"
    )


def _sql(rules: Rules = Rules()) -> str:
    """The same rules for another engine: windows and words as rows, histograms as lists."""

    def n_of(pattern: str) -> str:
        return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"

    def distance(counts: str, shares: str) -> str:
        p, q = f"({counts}[i] / list_sum({counts}))", f"{shares}[i]"
        return f"""sqrt(greatest(0, list_sum(list_transform(range(1, len({counts}) + 1), lambda i:
          CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END
          + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)) / 2))"""

    hits = " ".join(
        f"WHEN '{k}' THEN [" + ", ".join(f"len(list_filter(ws, lambda x: x = '{w}'))" for w in v.split()) + "]"
        for k, v in COMMON_WORDS.items()
    )
    w, small, capital, blank = rules.window, n_of("[a-z]"), n_of(r"\p{Lu}"), r"\x20\x09-\x0D"
    lines = f"list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{blank}]'))"
    symbols = n_of("[#*$%&|<>]")
    parts = [small, n_of(f"[{blank}]"), capital, f"{n_of(r'[\p{L}\p{M}]')} - ({small}) - ({capital})"]
    parts += [n_of(r"\p{N}"), n_of('[.,;:!?"()-]'), symbols]
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{blank}]+') AS ws FROM documents),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + {w - 1}], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {w - 2})) AS i FROM d WHERE len(ws) >= {w})),
dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + {w})) AS j FROM dup) GROUP BY rid),
m AS (
  SELECT d.*, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, {symbols} AS n_symbols,
         len({lines}) AS n_lines, len(list_distinct({lines})) AS n_kinds, coalesce(c.n, 0) AS n_repeat_words,
         [{', '.join(parts)}] AS part, CASE lang {hits} END AS hits
  FROM d LEFT JOIN covered c ON c.rid = d.rid),
h AS (
  SELECT *, part || [length(t) - list_sum(part)] AS classes, hits || [n_words - list_sum(hits)] AS common,
         n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM m),
sums AS (
  SELECT lang, [{', '.join(f'sum(classes[{i}])' for i in range(1, 9))}] AS c,
         [{', '.join(f'sum(common[{i}])' for i in range(1, 32))}] AS w FROM h WHERE hits IS NOT NULL GROUP BY lang),
refs AS (
  SELECT lang, list_transform(c, lambda x: x / list_sum(c)) AS c,
         list_transform(w, lambda x: x / list_sum(w)) AS w FROM sums)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines - n_kinds AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND coalesce(list_sum(classes) < {rules.class_min_chars} OR {distance('classes', 'r.c')} <= {rules.class_distance}, true)
       AND coalesce(n_words < {rules.word_min_words} OR {distance('common', 'r.w')} <= {rules.word_distance}, true) AS kept
FROM h LEFT JOIN refs r ON r.lang = h.lang"""


QUERIES = {"op6_quality_rules": (op6, _sql())}
