"""Rule-based quality filter: a threshold table compiled into Spark expressions.

``THRESHOLDS`` names a measure with the least and greatest value a kept
document may have. ``judge`` compiles measures and table into projections of
built-in functions over the whole text; there is no user function and no
shuffle. Ratios are compared by cross-multiplication free division on doubles,
identical on every engine.

Repeated three-word windows are found per document: each window is a 64-bit
hash of its words; only if two hashes of the document agree, the
(hash, position) pairs are sorted and neighbours compared, O(n log n) for any
length. (Two different windows of one document share a hash with a chance of
about n^2 / 2^65.)

Defined cases: NULL or blank text has no words, all counts 0, and fails the
base rule; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import words

SYMBOLS = "[#*$%&|<>]"
#: A whole word without a letter.
NO_LETTER = "(?<![^\\x20\\x09-\\x0D])[^\\p{L}\\x20\\x09-\\x0D]+(?![^\\x20\\x09-\\x0D])"
#: Function words of the corpus languages, compared as written.
STOP_WORDS = (
    "the of and to in is that for it was on with as by at this be are or an a from "
    "der die das und ist von mit den im zu ein eine nicht für auf "
    "le la les de et est un une des en que du pour dans avec "
    "el los las y del con por para se no lo"
).split()
#: measure, least, greatest (None: unbounded)
THRESHOLDS = (
    ("mean_word_chars", 2.5, 12.0),
    ("symbol_ratio", None, 0.1),
    ("stop_word_ratio", 0.05, None),
    ("letter_word_ratio", 0.8, None),
    ("dup_line_ratio", None, 0.4),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def window_hashes(w: Column) -> Column:
    """A hash for each run of three words, in order."""
    each = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 3, F.slice(each, 1, F.greatest(F.size(w) - 2, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))


def repeat_positions(hashes: Column) -> Column:
    """Starts, ascending, of the windows whose hash occurs more than once."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))

    def marked(s: Column) -> Column:
        return F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))

    # one-element transforms bind the sorted array once
    return F.flatten(F.transform(F.array(ranked), lambda s: F.sort_array(F.transform(marked(s), lambda x: x["i"]))))


def covered_words(starts: Column) -> Column:
    """Words lying in at least one three-word window that begins at ``starts``."""
    gap = lambda p, i: F.coalesce(F.get(starts, i + 1) - p, F.lit(3))
    return F.aggregate(F.transform(starts, lambda p, i: F.least(F.lit(3), gap(p, i)).cast("long")),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def measured(df: DataFrame, key: str, text: str, carry: list[str] | None = None) -> DataFrame:
    """key, the counts that the measures are made of, and a struct ``row``."""
    base = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"), F.struct(*(carry or [F.col(key)])).alias("row"))
    cut = base.select("key", "row", "t", words(F.col("t")).alias("w"), F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    hashed = cut.withColumn("hashes", window_hashes(F.col("w")))
    n = F.size
    found = hashed.select(
        "key", "row",
        n("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        matches(F.col("t"), SYMBOLS).alias("n_symbols"),
        n("lines").cast("long").alias("n_lines"),
        (n("lines") - n(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n(F.filter("lines", lambda x: x.rlike("^[\\x20\\x09-\\x0D]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        n(F.filter("lines", lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        n(F.filter("w", lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        (n("w") - matches(F.col("t"), NO_LETTER)).cast("long").alias("n_letter_words"),
        F.when(n("hashes") > n(F.array_distinct("hashes")), repeat_positions(F.col("hashes"))).alias("starts"),
    )
    return found.withColumn("n_repeat_words", F.coalesce(covered_words(F.col("starts")), F.lit(0).cast("long"))).drop("starts")


def measures() -> dict[str, Column]:
    """The measures by name, over the columns of ``measured``."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "letter_word_ratio": per("n_letter_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "bullet_line_ratio": per("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": per("n_ellipsis_lines", "n_lines"),
    }


def within(thresholds=THRESHOLDS) -> Column:
    """The table as one condition."""
    ok, by_name = F.lit(True), measures()
    for name, least, most in thresholds:
        if least is not None:
            ok = ok & (by_name[name] >= least)
        if most is not None:
            ok = ok & (by_name[name] <= most)
    return ok


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", thresholds=THRESHOLDS, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: key, counts, base_failed, kept, and a struct
    ``row`` of the columns in ``carry``."""
    counts = measured(df, key, text, carry)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & within(thresholds)).alias("kept"), *(["row"] if carry else []))


def oracle() -> str:
    """The same judgement in DuckDB SQL."""
    gap = "'[\\x20\\x09-\\x0D]+'"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    per = lambda a, b: f"(CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0 END)"
    made = {"mean_word_chars": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"),
            "stop_word_ratio": per("n_stop", "n_words"), "letter_word_ratio": per("n_letter", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"), "bullet_line_ratio": per("n_bullet", "n_lines"),
            "ellipsis_line_ratio": per("n_ellipsis", "n_lines")}
    ok = " AND ".join(f"{made[m]} {op} {v}" for m, lo, hi in THRESHOLDS for op, v in ((">=", lo), ("<=", hi)) if v is not None)
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), {gap}), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM spots),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS n_bullet,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_ellipsis,
    len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop,
    len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM cut LEFT JOIN repeated USING (doc_id)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND {ok} AS kept
FROM base"""
