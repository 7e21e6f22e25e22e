"""Mixing sources to target weights by Pareto order sampling.

Every source has a target, its weight's share of the mix. A target stops at
``cap`` times the source's words and what it cannot use is reshared by weight
(water filling: sources by words per weight, each saturated while the share
that is left reaches it).

Inside a source the expected copies of a document are ``k`` times its
importance, at most ``cap``; the default importance is the number of binary
digits of its size, so that longer documents are repeated a little sooner. ``k``
makes the expected words equal the target. The whole copies of the expectation
are certain; the rest ``p`` of it is an inclusion probability. Pareto order
sampling draws ``u`` and ranks a source's documents by their random odds over
their inclusion odds, ``u / (1 - u)`` over ``p / (1 - p)``, and takes the first
of them up to the words that are left. The sample has a fixed size, so a
source meets its target up to half of the one document at the cut.

No source is ever sorted. Words are summed per source and bucket of the rank
(whose cut lies near 1), and only the documents of the bucket that holds the
cut are ranked one by one. The draw is a hash of the id and the text, so
reruns agree however the rows are dealt.

Only a table with a row per source is ordered in one task, and joined tables
(a row per source and importance) are broadcast only where Spark finds them
small enough.

Defined cases: a NULL text has size 0; a document of size 0 has taken 0; a
NULL source is a source, the last one; rows that repeat id, source and text
share one draw, and are taken alike; NULL ids draw by their text; an empty
table gives an empty result; of the other columns only those of ``carry`` are
read, and come back in a struct, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import staged

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
#: Words of the mix by words of the input; copies of a document, at most.
SHARE, CAP = 1.5, 2
#: Rank buckets of width 1 / ``FINE``; ranks from ``TOP`` on share the last one.
FINE, TOP = 32_768, 4
#: Hexadecimal digits of the draw: all of them fit a double.
DIGITS = 13


def draw(key: Column, text: Column, seed: str) -> Column:
    """A number inside (0, 1) that depends on id, text and seed alone."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: int) -> DataFrame:
    """``sources`` (source, source_size) with its target."""
    at = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weighed = sources.select("*", at.alias("at")).withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("at") - 1) % len(weights) + 1))
    most = F.col("source_size") * cap
    by_need = Window.orderBy(most / F.col("weight"), "at")
    earlier, later = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(most).over(earlier), F.lit(0))
    level = weighed.withColumn("level", left / F.sum("weight").over(later))
    open_level = F.max(F.when(F.col("level") * F.col("weight") < most, F.col("level"))).over(everything)
    target = F.least(F.coalesce(open_level * F.col("weight"), most.cast("double")), most.cast("double"))
    return level.select("source", "source_size", target.alias("target"))


def plan(sized: DataFrame, weights: Sequence[float], share: float, cap: int) -> DataFrame:
    """Per source and importance: certain copies, inclusion probability ``p``,
    and the words that its source still draws."""
    classes = sized.groupBy("source", "importance").agg(F.sum("size").alias("words"))
    aimed = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap).withColumnRenamed("source", "_source")
    rows = classes.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    down = Window.partitionBy("source").orderBy(F.desc("importance"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("importance") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    k = F.when(rest > 0, (F.col("target") - above * cap) / rest)
    whole_source = Window.partitionBy("source")
    rows = rows.withColumn("k", k).withColumn("k", F.max(F.when(F.col("k") * F.col("importance") < cap, F.col("k"))).over(whole_source))
    copies = F.least(F.coalesce(F.col("k") * F.col("importance"), F.lit(float(cap))), F.lit(float(cap)))
    rows = rows.withColumn("copies", copies).withColumn("certain", F.floor("copies"))
    left = F.greatest(F.col("target") - F.sum(F.col("certain") * F.col("words")).over(whole_source), F.lit(0.0))
    return rows.select(F.col("source").alias("_source"), F.col("importance").alias("_importance"), "source_size", "target", "certain",
                       (F.col("copies") - F.col("certain")).alias("p"), left.alias("draws"))


def cuts(ranked: DataFrame) -> DataFrame:
    """Per source whose drawn words do not take every document: the bucket of
    the last one taken, and its rank there (NULL: none of that bucket)."""
    open_rows = ranked.filter(F.col("rank").isNotNull())
    sums = open_rows.groupBy("source", "bucket", "draws").agg(F.sum("size").alias("words"))
    earlier = lambda by, order: Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(earlier("source", "bucket")), F.lit(0))
    edge = (sums.select("*", before.alias("before"))
            .filter((F.col("before") <= F.col("draws")) & (F.col("draws") < F.col("before") + F.col("words")))
            .select(F.col("source").alias("_source"), F.col("bucket").alias("cut_bucket"), "before"))
    near = open_rows.join(edge, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("cut_bucket")))
    units = near.groupBy("source", "cut_bucket", "before", "draws", "rank").agg(F.sum("size").alias("words"))
    middle = F.col("before") + F.coalesce(F.sum("words").over(earlier("source", "rank")), F.lit(0)) + F.col("words") / 2
    return (units.select("*", (middle <= F.col("draws")).alias("taken"))
            .groupBy(F.col("source").alias("_source"), "cut_bucket").agg(F.max(F.when(F.col("taken"), F.col("rank"))).alias("cut_rank")))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        cap: int = CAP, importance: Column | None = None, seed: str = "mix", carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: key, size, source_size, target, taken, copies
    (and ``row``, a struct of the columns of ``carry``). ``importance`` is a
    positive whole number per row of ``df``."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    marks = F.length(F.bin("size")) if importance is None else F.col("_importance")
    given = [] if importance is None else [importance.cast("bigint").alias("_importance")]
    row = [F.struct(*carry).alias("row")] if carry else []
    sized = df.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), draw(F.col(key), F.col(text), seed).alias("u"), *given, *row)
    sized = staged(sized.select("key", "source", "size", "u", marks.alias("importance"), *(["row"] if carry else [])), "mixing-sizes")
    planned = staged(plan(sized.drop("row"), weights, share, cap), "mixing-plan")

    same = F.col("source").eqNullSafe(F.col("_source"))
    u, p = F.col("u"), F.col("p")
    rank = F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) / (p / (1 - p)))
    ranked = (sized.join(planned, same & (F.col("importance") == F.col("_importance"))).drop("_source", "_importance")
              .withColumn("rank", rank).withColumn("bucket", F.floor(F.least("rank", F.lit(float(TOP))) * FINE)))
    cut = staged(cuts(ranked.drop("row")), "mixing-cuts")
    joined = ranked.join(cut, same, "left")
    drawn = F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket")) | ((F.col("bucket") == F.col("cut_bucket")) & (F.col("rank") <= F.col("cut_rank")))
    copies = F.when(F.col("size") > 0, F.col("certain") + F.when(F.col("rank").isNotNull() & F.coalesce(drawn, F.lit(False)), 1).otherwise(0)).otherwise(0)
    return joined.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * copies).cast("bigint").alias("taken"),
                         copies.cast("int").alias("copies"), *(["row"] if carry else []))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``mix`` as often as it is taken, with its number."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))


def oracle(weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = "mix") -> str:
    """The same mix in DuckDB SQL, each source sorted as a whole."""
    first = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    rest = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    digest = f"md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, '')))"
    return f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    (CAST('0x' || substr({digest}, 1, {DIGITS}) AS BIGINT) + 0.5::DOUBLE) / {16**DIGITS}::DOUBLE AS u FROM documents),
sized AS (SELECT *, length(bin(size)) AS importance FROM docs),
weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS nr,
    [{", ".join(f"{w}::DOUBLE" for w in weights)}][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () * {share}::DOUBLE - coalesce(sum({cap} * source_size) OVER (ORDER BY {cap} * source_size / weight, nr {first}), 0))
    / sum(weight) OVER (ORDER BY {cap} * source_size / weight, nr {rest}) AS level FROM weighed),
aimed AS (
  SELECT source, source_size,
    least(coalesce(max(CASE WHEN level * weight < {cap} * source_size THEN level END) OVER () * weight, {cap}::DOUBLE * source_size), {cap}::DOUBLE * source_size) AS target
  FROM levels),
classes AS (SELECT source, importance, sum(size) AS words FROM sized GROUP BY ALL),
slopes AS (
  SELECT c.*, a.source_size, a.target,
    (a.target - {cap} * coalesce(sum(words) OVER (PARTITION BY c.source ORDER BY importance DESC {first}), 0))
      / nullif(CAST(sum(importance * words) OVER (PARTITION BY c.source ORDER BY importance DESC {rest}) AS DOUBLE), 0) AS k
  FROM classes c JOIN aimed a ON a.source IS NOT DISTINCT FROM c.source),
expected AS (
  SELECT *, least(coalesce(max(CASE WHEN k * importance < {cap} THEN k END) OVER (PARTITION BY source) * importance, {cap}::DOUBLE), {cap}::DOUBLE) AS copies FROM slopes),
certain AS (
  SELECT *, floor(copies) AS whole, copies - floor(copies) AS p,
    greatest(target - sum(floor(copies) * words) OVER (PARTITION BY source), 0::DOUBLE) AS draws FROM expected),
ranked AS (
  SELECT doc_id, s.source, size, source_size, target, whole, draws, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank
  FROM sized s JOIN certain c ON c.source IS NOT DISTINCT FROM s.source AND c.importance = s.importance),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, rank) AS unit,
    sum(size) OVER (PARTITION BY source ORDER BY rank RANGE UNBOUNDED PRECEDING) AS upto FROM ranked WHERE rank IS NOT NULL
  UNION ALL SELECT *, NULL, NULL FROM ranked WHERE rank IS NULL),
counted AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE CAST(whole AS BIGINT) + CASE WHEN upto - unit / 2 <= draws THEN 1 ELSE 0 END END AS copies FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies FROM counted"""
