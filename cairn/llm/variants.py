"""Spelling variants of a corpus's words by asymmetric q-chunks.

Words are counted over all texts; those long and frequent enough are compared.
Two words are near at one inserted, deleted or replaced code point. Of a pair,
the shorter word (length L) gives two disjoint chunks of L // 2 code points,
and the longer one all its positional grams of that length. One edit touches
at most one chunk, so the other stands in the longer word unchanged, shifted
by at most one (not at all where lengths are equal): chunk and gram join on
lengths, position and text. What meets is verified by the edit distance inside
the join, and a pair that meets twice is made one.

The join holds distinct words, never occurrences, and its keys are half words
at a place: as many words meet in one as differ in the other half alone. It is
a plain shuffled join, whose hot keys AQE splits.

A word's form is its most frequent near word where that is ``ratio`` times as
frequent. Counts grow by that factor at each step, so chains of forms are
short, and pointer doubling finds their ends in at most five joins.

Defined cases: a NULL text has no words; a NULL id counts as an empty one in
the damaged runs of ``with_slips``; repeated rows count each; an empty table gives no
words; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import ASCII_UPPER, ascii_lower, staged

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Words shorter or rarer than this are left out; a form is so many times as frequent.
LETTERS, OCCURRENCES, RATIO = 6, 5, 5
#: One of so many (id, run) loses a code point.
SLIP = 199


def with_slips(key: Column, run: Column, one_in: int = SLIP) -> Column:
    """The run, short of a code point where its checksum with the id says so."""
    h = F.crc32(F.encode(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run), "utf-8"))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(one_in)) == 0, cut).otherwise(run)


def counted(df: DataFrame, key: str, text: str, letters: int, slips: int | None) -> DataFrame:
    """Row per word: word, n."""
    runs = df.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= letters).select("key", ascii_lower(F.col("run")).alias("run"))  # a slip only shortens
    word = F.col("run") if slips is None else with_slips(F.col("key"), F.col("run"), slips)
    return runs.select(word.alias("word")).filter(F.length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs of near words of ``vocabulary`` (word, n), each once: a, n_a, b, n_b."""
    word, size = F.col("word"), F.length("word")
    half = F.floor(size / 2).cast("int")
    spot = lambda longer, at, part: F.struct(size.alias("size"), F.lit(longer).alias("longer"), at.alias("at"), part.alias("part"))
    first, second = F.substring(word, F.lit(1), half), F.substring(word, half + 1, half)
    zero = F.lit(0)
    chunks = [spot(longer, at + shift, part) for at, part in ((zero, first), (half, second)) for longer, shift in ((0, 0), (1, 0), (1, 1))]

    def grams(longer: int) -> Column:
        shorter = size - longer
        q = F.floor(shorter / 2).cast("int")
        return F.transform(F.sequence(zero, size - q), lambda i: F.struct(
            shorter.alias("size"), F.lit(longer).alias("longer"), i.alias("at"), F.substring(word, i + 1, q).alias("part")))

    short_side = vocabulary.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(*chunks)).alias("k")).select("a", "n_a", "k.*")
    long_side = (vocabulary.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.explode(F.concat(grams(0), grams(1))).alias("k"))
                 .select("b", "n_b", "k.*"))
    met = short_side.join(long_side, ["size", "longer", "at", "part"]).filter(((F.col("longer") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """The end of every word's chain of forms: ``forms`` (word, form) with ``root``."""
    reached, left = staged(forms.select("word", F.col("form").alias("root")), "variant-roots"), 1
    while left:
        on = reached.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = reached.join(on, F.col("root") == F.col("_word"), "left")
        reached = staged(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "variant-roots")
        left = reached.filter("moved").count()
        reached = reached.drop("moved")
    return reached


def group(df: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO,
          slips: int | None = None) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n. ``slips`` damages
    one of so many runs on purpose (for tests of the grouping on clean texts)."""
    vocabulary = staged(counted(df, key, text, letters, slips).filter(F.col("n") >= occurrences), "variant-words")
    pairs = staged(near_pairs(vocabulary), "variant-pairs")
    both = pairs.unionAll(pairs.select("b", "n_b", "a", "n_a"))
    best = F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("_word"), "n_a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n_a")
    near = staged(near.select("_word", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "variant-forms")
    ends = roots(near.filter(F.col("form").isNotNull()).select(F.col("_word").alias("word"), "form")).withColumnRenamed("word", "_end")
    joined = vocabulary.join(near, F.col("word") == F.col("_word"), "left").join(ends, F.col("word") == F.col("_end"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def oracle(letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO, slips: int = SLIP) -> str:
    """The same groups in DuckDB SQL: words that agree after one position is
    blanked or cut out. CRC-32 is folded over the bytes by its table, which is
    made from the polynomial."""
    low = f"translate(run, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"
    return f"""
WITH RECURSIVE bits(byte, c, step) AS (
  SELECT b, b, 0 FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT byte, xor(c // 2, (c % 2) * {0xEDB88320}), step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS crc FROM bits WHERE step = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
lowered AS (SELECT doc_id, {low} AS run, count(*) AS n FROM runs WHERE length(run) >= {letters} GROUP BY ALL),
encoded AS (
  SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS bytes FROM lowered),
hashed AS (
  SELECT run, n, xor({0xFFFFFFFF}, list_reduce(bytes, lambda h, b: xor(h // 256, crc[xor(h % 256, b) + 1]), CAST({0xFFFFFFFF} AS BIGINT))) AS h FROM encoded, crc_table),
slipped AS (SELECT CASE WHEN h % {slips} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= {letters} GROUP BY word HAVING sum(n) >= {occurrences}),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shapes AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM spots),
near AS (
  SELECT x.word AS a, y.word AS b, y.n FROM shapes x JOIN shapes y ON x.i = y.i AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM words x JOIN shapes y ON x.word = y.head || y.tail
  UNION SELECT x.word, y.word, y.n FROM shapes x JOIN words y ON x.head || x.tail = y.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n FROM near GROUP BY a),
formed AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {ratio} * w.n THEN form END AS form, CASE WHEN form_n >= {ratio} * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best ON a = word),
chain(word, stop) AS (SELECT word, word FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.stop WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.stop AS root FROM chain c JOIN formed f ON f.word = c.stop WHERE f.form IS NULL)
SELECT f.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed f JOIN ends ON ends.word = f.word"""
