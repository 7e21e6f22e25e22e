"""Divergence of a language's sources by the terms they use.

Terms are counted by length-bucketed packing. A task looks at the UTF-8 bytes
of a slice of texts at once: a table of 256 entries says which bytes belong to
a term and lower-cases them, and runs of such bytes are the terms. Those of up
to 8 bytes are packed big-endian into one uint64, those of up to 16 into two,
radix-sorted by 16-bit digits behind the digit of their (lang, source) group,
and counted as runs; a radix sort is stable, so the documents of a run are in
order and its distinct ones are counted too. Longer terms go to a bucket of
fixed-width byte strings per length class and are byte-sorted there; beyond
``WIDEST`` bytes they are sorted one by one. What leaves a task are its counts.

Spark sums them per (lang, source, term), keeps the terms that are in enough
of the lang's documents, and compares groups by sparse sums: a source that
lacks a term has the same share for all of those, so a pair of sources meets
only on terms that both have, and each source's own terms come in as a table
of how many have which count. The output itself holds every ordered pair of
a lang's sources.

Shares are whole numbers (billionths): all arithmetic is exact.

Defined cases: NULL text, lang and source are empty; a group without kept terms has
the even share everywhere, and differs by 0 from others where its lang keeps
none; repeated rows count as documents each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, staged

#: A term is kept in a lang where it is in so many of its documents; terms reported per group.
DOCUMENTS, TOP = 10, 10
#: Bytes of text that are counted together, and the widest byte-sorted bucket.
SLICE, WIDEST = 4 << 20, 256
UNIT = 1_000_000_000

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= ord("A")) & (_BYTES <= ord("Z"))) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | (_BYTES >= 0x80)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)


def radix_order(words: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """The stable order by group, then by the words, the first one leading: a
    pass for each 16-bit digit, the last one first."""
    order = np.arange(len(group))
    digits = [((w >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.uint16) for w in reversed(words) for s in (0, 16, 32, 48)]
    digits += [((group >> s) & 0xFFFF).astype(np.uint16) for s in ((0, 16) if len(group) and group.max() > 0xFFFF else (0,))]
    for digit in digits:
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(changes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted rows, where ``changes`` marks the first of each run (with
    documents in order): starts, rows and distinct documents of the runs."""
    starts = np.flatnonzero(changes)
    fresh = changes | np.concatenate([[True], doc[1:] != doc[:-1]])
    return starts, np.diff(np.append(starts, len(changes))), np.add.reduceat(fresh.astype(np.int64), starts)


class Counts:
    """Counted terms as columns: group, term bytes, n, documents."""

    def __init__(self) -> None:
        self.group: list[np.ndarray] = []
        self.term: list[pa.Array] = []
        self.n: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []

    def add(self, group: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> None:
        if len(group):
            self.group.append(group)
            self.term.append(terms)
            self.n.append(n)
            self.docs.append(docs)

    def table(self) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        if not self.group:
            return np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(self.group), pa.concat_arrays(self.term), np.concatenate(self.n), np.concatenate(self.docs)


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow string column."""
    ends = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[at].tobytes()))


def count_slice(data: np.ndarray, doc_starts: np.ndarray, group_of: np.ndarray) -> Counts:
    """The terms of one slice: bytes, the start of each document and, by
    document, a group number."""
    out, padded = Counts(), np.concatenate([_LOWER[data], np.zeros(16, np.uint8)])
    inside = np.concatenate([[False], _LETTER[data], [False]])
    edge = inside[1:] & ~inside[:-1]
    first = doc_starts[doc_starts < len(data)]
    edge[first] = inside[1:][first]  # a document's first byte starts a term, whatever stands before it
    start = np.flatnonzero(edge)
    stop = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if len(stop) != len(start):  # terms of two documents that touch
        stop = np.union1d(stop, first[(first > 0) & inside[1:][first] & inside[:-1][first]])
    length = stop - start
    doc = np.searchsorted(doc_starts, start, side="right") - 1
    group = group_of[doc]

    for low, n_words in ((0, 1), (8, 2)):
        pick = np.flatnonzero((length > low) & (length <= low + 8))
        if not len(pick):
            continue
        s, size = start[pick], length[pick]
        words = []
        for k in range(n_words):
            chars = padded[s[:, None] + np.arange(8 * k, 8 * k + 8)]
            chars[np.arange(8 * k, 8 * k + 8) >= size[:, None]] = 0
            words.append(chars.view(">u8").ravel().astype(np.uint64))
        order = radix_order(words, group[pick])
        keys = [w[order] for w in words] + [group[pick][order]]
        changes = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        at, n, docs = runs(changes, doc[pick][order])
        chosen = order[at]
        out.add(keys[-1][at], _strings(padded, s[chosen], size[chosen]), n, docs)

    top, width = int(length.max()) if len(length) else 0, 16
    while width < min(top, WIDEST):  # buckets of up to 32, 64 ... bytes
        pick = np.flatnonzero((length > width) & (length <= 2 * width))
        width *= 2
        if not len(pick):
            continue
        s, size = start[pick], length[pick]
        chars = padded[np.minimum(s[:, None] + np.arange(width), len(padded) - 1)]
        chars[np.arange(width) >= size[:, None]] = 0
        flat = chars.view(f"S{width}").ravel()  # numpy drops the zeros behind a term, which has none itself
        order = np.argsort(flat, kind="stable")
        order = order[np.argsort(group[pick][order], kind="stable")]
        flat, g = flat[order], group[pick][order]
        changes = np.concatenate([[True], (flat[1:] != flat[:-1]) | (g[1:] != g[:-1])])
        at, n, docs = runs(changes, doc[pick][order])
        chosen = order[at]
        out.add(g[at], _strings(padded, s[chosen], size[chosen]), n, docs)

    pick = np.flatnonzero(length > max(width, 16))
    if len(pick):
        rows = sorted((int(group[i]), padded[start[i] : stop[i]].tobytes(), int(doc[i])) for i in pick)
        n, docs = Counter(r[:2] for r in rows), Counter(r[:2] for r in set(rows))
        terms = list(n)
        out.add(np.array([g for g, _ in terms]), pa.array([t.decode() for _, t in terms]),
                np.array([n[t] for t in terms]), np.array([docs[t] for t in terms]))
    return out


def _cut(data: np.ndarray, size: int) -> list[np.ndarray]:
    """Pieces of about ``size`` bytes, cut behind a byte that is in no term."""
    pieces, at = [], 0
    while len(data) - at > size:
        stop = at + size
        while stop < len(data) and _LETTER[data[stop - 1]]:
            stop += 1
        pieces.append(data[at:stop])
        at = stop
    return [*pieces, data[at:]]


def _long_text(data: np.ndarray) -> Counts:
    """One document beyond a slice, piece by piece; it counts as one document."""
    total: Counter[str] = Counter()
    for piece in _cut(data, SLICE):
        _, terms, n, _ = count_slice(piece, np.zeros(1, np.int64), np.zeros(1, np.int64)).table()
        total.update(dict(zip(terms.to_pylist(), n.tolist(), strict=True)))
    out = Counts()
    out.add(np.zeros(len(total), np.int64), pa.array(list(total), pa.string()), np.array(list(total.values()), np.int64), np.ones(len(total), np.int64))
    return out


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counts, names: list[tuple[str, str]]) -> pa.RecordBatch:
        group, term, n, docs = counts.table()
        lang, source = (pa.array([x[i] for x in names], pa.string()).take(pa.array(group)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        # a batch may be a view of a larger one: offsets are taken as they stand
        text = batch.column("text").cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
        at = 0
        while at < len(text):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
            if offsets[stop] - offsets[at] > SLICE:
                yield rows(_long_text(data[offsets[at] : offsets[stop]]), names[at : at + 1])
            else:
                seen = {x: i for i, x in enumerate(dict.fromkeys(names[at:stop]))}
                groups = np.array([seen[x] for x in names[at:stop]], np.int64)
                yield rows(count_slice(data[offsets[at] : offsets[stop]], offsets[at:stop] - offsets[at], groups), list(seen))
            at = stop


def counted_terms(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Row per lang, source and term: n occurrences in docs documents."""
    bounded_batches(df.sparkSession)
    plain = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    rows = plain.mapInArrow(_term_rows, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """Billionths of a smoothed share, at least 1, exact for any count; 1 where there are no terms."""
    wide = lambda c: c.cast("decimal(26,0)")
    part = _quotient(F.lit(UNIT) * (wide(n) + 2), wide(total) + 2 * wide(terms))
    return (1 + F.when(terms > 0, part).otherwise(0)).cast("bigint")


def distance(p: Column, q: Column) -> Column:
    """(p - q) squared over p + q, rounded down; both are at most 1,000,000,001."""
    return _quotient((p - q) * (p - q), p + q)


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """Row per lang, source and other source (part ``pair``), and per one of
    its most overused terms (part ``term``): lang, source, part, item, value, rank."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = staged(counted_terms(df, text, lang, source), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= documents).drop("docs")
    own = staged(counts.drop("docs").join(kept, ["lang", "term"]), "kept-terms")

    per_lang = own.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    size = own.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    per_group = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own_terms"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    groups = (df.select(plain(lang).alias("lang"), plain(source).alias("source")).distinct()
              .join(per_group, ["lang", "source"], "left").join(size, "lang", "left").join(per_lang, "lang", "left")
              .select("lang", "source", *map(none, ("total", "own_terms", "terms", "lang_total"))))
    groups = staged(groups.withColumn("even", share(F.lit(0), F.col("total"), F.col("terms"))), "term-groups")

    shares = own.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    of_lang = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value).alias("rank")
    over = (shares.withColumn("q", of_lang).filter(F.col("p") > F.col("q"))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
            .select("*", rank).filter(F.col("rank") <= top))

    side = lambda df, name, *cols: df.select("lang", *cols[1:], *(F.col(c).alias(f"{name}_{c}") for c in ("source", *cols[0])))
    p = {name: F.col(f"{name}_p") for name in "ab"}
    even = {name: F.col(f"{name}_even") for name in "ab"}
    met = side(shares, "a", ("p", "even"), "term").join(side(shares, "b", ("p", "even"), "term"), ["lang", "term"]).filter("a_source < b_source")
    extra = distance(p["a"], p["b"]) - distance(p["a"], even["b"]) - distance(even["a"], p["b"])
    met = met.groupBy("lang", "a_source", "b_source").agg(F.sum(extra).alias("extra"), F.count(F.lit(1)).alias("shared"))
    alike = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("of"))
    alone = (side(alike, "a", ("p", "of")).join(side(groups, "b", ("even",)), "lang").filter("a_source <> b_source")
             .groupBy("lang", "a_source", "b_source").agg(F.sum(F.col("a_of") * distance(p["a"], even["b"])).alias("alone")))
    one_way = F.when(F.col("a_source") < F.col("b_source"), F.col("a_source")).otherwise(F.col("b_source"))
    other_way = F.when(F.col("a_source") < F.col("b_source"), F.col("b_source")).otherwise(F.col("a_source"))
    alone = alone.groupBy("lang", one_way.alias("a_source"), other_way.alias("b_source")).agg(F.sum("alone").alias("alone"))
    ends = ("own_terms", "even")
    pairs = side(groups, "a", ends, "terms").join(side(groups, "b", ends), "lang").filter("a_source < b_source")
    pairs = pairs.join(met, ["lang", "a_source", "b_source"], "left").join(alone, ["lang", "a_source", "b_source"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    in_none = F.col("terms") - F.col("a_own_terms") - F.col("b_own_terms") + zero("shared")
    value = (zero("alone") + zero("extra") + in_none * distance(even["a"], even["b"])).cast("bigint")
    ways = F.explode(F.array(*(F.struct(F.col(f"{x}_source").alias("source"), F.col(f"{y}_source").alias("item")) for x, y in ("ab", "ba"))))
    pairs = pairs.select("lang", value.alias("value"), ways.alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    return pairs.select("*", rank).unionAll(over)


def oracle(documents: int = DOCUMENTS, top: int = TOP) -> str:
    """The same audit in DuckDB SQL, over every group and kept term."""
    share_of = lambda n, total: f"1 + ({UNIT}::HUGEINT * ({n} + 2)) // ({total} + 2 * terms)"
    distance_of = lambda p, q: f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS nr, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
said AS (SELECT nr, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{upper}', '{upper.lower()}') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM said GROUP BY ALL HAVING count(DISTINCT nr) >= {documents}),
sizes AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang),
here AS (SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM here GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, {share_of("coalesce(h.n, 0)", "coalesce(t.total, 0)")} AS p, {share_of("k.n", "s.total")} AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN here h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum({distance_of("a.p", "b.p")}) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, {distance_of("p", "q")} FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
