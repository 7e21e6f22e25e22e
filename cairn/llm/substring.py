"""Substring deduplication: remove words covered by a repeated 35-word window.

Windows are counted through their anchor: the window's least 8-word hash (first
one on ties). Equal windows have equal anchors at equal places, and successive
windows share one, so a document is a list of *runs* of windows of one anchor,
about one run for 14 windows, and no window occurs twice inside a run.

1. Count-min prefilter. Every task counts its runs' anchors in a partial
   sketch of ``DEPTH`` rows, cut into shards; shards are merged by addition
   (saturating at two). A merged cell is never below the true count of any
   window counted there, so a window whose anchor stays below two is unique.
   The sketch has a fixed number of cells: 32 MB as bits, the only thing that
   is broadcast, whatever the corpus. The driver passes its shards on as tasks
   have compressed them, and drops the broadcast after the pass that reads it.
   A fuller sketch lets more through and loses nothing; ``cells`` is the knob
   for larger corpora.
2. The second pass emits only runs whose anchor is estimated repeated, and
   groups whole runs exactly by (anchor, hash of the run): equal runs settle
   all their windows at once.
3. Anchors that have different runs are marked in a bitmap of the same size.
   A third pass emits the window hashes of those runs alone, and groups them
   exactly by (anchor, window hash) - 128 bits, sums of partial counts, no
   group collected.
4. Starts of repeated windows go back to their documents.

Defined cases: NULL or empty text has no words and keeps nothing; texts of
fewer than 35 words are kept whole; rows that repeat count as further
documents; rows are matched by id (NULL allowed) and text hash, so an id may
recur with other text; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, slices, staged
from cairn.llm.minhash import mixed

WINDOW = 35
GRAM = 8
DEPTH = 2
CELLS = 1 << 27
SHARDS = 64
#: Of the merged shards.
CODEC = "zstd"
#: Anchors a task counts before it emits a partial sketch.
FLUSH = 500_000


#: Bytes of text whose words are hashed at once; a longer text is not cut.
SLICE = 1 << 19
#: Bytes of the longest word that is hashed together with others.
LONG_WORD = 64
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and how many words
    each text has. All words take their next eight bytes at once."""
    import xxhash

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    chars = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets, size = offsets - offsets[0], len(chars)
    inside = np.zeros(size + 2, bool)  # the byte before
    inside[1:-1] = (chars != 32) & (chars - np.uint8(9) > 4)
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    stop = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    length = stop - start
    hashes = length.astype(np.uint64) * _STEP
    eights = np.ndarray(size + 1, "<u8", np.concatenate([chars, np.zeros(8, np.uint8)]), strides=(1,))
    of = np.flatnonzero(length <= LONG_WORD)
    at, left = start[of], length[of]
    while len(of):
        hashes[of] = mixed(hashes[of] ^ eights[at] & _MASKS[np.minimum(left, 8)])
        more = np.flatnonzero(left > 8)
        of, at, left = of[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(chars[start[i] : stop[i]])
    return hashes, np.diff(np.searchsorted(start, offsets))


def least_at(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` successive values is (first one on ties)."""
    at, low, span = np.arange(len(values)), values, 1
    while span < width:
        step = min(span, width - span)
        at = np.where(low[step:] < low[:-step], at[step:], at[:-step])
        low, span = np.minimum(low[step:], low[:-step]), span + step
    return at


class Found(NamedTuple):
    """Runs of several texts: the text's number, the anchor, the first window
    (counted in the words of all texts and in those of its own), the number of
    windows, and the first window minus the anchor's place."""

    row: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    start: np.ndarray
    length: np.ndarray
    offset: np.ndarray

    def where(self, keep: np.ndarray) -> Found:
        return Found(*(x[keep] for x in self))


class Runs:
    """Texts to runs of windows that share an anchor.

    Grams, windows and the words of whole runs are hashed alike: the sum of
    word hashes times powers of an odd number, modulo 2**64. It is a difference
    of two prefix sums, moved to power zero, whatever the number of words."""

    FACTOR = 0xD1342543DE82EF95

    def __init__(self, window: int = WINDOW, gram: int = GRAM) -> None:
        self.window, self.gram = window, gram
        self.powers = self.inverse = np.ones(0, np.uint64)

    def __call__(self, texts: pa.Array) -> tuple[Found, np.ndarray]:
        """The runs, and the prefix sums that hash their words."""
        w, n = hashed_words(texts)
        if len(w) > len(self.powers):
            self.powers, self.inverse = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(w) * 5 // 4, f, np.uint64)])
                                         for f in (self.FACTOR, pow(self.FACTOR, -1, 1 << 64)))
        sums = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(w * self.powers[: len(w)], out=sums[1:])
        many, begin = np.maximum(n - self.window + 1, 0), np.cumsum(n) - n
        ends = np.cumsum(many)
        if not many.any():
            none = np.empty(0, np.int64)
            return Found(none, none.view(np.uint64), none, none, none, none), sums
        grams = mixed((sums[self.gram :] - sums[: -self.gram]) * self.inverse[: len(sums) - self.gram])
        windows = np.repeat(begin - ends + many, many) + np.arange(ends[-1])  # those within one text
        at = least_at(grams, self.window - self.gram + 1)[windows]
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        row, first = np.searchsorted(ends, new, side="right"), windows[new]
        return Found(row, grams[at[new]], first, first - begin[row], np.diff(np.r_[new, len(at)]), first - at[new]), sums

    def _hashes(self, sums: np.ndarray, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return mixed((sums[first + n] - sums[first]) * self.inverse[first])

    def window_hashes(self, sums: np.ndarray, found: Found) -> np.ndarray:
        """Of the windows of each run, in order."""
        ends = np.cumsum(found.length)
        return self._hashes(sums, np.repeat(found.first - ends + found.length, found.length) + np.arange(found.length.sum()), self.window)

    def span_hashes(self, sums: np.ndarray, found: Found) -> np.ndarray:
        """A hash of each run: its words in order and its place at the anchor."""
        place = (found.length * self.window + found.offset + self.window).astype(np.uint64)
        return mixed(self._hashes(sums, found.first, found.length + self.window - 1) + place * _STEP)


def cells_of(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mixed(anchors + np.uint64(row + 1)) & np.uint64(cells - 1)).astype(np.int64)


def partial_bits(anchors: np.ndarray, cells: int) -> Iterator[tuple[int, bytes]]:
    """(shard, cells met there with whether more than once) of a task's anchors."""
    wide = cells // SHARDS
    for row in range(DEPTH):
        cell, n = np.unique(cells_of(anchors, row, cells), return_counts=True)
        cuts = np.searchsorted(cell, np.arange(0, cells + 1, wide))
        for s, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if hi > lo:
                yield row * SHARDS + s, ((cell[lo:hi] - s * wide) * 2 + (n[lo:hi] > 1)).astype(np.uint32).tobytes()


def merged_bits(rows: DataFrame, anchors_of: Callable[[], Callable[[pa.RecordBatch], Iterator[np.ndarray]]], cells: int, least: int) -> dict[int, bytes]:
    """The merged sketch of all anchors as bits: 1 where a cell counts ``least``
    or more. By shard, compressed; shards without anchors are left out."""
    if cells & (cells - 1) or cells < 8 * SHARDS:
        raise ValueError(f"cells must be a power of two of at least {8 * SHARDS}")
    wide = cells // SHARDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held, size = anchors_of(), [], 0

        def partial() -> pa.RecordBatch:
            shard, blob = zip(*partial_bits(np.concatenate(held), cells), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(blob, pa.binary())], names=["shard", "blob"])

        for batch in batches:
            for anchors in find(batch):
                held.append(anchors)
                size += len(anchors)
                if size >= FLUSH:
                    yield partial()
                    held, size = [], 0
        if size:
            yield partial()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(wide, np.uint8)
        packed = lambda: pa.compress(np.packbits(counts >= least).tobytes(), codec=CODEC, asbytes=True)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed()], pa.binary())], names=["shard", "bits"])
        for batch in batches:
            for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob"), strict=True):
                if shard != now:
                    if now is not None:
                        yield done()
                    now, counts = shard, np.zeros(wide, np.uint8)
                held = np.frombuffer(blob.as_py(), np.uint32)
                counts[held >> 1] = np.minimum(2, counts[held >> 1] + 1 + (held & 1).astype(np.uint8))
        if now is not None:
            yield done()

    merged = (rows.mapInArrow(count, "shard int, blob binary").repartition(DEPTH * SHARDS, "shard")
              .sortWithinPartitions("shard").mapInArrow(merge, "shard int, bits binary"))
    shards = merged.toArrow()  # DEPTH * cells bits at most, before they were compressed
    return dict(zip(shards["shard"].to_pylist(), shards["bits"].to_pylist(), strict=True))


def unpacked_bits(shards: dict[int, bytes], cells: int) -> np.ndarray:
    """The whole sketch, eight cells a byte."""
    size = cells // SHARDS // 8
    bits = np.zeros(DEPTH * SHARDS * size, np.uint8)
    for s, blob in shards.items():
        bits[s * size : (s + 1) * size] = np.frombuffer(pa.decompress(blob, decompressed_size=size, codec=CODEC), np.uint8)
    return bits


def marked(bits: np.ndarray, anchors: np.ndarray, cells: int) -> np.ndarray:
    """Which anchors have all their cells set."""
    keep = np.ones(len(anchors), bool)
    for row in range(DEPTH):
        cell = cells_of(anchors, row, cells) + row * cells
        keep &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return keep


def marked_runs(docs: DataFrame, runs, shards: dict[int, bytes], cells: int, hashes: bool, name: str) -> DataFrame:
    """Runs whose anchor is marked: id, print, anchor, span, start, length, and
    with ``hashes`` the hashes of their windows. Staged under ``name``, so that
    the sketch need not be kept."""
    shared = docs.sparkSession.sparkContext.broadcast(shards)
    names = ["id", "print", "anchor", "span", "start", "length", *(["hashes"] if hashes else [])]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = runs(), unpacked_bits(shared.value, cells)
        longs, ints = lambda x: pa.array(x.view(np.int64)), lambda x: pa.array(x.astype(np.int32))
        for batch in slices(batches, size=SLICE):
            found, sums = find(batch.column("text"))
            found = found.where(marked(held, found.anchor, cells))
            if len(found.row):
                of = pa.array(found.row)
                columns = [batch.column("id").take(of), batch.column("print").take(of), longs(found.anchor), longs(find.span_hashes(sums, found)),
                           ints(found.start), ints(found.length)]
                if hashes:
                    columns.append(pa.ListArray.from_arrays(ints(np.r_[0, np.cumsum(found.length)]), longs(find.window_hashes(sums, found))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id long, print long, anchor long, span long, start int, length int" + ", hashes array<long>" * hashes
    found = staged(docs.mapInArrow(emit, schema), name)
    shared.destroy()
    return found


def repeated_stretches(docs: DataFrame, runs, cells: int) -> DataFrame:
    """(id, print, start, length): windows that occur more than once."""

    def in_texts():
        find = runs()
        return lambda batch: (find(part.column("text"))[0].anchor for part in slices(iter([batch]), size=SLICE))

    def in_rows():
        return lambda batch: iter([batch.column("anchor").to_numpy().view(np.uint64)])

    suspected = marked_runs(docs, runs, merged_bits(docs.select("text"), in_texts, cells, 2), cells, False, "runs")
    spans = staged(suspected.groupBy("anchor", "span").agg(F.count("*").alias("n")), "spans")
    whole = suspected.join(spans.filter("n > 1").select("anchor", "span"), ["anchor", "span"]).select("id", "print", "start", "length")
    several = spans.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
    differing = marked_runs(docs, runs, merged_bits(several, in_rows, cells, 1), cells, True, "differing")
    again = staged(differing.select("anchor", F.explode("hashes").alias("hash")).groupBy("anchor", "hash")
                   .agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "hash"), "windows")
    single = differing.join(spans.filter("n = 1").select("anchor", "span"), ["anchor", "span"])
    parts = (single.select("id", "print", "anchor", "start", F.posexplode("hashes").alias("at", "hash"))
             .join(again, ["anchor", "hash"]).select("id", "print", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("length")))
    return whole.union(parts)


def cut_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                cells: int = CELLS, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: key, text_print (64-bit hash of the text),
    n_words, n_removed, kept_text (kept words joined by one space). With
    ``carry`` also a struct ``row`` of the columns named there, and kept_text
    is NULL where nothing is removed."""
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("print"), F.col(text).cast("string").alias("text"))
    stretches = repeated_stretches(docs, lambda: Runs(window, gram), cells)
    # a document's own stretches, at most its own words
    cuts = stretches.groupBy("id", "print").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
    cuts = staged(cuts, "cuts").withColumnsRenamed({"id": "cut_id", "print": "cut_print"})
    only_cut = carry is not None

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_text: string>")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, all_cuts in columns:
            total, gone, kept = [], [], []
            for text, spans in zip(texts, all_cuts, strict=True):  # one text at a time is a Python string
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                edge = np.zeros(len(words) + 1, np.int64)
                if spans.is_valid:
                    start = spans.values.field("start").to_numpy()
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + spans.values.field("length").to_numpy() + window - 1, -1)
                stay = np.cumsum(edge[:-1]) == 0
                total.append(len(words))
                gone.append(len(words) - int(stay.sum()))
                if only_cut and not gone[-1]:
                    kept.append(None)
                else:
                    kept.append(b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]).decode("utf-8", "replace"))
            yield pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["n_words", "n_removed", "kept_text"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("print"), F.col(text).cast("string").alias("text"),
                     *([F.struct(*carry).alias("row")] if carry else []))
    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("print") == F.col("cut_print")), "left")
    done = joined.select("id", "print", cut("text", "cuts").alias("c"), *(["row"] if carry else []))
    return done.select(F.col("id").alias(key), F.col("print").alias("text_print"), "c.n_words", "c.n_removed", "c.kept_text", *(["row"] if carry else []))
