"""MinHash near-duplicate groups with min-max hashing.

A document's set holds its distinct five-word shingles (64-bit hashes of
ASCII-lower-cased words; fewer words: the whole sequence as one). Min-max
hashing keeps the least *and* the greatest value of every permutation, so 512
permutations give 1024 unbiased signature values for half the hash
evaluations. The first 270 values form 45 bands of six (a pair at Jaccard 0.75
shares no band with a chance of 0.00015); one bit of every value is kept as a
sketch, whose Hamming distance bounds the similarity in the second round.

1. Documents with equal sets become one class, represented by its least id.
2. Of every band bucket, each member is compared with the bucket's least id
   (a star, not all pairs). Confirmed links give components.
3. Buckets that still hold several components are joined with themselves
   *across* components. Size ratio (exact) and sketch distance (within 3.5
   standard deviations of the threshold) are join conditions, and a pair is
   met only in the first bucket it shares; what passes is confirmed on the
   full sets. Pairs inside a component need no link.

Links are confirmed in blocks of pairs that carry both texts, from a table of
those documents that share a bucket at all. No bucket, class or component is
ever collected; a hot key is a plain shuffled join that AQE may split.

Defined cases: text that is NULL or has no words has an empty set and links
with nothing; repeated rows are one class; a NULL id never links, its
component is NULL and it is kept; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, staged
from cairn.llm.components import connected

SHINGLE = 5
THRESHOLD = 75
PERMUTATIONS = 512
BANDS, ROWS = 45, 6
#: Sketch bits of a pair at the threshold agree with 0.875 each.
SKETCH_LONGS = 2 * PERMUTATIONS // 64
AGREE = (1 + THRESHOLD / 100) / 2
SKETCH_LIMIT = int((1 - AGREE + 3.5 * (AGREE * (1 - AGREE) / (2 * PERMUTATIONS)) ** 0.5) * 2 * PERMUTATIONS)
#: Words a task remembers the hash of.
WORD_CACHE = 120_000


def _odd(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (xor-shift and multiply rounds)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word bytes to 64-bit hash; remembers the first ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = value
        return value


class Shingler:
    def __init__(self) -> None:
        self.hashes = WordHashes()
        self.factors = _odd(np.random.default_rng(11), SHINGLE)

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        k = min(SHINGLE, len(w))
        last = len(w) - k + 1
        total = np.full(last, k, np.uint64)
        for i in range(k):
            total += w[i : i + last] * self.factors[i]
        return np.unique(mixed(total))


class Signer:
    def __init__(self) -> None:
        rng = np.random.default_rng(23)
        self.a, self.b = _odd(rng, PERMUTATIONS)[:, None], rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)[:, None]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """Least and greatest value of each permutation, alternating."""
        low = np.full(PERMUTATIONS, ~np.uint64(0))
        high = np.zeros(PERMUTATIONS, np.uint64)
        for at in range(0, len(shingles), 256):
            y = shingles[at : at + 256] * self.a + self.b
            low, high = np.minimum(low, y.min(1)), np.maximum(high, y.max(1))
        return np.stack([low, high], 1).ravel()


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = mixed(signature[: BANDS * ROWS].reshape(BANDS, ROWS))
    return mixed((rows * _odd(np.random.default_rng(5), ROWS)).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def sketch(signature: np.ndarray) -> np.ndarray:
    return np.packbits((mixed(signature) & np.uint64(1)).astype(np.uint8)).view(np.uint64)


def signatures(docs: DataFrame) -> DataFrame:
    """(id, hash, text) to id, hash, n (set size), digest of the set, band keys, sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingles, signed = Shingler(), Signer()
        for batch in batches:
            n, digests, keys, bits = [], [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py())
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signature = signed(s) if len(s) else None
                keys.append(band_keys(signature).view(np.int64) if len(s) else None)
                bits.append(sketch(signature).view(np.int64) if len(s) else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(keys, longs), pa.array(bits, longs)], names=["id", "hash", "n", "digest", "keys", "bits"])

    return docs.mapInArrow(sign, "id long, hash long, n long, digest binary, keys array<long>, bits array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs of sets (a, set_a, b, set_b) the ids (a, b) of those that reach
    the threshold; ``texts`` has one row for each (id, set)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        recent: dict[tuple[int, int], np.ndarray] = {}

        def of(key: tuple[int, int], text) -> np.ndarray:
            if key not in recent:
                while len(recent) > 64:
                    recent.pop(next(iter(recent)))
                recent[key] = shingles(text.as_py())
            return recent[key]

        for batch in batches:
            a, b = (list(zip(batch.column(s).to_pylist(), batch.column(f"set_{s}").to_pylist(), strict=True)) for s in "ab")
            linked = []
            for i, (p, q) in enumerate(zip(a, b, strict=True)):
                x, y = of(p, batch.column("text_a")[i]), of(q, batch.column("text_b")[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(bool(both) and 100 * both >= THRESHOLD * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    side = lambda s: texts.select(F.col("id").alias(s), F.col("set").alias(f"set_{s}"), F.col("text").alias(f"text_{s}"))
    both = pairs.join(side("b"), ["b", "set_b"]).join(side("a"), ["a", "set_a"])
    return both.select("a", "set_a", "b", "set_b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def candidate_texts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, set, text), one row for each of ``sets`` (id, set, recurs). Most ids
    have one row; the rows of ids that recur are reduced to one for each set,
    copies before they are shuffled."""
    once = docs.join(sets.filter("NOT recurs").select("id", "set"), "id").select("id", "set", "text")
    again = sets.filter("recurs").select(F.col("id").alias("of"), "set")
    rows = docs.join(again.select("of").distinct(), F.col("id") == F.col("of"), "left_semi").dropDuplicates(["id", "hash"])
    rows = rows.join(again, (F.col("id") == F.col("of")) & ((F.col("set") == 0) | (F.col("set") == F.col("hash"))))
    return once.unionByName(rows.select("id", "set", "text").dropDuplicates(["id", "set"]))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id, kept. Links are
    between ids; the texts of an id that has several are each compared."""
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    signed = staged(signatures(docs.select("id", "hash", "text")), "signatures")
    usable = signed.filter("id IS NOT NULL AND digest IS NOT NULL")
    first_row = F.min(F.struct("id", "hash")).alias("first")
    classes = staged(usable.groupBy("digest").agg(first_row).select("digest", F.col("first.id").alias("rep"), F.col("first.hash").alias("rep_hash")), "classes")
    recurring = staged(usable.groupBy("id").agg(F.count("*").alias("rows"), (F.min("digest") != F.max("digest")).alias("several"))
                       .filter("rows > 1").select("id", "several"), "recurring")
    # a set is known by its id, and where that has several by the hash of the text too
    of_class = (usable.digest == classes.digest) & (F.col("id") == F.col("rep")) & (F.col("hash") == F.col("rep_hash"))
    reps = staged(usable.join(classes, of_class, "left_semi").dropDuplicates(["id", "digest"]).join(recurring, "id", "left")
                  .select("id", F.when(F.col("several"), F.col("hash")).otherwise(F.lit(0).cast("long")).alias("set"),
                          F.col("several").isNotNull().alias("recurs"), "n", "keys", "bits"), "reps")

    members = reps.select("id", "set", "recurs", F.posexplode("keys").alias("band", "bucket"))
    me = F.struct("id", "set")
    shared = staged(members.groupBy("bucket").agg(F.min(me).alias("lead"), F.max(me).alias("top"))
                    .filter("lead < top").select("bucket", F.col("lead.id").alias("lead"), F.col("lead.set").alias("lead_set")), "buckets")
    members = staged(members.join(shared, "bucket"), "members")
    texts = staged(candidate_texts(docs, members.select("id", "set", "recurs").distinct()), "texts")
    star = members.filter("id > lead").select(F.col("lead").alias("a"), F.col("lead_set").alias("set_a"), F.col("id").alias("b"), F.col("set").alias("set_b")).distinct()
    links = staged(confirmed(star, texts), "links")

    # the second round: across the components of a bucket
    first = connected(links)
    placed = staged(members.join(first, "id", "left").select("id", "set", "band", "bucket", F.coalesce("component", "id").alias("part")), "placed")
    split = staged(placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"))
                   .filter("low < high").select("bucket"), "split")
    open_rows = placed.join(split, "bucket").join(reps.select("id", "set", "n", "bits", "keys"), ["id", "set"])
    side = staged(open_rows.select("band", "bucket", "part", "id", "set", "n", "keys", *(F.col("bits")[i].alias(f"s{i}") for i in range(SKETCH_LONGS))), "open")
    a, b = side.alias("x"), side.alias("y")
    apart = sum((F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(SKETCH_LONGS)), F.lit(0))
    near = ((F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.part") != F.col("y.part"))
            & (100 * F.least("x.n", "y.n") >= THRESHOLD * F.greatest("x.n", "y.n")) & (apart <= SKETCH_LIMIT)
            & (F.array_position(F.zip_with("x.keys", "y.keys", lambda p, q: p == q), True) == F.col("x.band") + 1))  # their first common bucket
    crossing = a.join(b, near).select(F.col("x.id").alias("a"), F.col("x.set").alias("set_a"), F.col("y.id").alias("b"), F.col("y.set").alias("set_b")).distinct()
    more = staged(confirmed(crossing, texts), "links")

    # an id with several sets joins their classes
    joins = usable.join(recurring.filter("several"), "id", "left_semi").join(classes, "digest").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    groups = connected(links.union(more).union(joins))
    by_class = staged(classes.join(groups, classes.rep == groups.id, "left")
                      .select("digest", F.coalesce("component", "rep").alias("component")), "by-class")
    found = signed.select("id", "n", "digest").join(by_class, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
