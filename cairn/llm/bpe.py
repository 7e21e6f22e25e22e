"""Byte-level BPE encoding and decoding from a file of ranks.

1. Words (matches of the pattern) of all documents are counted by Spark, and
   the most frequent distinct ones, at most ``KNOWN`` of ``LONG`` bytes, are
   encoded with higher-order functions: an aggregate folds ranked merges over
   the word's array of bytes; ranks come from a literal map, held as an array
   of hash buckets so that a look-up reads one bucket.
2. Documents are encoded in one pass without a shuffle. The folded words are a
   broadcast of bounded size; any other word is merged in the task, from a
   heap of ranked pairs, in O(n log n) of its bytes.
3. Decoding concatenates the ids' binary pieces.

Defined cases: NULL or empty text has no ids; texts and words of any length
are encoded whole; rows that repeat are encoded each; special tokens have no
meaning; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import staged

#: Distinct words that are folded and broadcast, and the longest of them in bytes.
KNOWN, LONG = 200_000, 32
#: Other words whose ids a task remembers.
REMEMBERED = 300_000
BUCKETS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def spark_pattern(pattern: str) -> str:
    """The pattern with Unicode white space spelled out for Java."""
    return pattern.replace("\\s", "\\p{IsWhite_Space}").replace("\\S", "\\P{IsWhite_Space}")


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal array of buckets, by the low bits of xxhash64."""
    import xxhash

    table: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        table[xxhash.xxh64_intdigest(piece, 42) % BUCKETS].append({"k": base64.b64encode(piece).decode(), "r": rank})
    return F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<array<struct<k:binary,r:int>>>")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a word, as a fold of ranked merges over its bytes."""
    table = rank_map(ranks)
    bucket = lambda piece: F.get(table, F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int"))
    rank = lambda piece: F.get(F.filter(bucket(piece), lambda e: e["k"] == piece), F.lit(0))["r"]
    raw = F.encode(word, "utf-8")
    single = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(raw, i, F.lit(1)))

    def merge(pieces: Column, _) -> Column:
        pair = lambda i: F.concat(F.get(pieces, i), F.get(pieces, i + 1))
        ranked = F.transform(F.sequence(F.lit(0), F.size(pieces) - 2), lambda i: rank(pair(i)))

        def joined(r: Column) -> Column:
            at = F.array_position(r, F.array_min(r)).cast("int")
            whole = F.concat(F.slice(pieces, F.lit(1), at - 1), F.array(pair(at - 1)), F.slice(pieces, at + 2, F.size(pieces)))
            return F.when(F.array_min(r).isNull(), pieces).otherwise(whole)

        return F.when(F.size(pieces) < 2, pieces).otherwise(bound(ranked, joined))

    steps = F.sequence(F.lit(1), F.octet_length(word))
    return F.transform(F.aggregate(steps, single, merge), rank)


def frequent_words(df: DataFrame, text: str, pattern: str, known: int = KNOWN) -> DataFrame:
    """The distinct words, counted over all texts, from the least power of two
    of occurrences that leaves at most ``known`` of them. (No global sort: the
    driver sees how many words each power has.)"""
    found = df.select(F.explode(F.regexp_extract_all(text, F.lit(spark_pattern(pattern)), F.lit(0))).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n")).filter(F.octet_length("word").between(1, LONG))
    powers = staged(counts.select("word", F.floor(F.log2("n")).cast("int").alias("power")), "words")
    sizes = {r.power: r.n for r in powers.groupBy("power").agg(F.count("*").alias("n")).collect()}  # at most 63
    least = max(sizes, default=0) + 1
    while sizes and least > 0 and sum(n for p, n in sizes.items() if p >= least - 1) <= known:
        least -= 1
    return powers.filter(F.col("power") >= least).select("word")


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the lowest-ranked pair first, leftmost on ties."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    piece, after, before = [word[i : i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, word[i : i + 2]) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if piece[i] else n
        if j >= n or piece[i] + piece[j] != pair:
            continue  # one of the two was merged away
        piece[i], piece[j], after[i] = pair, b"", after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and (b := after[a]) < n and (r := ranks.get(both := piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (r, a, both))
    return [ranks[p] for p in piece if p]


def encode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", known: int = KNOWN) -> DataFrame:
    """One row per input row: key, n_tokens, ids (unsigned 32-bit, little-endian)."""
    ranks = read_ranks(ranks_path)
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    words = frequent_words(docs, "text", pattern, known)
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    rows = words.repartition(tasks).select("word", folded(F.col("word"), ranks).alias("ids")).toArrow()  # at most ``known`` words
    table = {w: np.array(i, "<u4").tobytes() for w, i in zip(rows["word"].to_pylist(), rows["ids"].to_pylist(), strict=True)}
    sent = df.sparkSession.sparkContext.broadcast((ranks, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        ranks, folded_words = sent.value
        split, held = regex.compile(pattern).findall, dict(folded_words)
        most = len(held) + REMEMBERED

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = np.array(merged(word.encode("utf-8", "surrogatepass"), ranks), "<u4").tobytes()
                if len(self) < most and len(word) <= LONG:
                    self[word] = ids
                return ids

        known = Words(held)
        del held
        for batch in batches:
            ids = [b"".join(map(known.__getitem__, split(t or ""))) for t in batch.column("text").to_pylist()]
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, pa.array(ids, pa.binary())], names=[key, "n_tokens", "ids"])

    return docs.mapInArrow(run, f"`{key}` long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that its ids stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast({rank: piece for piece, rank in read_ranks(ranks_path).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = sent.value.__getitem__
        for batch in batches:
            text = [b"".join(map(piece, np.frombuffer(x.as_buffer(), "<u4").tolist())) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.binary())], names=[*batch.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")
