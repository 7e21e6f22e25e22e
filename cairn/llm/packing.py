"""Packing documents into fixed-size sequences by cutting-stock patterns.

A document's ids (with an end id) are cut only where they exceed a sequence:
full sequences first, then one remainder. How the remainders share sequences
is a cutting-stock problem over their length histogram, at most ``size - 1``
numbers however large the corpus. Its bins of ``STEP`` tokens, by their middle,
are the pieces of a linear program over patterns, solved by column generation
(revised simplex), where a knapsack dynamic program over the dual prices finds
the next patterns. Rounded-down counts of full patterns are used with exact
lengths that fit; what they leave over is filled largest first.

The pieces of each length are ranked over all documents without sorting or
collecting any: a task counts its own, counts are summed over earlier tasks,
and rank decides pattern, sequence and offset by arithmetic.

Defined cases: NULL or empty text is one piece holding the end id; repeated
rows are packed each; NULL ids are packed under a NULL id; an empty table has
no pieces; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, ddl, slices, staged
from cairn.llm.tokens import CHARS_AT_ONCE, encoder, read_vocabulary

SIZE = 1024
END = 0
#: Bins of the length histogram, in tokens. Column generation ends this near to the program's bound, or after so many
#: pivots; each knapsack gives up to ``COLUMNS`` patterns.
STEP = 16
GAP, PIVOTS, COLUMNS = 0.001, 3000, 8
#: Patterns less full than this are left to the final filling.
FILLED = 0.99


def pieces(df: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """Row per piece: key, start, length, ids (binary, unsigned 32-bit), doc_tokens."""
    bounded_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value)
        for batch in slices(batches, size=CHARS_AT_ONCE):
            of, starts, lengths, ids, totals = [], [], [], [], []
            for row, tokens in enumerate(encode(batch.column("text"))):
                tokens += last
                total = len(tokens) // 4
                for at in range(0, total, size):
                    here = min(size, total - at)
                    of.append(row)
                    starts.append(at)
                    lengths.append(here)
                    ids.append(tokens[4 * at : 4 * (at + here)])
                    totals.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                                              pa.array(ids, pa.binary()), pa.array(totals, pa.int64())], names=[key, "start", "length", "ids", "doc_tokens"])

    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return docs.mapInArrow(cut, f"`{key}` long, start long, length long, ids binary, doc_tokens long")


def knapsack(price: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the greatest value within
    each capacity, and the last piece taken there (0: none). price[l] is what
    a piece of length l is worth."""
    value, last = np.zeros(size + 1), np.zeros(size + 1, int)
    for c in range(1, size + 1):
        with_last = value[c - 1 :: -1] + price[1 : c + 1]
        best = int(with_last.argmax())
        value[c], last[c] = (with_last[best], best + 1) if with_last[best] > value[c - 1] + 1e-12 else (value[c - 1], 0)
    return value, last


def traced(last: np.ndarray, capacity: int, first: int) -> dict[int, int]:
    """The pattern of ``first`` and the best pieces beside it."""
    pattern, c = defaultdict(int, {first: 1}), capacity - first
    while c > 0:
        if last[c]:
            pattern[int(last[c])] += 1
        c -= max(1, int(last[c]))
    return dict(pattern)


def fractional_patterns(demand: dict[int, int], size: int) -> list[tuple[dict[int, int], float]]:
    """A solution of the pattern program, (pattern, times), by column
    generation; feasible after any pivot, so that ``PIVOTS`` may end it."""
    lengths = np.array(sorted(demand))
    row = np.zeros(size + 1, int)
    row[lengths] = np.arange(len(lengths))
    need = np.array([demand[int(x)] for x in lengths], float)
    patterns = [{int(x): size // int(x)} for x in lengths]
    inverse = np.diag([1.0 / (size // int(x)) for x in lengths])
    times, dual = inverse @ need, inverse.sum(0)
    floor, pivots = float(lengths @ need) / size, 0
    while pivots < PIVOTS:
        price = np.zeros(size + 1)
        price[lengths] = np.maximum(dual, 0)
        value, last = knapsack(price, size)
        floor = max(floor, times.sum() / max(value[size], 1.0))
        worth = price[lengths] + value[size - lengths]
        better = [int(x) for x in lengths[np.argsort(-worth)[:COLUMNS]] if price[x] + value[size - x] > 1 + 1e-9]
        if not better or times.sum() - floor <= GAP * floor:
            break
        for x in better:
            pattern = traced(last, size, x)
            at, n = row[list(pattern)], np.array(list(pattern.values()), float)
            if dual[at] @ n <= 1 + 1e-9:
                continue
            step = inverse[:, at] @ n
            ratio = np.where(step > 1e-9, np.maximum(times, 0) / np.where(step > 1e-9, step, 1), np.inf)
            out = int(ratio.argmin())
            theta, pivot = ratio[out], inverse[out] / step[out]
            times -= theta * step
            times[out] = theta
            dual += pivot * (1 - dual[at] @ n)
            inverse -= np.outer(step, pivot)
            inverse[out] = pivot
            patterns[out] = pattern
            pivots += 1
    return list(zip(patterns, times.tolist(), strict=True))


def whole_patterns(demand: dict[int, int], size: int = SIZE, step: int = STEP) -> list[tuple[dict[int, int], int]]:
    """Patterns with whole counts that use every piece exactly once."""
    left = {x: n for x, n in sorted(demand.items()) if n}
    bins: dict[int, list[int]] = defaultdict(list)
    for x in left:
        bins[(x - 1) // step * step + (step + 1) // 2].append(x)
    plan: list[tuple[dict[int, int], int]] = []

    def use(slots: list[int], times: int) -> None:
        pattern = dict(Counter(slots))
        plan.append((pattern, times))
        for x, k in pattern.items():
            left[x] -= k * times

    def exact(pattern: list[int]) -> list[int]:
        """A length for every slot, the longest that leaves room for the
        shortest of the others; empty if the bins have none."""
        slots, room = [], size
        spare = lambda b: (x for x in bins[b] if left[x] > slots.count(x))
        for i, b in enumerate(pattern):
            kept = sum(next(spare(c), size + 1) for c in pattern[i + 1 :])
            x = max((x for x in spare(b) if x + kept <= room), default=0)
            if not x:
                return []
            slots.append(x)
            room -= x
        return slots

    program = fractional_patterns({b: sum(left[x] for x in xs) for b, xs in bins.items()}, size) if len(bins) > 1 else []
    for pattern, times in program:
        times, each = int(times + 1e-6), [b for b, k in sorted(pattern.items(), reverse=True) for _ in range(k)]
        while times and sum(each) >= FILLED * size and (slots := exact(each)):
            n = min(times, *(left[x] // k for x, k in Counter(slots).items()))
            use(slots, n)
            times -= n
    while any(left.values()):
        room, slots = size, []
        for x in sorted((x for x, n in left.items() if n), reverse=True):
            k = min(room // x, left[x])
            slots += [x] * k
            room -= k * x
        use(slots, min(left[x] // k for x, k in Counter(slots).items()))
    return plan


class Places:
    """Where the piece of a length and rank goes, from the pattern plan."""

    def __init__(self, demand: dict[int, int], size: int) -> None:
        rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        taken: dict[int, int] = defaultdict(int)
        at = 0
        shorter = {x: n for x, n in demand.items() if x < size}
        if full := demand.get(size):
            rows[size].append((0, at, 1, 0))
            at += full
        for pattern, times in whole_patterns(shorter, size):
            offset = 0
            for x, k in sorted(pattern.items(), reverse=True):
                rows[x].append((taken[x], at, k, offset))
                taken[x] += k * times
                offset += k * x
            at += times
        self.rows = {x: np.array(r, np.int64) for x, r in rows.items()}
        self.sequences = at

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for x in np.unique(length):
            here = length == x
            table = self.rows[int(x)]
            first, base, each, at = table[np.searchsorted(table[:, 0], rank[here], "right") - 1].T
            nth = rank[here] - first
            sequence[here], offset[here] = base + nth // each, at + nth % each * x
        return sequence, offset


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """``parts`` with a length column, plus sequence_id and offset."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            nth = []
            for x in batch.column("length").to_pylist():
                nth.append(seen[x])
                seen[x] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(nth), pa.int64()), pa.array(nth, pa.int64())],
                                             names=[*batch.schema.names, "pack_task", "pack_nth"])

    names = parts.columns
    ranked = staged(parts.mapInArrow(number, f"{ddl(parts)}, pack_task long, pack_nth long"), "pieces")
    counts = staged(ranked.groupBy("length", "pack_task").agg(F.count("*").alias("n")), "counts")
    demand = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    places = parts.sparkSession.sparkContext.broadcast(Places(demand, size))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("pack_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = staged(counts.select("length", "pack_task", F.coalesce(before, F.lit(0)).alias("pack_before")), "offsets")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("pack_before").to_numpy() + batch.column("pack_nth").to_numpy()
            where = places.value(batch.column("length").to_numpy(), rank)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, where)], names=[*names, "sequence_id", "offset"])

    return ranked.join(offsets, ["length", "pack_task"]).mapInArrow(assign, f"{ddl(parts)}, sequence_id long, offset long")
