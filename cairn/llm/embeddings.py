"""Near-duplicate vectors by collision counting over one-dimensional projections.

Two unit vectors of cosine c differ by a normal amount of variance 2 - 2c on a
random Gaussian direction. A pair *collides* on a projection if one lies in a
window of half-width ``WIDTH`` centred at the other. The number of collisions
is binomial, so the least count that a linked pair may have is calibrated: at
the threshold cosine a pair falls below it with a chance of ``MISS``.

Vectors of a label, in the order of their first projection, are cut into
blocks of at most ``BLOCK`` rows by a range partitioning, so that no label has
to fit a task. Blocks whose first-projection intervals are in reach of each
other meet; inside a block pair all windows are compared at once, first on
``FIRST`` projections, then on all for the pairs that are left, and pairs with
enough collisions are verified by cosine in double precision. A block pair
returns sums of links per vector and a spanning set of links, never its pairs.
Equal vectors are one class with a weight.

Comparing blocks of a label remains quadratic in the label; the pairs are
counted in blocks of arrays, a few nanoseconds each.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite
components, rows of a NULL label or id, link with nothing; vectors of other
length never link; a NULL id has a NULL component and is kept; rows that
repeat id and vector count as links of each other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import staged
from cairn.llm.components import connected

COSINE = 0.93
PROJECTIONS, FIRST = 64, 16
#: Window half-width and reach of blocks, in standard deviations at the threshold.
WIDTH, REACH = 1.5, 4.5
MISS = 1e-5
BLOCK = 512


def least_count(trials: int, miss: float = MISS) -> int:
    """The greatest count that a pair at the threshold falls short of with a chance below ``miss``."""
    p = erf(WIDTH / sqrt(2))
    below = 0.0
    for k in range(trials + 1):
        below += comb(trials, k) * p**k * (1 - p) ** (trials - k)
        if below > miss:
            return k
    return trials


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(41).standard_normal((size, PROJECTIONS))


def unit_vectors(df: DataFrame) -> DataFrame:
    """(id, label, vector) to id, label, size, unit (doubles as bytes), first; usable rows only."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, unit, first = [], [], [], []
            for i, v in enumerate(batch.column("vector")):
                if not v.is_valid or not len(v) or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(float)
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    continue
                x = x / top
                x /= np.sqrt(x @ x)
                rows.append(i)
                size.append(len(x))
                unit.append(x.tobytes())
                first.append(float(x @ directions(len(x))[:, 0]))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("label").take(at), pa.array(size, pa.int32()),
                                              pa.array(unit, pa.binary()), pa.array(first, pa.float64())], names=["id", "label", "size", "unit", "first"])

    usable = df.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return usable.mapInArrow(scale, "id long, label string, size int, unit binary, first double")


def blocks(classes: DataFrame) -> DataFrame:
    """Blocks of neighbours in the order of label, size and first projection."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, held, key = TaskContext.get().partitionId(), 0, [], None

        def block():
            nonlocal made
            made += 1
            rep, weight, unit, first = zip(*held, strict=True)
            return pa.RecordBatch.from_pydict({
                "label": [key[0]], "size": [key[1]], "block": [(task << 32) + made], "low": [first[0]], "high": [first[-1]],
                "reps": [np.array(rep, np.int64).tobytes()], "weights": [np.array(weight, np.int64).tobytes()], "units": [b"".join(unit)]})

        for batch in batches:
            for label, size, first, rep, weight, unit in zip(*(batch.column(c).to_pylist() for c in ("label", "size", "first", "rep", "weight", "unit")), strict=True):
                if held and (key != (label, size) or len(held) == BLOCK):
                    yield block()
                    held = []
                key = (label, size)
                held.append((rep, weight, unit, first))
        if held:
            yield block()

    ordered = classes.repartitionByRange("label", "size", "first", "rep").sortWithinPartitions("label", "size", "first", "rep")
    return ordered.mapInArrow(cut, "label string, size long, block long, low double, high double, reps binary, weights binary, units binary")


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks of unit vectors with enough collisions and cosine."""
    axes = directions(x.shape[1])
    p, q = (x @ axes).astype(np.float32), (y @ axes).astype(np.float32)
    half = np.float32(WIDTH * sqrt(2 - 2 * cosine) + 1e-5)
    count = np.zeros((len(x), len(y)), np.uint8)
    for j in range(FIRST):
        count += np.abs(p[:, j, None] - q[None, :, j]) <= half
    a, b = np.nonzero(count >= least_count(FIRST))
    near = (np.abs(p[a] - q[b]) <= half).sum(1) >= least_count(PROJECTIONS)
    a, b = a[near], b[near]
    true = np.einsum("ij,ij->i", x[a], y[b]) >= cosine
    return a[true], b[true]


def block_links(met: DataFrame, cosine: float) -> DataFrame:
    """Block pairs to rows (id, n, root): n links of id, and one of the
    block pair's spanning links, to ``root``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                raw = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
                ids, weights, units = ([np.frombuffer(raw(f"{c}_{s}"), t) for s in "xy"] for c, t in (("reps", np.int64), ("weights", np.int64), ("units", float)))
                x, y = (u.reshape(len(i), -1) for u, i in zip(units, ids, strict=True))
                a, b = linked(x, y, cosine)
                if same := raw("block_x") == raw("block_y"):
                    a, b = a[a != b], b[a != b]
                if not len(a):
                    continue
                n = [np.bincount(a, weights[1][b], len(x)), np.bincount(b, weights[0][a], len(y)) * (not same)]
                root = list(range(len(x) + len(y)))

                def find(i: int) -> int:
                    while root[i] != i:  # noqa: B023
                        root[i] = root[root[i]]  # noqa: B023
                        i = root[i]  # noqa: B023
                    return i

                shift = 0 if same else len(x)
                for i, j in zip(a.tolist(), (b + shift).tolist(), strict=True):
                    root[find(j)] = find(i)
                everyone = np.concatenate(ids)
                total = np.concatenate(n).astype(np.int64)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"id": everyone[at], "n": total[at], "root": everyone[[find(i) for i in at.tolist()]]})

    return met.mapInArrow(compare, "id long, n long, root long")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per input row: key, n_links, component_id, kept."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    units = staged(unit_vectors(rows), "units")
    classes = staged(units.groupBy("label", "size", "unit").agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.min("first").alias("first")), "classes")
    cut = staged(blocks(classes), "blocks")
    reach = REACH * sqrt(2 - 2 * cosine)
    place = cut.select("label", "size", "block", "low", "high")
    x, y = place.alias("x"), place.alias("y")
    close = ((F.col("x.label") == F.col("y.label")) & (F.col("x.size") == F.col("y.size")) & (F.col("x.block") <= F.col("y.block"))
             & (F.col("y.low") - F.col("x.high") <= reach) & (F.col("x.low") - F.col("y.high") <= reach))
    pairs = staged(x.join(y, close).select(F.col("x.block").alias("block_x"), F.col("y.block").alias("block_y")), "block-pairs")
    side = lambda s: cut.select(*(F.col(c).alias(f"{c}_{s}") for c in ("block", "reps", "weights", "units")))
    found = staged(block_links(pairs.join(side("x"), "block_x").join(side("y"), "block_y"), cosine), "links")
    groups = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = staged(found.groupBy("id").agg(F.sum("n").alias("n")), "counts")
    by_rep = counts.join(groups, "id", "full_outer")
    by_class = staged(classes.join(by_rep, classes.rep == by_rep.id, "left")
                      .select("label", "size", "unit", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "by-class")
    # ids that recur are told apart by their vector
    members = units.join(by_class, ["label", "size", "unit"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    members = staged(members, "members").withColumnRenamed("id", "member")
    all_rows = rows.select("id").join(members, F.col("id") == F.col("member"), "left")
    component = F.coalesce("component", "id")
    return all_rows.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                           F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
