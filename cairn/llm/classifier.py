"""Quality classifier by co-training of two views of a document.

The *content* view sees the text: shape ratios and hashed word counts. The
*metadata* view sees lang, source and length only. Each view is a logistic
regression. In every round each view labels all documents, and hands those it
is surest of to the *other* view's training set. At the end both views are
calibrated on held-out labelled rows (Platt scaling), combined by a second
small regression there, and score every document.

The features of all texts are written to the shared folder, and every round is
a pass over those. Fitted are at most ``LABELLED`` labelled rows
(least hash of their id), and ``HANDED`` rows more of either kind a round and
view; both are parameters. The pool they are chosen from is every document.

Defined cases: NULL or empty text has zero content features; NULL lang, source
or length are values of their own; a label row that is NULL is no label; with
labels of one kind only, or none, nothing is learnt: the score is that kind
(1.0 without labels) and documents of score 1.0 are kept; repeated rows are
scored alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import bounded_batches, staged
from cairn.llm.minhash import WordHashes

#: Labelled rows that are fitted, at most.
LABELLED = 6000
ROUNDS, HELD_OUT = 4, 0.25
#: Documents of a kind a view hands over each round, at most, and how sure it must be.
HANDED, SURE = 300, 0.98
ROWS_AT_ONCE = 1000
WORD_BINS, SOURCE_BINS, LANG_BINS = 256, 64, 16
#: Documents less likely good than this are rejected.
KEEP_FROM = 0.1

_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+@]")


class Content:
    """Text to features: twelve shape ratios, then hashed word shares."""

    size = 12 + WORD_BINS

    def __init__(self) -> None:
        self.hashes = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(self.size)
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return out
        n, chars = len(words), max(1, len(text))
        lines = [x for x in text.split("\n") if x.strip()]
        width = np.fromiter(map(len, words), float, n)
        distinct = len(set(words))
        upper = sum(w.isupper() for w in words)
        bare = sum(not any(c > 64 for c in w) for w in words)
        out[:12] = (np.log1p(n) / 8, width.mean() / 10, width.std() / 10, len(_SYMBOL.findall(text)) / n, upper / n, bare / n,
                    distinct / n, 1 - len(set(lines)) / max(1, len(lines)), text.count("!") / n, sum(map(str.isdigit, text)) / chars,
                    (text.count(".") + text.count(",")) / n, len(lines) / n)
        ids = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, n) % np.uint64(WORD_BINS)
        out[12:] = np.sqrt(np.bincount(ids.astype(int), minlength=WORD_BINS) / n)
        return out


class Metadata:
    """lang, source and length to features."""

    size = SOURCE_BINS + LANG_BINS + 3

    def __init__(self) -> None:
        self.hashes = WordHashes()

    def __call__(self, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
        out = np.zeros(self.size)
        for value, at, bins in ((source, 0, SOURCE_BINS), (lang, SOURCE_BINS, LANG_BINS)):
            out[at + self.hashes[("?" if value is None else f"={value}").encode("utf-8", "surrogatepass")] % bins] = 1
        size = np.log1p(max(0, n_chars or 0)) / 10
        out[-3:] = n_chars is None, size, size * size
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Newton's method for ridge logistic regression; the last weight is the intercept."""
    x1 = np.c_[x, np.ones(len(x))]
    penalty = np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = chance(x1 @ w)
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9), x1.T @ (p - y) + penalty * w)
        w -= step * min(1.0, 10 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


@dataclass
class Model:
    """Weights of the two views, their calibration lines and the combination."""

    views: list[np.ndarray] = field(default_factory=list)
    lines: list[np.ndarray] = field(default_factory=list)
    both: np.ndarray | None = None
    constant: float | None = None

    def scores(self, *x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated content and metadata chances, and the combined one."""
        if self.constant is not None:
            same = np.full(len(x[0]), self.constant)
            return same, same, same
        logits = [np.clip((f @ w[:-1] + w[-1]) * line[0] + line[1], -12, 12) for f, w, line in zip(x, self.views, self.lines, strict=True)]
        return chance(logits[0]), chance(logits[1]), chance(np.stack(logits, 1) @ self.both[:-1] + self.both[-1])


def surest(p: np.ndarray, kind: int) -> np.ndarray:
    """How sure a view is that rows are of a kind, from their chance to be good."""
    return p if kind else 1 - p


#: Gives, for the two views' weights, rows to hand to each view: (x, m, y) of view 0 and of view 1.
Hand = Callable[[list[np.ndarray]], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def from_arrays(content: np.ndarray, meta: np.ndarray, handed: int) -> Hand:
    """Pool rows held in memory."""
    taken: list[set[int]] = [set(), set()]

    def hand(weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out = []
        for to in (0, 1):
            w, x = weights[1 - to], (content, meta)[1 - to]
            p, rows, kinds = chance(x @ w[:-1] + w[-1]), [], []
            for kind in (1, 0):
                sure = surest(p, kind)
                best = [int(j) for j in np.argsort(-sure, kind="stable") if sure[j] >= SURE and int(j) not in taken[to]][:handed]
                taken[to].update(best)
                rows, kinds = rows + best, kinds + [kind] * len(best)
            out.append((content[rows], meta[rows], np.array(kinds, int)))
        return out

    return hand


def co_train(content: np.ndarray, meta: np.ndarray, label: np.ndarray, hand: Hand | None = None, rounds: int = ROUNDS, handed: int = HANDED) -> Model:
    """Fit on labelled rows; ``label`` is 1 or 0, or -1 for pool rows in memory.
    In every round both views are fitted, and each hands the pool rows that it
    is surest of to the *other* view's training set."""
    known = label >= 0
    if len({*label[known]}) < 2:
        return Model(constant=float(label[known][0]) if known.any() else 1.0)
    hand = hand or from_arrays(content[~known], meta[~known], handed)
    views, y = (content[known], meta[known]), label[known]
    held = np.zeros(len(y), bool)
    for kind in (0, 1):  # every fourth row of either kind
        held[np.flatnonzero(y == kind)[:: round(1 / HELD_OUT)]] = True
    train = [(views[v][~held], y[~held]) for v in (0, 1)]
    for _ in range(rounds):
        given = hand([logistic(*t) for t in train])
        train = [(np.r_[x, g[v]], np.r_[t, g[2]]) for v, ((x, t), g) in enumerate(zip(train, given, strict=True))]
    weights = [logistic(*t) for t in train]
    raw = [views[v][held] @ w[:-1] + w[-1] for v, w in enumerate(weights)]
    lines = [logistic(r[:, None], y[held], 0.1) for r in raw]
    logits = [np.clip(r * a[0] + a[1], -12, 12) for r, a in zip(raw, lines, strict=True)]
    return Model(weights, lines, logistic(np.stack(logits, 1), y[held], 0.1))


def packed(rows: np.ndarray) -> pa.Array:
    """Feature rows as 32-bit floats, a binary value each."""
    return pa.array([r.tobytes() for r in rows.astype(np.float32, copy=False)], pa.binary())


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, size)


def view_features(content: Content, meta: Metadata, text: pa.Array, *about: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both views' features of text and of lang, source and n_chars."""
    x = np.empty((len(text), Content.size), np.float32)
    for i, t in enumerate(text):  # one text at a time is a Python string
        x[i] = content(t.as_py())
    m = np.array([meta(*r) for r in zip(*(c.to_pylist() for c in about), strict=True)], np.float32).reshape(-1, Metadata.size)
    return x, m


@F.arrow_udf(T.StructType([T.StructField("x", T.BinaryType()), T.StructField("m", T.BinaryType())]))
def features(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    content, meta = Content(), Metadata()
    for batch in columns:
        yield pa.StructArray.from_arrays([packed(f) for f in view_features(content, meta, *batch)], ["x", "m"])


def from_table(table: DataFrame, known: np.ndarray, handed: int) -> Hand:
    """Pool rows in ``table`` (id, x, m): all documents but the ``known`` ids.
    Every round scores all of them with both views. A task keeps the surest
    ``handed`` different rows per view and kind, and so does the whole job;
    equal features count as one row, so copies do not crowd out the rest."""
    taken: list[set[bytes]] = [set(), set()]
    names = ["to", "kind", "sure", "print", "id", "x", "m"]

    def hand(weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        gone = [set(t) for t in taken]

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            held: dict[tuple[int, int], dict[bytes, tuple[float, int, bytes, bytes]]] = {(to, kind): {} for to in (0, 1) for kind in (1, 0)}
            for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, len(b), ROWS_AT_ONCE)):
                ids = pc.fill_null(batch.column("id"), -1).to_numpy()
                raw = [batch.column(c) for c in ("x", "m")]
                free = ~np.isin(ids, known)
                for to in (0, 1):
                    w = weights[1 - to]
                    p = chance(unpacked(raw[1 - to], len(w) - 1) @ w[:-1] + w[-1])
                    for kind in (1, 0):
                        sure = np.where(free, surest(p, kind), 0)
                        top = held[to, kind]
                        for j in np.argsort(-sure, kind="stable"):
                            if sure[j] < SURE or (len(top) >= 2 * handed and sure[j] < min(v[0] for v in top.values())):
                                break
                            x, m = (r[int(j)].as_py() for r in raw)
                            key = xxhash.xxh3_128_digest(x + m)
                            if key not in gone[to] and (key not in top or top[key][1] > ids[j]):
                                top[key] = (float(sure[j]), int(ids[j]), x, m)
                            if len(top) >= 4 * handed:
                                break
                        held[to, kind] = dict(sorted(top.items(), key=lambda e: (-e[1][0], e[0]))[:handed])
            rows = [(to, kind, v[0], key, *v[1:]) for (to, kind), top in held.items() for key, v in top.items()]
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema(
                    [("to", pa.int32()), ("kind", pa.int32()), ("sure", pa.float64()), ("print", pa.binary()), ("id", pa.int64()), ("x", pa.binary()), ("m", pa.binary())]))

        found = table.mapInArrow(best, "to int, kind int, sure double, print binary, id long, x binary, m binary")
        one = found.groupBy("to", "kind", "print").agg(F.max("sure").alias("sure"), F.first("x").alias("x"), F.first("m").alias("m"))
        rank = lambda *by: F.row_number().over(Window.partitionBy("to", "kind", *by).orderBy(F.desc("sure"), "print"))
        salted = one.withColumn("salt", F.pmod(F.xxhash64("print"), F.lit(64)))  # so that the last ranking sees 64 * handed rows of a kind at most
        few = salted.withColumn("rank", rank("salt")).filter(F.col("rank") <= handed)
        rows = few.withColumn("rank", rank()).filter(F.col("rank") <= handed).orderBy("to", "kind", "rank").collect()  # 4 * handed rows at most
        out = []
        for to in (0, 1):
            mine = [r for r in rows if r["to"] == to]
            taken[to].update(bytes(r["print"]) for r in mine)
            matrix = lambda c, n: np.frombuffer(b"".join(bytes(r[c]) for r in mine), np.float32).reshape(-1, n).astype(float)  # noqa: B023, E731
            out.append((matrix("x", Content.size), matrix("m", Metadata.size), np.array([r["kind"] for r in mine], int)))
        return out

    return hand


def fit(table: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, handed: int = HANDED) -> Model:
    """``table`` (id, x, m) and ``labels`` (id, label): at most ``labelled``
    label rows, those with the least hash of their id, a row for each id."""
    known = labels.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(labelled)
    one = F.min(F.struct("x", "m")).alias("f")
    rows = table.join(known, "id").groupBy("id", "label").agg(one).select("id", "label", "f.x", "f.m").orderBy("id").toArrow()  # ``labelled`` rows at most
    ids, label = rows["id"].to_numpy(), rows["label"].to_numpy()
    x, m = (unpacked(rows[c].combine_chunks(), n).astype(float) for c, n in (("x", Content.size), ("m", Metadata.size)))
    return co_train(x, m, label, from_table(table, ids, handed), rounds, handed)


def score(df: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", keep_from: float = KEEP_FROM,
          carry: list[str] | None = None, labelled: int = LABELLED, rounds: int = ROUNDS, handed: int = HANDED) -> DataFrame:
    """One row per input row: key, content_score, metadata_score,
    quality_score, kept, and a struct ``row`` of the columns in ``carry``."""
    bounded_batches(df.sparkSession)
    seen = [F.col(c).cast("string") for c in ("text", "lang", "source")] + [F.col("n_chars").cast("long")]
    of_id = F.col(key).cast("long").alias("id")
    found = df.select(of_id, features(*seen).alias("f"))
    table = staged(found.select("id", "f.x", "f.m"), "features")
    known = labels.select(of_id, F.col(label).cast("int").alias("label"))
    model = fit(table, known, labelled, rounds, handed)

    def combined(x: np.ndarray, m: np.ndarray) -> pa.Array:
        cut = range(0, max(1, len(x)), ROWS_AT_ONCE)
        some = [model.scores(x[i : i + ROWS_AT_ONCE], m[i : i + ROWS_AT_ONCE]) for i in cut]
        return pa.StructArray.from_arrays([pa.array(np.concatenate(p)) for p in zip(*some, strict=True)], ["content", "metadata", "both"])

    kind = "struct<content: double, metadata: double, both: double>"

    @F.arrow_udf(kind)
    def of_features(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, m in columns:
            yield combined(unpacked(x, Content.size), unpacked(m, Metadata.size))

    @F.arrow_udf(kind)
    def of_texts(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        content, meta = Content(), Metadata()
        for batch in columns:
            yield combined(*view_features(content, meta, *batch))

    if carry:  # the features are made once more, so that no second copy of the texts is written
        scored = df.withColumn("_s", of_texts(*seen)).select(of_id, F.col("_s").alias("s"), F.struct(*carry).alias("row"))
    else:
        scored = table.withColumn("s", of_features("x", "m"))
    return scored.select(F.col("id").alias(key), F.col("s.content").alias("content_score"), F.col("s.metadata").alias("metadata_score"),
                         F.col("s.both").alias("quality_score"), (F.col("s.both") >= keep_from).alias("kept"), *(["row"] if carry else []))
