"""Near-duplicate, substring and vector dedup against brute force."""

import hashlib
import pickle
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext

from cairn.llm import embeddings, minhash, substring
from tests.llm.cases import documents, texts, with_odd_ids


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_minhash_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(set(want.values())) < len(rows) - 12


def test_minhash_odd_rows(spark):
    got = minhash.near_duplicates(documents(spark, with_odd_ids(list(enumerate(texts()))[:12]))).collect()
    assert len(got) == 15
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert {(r.component_id, r.kept) for r in got if r.doc_id == 8} == {(8, True)}
    assert minhash.near_duplicates(documents(spark).limit(0)).count() == 0


def test_minhash_ids_with_several_texts(spark):
    """Each text of an id is compared, in whatever order the rows come; an id that recurs costs one text."""
    one, two = (" ".join(f"{p}{i}" for i in range(60)) for p in "xy")
    three = "some other words"
    near = two + " tail"
    rows = [(1, one), (1, two), (2, near), (3, one.upper()), (2, three), (0, three)] + [(5, near)] * 5000
    for these in (rows, rows[::-1]):
        got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, these)).collect()}
        assert got == {(0, 0, True), (1, 0, False), (2, 0, False), (3, 0, False), (5, 0, False)}


def test_star_misses_are_found_across_components(spark):
    """A hub whose copies differ from each other, and a chain that only its neighbours link."""
    base = [f"t{i}" for i in range(100)]
    chain = [" ".join([*base[k * 6 :], *(f"n{k}_{j}" for j in range(k * 6))]) for k in range(8)]
    sets = {i: shingles(t) for i, t in enumerate(chain)}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    got = minhash.near_duplicates(documents(spark, list(enumerate(chain)))).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def expected_cuts(rows):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_equals_brute_force(spark):
    rows = with_odd_ids(list(enumerate(texts())))
    rows.append((3, texts()[8]))  # an id with two texts
    want = Counter((i, *x) for (i, _), x in zip(rows, expected_cuts(rows), strict=True))
    for cells in (1 << 27, 1 << 9):  # a sketch that is far too small loses nothing
        got = substring.cut_repeats(documents(spark, rows), cells=cells).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got) == want
    assert any(n for _, _, n, _ in want)
    assert substring.cut_repeats(documents(spark).limit(0)).count() == 0


def test_words_are_hashed_in_the_bytes():
    """As bytes.split() cuts them; texts that touch, parts of a column, words of any length."""
    long = "z" * 64
    odd = [None, "", " \t\n\v\f\r ", "a b", "b", "ab", "a\0", "a\0\0", "a", "\0", "abcdefgh", "abcdefg", "abcdefghi", "naïve\x1cÜber\u2003 日本語\u00a0x",
           long, long + "z", long + "y", f"{long}y z{long} ", "  lead", *texts()]
    for column in (pa.array(odd), pa.array(odd, pa.large_string()), pa.array(odd).slice(3, 21), pa.array(odd[:3]), pa.array(odd[:0], pa.string())):
        words = [(t or "").encode().split() for t in column.to_pylist()]
        hashes, n = substring.hashed_words(column)
        assert n.tolist() == [len(w) for w in words]
        pairs = list(zip([x for w in words for x in w], hashes.tolist(), strict=True))
        assert len(set(pairs)) == len(dict(pairs)) == len({h: x for x, h in pairs})


def test_runs_equal_brute_force():
    """Each window of each text is in one run, equal windows have their anchor at equal places; equal runs and windows hash alike, others do not."""
    for window, gram in ((35, 8), (5, 2), (3, 3), (1, 1)):
        find, column = substring.Runs(window, gram), pa.array([*texts(), *texts()[::-1]])
        found, sums = find(column)
        words = [(t or "").encode().split() for t in column.to_pylist()]
        got = list(zip(*(x.tolist() for x in (found.row, found.start, found.length, found.offset)), strict=True))
        assert [(r, s + k) for r, s, n, _ in got for k in range(n)] == [(r, s) for r, w in enumerate(words) for s in range(len(w) - window + 1)]
        assert all(n - 1 <= -o <= window - gram for _, _, n, o in got)
        for hashes, of in ((found.anchor, [tuple(words[r][s - o : s - o + gram]) for r, s, _, o in got]),
                           (find.span_hashes(sums, found), [(n, o, *words[r][s : s + n + window - 1]) for r, s, n, o in got]),
                           (find.window_hashes(sums, found), [tuple(words[r][s + k : s + k + window]) for r, s, n, _ in got for k in range(n)])):
            pairs = list(zip(of, hashes.tolist(), strict=True))
            assert len(set(pairs)) == len(dict(pairs)) == len({h: x for x, h in pairs})
        places = {(tuple(words[r][s + k : s + k + window]), -o - k) for r, s, n, o in got for k in range(n)}
        assert len(places) == len(dict(places))


def test_least_is_the_first_of_equal_ones():
    values = np.random.default_rng(2).integers(0, 9, 500).astype(np.uint64)
    for width in (1, 2, 3, 8, 28):
        views = np.lib.stride_tricks.sliding_window_view(values, width)
        assert np.array_equal(substring.least_at(values, width), np.arange(len(views)) + views.argmin(1))


def test_runs_cost_little_more_than_words():
    """Hashing and finding the runs takes less than six times as long as cutting the words alone, also when most words are new."""
    rng = np.random.default_rng(4)
    column = pa.array([" ".join(f"{x:x}" for x in rng.integers(0, 1 << 28, 400)) for _ in range(500)])

    def seconds(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    find = substring.Runs()
    assert min(seconds(lambda: find(column)) for _ in range(5)) < 6 * min(seconds(lambda: [t.as_py().encode().split() for t in column]) for _ in range(5))


def test_sketch_is_small_on_the_driver(spark, monkeypatch):
    """The sketch of a small corpus is small there too, and is not kept after the pass that reads it."""
    rows = list(enumerate(texts()))
    sent, dropped, broadcast, destroy = [], [], SparkContext.broadcast, Broadcast.destroy

    def noted(self, value):
        sent.append((broadcast(self, value), len(pickle.dumps(value))))
        return sent[-1][0]

    def noted_too(self, blocking=False):
        dropped.append(self)
        destroy(self, blocking)

    monkeypatch.setattr(SparkContext, "broadcast", noted)
    monkeypatch.setattr(Broadcast, "destroy", noted_too)
    got = substring.cut_repeats(documents(spark, rows))
    assert len(sent) == 2 and max(size for _, size in sent) < substring.CELLS // 100
    assert dropped == [made for made, _ in sent]
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got.collect()} == {i: x[:2] for (i, _), x in zip(rows, expected_cuts(rows), strict=True)}


def test_sketch_marks_what_counts_enough(spark):
    cells = 1 << 16
    rng = np.random.default_rng(9)
    once, twice = np.split(rng.integers(0, 2**63, 400, dtype=np.uint64), 2)
    anchors = np.r_[once, twice, twice].view(np.int64).tolist()
    df = spark.createDataFrame([(a,) for a in anchors], "anchor long").repartition(5)
    of_rows = lambda: lambda batch: iter([batch.column("anchor").to_numpy().view(np.uint64)])
    for least in (1, 2):
        want = np.zeros(substring.DEPTH * cells, bool)
        for row in range(substring.DEPTH):
            n = np.bincount(substring.cells_of(np.array(anchors).view(np.uint64), row, cells), minlength=cells)
            want[row * cells : (row + 1) * cells] = n >= least
        shards = substring.merged_bits(df, of_rows, cells, least)
        assert np.array_equal(np.unpackbits(substring.unpacked_bits(shards, cells)).astype(bool), want)
    assert not substring.unpacked_bits(substring.merged_bits(df.limit(0), of_rows, cells, 1), cells).any()


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(6):
        center = rng.standard_normal(32)
        rows += [(center + rng.standard_normal(32) * s, k % 3) for s in (0, 0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)]
    rows += [(rng.standard_normal(32), k % 3) for k in range(60)]
    rows = [(i, [float(x) for x in v], c) for i, (v, c) in enumerate(rows)]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan"), *[1.0] * 31], 1), (903, [None, *[1.0] * 31], 1), (904, rows[0][1], None),
           (905, rows[0][1][:16], 0), (906, [], 0), (907, [x * 1e200 for x in rows[0][1]], 0), (908, [float("inf")] * 32, 0)]
    usable = [*rows, (907, rows[0][1], 0)]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in usable}
    label = {i: c for i, _, c in usable}
    links = [(a, b) for a, b in combinations(unit, 2) if label[a] == label[b] and unit[a] @ unit[b] >= 0.93]
    want, degree = groups([i for i, _, _ in [*rows, *odd]], links), Counter(x for p in links for x in p)
    df = spark.createDataFrame([(*r, "u", 1) for r in [*rows, *odd]], "vec_id long, embedding array<double>, label int, unit string, n int")
    got = embeddings.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (degree[i], want[i], want[i] == i) for i in want}
    assert len(links) > 60
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_odd_ids(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (None, v, 0), (2, v, 0), (3, v, 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect() if r.vec_id is not None)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_calibrated_count():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.standard_normal(x.shape) * 0.06
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    true = {(i, i) for i in np.flatnonzero(np.einsum("ij,ij->i", x, y) >= 0.93)}
    found = {(int(a), int(b)) for a, b in zip(*embeddings.linked(x, y, 0.93), strict=True)}
    assert len(true & found) >= 0.999 * len(true)
