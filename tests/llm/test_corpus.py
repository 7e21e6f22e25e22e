"""Mixing, spelling variants and source divergence against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from cairn.llm import divergence, mixing, variants
from tests.llm.cases import documents, prose, texts, with_odd_ids


def mixed_by_hand(rows, weights=(3, 1, 2), share=1.5, cap=2):
    """(id, size, source size, target, copies) of (id, text, source) rows."""
    sized = [(i, len((t or "").encode().split()), s, hashlib.md5(
        f"mix|{'' if i is None else i}|{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()) for i, t, s in rows]
    total = Counter()
    for _, n, s, _ in sized:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, rising = dict.fromkeys(order, Fraction(0)), Fraction(share) * sum(total.values()), set(order)
    while left > 0 and rising:  # share what is left by weight, cut at the caps, share the excess again
        whole, given, left = sum(weight[s] for s in rising), left, Fraction(0)
        for s in list(rising):
            target[s] += given * weight[s] / whole
            if target[s] >= cap * total[s]:
                left += target[s] - cap * total[s]
                target[s] = Fraction(cap * total[s])
                rising.discard(s)
    out = []
    for s in order:
        mine = [x for x in sized if x[2] == s]
        low, high = 0.0, 1e9
        for _ in range(200):
            k = (low + high) / 2
            low, high = (k, high) if sum(min(cap, k * n.bit_length()) * n for _, n, _, _ in mine) < target[s] else (low, k)
        rank, copies, draws = {}, {}, float(target[s])
        for x in mine:
            expected = min(cap, high * max(1, x[1].bit_length())) if target[s] < cap * total[s] else cap
            copies[x], p = int(expected), expected - int(expected)
            draws -= copies[x] * x[1]
            if p > 0 and x[1]:
                u = (int(x[3][:13], 16) + 0.5) / 16**13
                rank[x] = (u / (1 - u)) / (p / (1 - p))
        units, before = Counter(), 0.0
        for x in mine:
            if x in rank:
                units[rank[x]] += x[1]
        taken = set()
        for r in sorted(units):
            if before + units[r] / 2 <= draws:
                taken.add(r)
            before += units[r]
        out += [(x[0], x[1], total[s], round(float(target[s]), 6), copies[x] + (rank.get(x) in taken) if x[1] else 0) for x in mine]
    return out


def test_mix_equals_brute_force(spark):
    rows = with_odd_ids([*enumerate(texts()), *((100 + i, prose(i, 5 + 13 * i % 400)) for i in range(150))])
    df = documents(spark, rows)
    want = mixed_by_hand([(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()])
    got = mixing.mix(df, carry=["row", "key", "n_chars"]).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.copies) for r in got) == Counter(want)
    assert all(r.taken == r.size * r.copies <= 2 * r.size and r["row"].key == "k" for r in got)
    taken, largest, aim = Counter(), Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        largest[r.source_size] = max(largest[r.source_size], r.size)
        aim[r.source_size] = r.target
    assert all(abs(taken[s] - aim[s]) <= largest[s] / 2 + 1 for s in aim)


def test_mix_reruns_agree_and_repeat_rows(spark):
    df = documents(spark)
    once, again = (mixing.mix(d, importance=d.n_chars * 0 + 1) for d in (df, df.repartition(7)))
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, again.collect()))
    assert mixing.repeated(once).count() == sum(r.copies for r in once.collect())
    assert mixing.mix(df.limit(0)).count() == 0
    empty = mixing.mix(documents(spark, [(1, None), (2, ""), (3, " \n")])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 3


def test_mix_of_one_hot_id(spark):
    """Rows that repeat id and text share a draw, and go together."""
    rows = [(1, "a b c d")] * 3000 + [(i, prose(i, 40)) for i in range(2, 60)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, source string, u int")
    got = mixing.mix(df, share=0.5).collect()
    assert len(got) == len(rows) and len({r.copies for r in got if r.doc_id == 1}) == 1
    assert abs(sum(r.taken for r in got) - got[0].target) <= 6000


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_by_hand(rows, slips):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if k >= 5 and len(w) >= 6}
    by_first = {w: [x for x in n if near(w, x)] for w in n}
    form = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in by_first.items() if xs}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}
    root = {}
    for w in n:
        at = w
        while at in form:
            at = form[at]
        root[w] = at
    return {(w, form.get(w), root[w], n[w], len(by_first[w]), n.get(form.get(w))) for w in n}


@pytest.fixture(scope="module")
def spellings():
    rnd = random.Random(5)
    letters = "abcdéÿ×"
    words = ["".join(rnd.choices(letters, k=rnd.randint(5, 13))) for _ in range(60)]
    for _ in range(4):  # edits of edits: chains of forms
        for w in rnd.sample(words, 40):
            at, kind = rnd.randrange(len(w) + 1), rnd.randrange(3)
            words.append(w[:at] + (rnd.choice(letters) if kind else "") + w[at + (kind != 1) :])
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaab", "baaaaa", "Aaaaaa", "x" * 5000, "x" * 4999, "x" * 4998 + "y"]
    bag = [w for i, w in enumerate(words) for _ in range(rnd.choice([3, 5, 6, 30, 200, 1200]) if i % 3 else 5)]
    rnd.shuffle(bag)
    rows = [(i, "-".join(bag[k : k + 40])) for i, k in enumerate(range(0, len(bag), 40))]
    return [*rows, (None, "abcdefg 1 " * 9), (None, None), (5, ""), rows[0], rows[0]]


@pytest.mark.parametrize("slips", [None, 7])
def test_variants_equal_brute_force(spark, spellings, slips):
    got = variants.group(documents(spark, spellings), slips=slips).collect()
    want = groups_by_hand(spellings, slips)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(f for _, f, *_ in want) and any(r != f and f for _, f, r, *_ in want)


def test_variants_of_nothing(spark):
    assert variants.group(documents(spark).limit(0)).count() == 0
    assert variants.group(documents(spark, [(1, None), (None, ""), (2, "short of six")])).count() == 0


def audit_by_hand(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = {t for t, n in docs[lang].items() if n >= least}
        groups = sorted({r[2] for r in rows if r[1] == lang})
        counts = {s: count[lang, s] for s in groups}
        counts[None] = sum(counts.values(), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s, c in counts.items()}
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-far(p[s][t], p[None][t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found)[:most])}
    return out


def test_audit_equals_brute_force(spark):
    long_terms = ["z" * n for n in (8, 9, 16, 17, 31, 32, 33, 64, 255, 256, 257, 900)] + ["é" * n for n in (4, 5, 8, 9, 200)]
    rows = with_odd_ids([*enumerate(texts()), *((200 + i, " ".join([prose(i, 30), *long_terms[i % 5 :]])) for i in range(24))])
    df = documents(spark, rows)
    got = divergence.audit(df, documents=2, top=7).collect()
    want = audit_by_hand([(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()], 2, 7)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    none_kept = divergence.audit(df, documents=10**6).collect()
    assert none_kept and all(r.part == "pair" and r.value == 0 for r in none_kept)
    assert divergence.audit(df.limit(0)).count() == 0


def test_terms_are_counted_across_slices_and_long_texts(monkeypatch):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abYZé日", k=rnd.choice([1, 3, 7, 8, 9, 15, 16, 17, 40, 300])))
    bag = [word() for _ in range(80)]
    made = [rnd.choice([" ", "\n", "_"]).join(rnd.choices(bag, k=rnd.choice([0, 1, 2, 30, 900]))) for _ in range(60)]
    names = [(rnd.choice("xy"), rnd.choice("st")) for _ in made]
    monkeypatch.setattr(divergence, "SLICE", 5000)
    table = pa.table({"lang": [a for a, _ in names], "source": [b for _, b in names], "text": made})
    n, docs = Counter(), Counter()
    for out in divergence._term_rows(iter([table.to_batches()[0].slice(3, 50)])):
        for r in out.to_pylist():
            n[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    want, want_docs = Counter(), Counter()
    for (lang, source), text in list(zip(names, made, strict=True))[3:53]:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text))
        want.update((lang, source, t) for t in terms)
        want_docs.update((lang, source, t) for t in set(terms))
    assert n == want and docs == want_docs


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 2**64, 5000, dtype=np.uint64) >> rng.integers(0, 64, 5000).astype(np.uint64) for _ in range(2)]
    group = rng.integers(0, 70_000, 5000)
    order = divergence.radix_order(words, group)
    assert order.tolist() == sorted(range(5000), key=lambda i: (group[i], words[0][i], words[1][i], i))
