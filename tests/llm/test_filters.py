"""Quality rules, URL filter, classifier and archives."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from cairn.llm import classifier, quality_rules, urls, warc
from tests.conftest import SF_ORACLE
from tests.llm.cases import documents, texts, with_odd_ids


def rule_counts(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_quality_rules_equal_brute_force(spark):
    rows = with_odd_ids(list(enumerate(texts())))
    got = quality_rules.judge(documents(spark, rows)).collect()
    want = Counter((i, *rule_counts(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.judge(documents(spark).limit(0)).count() == 0


def test_quality_rules_verdicts(spark):
    fine = " ".join(f"the word{i} of a sentence{i}." for i in range(20))
    symbols, bare, lines = fine + " ###" * 20, fine + " 123" * 60, "\n".join([fine, *[f"the line of {i % 2}" for i in range(12)]])
    got = quality_rules.judge(documents(spark, list(enumerate([fine, symbols, bare, lines, fine.upper()])))).collect()
    assert {r.doc_id: r.kept for r in got} == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_url_judgement(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "http://a.example.net/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://EXAMPLE.com/de/": ("example.com", "/de/", "example.com/de/", "block"), "http://x.org/fr/casino": ("x.org", "/fr/casino", "org/fr/", "allow"),
        "http://net": ("net", "", None, "allow"), "http://bnet/x": ("bnet", "/x", None, "allow"), "no scheme casino": ("", "", None, "block"),
        "https://h.com/casinos/a": ("h.com", "/casinos/a", None, "allow"), "https://win.com/a-bonus": ("win.com", "/a-bonus", None, "block"),
        "https://win.com/win": ("win.com", "/win", None, "allow"), "https://h.com?x=//y/": ("h.com", "", None, "allow"), "https://É.com/É": ("É.com", "/É", None, "allow"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "x://y://z/p": ("y:", "//z/p", None, "allow"), "http://h.com/" + "a" * 60_000: ("h.com", "/" + "a" * 60_000, None, "allow"),
    }
    rows = [(i, u, "k", 1) for i, u in enumerate(cases)]
    df = spark.createDataFrame(rows, "page_id long, url string, key string, score int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}
    assert got == {i: cases[u] for i, u, _, _ in rows}
    assert urls.judge_urls(df.limit(0)).count() == 0
    bare = urls.judge_urls(df.union(df), vocabulary={}, rules=()).collect()
    assert len(bare) == 2 * len(rows) and {(r.rule, r.verdict, r.n_strict) for r in bare} == {(None, "allow", 0)}


def test_classifier_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    hidden = labels.filter("doc_id % 3 = 0")
    scored = classifier.score(docs, labels.filter("doc_id % 3 <> 0"))
    rows = scored.join(hidden, "doc_id").select("kept", "quality", "quality_score").collect()
    assert len(rows) > 100 and scored.count() == docs.count()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1


def test_co_training_uses_the_other_view():
    """Two informative views and few labels: pseudo-labels must not hurt, and both views are calibrated."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    x, m = (np.c_[(y * 2 - 1)[:, None] * 1.2 + rng.standard_normal((3000, 3))] for _ in range(2))
    label = np.where(np.arange(3000) < 60, y, -1)
    model = classifier.co_train(x, m, label)
    content, meta, both = model.scores(x[1000:], m[1000:])
    accuracy = [np.mean((p > 0.5) == y[1000:]) for p in (content, meta, both)]
    assert accuracy[2] >= max(accuracy[:2]) - 0.01 and accuracy[2] > 0.97


@pytest.mark.parametrize(("kept", "score"), [("quality = 1", 1.0), ("quality = 0", 0.0), ("false", 1.0)])
def test_classifier_without_two_classes(spark, kept, score):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int").filter(kept)
    got = classifier.score(documents(spark, with_odd_ids(list(enumerate(texts()))[:10])), labels).collect()
    assert len(got) == 13 and {r.quality_score for r in got} == {score} and {r.kept for r in got} == {score == 1.0}
    assert classifier.score(documents(spark).limit(0), labels).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, id string, size int")


def test_archives_round_trip(spark):
    long, longer = "<p>é</p>" * 200, "z" * 400_000
    rows = [(1, "http://a/ b", long), (5, None, long), (3, "http://c", long), (2, "http://a", "x"), (4, "http://a", "x"), (6, "u\r\nEvil: 1", None),
            (7, "http://e", ""), (8, "http://l", longer), (9, "http://m", longer + "!"), (9, "http://m", longer + "!"), (None, "n", long), (None, "n", "solo" * 400)]
    got = warc.round_trip(pages(spark, rows)).collect()
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        top = max((j for j, _, h in rows if h == html and j is not None), default=None) if len(body) >= 1000 else None
        revisit = top is not None and (i is None or i < top)
        want[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0


def test_archive_layout(tmp_path):
    """Dictionary in a leading skippable frame; each record is a frame of its own."""
    import struct

    import zstandard
    from pyarrow import fs

    records = [warc.page_record(i, f"http://h/{i}", (f"<html><p>common words and more {i}</p>" * 30).encode(), None) for i in range(300)]
    system, path = fs.LocalFileSystem(), f"{tmp_path}/one.warc.zst"
    archive = warc.Archive(system, path, records[:200])
    for r in records[200:]:
        archive.add(r)
    archive.out.close()
    data = system.open_input_stream(path).read()
    magic, size = struct.unpack("<II", data[:8])
    held = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    assert magic == 0x184D2A5D and held.dict_id() and archive.records == 301 and len(data) < sum(map(len, records)) / 4
    one, rest = zstandard.ZstdDecompressor(dict_data=held).decompressobj(), data[8 + size :]
    assert b"warcinfo" in one.decompress(rest)
    second = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
    assert second.decompress(one.unused_data) == records[0]
