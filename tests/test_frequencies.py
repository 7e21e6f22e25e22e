"""Kept document frequencies against a recompute, and summaries from them."""

import re

from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.operators import text as tx
from cairn.streaming.frequencies import TokenFrequencies

STATES = [
    [(1, "red fox. red hen"), (2, "Red, red!"), (3, None), (4, "")],
    [(1, "red fox. blue hen"), (3, "now a text"), (4, ""), (5, "hen hen hen")],
    [(1, "red fox. blue hen"), (5, "fox")],
    [(None, "no id"), (5, None)],
]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id int, text string")


def _counted(docs):
    return {r["tok"]: r["df"] for r in tx.token_rows(docs.select("text")).groupBy("tok").agg(F.count("*").alias("df")).collect()}


def _held(spark, kept):
    return {r["tok"]: r["df"] for r in kept.read(spark).collect()}


def test_frequencies_follow_the_changes(spark, tmp_dir):
    kept = TokenFrequencies(f"{tmp_dir}/f")
    kept.start(_frame(spark, STATES[0]))
    for batch, (old, new) in enumerate(zip(STATES, STATES[1:], strict=False), start=1):
        feed = ch.change_feed(_frame(spark, old), _frame(spark, new), ["doc_id"])
        for _ in range(2):  # the replay changes nothing
            kept.add(feed, batch, share=0.0 if batch == 2 else 100.0)
            assert _held(spark, kept) == _counted(_frame(spark, new))
    assert kept.state.folded(spark) == 2


def test_new_documents_are_summarised_from_kept_counts(spark, tmp_dir):
    kept = TokenFrequencies(f"{tmp_dir}/f")
    old, new = _frame(spark, STATES[1]), _frame(spark, [(8, "An owl? The fox and hen. Zzz"), (9, None), (10, "zzz")])
    kept.start(old)
    kept.add(ch.as_inserts(new, ["doc_id"]), 1)
    alone = {r["doc_id"]: tuple(r) for r in tx.summarize(new, frequencies=kept.read(spark)).collect()}
    whole = {r["doc_id"]: tuple(r) for r in tx.summarize(old.union(new)).collect()}
    assert alone == {i: whole[i] for i in (8, 10)}
    assert alone[8] == (8, "Zzz", 2.0)  # zzz: 2 documents; the 1, fox 2, and 1, hen 3


def test_unknown_tokens_and_empty_tables(spark, tmp_dir):
    kept = TokenFrequencies(f"{tmp_dir}/f")
    kept.start(_frame(spark, []))
    assert _held(spark, kept) == {}
    got = tx.summarize(_frame(spark, [(1, "never seen. words")]), frequencies=kept.read(spark)).collect()
    assert [tuple(r) for r in got] == [(1, "never seen", 0.0)]
    assert tx.summarize(_frame(spark, [])).collect() == []


def test_frequent_tokens_are_dealt_out_in_parts(spark):
    """No token brings all its rows to one task; whatever the list's length,
    the summaries are the same."""
    words = ["the", "of", "and", *(f"{a}{b}" for a in "bcdfghklm" for b in "aeiouy")]
    rows = [(i % 90 if i % 7 else None, ". ".join(" ".join(["the"] * (i % 3) + ["Of", words[(i * k) % len(words)], words[(i + k * k) % 9]]) for k in range(i % 5)))
            for i in range(120)] + [(300, None), (301, ""), (302, "the the. the of")]
    docs = _frame(spark, rows)
    counts = tx.token_rows(docs.select("text")).groupBy("tok").agg(F.count("*").alias("df"))
    top = tx.frequent(counts, 8)
    shares = {r["tok"]: r["shares"] for r in top.collect()}
    assert 0 < len(shares) <= 8 and {"the", "of"} <= set(shares) and sum(shares.values()) <= 16
    assert tx.frequent(counts.limit(0)).count() == 0
    whole = lambda df: sorted(map(str, df.collect()))
    want = whole(tx.summarize(docs, most_frequent=1_000_000))
    known = counts.filter("tok <> 'of' AND tok <> 'ba'")
    lacking = whole(tx.summarize(docs, frequencies=known, most_frequent=1_000_000))
    for most in (1, 8):
        assert whole(tx.summarize(docs, most_frequent=most)) == want
        assert whole(tx.summarize(docs, frequencies=known, most_frequent=most)) == lacking
    plan = tx.summarize(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner.*\(_part#\d+ = _part#\d+\)", plan)
