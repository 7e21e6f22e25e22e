"""Tokenising, packing and token files against the public libraries."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cairn.llm import bpe, packing, token_orc, tokens
from cairn.llm.common import shared_path
from tests.llm.cases import documents, texts, with_odd_ids

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(JSON)
    made.encode_special_tokens = True
    return lambda t: made.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    made = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    return lambda t: made.encode_ordinary(t or "")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_bpe_equals_library_and_decodes(spark, tik):
    rows = with_odd_ids(list(enumerate(texts())))
    want = Counter((i, np.array(tik(t), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    for known in (5, 10_000):  # most words folded in the tasks, or by Spark
        got = bpe.decode(bpe.encode(documents(spark, rows), RANKS, public_tokenizers.PATTERN, known=known), RANKS).collect()
        assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
        assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert bpe.encode(documents(spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_folded_words_equal_merged_words(spark, tik):
    words = [" the", "hello", " naïve", "  ", "\n\n", "日本語", " 1234567", "€", " Ungeheuer", "a", "eeeeeeee", "antidisestablishment"]
    ranks = bpe.read_ranks(RANKS)
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for r in df.select("word", bpe.folded(df.word, ranks).alias("ids")).collect():
        assert r.ids == tik(r.word) == bpe.merged(r.word.encode(), ranks)


def test_chunked_encoder_equals_library(library):
    encode = tokens.Encoder(tokens.read_vocabulary(JSON))
    for many in (texts(), texts()[::-1]):
        for t, ids in zip(many, encode(many), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library(t)


class Counted:
    """The library, and how many texts it was given."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def encode_batch_fast(self, found, **kwargs):
        self.texts += len(found)
        return self.library.encode_batch_fast(found, **kwargs)


def test_new_chunks_are_encoded_as_few_texts(library):
    encode = tokens.Encoder(tokens.read_vocabulary(JSON))
    encode.library = counted = Counted(encode.library)
    for gap in (" ", " ", "\n\n"):
        text = gap.join(f"w{i}x, é{i}" for i in range(4000))
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == library(text)
    assert 0 < counted.texts <= 30  # of some 12,000 new chunks


def test_odd_cuts_equal_library_whatever_the_cache(library):
    odd = ["a\x01. b", "\x01 \x01.", "a\x02. b", "a.  b,\n\nc.", "  a. \n b..\n\n,\t. ", " lead", "trail ", "a.\nb, c", "a.. b", "_. b", "., b", "é. ½, Ⅷ. b", "a\u0301. b", "a\x1c b", "a \x85b", "a\u3000 b", "a\u00a0b c",
           "x \n\n y", "\r\nq\r\n", "\t\tz 's", "it 's, 'll. <|endoftext|>", "", None, "\n", ".", " ", "\U0001f600, \u200b. b"]
    for cache in (4, 1000):
        encode = tokens.Encoder(tokens.read_vocabulary(JSON), cache=cache, chars_at_once=40)
        for many in (odd, odd[::-1], pa.array(odd).slice(3, 11)):
            plain = many.to_pylist() if isinstance(many, pa.Array) else many
            assert [np.frombuffer(x, "<u4").tolist() for x in encode(many)] == [library(t) for t in plain]
        assert encode([]) == []


def test_chunks_are_encoded_singly_if_ids_do_not_end_with_them(library):
    encode = tokens.Encoder(tokens.read_vocabulary(JSON))
    encode.bytes[:] = 3
    encode.library = counted = Counted(encode.library)
    text = " ".join(f"word{i}" for i in range(300))
    assert np.frombuffer(encode([text])[0], "<u4").tolist() == library(text)
    assert counted.texts > 300


def test_packing_covers_every_id_once(spark, library):
    rows = list(enumerate(texts()))
    packed = packing.pack(packing.pieces(documents(spark, rows), JSON)).collect()
    ids = {i: [*library(t), packing.END] for i, t in rows}
    at = defaultdict(list)
    for r in packed:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id].append((r.start, r.length))
    assert at.keys() == ids.keys()
    for i, spans in at.items():
        assert sum(n for _, n in spans) == len(ids[i]) and [s for s, _ in sorted(spans)] == list(np.cumsum([0, *(n for _, n in sorted(spans))])[:-1])
    rooms = defaultdict(list)
    for r in packed:
        rooms[r.sequence_id].append((r.offset, r.length))
    assert sorted(rooms) == list(range(len(rooms)))
    for spans in rooms.values():
        assert sum(n for _, n in spans) <= 1024 and [s for s, _ in sorted(spans)] == list(np.cumsum([0, *(n for _, n in sorted(spans))])[:-1])
    assert packing.pack(packing.pieces(documents(spark).limit(0), JSON)).count() == 0


def test_patterns_use_every_piece_with_little_padding():
    rng = np.random.default_rng(4)
    for n in (1, 7, 40_000):
        lengths = 1 + (rng.lognormal(7, 0.9, n).astype(int) % 1023)
        demand = {int(x): int(k) for x, k in zip(*np.unique(lengths, return_counts=True), strict=True)}
        plan = packing.whole_patterns(demand)
        used = Counter()
        for pattern, times in plan:
            assert times > 0 and sum(x * k for x, k in pattern.items()) <= 1024
            for x, k in pattern.items():
                used[x] += k * times
        assert used == demand
        if n > 1000:
            assert sum(t for _, t in plan) * 1024 <= 1.02 * lengths.sum()


def test_column_generation_beats_single_length_patterns():
    demand = {600: 100, 424: 100, 300: 100, 124: 100}
    total = sum(t for _, t in packing.fractional_patterns(demand, 1024))
    assert total <= sum(x * n for x, n in demand.items()) / 1024 * 1.02 < sum(n / (1024 // x) for x, n in demand.items())


def test_token_files_round_trip(spark, library):
    rows = list(enumerate(texts()))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_orc.round_trip(documents(spark, rows), JSON).collect()}
    start = 0
    for i, t in rows:
        ids = [*library(t), token_orc.END]
        assert got[i] == (start, len(ids), crc(ids))
        start += len(ids)
    odd = token_orc.round_trip(documents(spark, with_odd_ids(rows[:10])), JSON).collect()
    assert len(odd) == 13 and min(r.start for r in odd if r.doc_id is None) == 0
    assert token_orc.round_trip(documents(spark).limit(0), JSON).count() == 0


def test_token_files_prune_by_id(spark):
    path = shared_path(spark, "orc-test")
    token_orc.write_ids(documents(spark), path, JSON)
    one = token_orc.read_ids(spark, path).filter("doc_id = 7")
    assert one.count() == 1 and "EqualTo(doc_id,7)" in one._jdf.queryExecution().executedPlan().toString()
