"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

Its pattern never matches across the start of white space that follows a
non-space, so a text may be cut there and its chunks encoded one by one. Arrow
cuts the texts of a slice and numbers their distinct chunks. A worker remembers
the ids of the chunks it uses most, across its tasks, and sends only new ones
to the library, many as one text, whose ids are cut again by their bytes.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cairn.llm.common import slices

#: Chunks a worker remembers at most (beyond those of one slice of texts; some 150 bytes each), and the longest it keeps.
CHUNK_CACHE, CHUNK_CHARS = 200_000, 48
#: Texts that are encoded together hold so many bytes, or are one text.
CHARS_AT_ONCE = 2_000_000
#: New chunks in one call of the library, and in one of its texts.
NEW_AT_ONCE, JOINED = 8_000, 1_000

_SPACES = " \t\n\r\x0b\x0c"
_BEFORE_SPACE = re.compile(rf"(?<=\S)(?=[{_SPACES}])")
#: Python's \s for Arrow, whose own is ASCII only.
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A full stop or comma behind anything but a letter or digit: part of a longer run.
_IN_RUN = r"(?:\A|[^\p{L}\p{N}])[.,] "


def read_vocabulary(path: str) -> str:
    """The file as text, read once on the driver and sent along with tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def plain_keys(texts: pa.Array) -> pa.Array:
    """Lists of the chunk keys of texts without two white-space characters in
    a row and without marks. A key is its chunk without its one space, or as it
    is after a line break. A text's first chunk is marked by \\x01; so is a full
    stop or comma that ends a word, as a chunk of its own, so that the word is
    known with and without it."""
    lines = pc.replace_substring(texts, "\n", " \n")
    cut = lines
    for mark in ".,":
        cut = pc.replace_substring(cut, f"{mark} ", f" \x01{mark} ")
    cut = pc.if_else(pc.match_substring_regex(lines, _IN_RUN), lines, cut)
    return pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\x01", cut.type), cut, pa.scalar("", cut.type)), " ")


def spaced_chunks(texts: pa.Array) -> pa.Array:
    """Lists of the chunks of texts without marks; \\x02 is put at the cuts."""
    words = pc.replace_substring_regex(texts, rf"([\p{{L}}\p{{N}}])([.,])([{_SPACES}])", "\\1\x02\\2\x02\\3")
    return pc.split_pattern(pc.replace_substring_regex(words, rf"([^{_SPACE}\x02])([{_SPACES}])", "\\1\x02\\2"), "\x02")


def any_chunks(texts: pa.Array) -> pa.Array:
    return pa.array(map(_BEFORE_SPACE.split, texts.to_pylist()), pa.list_(texts.type))


def key_of(chunk: str) -> str:
    if chunk[:1] == " " and chunk[1:2] not in {" ", "\n", "\x01"}:
        return chunk[1:]
    return chunk if chunk[:1] == "\n" else f"\x01{chunk}"


def chunk_of(key: str) -> str:
    return key if key[:1] == "\n" else key[1:] if key[:1] == "\x01" else f" {key}"


class Codes(dict):
    """Chunk keys to numbers; ``new`` lists those that got one just now."""

    def __init__(self, keys: list[str] = ()) -> None:
        super().__init__(zip(keys, range(len(keys)), strict=True))
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code


class Encoder:
    """Texts to ids. Chunk keys are numbered; the ids of a number lie in one
    flat array, so a text is a gather. The most used chunks stay."""

    def __init__(self, vocabulary: str, cache: int = CHUNK_CACHE, chars_at_once: int = CHARS_AT_ONCE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True  # their strings are ordinary text
        self.cache, self.chars_at_once = cache, chars_at_once
        self.codes = Codes()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)
        self.bytes[list(vocab.values())] = [len(x) for x in vocab]  # a byte is a character there
        self.flat, self.start, self.size, self.uses = (np.empty(0, t) for t in (np.uint32, np.int64, np.int64, np.int64))

    def _encoded(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each chunk, and all ids. Chunks that may follow
        each other in a text are encoded as one, whose ids are cut where the
        bytes of a chunk end; should an id lie across, each by itself."""
        runs: list[list[str]] = []
        open_run = False
        for c in found:
            if open_run and c[:1] in _SPACES and len(runs[-1]) < JOINED:
                runs[-1].append(c)
            else:
                runs.append([c])
            open_run = not c[-1:].isspace() and c != ""
        ids = [x.ids for x in self.library.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
        reached = np.r_[0, np.cumsum(self.bytes[flat])]
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in found), np.int64, len(found)))
        at = np.searchsorted(reached, ends)
        if reached[-1] == ends[-1] and (reached[at] == ends).all():
            return np.diff(at, prepend=0), flat
        ids = [x.ids for x in self.library.encode_batch_fast(found, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))

    def _learn(self) -> None:
        """Encode the chunks that are new, ``NEW_AT_ONCE`` in a call (the
        library's result objects take some hundred times the ids' bytes)."""
        sizes, flat = [self.size], [self.flat]
        for at in range(0, len(self.codes.new), NEW_AT_ONCE):
            size, ids = self._encoded([chunk_of(k) for k in self.codes.new[at : at + NEW_AT_ONCE]])
            sizes.append(size)
            flat.append(ids)
        self.size, self.flat = np.concatenate(sizes), np.concatenate(flat)
        self.start = np.cumsum(self.size) - self.size
        self.uses = np.append(self.uses, np.zeros(len(self.codes.new), np.int64))
        self.codes.new = []

    def _forget(self) -> None:
        """Keep the most used chunks of no great length, half the cache."""
        keys = list(self.codes)
        short = np.fromiter(map(len, keys), np.int64, len(keys)) <= CHUNK_CHARS
        keep = np.argsort(np.where(short, -self.uses, 1), kind="stable")[: min(self.cache // 2, int(short.sum()))]
        size = self.size[keep]
        self.flat = self.flat[_ranges(self.start[keep], size)]
        self.start, self.size, self.uses = np.cumsum(size) - size, size, self.uses[keep] // 2
        self.codes = Codes([keys[k] for k in keep])

    def _gathered(self, lists: pa.Array, keyed: bool) -> list[bytes]:
        """Ids of each list of chunks, or of their keys."""
        numbered = lists.flatten().dictionary_encode()
        found, of = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices
        code = np.fromiter(map(self.codes.__getitem__, found if keyed else map(key_of, found)), np.int64, len(found))
        if self.codes.new:
            self._learn()
        self.uses[code] += np.bincount(of.to_numpy(), minlength=len(found))
        size = self.size[code]
        ids = self.flat[_ranges(self.start[code], size)]
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(found), [None, *map(pa.py_buffer, (4 * np.r_[0, np.cumsum(size)], ids))])
        if len(self.codes) > self.cache:
            self._forget()
        _, ends, taken = known.take(of).buffers()
        cuts = np.frombuffer(ends, np.int64)[np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]].tolist()
        return [taken[a:b].to_pybytes() if b > a else b"" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _few(self, texts: pa.Array) -> list[bytes]:
        marked, spaced = (pc.match_substring_regex(texts, x).to_numpy(zero_copy_only=False) for x in (r"[\x01\x02]", f"[{_SPACE}]{{2}}"))
        out = [b""] * len(texts)
        for rows, cut in ((~marked & ~spaced, plain_keys), (~marked & spaced, spaced_chunks), (marked, any_chunks)):
            if rows.any():
                for i, ids in zip(np.flatnonzero(rows).tolist(), self._gathered(cut(texts.filter(pa.array(rows))), cut is plain_keys), strict=True):
                    out[i] = ids
        return out

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; NULL is empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        whole = pa.RecordBatch.from_arrays([pc.fill_null(texts.cast(pa.large_string()), "")], names=["text"])
        was_on = gc.isenabled()
        gc.disable()  # no cycles are made here, and a pass would visit every chunk
        try:
            return [ids for few in slices([whole], size=self.chars_at_once) for ids in self._few(few.column("text"))]
        finally:
            if was_on:
                gc.enable()


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each range, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_ENCODERS: dict[tuple[str, int, int], Encoder] = {}


def encoder(vocabulary: str, cache: int = CHUNK_CACHE, chars_at_once: int = CHARS_AT_ONCE) -> Encoder:
    """One encoder per Python worker, which tasks of one vocabulary share."""
    wanted = (vocabulary, cache, chars_at_once)
    if wanted not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[wanted] = Encoder(*wanted)
    return _ENCODERS[wanted]
