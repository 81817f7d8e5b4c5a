"""Token ids of whole texts by the tokenizers library, one call for many short segments.

A text is split at safe boundaries, places that no token of the tokenizer spans.  Arrow
cuts the segments, and from plain words the line feed before and the signs after them.
Equal pieces have equal ids, so each worker asks the library once for a piece and keeps
the answer (for a bounded number of pieces, in two generations); a long text costs no more
memory than its segments.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20
KEPT_SEGMENTS = 200_000
JOINED_WORDS = 4096
DIGIT = "1"
SIGNS = ".,;:!?%#*&$|"   # a run of them is one token run
# By byte: a letter or the first byte of two of one; a sign.
_LETTERS, _SIGNS = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz\xc3", SIGNS.encode()))
# The characters that byte-level vocabularies write for bytes: printable Latin-1 as it is,
# the others, in order, from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _long_gap(text: str) -> bool:
    return "  " in text or "\n\n" in text or " \n" in text or "\n " in text


def marked(text: str) -> str:
    """A text with a NUL at every boundary of ``before_space``; it must not have one before."""
    # Printable characters and these two hold no other white space.
    if not (_long_gap(text) or text[:1] in " \n" or text[-1:] in " \n") and text.replace("\n", "").isprintable():
        return text.replace(" ", "\0 ").replace("\n", "\0\n")
    return _SAFE.sub("\0", text)


def before_space(text: str) -> list[str]:
    """Segments for a tokenizer that puts one space before a word into the word's token:
    a boundary lies before each space or line feed that stands alone between two other
    characters.  Longer and other white space is never split."""
    return _SAFE.split(text) if "\0" in text else marked(text).split("\0")


def at_space(text: str) -> list[str]:
    """Segments for a tokenizer that drops white space: the text without its spaces and
    line feeds, which no token spans."""
    return text.replace("\n", " ").split(" ")


# The steps before the model in the two kinds of tokenizer whose segments are
# known.  Words of letters are one pre-token in both.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORDS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_LOWER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}


def splitter(tokenizer) -> Callable[[str], list[str]]:
    """The segments that are safe for a tokenizer, if all steps before its model are those of
    a known kind and no added token takes more than its own text; else whole texts."""
    steps = json.loads(tokenizer.to_str())
    own = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"]
                  or "\n" in t["content"] for t in steps["added_tokens"])
    if own and steps["normalizer"] is None and steps["pre_tokenizer"] == _BYTE_LEVEL:
        return before_space
    if own and steps["normalizer"] == _LOWER and steps["pre_tokenizer"] == _WORDS:
        return at_space
    return lambda text: [text]


class Encoder:
    """``ids(texts)``: for each text the raw ids of its tokens, as ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split = splitter(self.tokenizer)
        self.dtype = np.dtype("H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I")
        self.spaced = self.split is before_space
        # Plain words go straight to the model, many at a time, only where the steps before it are
        # known and no added token can lie in a word with its signs.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.joined = Tokenizer(self.tokenizer.model)
        self.joined.pre_tokenizer = Split(DIGIT, "isolated")
        self.digit = self.joined.encode(DIGIT, add_special_tokens=False).ids
        self.plain = len(self.digit) == 1 and (self.split is before_space or self.split is at_space) and all(
            any(not c.isalpha() and c not in SIGNS for c in x) for x in added)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, missing: set[str]) -> None:
        """Ask the library: for plain words many at a time, for anything else by itself."""
        known, code, spaced = self.known, self.dtype.char, self.spaced
        words, others = [], []
        for s in missing:
            word = s[1:] if spaced and s[:1] == " " else s
            plain = self.plain and word.isalpha() and (word.isascii() or max(word) < "Ā")
            (words if plain else others).append(s)
        for s, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            known[s] = array(code, e.ids).tobytes()
        for i in range(0, len(words), JOINED_WORDS):
            some = words[i:i + JOINED_WORDS]
            known.update(zip(some, self._words(some)))

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of plain words, which the model takes as they are: a digit parts them, and no
        token of a word is the digit's."""
        text = DIGIT.join(words)
        text = (text if self.spaced else text.lower()).encode().decode("latin-1").translate(_BYTE_CHARS)
        ids = np.array(self.joined.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        cut = np.flatnonzero(ids == self.digit[0])
        if len(cut) != len(words) - 1:
            raise ValueError(f"{len(cut) + 1} words came back for {len(words)}")
        raw, cut = ids.tobytes(), cut * self.dtype.itemsize
        return [raw[x:y] for x, y in zip([0, *(cut + self.dtype.itemsize).tolist()], [*cut.tolist(), len(raw)])]

    def _know(self, segments: set[str]) -> dict[str, bytes]:
        """What is known, all of the segments included."""
        if len(self.known) > KEPT_SEGMENTS:
            self.old, self.known = self.known, {}       # what is still in use comes back
        known, old = self.known, self.old
        if missing := segments.difference(known):
            if again := missing.intersection(old):
                known.update((s, old[s]) for s in again)
                missing -= again
            self._learn(missing)
        return known

    def ids(self, texts: list[str]) -> list[bytes]:
        if self.split is at_space:
            return self._ids_cut(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        if self.split is before_space and not any("\0" in t for t in texts):
            return self._ids_cut(pa.array([marked(t) for t in texts], pa.large_string()), "\0")
        parts = [self.split(t) for t in texts]
        known = self._know(set().union(*parts))
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def _ids_cut(self, texts: pa.Array, mark: str) -> list[bytes]:
        """The segments between marks are cut, numbered and put together by Arrow: Python sees
        each word of the texts once."""
        segments = pc.split_pattern(texts, mark)
        coded = segments.flatten().dictionary_encode()
        pieces = _pieces(coded.dictionary, self.spaced) if self.plain else coded.dictionary
        parts = pieces.dictionary_encode()
        distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._know(set(distinct))
        ids = _joined(pa.array([known[s] for s in distinct], pa.large_binary()).take(parts.indices),
                      len(pieces) // max(1, len(coded.dictionary)))
        ids = ids.take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(segments).to_numpy(zero_copy_only=False))])
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ends + ids.offset] if len(ids) else np.zeros(len(ends), np.int64)
        raw = ids.buffers()[2].to_pybytes() if len(ids) else b""
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _bounds(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]


def _joined(values: pa.Array, n: int) -> pa.Array:
    """Every ``n`` neighbours of large binary values as one, in the same bytes."""
    if n <= 1 or not len(values):
        return values
    return pa.Array.from_buffers(pa.large_binary(), len(values) // n, [
        None, pa.py_buffer(np.ascontiguousarray(_bounds(values)[::n])), values.buffers()[2]])


def _pieces(segments: pa.Array, spaced: bool) -> pa.Array:
    """Three pieces of each segment, in the same bytes.  Around a plain word a line feed before
    it and the signs after it are token runs of their own; any other segment is one piece
    and two empty ones."""
    if not len(segments):
        return segments
    end, data = _bounds(segments), np.frombuffer(segments.buffers()[2] or b"", np.uint8)
    start, end = end[:-1], end[1:]
    count = lambda of: np.concatenate([[0], np.cumsum(of)])
    first = np.where(end > start, data[np.minimum(start, len(data) - 1)], 0) if len(data) else np.zeros(len(start))
    feed = (first == 10) & spaced
    lead = start + (feed | (first == 32) & spaced)
    # Letters of ASCII and, as two bytes, those from U+00C0 to U+00FF.
    letter = _LETTERS[data]
    two = np.flatnonzero(data[1:] < 0xC0) + 1
    two = two[(data[two] >= 0x80) & (data[two - 1] == 0xC3) & (data[two] != 0x97) & (data[two] != 0xB7)]
    letter[two] = True
    last = np.maximum.accumulate(np.concatenate([[0], np.where(_SIGNS[data], 0, np.arange(1, len(data) + 1))]))
    sign, others = np.maximum(last[end], lead), count(~letter)
    plain = (sign > lead) & (others[sign] == others[lead])
    cuts = np.empty(3 * len(start) + 1, np.int64)
    cuts[:-1:3], cuts[1::3], cuts[2::3] = start, start + (feed & plain), np.where(plain, sign, end)
    cuts[-1] = end[-1]
    return pa.Array.from_buffers(pa.large_string(), 3 * len(start), [None, pa.py_buffer(cuts), segments.buffers()[2]])


def encoder(path: str, _made: dict = {}) -> Encoder:  # noqa: B006
    """One encoder for each file in a worker."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, after which the memory that Arrow keeps for its next batch goes back: the worker
    lives on beside the steps that follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
    return run


def by_bytes(sizes: list[int], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
