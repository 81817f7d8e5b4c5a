"""SentencePiece encoding that keeps the places of the source, and decoding.

A text is normalised here, by the model's own rules: at each place the longest prefix that
the compiled character map knows is replaced, and for every byte written the byte of the
source that it came from is recorded.  The library then splits the normalised text into
pieces (by the same model with its own normalising turned off), and each piece's range is
projected through the record to a span of source bytes.  A character that the vocabulary
lacks becomes one piece for each of its bytes, and each has the span of its own byte.

Long texts are worked on in stretches of about ``STRETCH`` characters, cut before a space
where neither a rule nor a piece can span the cut; a model that allows no such cuts gets
whole texts.

Defined cases: a null text is empty; an empty text has no pieces and decodes to an empty
text; texts of any length are encoded whole; null and repeated ids are carried, each row by
itself; an empty table gives no rows.  A model that writes spaces as suffixes is refused.
Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRETCH = 1 << 16
_SPACE = "▁".encode()

# Fixed values of the model file format: field numbers, the type of user-defined symbols,
# and the bits of a unit of the map's double-array trie.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE = 2, 3, 4, 5
SUFFIX = 24
PIECE, TYPE, USER_DEFINED, BYTE = 1, 3, 4, 6
LEAF, LABEL, VALUE = 1 << 8, 1 << 31 | 255, (1 << 31) - 1


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte, i = data[i], i + 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of one message of the model file."""
    i = 0
    while i < len(data):
        tag, i = _varint(data, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(data, i)
        else:
            size, i = _varint(data, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = data[i:i + size], i + size
        yield tag >> 3, value


def message(number: int, value: int | bytes) -> bytes:
    """One field in the model file's format; numbers are below 128."""
    if isinstance(value, int):
        return bytes([number << 3, value])
    size, head = len(value), bytearray([number << 3 | 2])
    while size > 127:
        head.append(size & 127 | 128)
        size >>= 7
    return bytes(head) + bytes([size]) + value


class CharacterMap:
    """The compiled map: a double-array trie of prefixes and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64) if size else np.zeros(0, np.int64)
        self.words = self.units.tolist()
        self.texts = blob[4 + size:]

    @staticmethod
    def _offset(unit):
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _text(self, value: int) -> bytes:
        return self.texts[value:self.texts.index(0, value)]

    def longest(self, data: bytes, i: int) -> tuple[bytes, int]:
        """What the longest known prefix at ``i`` becomes and its length; a character that
        begins none stays."""
        words, best = self.words, None
        if words:
            node = self._offset(words[0])
            for k in range(i, len(data)):
                node ^= data[k]
                if node >= len(words) or words[node] & LABEL != data[k]:
                    break
                unit = words[node]
                node ^= self._offset(unit)
                if unit & LEAF:
                    best = words[node] & VALUE, k + 1 - i
        if best:
            return self._text(best[0]), best[1]
        lead = data[i]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[i:i + size], size

    def keeps_cuts(self) -> bool:
        """Whether a place between a printable ASCII character and a space is never inside a
        rule, nor after a rule's output that is empty or ends in a space."""
        if not self.words:
            return True
        labels, units = np.arange(1, 256), self.units
        at, root = np.zeros(1, np.int64), True
        while len(at):
            base = at ^ self._offset(units[at])
            child = base[:, None] ^ labels[None, :]
            known = child < len(units)
            known &= (units[np.where(known, child, 0)] & LABEL) == labels
            if not root and known[:, 31].any():         # a space inside a rule
                return False
            ends = labels[None, :].repeat(len(at), 0)[known]
            at, root = child[known], False
            leaf = at[(units[at] & LEAF > 0) & (ends > 32) & (ends < 127)]
            for value in (units[leaf ^ self._offset(units[leaf])] & VALUE).tolist():
                if self._text(value)[-1:] in (b"", b" "):
                    return False
        return True


class Pieces:
    """A model, ready to encode texts."""

    def __init__(self, model: bytes):
        import sentencepiece

        spec = {DUMMY_PREFIX: 1, REMOVE_SPACES: 1, ESCAPE: 1, MAP: b""}
        symbols, sizes, fallback, inner = [], [], False, False
        for number, value in fields(model):
            if number == NORMALIZER:
                spec.update(fields(value))
            elif number == TRAINER and dict(fields(value)).get(SUFFIX):
                raise ValueError("models that write spaces as suffixes are not supported")
            elif number == PIECES:
                piece = dict(fields(value))
                text, kind = piece[PIECE], piece.get(TYPE)
                inner |= b" " in text[1:] or _SPACE in text.lstrip(_SPACE)
                fallback |= kind == BYTE
                sizes.append(1 if kind == BYTE else len(text))
                if kind == USER_DEFINED:
                    symbols.append(text)
        self.dummy, self.remove, self.escape = (bool(spec[k]) for k in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE))
        self.space = _SPACE if self.escape else b" "
        self.map = CharacterMap(spec[MAP])
        self.symbols = re.compile(b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))) if symbols else None
        # The same model, which takes a text as it is.
        self.splitter = sentencepiece.SentencePieceProcessor(model_proto=model + message(NORMALIZER, b"".join(
            message(k, v) for k, v in ((MAP, b""), (DUMMY_PREFIX, 0), (REMOVE_SPACES, 0), (ESCAPE, int(self.escape))))))
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        # Without bytes for unknown characters, a run of these is one piece of any length.
        self.sizes = np.array(sizes) if fallback else None
        self.cuts = fallback and self.escape and not inner and not symbols and self.map.keeps_cuts()
        self.cut = re.compile(f"(?<=[{'!-~' if self.map.words else '^ ▁'}])(?= )")

    def normalise(self, data: bytes, first: bool = True, last: bool = True) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the place in ``data``
        that it comes from."""
        if not (self.map.words or self.symbols or self.remove or not data):
            lead = self.space if first and self.dummy else b""
            each = np.ones(len(data) + 1, np.int32)
            each[:-1][np.frombuffer(data, np.uint8) == 32] = len(self.space)
            each[0] += len(lead)
            return lead + data.replace(b" ", self.space), np.repeat(np.arange(len(data) + 1, dtype=np.int32), each)
        out, source = self._by_rules(data, first, last)
        return bytes(out), np.array(source, np.int32)

    def _by_rules(self, data: bytes, first: bool, last: bool) -> tuple[bytearray, list[int]]:
        i, n, blank = 0, len(data), self.remove and first
        out, source = bytearray(), []

        def prefix(at: int) -> tuple[bytes, int]:
            found = self.symbols and self.symbols.match(data, at)
            return (found.group(), len(found.group())) if found else self.map.longest(data, at)

        while blank and i < n:
            text, used = prefix(i)
            if text != b" ":
                break
            i += used
        if i == n:
            return out, [n]
        if first and self.dummy:
            out += self.space
            source += [i] * len(self.space)
        while i < n:
            text, used = prefix(i)
            kept = text == data[i:i + used] and text != b" "
            if blank:
                text = text.lstrip(b" ")
            if text:
                blank = self.remove and text.endswith(b" ")
                text = text.replace(b" ", self.space)
                out += text
                source += range(i, i + used) if kept else [i] * len(text)
            i += used
        while self.remove and last and out.endswith(self.space):
            del out[-len(self.space):]
            i = source[len(out)]
            del source[len(out):]
        return out, source + [i]

    def stretches(self, text: str) -> Iterator[tuple[str, bool, bool]]:
        """Parts of a text, and whether each is its first and its last."""
        at = 0
        while self.cuts and (found := self.cut.search(text, at + STRETCH)):
            yield text[at:found.start()], at == 0, False
            at = found.start()
        yield text[at:], at == 0, True

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a whole text, and the first and past-the-last source bytes of each."""
        parts, start = [], 0
        for part, first, last in self.stretches(text):
            data = part.encode("utf-8", "replace")
            out, source = self.normalise(data, first, last)
            if self.sizes is None:
                found = self.splitter.encode_as_offset_mapping(out)
                ids, bounds = np.array(found["ids"], np.int32), np.array(found["offsets"], np.int32).reshape(-1, 2)
                parts.append((ids, source[bounds[:, 0]] + start, source[bounds[:, 1]] + start))
            else:
                ids = self.splitter.encode_as_numpy(out)
                bounds = np.cumsum(np.append(0, self.sizes[ids]))
                parts.append((ids, source[bounds[:-1]] + start, source[bounds[1:]] + start))
            start += len(data)
        return tuple(p[0] if len(p) == 1 else np.concatenate(p) for p in zip(*parts))

    def decode(self, ids: list) -> str:
        return self.decoder.decode(ids) if ids else ""


def model(path: str, _made: dict = {}) -> Pieces:  # noqa: B006
    """One model for each file in a worker."""
    if path not in _made:
        with open(path, "rb") as f:
            _made[path] = Pieces(f.read())
    return _made[path]


def _per_text(docs: DataFrame, path: str, id_col: str, text_col: str, columns: dict[str, str], row) -> DataFrame:
    """The values ``row(model, text)`` for each text; texts are taken from their batch one by
    one."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = ", ".join(f"{k} {v}" for k, v in {"doc_id": dict(narrow.dtypes)["doc_id"], **columns}.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            values = zip(*(row(pieces, t.as_py()) for t in batch.column(1))) if len(batch) else [()] * len(columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values)], ["doc_id", *columns])

    return narrow.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, begins, ends``: the ids of every text and the span of source bytes of
    each."""
    lists = dict.fromkeys(("ids", "begins", "ends"), "array<int>")
    return _per_text(docs, path, id_col, text_col, lists, lambda pieces, text: pieces.encode(text))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` for rows of ids; null ids give an empty text."""
    narrow = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            texts = pa.array([pieces.decode(x.as_py() or []) for x in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return narrow.mapInArrow(run, f"doc_id {dict(narrow.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32`` for every row of ``docs``; the
    last one over all first bytes, then all ends, as little-endian 32-bit integers."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def row(pieces: Pieces, text: str) -> tuple:
        ids, begins, ends = pieces.encode(text)
        listed = ids.tolist()
        return (len(listed), sha(",".join(map(str, listed))), sha(pieces.decode(listed)),
                zlib.crc32(ends.astype("<i4").tobytes(), zlib.crc32(begins.astype("<i4").tobytes())))

    return _per_text(docs, path, id_col, text_col, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string",
                                                    "spans_crc32": "long"}, row)
