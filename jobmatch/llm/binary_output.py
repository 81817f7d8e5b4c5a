"""Token ids in binary shards, with a minimal perfect hash index for keyed access.

A shard is two files.  ``<n>.ids`` holds the raw little-endian ids of its documents, one
after another, in ascending order of their keys.  ``<n>.idx`` holds a minimal perfect
hash over the shard's distinct keys (levels of bit arrays: a key is placed at the first
level at which no other key shares its bit; its rank among all bits is its number), and,
by that number, a fingerprint of the key, its first document and their count; then each
document's key, offset and length.  One lookup reads a bit and a rank per level and one
entry, whatever the number of keys.

Files are written by the tasks into the shared folder under a temporary name and then
renamed, so that a task that is run again replaces its own files by equal ones.  The
manifest, one row for each shard, is written by Spark after all shards are there.

Defined cases: a null text is empty (its document has the end id alone); a null key
comes first and is looked up as None; documents with equal keys lie next to each other
and one lookup finds them all (in one or more neighbouring shards); an empty table gives
no shards.  Only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark import TaskContext

from .common import stored, work_path
from .tokens import by_bytes, encoder, releasing

END_ID = 0
MAGIC = b"IDS1"
GAMMA = 2                # bits of a level for each key that reaches it
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
NULL_KEY = np.uint64(0x6E756C6C)
MANIFEST = "shard int, ids_path string, idx_path string, n_docs long, n_tokens long, first_key long, last_key long"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys ^ np.uint64(seed * _ODD[0] & 0xFFFFFFFFFFFFFFFF)
    for odd, shift in zip(_ODD, (30, 27, 31)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Numbers 0 to n-1 for n distinct 64-bit keys; any number for other keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.concatenate([[0], np.cumsum(flat)])
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(2, GAMMA * len(keys))
            at = (_mix(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        for i, bits in enumerate(self.levels):
            at = (_mix(keys, i + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = (found < 0) & bits[at]
            found[hit] = self.rank[self.start[i] + at[hit]]
        return found


def _as_keys(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys and a mask of nulls."""
    null = np.asarray(ids.is_null())
    return np.asarray(ids.fill_null(0)).astype(np.int64).view(np.uint64), null


def _hashed(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """What the index is built on: nulls are a key of their own."""
    return np.where(null, NULL_KEY, _mix(keys, 0))


def _index_bytes(keys: np.ndarray, null: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    hashed = _hashed(keys, null)
    new = np.concatenate([[True], (hashed[1:] != hashed[:-1])]) if len(hashed) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    mph = PerfectHash.build(hashed[first])
    number = mph.number(hashed[first])
    entries = np.zeros((3, len(first)), np.int64)
    entries[0, number] = hashed[first].view(np.int64)           # fingerprint
    entries[1, number] = first
    entries[2, number] = np.diff(np.concatenate([first, [len(hashed)]]))
    out = io.BytesIO()
    np.savez(out, width=width, sizes=np.array([len(x) for x in mph.levels], np.int64),
             bits=np.packbits(np.concatenate(mph.levels) if mph.levels else np.zeros(0, bool)),
             entries=entries, keys=keys, null=np.packbits(null),
             offsets=np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
    return MAGIC + out.getvalue()


class Shard:
    """A shard that is open for reading."""

    def __init__(self, files: fs.FileSystem, ids_path: str, idx_path: str):
        with files.open_input_stream(idx_path) as f:
            raw = f.read()
        if raw[:4] != MAGIC:
            raise ValueError(f"not an index of token ids: {idx_path}")
        x = np.load(io.BytesIO(raw[4:]))
        self.dtype = np.dtype(f"<u{int(x['width'])}")
        bits = np.unpackbits(x["bits"])[:x["sizes"].sum()].astype(bool)
        self.index = PerfectHash(np.split(bits, np.cumsum(x["sizes"])[:-1]) if len(x["sizes"]) else [])
        self.entries, self.keys, self.offsets = x["entries"], x["keys"], x["offsets"]
        self.null = np.unpackbits(x["null"])[:len(self.keys)].astype(bool)
        self.file = files.open_input_file(ids_path)

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and count for each hashed key; count 0 where the stored
        fingerprint is another key's."""
        number = self.index.number(hashed)
        known = number >= 0
        known[known] = self.entries[0, number[known]] == hashed[known].view(np.int64)
        return (np.where(known, self.entries[1, number], 0), np.where(known, self.entries[2, number], 0))

    def ids(self, doc: int) -> np.ndarray:
        a, b = int(self.offsets[doc]), int(self.offsets[doc + 1])
        w = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((b - a) * w, a * w), self.dtype)

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of every document with this key."""
        hashed = _hashed(np.array([key or 0], np.int64).view(np.uint64), np.array([key is None]))
        first, n = self.find(hashed)
        return [self.ids(int(first[0]) + i) for i in range(int(n[0]))]


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """A file system that tasks can write to without Spark, and the folder in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Write all documents in ascending order of their keys; the manifest is returned."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width, end = enc.dtype.itemsize, np.array([END_ID], enc.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        tmp = f"{base}/.{shard}-{uuid.uuid4().hex}"
        keys, nulls, lengths = [], [], []
        with files.open_output_stream(f"{tmp}.ids") as out:
            for batch in batches:
                texts = batch.column(1)
                for a, b in by_bytes(pc.binary_length(texts.cast(pa.binary())).to_pylist()):
                    found = [x + end for x in enc.ids(texts.slice(a, b - a).to_pylist())]
                    lengths += [len(x) // width for x in found]
                    out.write(b"".join(found))
                k, null = _as_keys(batch.column(0))
                keys.append(k)
                nulls.append(null)
        if not lengths:
            files.delete_file(f"{tmp}.ids")
            return
        k, null, n = np.concatenate(keys), np.concatenate(nulls), np.array(lengths, np.int64)
        with files.open_output_stream(f"{tmp}.idx") as out:
            out.write(_index_bytes(k, null, n, width))
        for kind in ("ids", "idx"):
            files.move(f"{tmp}.{kind}", f"{base}/{shard}.{kind}")
        known = k[~null].view(np.int64)
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "ids_path": f"{base}/{shard}.ids", "idx_path": f"{base}/{shard}.idx",
            "n_docs": len(n), "n_tokens": int(n.sum()),
            "first_key": int(known[0]) if len(known) and not null.any() else None,
            "last_key": int(known[-1]) if len(known) else None}],
            schema=pa.schema([("shard", pa.int32()), ("ids_path", pa.string()), ("idx_path", pa.string()),
                              ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_key", pa.int64()),
                              ("last_key", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.monotonically_increasing_id().alias("tie"))
    # The running id spreads a key with very many rows over several shards.
    placed = rows.repartitionByRange("k", "tie").sortWithinPartitions("k", F.xxhash64("t"))
    return stored(placed.select("k", "t").mapInArrow(releasing(write), MANIFEST), "manifest")


def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, found by its key in the
    index of its shard, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            shard = Shard(files, row["ids_path"], row["idx_path"])
            hashed = _hashed(shard.keys, shard.null)
            first, count = shard.find(hashed)
            run = np.concatenate([[True], hashed[1:] != hashed[:-1]])
            # The place of each document among those with its key.
            place = np.arange(len(hashed)) - np.maximum.accumulate(np.where(run, np.arange(len(hashed)), 0))
            if (count <= place).any():
                raise ValueError(f"a key of shard {row['shard']} is not in its index")
            at = first + place
            crc = [zlib.crc32(shard.ids(i).astype("<u4")) for i in at.tolist()]
            keys = pa.array(shard.keys.view(np.int64), pa.int64(), mask=shard.null)
            start = shard.offsets[at] + row["before"]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(start), pa.array(np.diff(shard.offsets)[at]), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return (listed.repartition(max(1, manifest.count()), "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def lookup(spark: SparkSession, manifest: DataFrame, folder: str, key: int | None) -> list[list[int]]:
    """The ids of the documents with one key: the shards whose range has it, one lookup each."""
    files, _ = open_folder(folder)
    hit = F.col("first_key").isNull()
    if key is not None:
        hit = (hit | (F.col("first_key") <= key)) & (F.col("last_key") >= key)
    rows = manifest.where(hit).orderBy("shard").collect()
    return [ids.tolist() for r in rows for ids in Shard(files, r["ids_path"], r["idx_path"]).get(key)]


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` to a new folder of the shared checkpoint folder and read them back."""
    folder = work_path(docs.sparkSession, "ids")
    return read_back(write_shards(docs, tokenizer_path, folder), folder)
