"""Text sources (S1, S2, S9), and the landing of texts as files of their own."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from importlib import import_module
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..plans.sizing import shuffle_partitions


def text_lines(spark: SparkSession, path: str, shards: int | None = None) -> DataFrame:
    """``(line)`` of text files; ``repartition(shards)`` only when asked."""
    df = spark.read.text(path).withColumnRenamed("value", "line")
    return df.repartition(shards) if shards else df


SHARDS = 256             # folders that the folders of texts are dealt to


def land_texts(df: DataFrame, key: str, path: str, text_col: str = "text") -> int:
    """One folder ``key=...`` per text, its line in a file there (a null text is an empty line);
    returns the number of rows.  The folders lie in ``SHARDS`` others, so that readers list them in
    as many tasks.  Each task makes its files itself and gives them their names once they are
    whole: nothing is left for the driver to rename, and a task that is repeated replaces
    its own files.  Rows of one key in one task share a file, a line each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem
        fs, root = FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
        name, n, last, out, at = f"part-{TaskContext.get().partitionId():05d}.txt", 0, None, None, ""

        def close() -> None:
            if out is not None:
                out.close()
                fs.move(f"{at}/_{name}", f"{at}/{name}")

        for batch in batches:
            for folder, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if folder != last:
                    close()
                    last, at = folder, f"{root}/{folder}"
                    fs.create_dir(at, recursive=True)
                    out = fs.open_output_stream(f"{at}/_{name}", compression=None)
                if text.is_valid:
                    out.write(text.as_buffer())
                out.write(b"\n")
                n += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    value = F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    folder = F.concat(F.lit("shard="), F.pmod(F.xxhash64(key), F.lit(SHARDS)).cast("string"), F.lit(f"/{key}="), value)
    rows = df.select(folder.alias("folder"), F.col(text_col).cast("binary").alias("text"))
    return rows.sortWithinPartitions("folder").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _spark_whole_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, text)`` by Spark's reader, whose driver holds the status of every file."""
    df = spark.read.text(list(paths), wholetext=True, recursiveFileLookup=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


LISTED_ROWS = 1 << 13    # names that a task gathers before it hands them on
READ_BYTES = 4 << 20     # of texts that a task holds at a time
OPEN_BYTES = 1 << 14     # that opening a file counts as
TASK_BYTES = 1 << 25     # of texts and openings of a task
_CODECS = {"gz": "gzip", "bz2": "bz2", "zst": "zstd", "deflate": "zlib"}
_SPARK_CODECS = r"(?i)\.(snappy|lz4)$"          # Hadoop's framing; left to Spark's reader
# What a path of Java's URI class quotes.
_QUOTED = re.compile(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/\u0080-\U0010ffff]"
                     r"|[\u0080-\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PATTERN = re.compile(r"[][{}*?\\]")


def _open(uri: str):
    """The file system of a folder's URI and the folder's path there."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    if uri.startswith("file:"):
        return LocalFileSystem(), unquote(re.sub(r"^file:/+", "/", uri))
    return FileSystem.from_uri(uri)


def _folder_uri(spark: SparkSession, path: str) -> str | None:
    """The URI of a folder that Python can list too; ``None`` for files, patterns, missing paths and
    file systems that only Spark reads."""
    from py4j.protocol import Py4JJavaError
    from pyarrow.fs import FileType

    from ..session import spark_context
    sc = spark_context(spark)
    if sc is None or _PATTERN.search(path):
        return None
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        uri = p.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(p).getPath().toUri().toString()
        fs, root = _open(uri)
        return re.sub(r"^file:/+", "file:/", uri) if fs.get_file_info(root).type == FileType.Directory else None
    except (Py4JJavaError, pa.ArrowException, OSError, ImportError):
        return None


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark's readers pass over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(fs, folder: str) -> Iterator[tuple[str, int | None]]:
    """Names of a folder's folders, without a size, and of its files with theirs; empty files are
    left out, as Spark's readers give them no row."""
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem
    if isinstance(fs, LocalFileSystem):
        with os.scandir(folder) as found:       # one by one, however many they are
            for x in found:
                size = None if x.is_dir() else x.stat().st_size if os.path.exists(x) else 0
                if size != 0 and not _hidden(x.name, size is None):
                    yield x.name, size
        return
    for x in fs.get_file_info(FileSelector(folder)):
        is_folder = x.type == FileType.Directory
        if (is_folder or x.size) and not _hidden(x.base_name, is_folder):
            yield x.base_name, None if is_folder else x.size


def _listed(spark: SparkSession, uri: str) -> DataFrame:
    """``(path, size)`` of the files below a folder, by their paths in it; listed by tasks, the folders of the
    first level in one and what is in them in others."""

    def below(batches: Iterator[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
        fs, root = _open(uri)
        paths, sizes = [], []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])

        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns)):
                folders = [path] if size is None else []
                if size is not None:
                    paths.append(path)
                    sizes.append(size)
                while folders:
                    at = folders.pop()
                    for name, size in _entries(fs, f"{root}/{at}"):
                        name = f"{at}/{name}" if at else name
                        if size is None and deep:
                            folders.append(name)
                        else:
                            paths.append(name)
                            sizes.append(size)
                        if len(paths) >= LISTED_ROWS:
                            yield rows()
                            paths, sizes = [], []
        yield rows()

    from ..streaming.jobs import work_dir
    schema = "path string, size long"
    top = spark.range(0, 1, 1, 1).select(F.lit("").alias("path"), F.lit(None).cast("long").alias("size"))
    first = top.mapInArrow(lambda b: below(b, False), schema)
    files = first.repartition(shuffle_partitions(spark), "path").mapInArrow(lambda b: below(b, True), schema)
    out = work_dir(spark, "files")
    files.write.parquet(out)
    return spark.read.schema(schema).parquet(out)


def whole_text_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, name, text)``, one row per file read whole, at any depth.  No partition columns
    are made of the folders' names.  The files of a folder are listed by tasks into a stored table
    and read by tasks: the driver, which Spark's reader would give the status of every file, holds
    none of them.  Hidden and empty files have no row and compressed files are unpacked, as by Spark's reader,
    which is used where Python cannot list the path, and for the codecs that only it knows."""
    uri = _folder_uri(spark, path)
    if uri is None:
        files = _spark_whole_files(spark, path)
        return files.select("path", base_name("path").alias("name"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(uri)
        paths, texts, held = [], [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "text"])

        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    data = f.read()
                codec = _CODECS.get(name.rpartition(".")[2].lower())
                if codec in ("gzip", "bz2", "zlib"):
                    data = import_module(codec).decompress(data)
                elif codec:
                    data = pa.CompressedInputStream(pa.BufferReader(data), codec).read()
                quoted = _QUOTED.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), name)
                paths.append(f"{uri.rstrip('/')}/{quoted}")
                texts.append(data)
                held += len(data) + len(paths[-1])
                if held >= READ_BYTES:
                    yield rows()
                    paths, texts, held = [], [], 0
        yield rows()

    files = _listed(spark, uri)
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    width = max(-(-(size + n * OPEN_BYTES) // TASK_BYTES), min(n, spark.sparkContext.defaultParallelism), 1)
    out = (files.where(~F.col("path").rlike(_SPARK_CODECS)).select("path").repartition(width, "path")
           .mapInArrow(read, "path string, text binary").select("path", F.col("text").cast("string").alias("text")))
    left = [r.path for r in files.where(F.col("path").rlike(_SPARK_CODECS)).select("path").collect()]
    if left:
        left = [f"{path.rstrip('/')}/" + _PATTERN.sub(lambda m: "\\" + m[0], name) for name in left]
        out = out.union(_spark_whole_files(spark, *left))
    return out.select("path", base_name("path").alias("name"), "text")
