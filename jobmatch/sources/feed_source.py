"""Feed items that can be read from a broken feed (S5, U2, Q2): a Python data source.

``rss_items`` reads landed feed files, one partition per file, in batch and as a stream.  A
file is read in blocks and cut at its ``<item>`` tags (comments and CDATA sections are
skipped), each item is parsed by itself, and its place in the file comes from the reader, so
no window numbers the rows of a file.  What is wrong with one item sets that item aside, with
its text and the ``problem``; the others stay:

* an item that does not parse, that has bytes outside the file's encoding, or no GUID;
* an item without its end tag: the rest of a truncated file, or what stands before the next
  start tag;
* a file whose encoding is not known is one row; a file without items (an empty one too)
  gives none.

Places count all items of a file, those set aside too.  Missing elements are null; text is
trimmed; of a repeated element other than ``category`` the last counts.  A task holds one block
and one item; only after a comment or section that is never closed, the rest of the file.

As a stream, a batch takes the files landed since the last one, by modification time, and numbers
them by path, so a feed that is landed in several parts keeps their order.  The offset is the last
time taken and the files of that very time, so it does not grow with the folder.  A file
must not land with a time before one already taken (``settle`` seconds give writers time:
younger files wait for the next batch).
"""

from __future__ import annotations

import codecs
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..plans.sizing import cut_lineage

FORMAT = "rss_items"
BLOCK = 1 << 20
BATCH_ITEMS = 1024             # items that a reader holds at a time
SCHEMA = ("file string, file_no int, place bigint, guid string, title string, author string, "
          "category array<string>, problem string, raw string")
_FIELDS = pa.schema([("file", pa.string()), ("file_no", pa.int32()), ("place", pa.int64()), ("guid", pa.string()),
                     ("title", pa.string()), ("author", pa.string()), ("category", pa.list_(pa.string())),
                     ("problem", pa.string()), ("raw", pa.string())])
_MARK = re.compile(r"<!--|<!\[CDATA\[|<item(?=[\s/>])[^>]*/>|<item(?=[\s/>])|</item\s*>")
_CLOSED_BY = {"<!--": "-->", "<![CDATA[": "]]>"}
_TAIL = 64                     # a mark cut by the end of a block is shorter, or starts an item
_ENCODING = re.compile(rb"""<\?xml[^>]*encoding\s*=\s*["']([A-Za-z0-9._-]+)""")
_BOMS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def cut_items(blocks: Iterator[str]) -> Iterator[tuple[str, bool]]:
    """``(text, whole)`` of every item, in order; what is outside of items is dropped."""
    text, at, start, done = "", 0, None, False
    blocks = iter(blocks)
    while True:
        mark = _MARK.search(text, at)
        closer = mark and _CLOSED_BY.get(mark.group())
        close = text.find(closer, mark.end()) if closer else -1
        short = mark is None or mark.end() > len(text) - _TAIL or (closer and close < 0)
        if short and not done:
            # what is before the mark (or the end) is settled; an open item is kept
            keep = start if start is not None else (mark.start() if mark else max(at, len(text) - _TAIL))
            at = (mark.start() if mark else max(at, len(text) - _TAIL)) - keep
            start = 0 if start is not None else None
            more = next(blocks, None)
            done = more is None
            text = text[keep:] + (more or "")
            continue
        if mark is None:
            break
        at = mark.end()
        if closer:
            at = close + len(closer) if close >= 0 else at      # never closed: read on behind its mark
        elif mark.group().startswith("</"):
            if start is not None:
                yield text[start:at], True
                start = None
        else:
            if start is not None:
                yield text[start:mark.start()], False
            start = mark.start()
            if mark.group().endswith("/>"):
                yield mark.group(), True
                start = None
    if start is not None:
        yield text[start:], False


def parse_item(xml: str) -> dict:
    """The fields of one item, without regard to name spaces declared around it."""
    path: list[str] = []
    texts: list[list[str]] = []
    item: dict = {"guid": None, "title": None, "author": None, "category": []}

    def opened(name: str, _attributes: dict) -> None:
        path.append(name)
        texts.append([])

    def closed(_name: str) -> None:
        value = "".join(texts.pop()).strip()
        inner = path[1:]
        path.pop()
        if inner == ["category"]:
            item["category"].append(value)
        elif inner in (["guid"], ["title"]):
            item[inner[0]] = value
        elif inner == ["author", "name"] or (inner == ["author"] and value):
            item["author"] = value

    parser = expat.ParserCreate("utf-8")
    parser.StartElementHandler, parser.EndElementHandler = opened, closed
    parser.CharacterDataHandler = lambda s: texts[-1].append(s)
    parser.Parse(xml.encode("utf-8"), True)
    return item


def _blocks(stream) -> Iterator[str]:
    first = stream.read(BLOCK)
    named = _ENCODING.match(first.lstrip())
    encoding = next((e for bom, e in _BOMS if first.startswith(bom)), named.group(1).decode() if named else "utf-8")
    decoder = codecs.getincrementaldecoder(encoding)("surrogateescape")
    while first:
        yield decoder.decode(first)
        first = stream.read(BLOCK)
    yield decoder.decode(b"", True)


def _filesystem(path: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


@dataclass
class FeedFile(InputPartition):
    path: str
    number: int


def read_file(part: FeedFile) -> Iterator[tuple]:
    fs, path = _filesystem(part.path)
    place = -1
    with fs.open_input_stream(path) as stream:
        try:
            for place, (raw, whole) in enumerate(cut_items(_blocks(stream))):
                item, problem = {}, None if whole else "the item has no end"
                if whole:
                    try:
                        item = parse_item(raw)
                        problem = None if item["guid"] else "no guid"
                    except (expat.ExpatError, UnicodeEncodeError) as e:
                        problem = str(e) if isinstance(e, expat.ExpatError) else "bytes outside the encoding"
                yield (part.path, part.number, place, item.get("guid") or None, item.get("title"), item.get("author"),
                       item.get("category") or None, problem,
                       raw.encode("utf-8", "replace").decode() if problem else None)
        except (LookupError, UnicodeDecodeError) as e:
            yield part.path, part.number, place + 1, None, None, None, None, f"the file cannot be decoded: {e}", None


def read_batches(part: FeedFile) -> Iterator[pa.RecordBatch]:
    """The rows of a file in batches of ``BATCH_ITEMS``; of plain rows, Spark would gather ten
    times as many, in lists, whatever their size."""
    for rows in batched(read_file(part), BATCH_ITEMS):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def list_files(path: str) -> list[tuple[int, str]]:
    """``(modification time, path)`` of the landed files, in this order; names that begin with
    ``_`` or ``.`` are not data, as for Spark's own file sources."""
    from pyarrow.fs import FileSelector, FileType
    path = path.rstrip("/")
    fs, root = _filesystem(path)
    prefix = path[:len(path) - len(root)] if path.endswith(root) else ""     # scheme and host
    found = []
    for info in fs.get_file_info(FileSelector(root, recursive=True, allow_not_found=True)):
        inner = info.path[len(root):].strip("/").split("/")
        if info.type == FileType.File and not any(p.startswith(("_", ".")) for p in inner):
            found.append((info.mtime_ns or 0, prefix + info.path))
    return sorted(found)


class FeedReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        # by path: a feed's files count in the order of their names
        return [FeedFile(p, i) for i, p in enumerate(sorted(p for _t, p in list_files(self.path)))]

    def read(self, partition):
        return read_batches(partition)


class FeedStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.settle = options["path"], float(options.get("settle", 0))

    def initialOffset(self) -> dict:
        return {"time": -1, "files": []}

    def latestOffset(self) -> dict:
        settled = time.time_ns() - int(self.settle * 1e9)
        files = [(t, p) for t, p in list_files(self.path) if self.settle <= 0 or t <= settled]
        if not files:
            return self.initialOffset()
        last = files[-1][0]
        return {"time": last, "files": [p for t, p in files if t == last]}

    def partitions(self, start: dict, end: dict):
        def within(t: int, p: str) -> bool:
            taken = t < start["time"] or (t == start["time"] and p in start["files"])
            return not taken and (t < end["time"] or (t == end["time"] and p in end["files"]))
        return [FeedFile(p, i) for i, p in enumerate(sorted(p for t, p in list_files(self.path) if within(t, p)))]

    def read(self, partition):
        return read_batches(partition)

    def commit(self, end: dict) -> None:
        pass


class FeedSource(DataSource):
    """``spark.read.format("rss_items").load(folder)``, ``readStream`` likewise."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return FeedReader(self.options)

    def streamReader(self, schema):
        return FeedStreamReader(self.options)


def _with_feed(rows: DataFrame) -> DataFrame:
    """``feed_index`` from the folder ``feed_index=N``, or else the digits of the file's name."""
    folder, name = (F.regexp_extract("file", rx, 1) for rx in (r"feed_index=(\d+)/", r"(\d+)[^/]*$"))
    return rows.withColumn("feed_index", F.coalesce(F.nullif(folder, F.lit("")), F.nullif(name, F.lit(""))).cast("int"))


def read_feeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good items ``(feed_index, item_index, guid, title, author, category)`` and those set
    aside ``(file, place, guid, title, problem, raw)``.  ``item_index`` counts all items of a
    feed over its files, as ``read_feed_items`` does: the place plus the sizes of the
    feed's earlier files (one row a file)."""
    from pyspark.sql import Window
    spark.dataSource.register(FeedSource)
    rows = cut_lineage(_with_feed(spark.read.format(FORMAT).load(path)))     # parsed once
    sizes = rows.groupBy("feed_index", "file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("feed_index").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    good = rows.filter("problem IS NULL").join(starts, "file").select(
        "feed_index", (F.col("_start") + F.col("place")).alias("item_index"), "guid", "title", "author", "category")
    return good, rows.filter("problem IS NOT NULL").select("file", "place", "guid", "title", "problem", "raw")


def read_feeds_stream(spark: SparkSession, path: str, settle: float = 0) -> DataFrame:
    """The same rows as a stream, good and bad: ``SCHEMA`` and ``feed_index``."""
    spark.dataSource.register(FeedSource)
    return _with_feed(spark.readStream.format(FORMAT).option("settle", str(settle)).load(path))
