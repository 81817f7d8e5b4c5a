"""Token counts: batches of Arrow rows balanced by bytes, encoded by the library, of
which only lengths are returned.

Defined cases: a null text counts as empty, with no bytes and no tokens; null ids are
returned as they are; every row is counted, equal ones too; an empty table gives no rows.
Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import by_bytes, encoder, releasing

LIMIT = 512


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width = enc.dtype.itemsize
        for batch in batches:
            sizes = pc.binary_length(batch.column(1).cast(pa.binary()))
            texts, counts = batch.column(1), []
            for a, b in by_bytes(sizes.to_pylist()):
                counts += [len(x) // width for x in enc.ids(texts.slice(a, b - a).to_pylist())]
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes.cast(pa.int64()), n, pc.greater(n, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(releasing(count), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
