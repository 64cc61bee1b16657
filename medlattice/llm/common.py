"""What several training-data operators share: words, table reading, views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.session import cut_lineage, read_table

__all__ = ["cut_lineage", "documents", "in_slices", "in_small_batches", "lower_words", "n_words", "packed", "read_table", "remainder", "row_key", "utf8", "words"]

_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
BATCH = 512

#: a word is a run of anything but these bytes
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of ``documents``, whatever else the table carries."""
    return read_table(spark, sf_dir, "documents").select(*columns)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def n_words(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns beside the whole row as struct ``row``, so that no other column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def row_key(doc_id: str, text_hash: Column | str) -> list[Column]:
    """Plain equality columns that name a row by its id, null included, and the hash of its text. A join and a
    removal of repeated rows by the same columns share one exchange."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("key"), F.col(doc_id).isNull().alias("no_id"), (F.col(text_hash) if isinstance(text_hash, str) else text_hash).alias("h")]


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``. A null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column and its n+1 offsets, without copying the text. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n, first = len(column), column.offset
    ends = np.frombuffer(offsets, dtype=np.int64)[first : first + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with Arrow batches of ``BATCH`` rows for the session unless the user chose a size: at the
    default of 10,000 rows a batch of long texts alone takes hundreds of megabytes of each task."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        conf.set(_BATCH_CONF, BATCH)
    return docs


def in_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with at most ``limit`` bytes of text each (a longer row stands
    alone), so that work arrays stay small whatever the batch size is."""
    _, ends = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


def lower_words(data: bytes) -> list[bytes]:
    """Words of UTF-8 text with A-Z lower-cased; both steps of ``bytes`` touch ASCII only."""
    return data.lower().split()
