"""Reading and small expressions that the operators of this package share."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectorgauge.sources.stages import stage

#: A word is a longest run of characters outside this ASCII white space.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Files whose numbers may be broadcast (a path each); more are joined by shuffle.
BROADCAST_FILES = 20_000
#: Rows of one file that a row key tells apart: 2 to this power.
ROW_BITS = 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def checksum_fold(doc_id: Column, folds: int = 5) -> Column:
    """Fold of a document: crc32 of its id written as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of their lowest to highest bytes."""
    little = numbers.astype(numbers.dtype.newbyteorder("<"))
    planes = np.ascontiguousarray(little.view(np.uint8).reshape(-1, little.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _row_place(table: DataFrame) -> list[Column]:
    """File of a row and its place in it."""
    meta = table.metadataColumn("_metadata")
    return [meta["file_path"].alias("row_file"), meta["row_index"].alias("row_place")]


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` if it is a table as read, whose rows have a file and a place; else stored now."""
    try:
        docs.select(*_row_place(docs)).schema
    except AnalysisException:
        return stage(docs, "docs")
    return docs


def with_row_keys(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``row_key`` and the named columns: a key of its own for every row, the same in every read.

    The key is the number of the row's file and its place there, so rows that agree in
    ``doc_id``, or in everything, are told apart without a copy of the table. ``docs`` has to
    be a Parquet table as read, or the result of ``stored``. Only the file numbers move.
    """
    placed = docs.select(*columns, *_row_place(docs))
    files = placed.select("row_file").distinct()
    files = files.select(
        F.col("row_file").alias("numbered_file"),
        (F.row_number().over(Window.orderBy("row_file")) - 1).cast("long").alias("file_number"),
    )
    files = stage(files, "files")
    if files.count() <= BROADCAST_FILES:
        files = F.broadcast(files)
    key = F.shiftleft("file_number", ROW_BITS) + F.col("row_place")
    return placed.join(files, F.col("row_file") == F.col("numbered_file")).select(
        key.alias("row_key"), *placed.columns[:-2]
    )
