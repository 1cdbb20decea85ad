"""Small helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: cuts the
    lineage, survives lost executors."""
    return write_table(spark, df, name)


def id_crc(id_col: str) -> Column:
    """crc32 of the id written as text (the fold of a document)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ids that may be broadcast; beyond that the join shuffles
BROADCAST_ROWS = 2_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow, written table as the side of a join: broadcast if it is
    counted to be small, shuffled if not."""
    return F.broadcast(df) if df.count() <= rows else df

def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts whose strings of ``column`` have about ``limit``
    bytes; a longer one is alone."""
    if batch.num_rows:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // limit
        starts = np.append(0, np.flatnonzero(np.diff(part)) + 1).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)


# lower-cases A-Z alone
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def slices(text: str, gap: re.Pattern, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in parts of about ``size`` code points, each cut before a
    match of ``gap``; a longer stretch without one stays whole."""
    at = 0
    while len(text) - at > size:
        m = gap.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


def byte_letters() -> list[str]:
    """The printable characters that byte-level vocabularies write bytes as:
    printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
