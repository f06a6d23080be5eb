"""What the operators of this subpackage share: tables, the shared folder, Arrow helpers and skew-safe joins."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.operators.lineage import cut, discard, stored
from spindrift.operators.lineage import shared_folder as ensure_checkpoint_dir
from spindrift.operators.skew import components, join_counted

__all__ = ["bitmap", "components", "cut", "discard", "ensure_checkpoint_dir", "free_name", "in_bitmap", "join_counted", "may_be_in", "ranges", "regroup", "release", "stored", "strings", "table"]

#: Rows in an Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; Arrow batches of the session become small, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Gives the free memory of this worker back to the system; workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Null texts count as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def regroup(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Tables of about `limit` bytes of `column`; one longer row makes a table of its own size."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(column)).get_total_buffer_size() if batch.num_rows else 0
        if size >= limit:
            whole, held, size = pa.Table.from_batches(held), [], 0
            yield whole
            del whole
    if held:
        yield pa.Table.from_batches(held)
    del held
    release()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes starts[0] .. starts[0]+lengths[0]-1, starts[1] .. and so on."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


#: Bits of a bitmap, as powers of two: the least, the most (16 MB), and how many more than values there are.
BITMAP_LEAST, BITMAP_MOST, BITMAP_ROOM = 20, 27, 4


def bitmap(numbers: DataFrame) -> np.ndarray:
    """Bits for the values of the one long column of a table, folded to 16 bits a value, 16 MB at most.

    A filter: it lets through every value of the table and some others, about 1 in 16, and more only
    beyond 2^23 values; what passes is joined exactly afterwards. At most 2^BITMAP_MOST / 64 rows come to
    the driver.
    """
    column = F.col(numbers.columns[0])
    held = numbers.where(column.isNotNull())
    size = min(BITMAP_MOST, max(BITMAP_LEAST, int(held.count()).bit_length() + BITMAP_ROOM))
    place = held.select(F.pmod(column, F.lit(1 << size)).alias("at"))
    words = place.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.astype(np.int64) & (64 * len(bits) - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def free_name(name: str, *taken: list[str]) -> str:
    """name, with underscores before it until it differs from all column names taken (in any case)."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name = "_" + name
    return name


def may_be_in(bits: np.ndarray, ids: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """in_bitmap for a column of ids; null ids always pass."""
    missing = ids.is_null().to_numpy(zero_copy_only=False) if isinstance(ids, pa.Array) else ids.is_null().to_numpy()
    return missing | in_bitmap(bits, ids.fill_null(0).to_numpy())
