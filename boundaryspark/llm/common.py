"""Shared helpers: columns appended by Arrow functions, counted broadcasts, bit tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.operators.components import connected_components  # noqa: F401

#: Rows that a broadcast may have; callers' rows are under 200 bytes, so a copy stays below 20 MB.
BROADCAST_ROWS = 100_000

#: Rows that an appending function sees at once: its results stay small beside Spark's own batches.
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def append_columns(df: DataFrame, fields: list[T.StructField],
                   function: Callable[[pa.RecordBatch], list[pa.Array]], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the columns that `function` makes of each Arrow batch; input columns of the same names are replaced."""
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names and f.name not in drop]
    schema = T.StructType([*kept, *fields])
    kept_names, out_names = [f.name for f in kept], [*[f.name for f in kept], *[f.name for f in fields]]

    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(first, SLICE_ROWS)
                columns = [batch.column(batch.schema.get_field_index(n)) for n in kept_names]
                yield pa.RecordBatch.from_arrays([*columns, *function(batch)], names=out_names)
    return df.mapInArrow(run, schema)


def broadcast_if_counted(written: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a written table whose rows, counted, are few; otherwise a shuffled join."""
    return F.broadcast(written) if written.limit(limit + 1).count() <= limit else written


#: Bits of the tables that tell later passes which hashes matter; they fill up with very many hashes and
#: then let more rows through, but their size never grows.
TABLE_BITS = 26


def hash_table(df: DataFrame, value: Column) -> bytes:
    """A bit table of fixed size in which the low bits of every hash are set.

    The high bits would not do: anchors are least hashes, whose high bits are mostly zero.
    """
    bits = df.select(value.bitwiseAND(F.lit((1 << TABLE_BITS) - 1).cast("long")).alias("bit"))
    parts = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = bytearray((1 << TABLE_BITS) // 8 + 4096)
    for bucket, part in parts:
        # the bitmap functions number buckets from 1 for bits above 0; bucket 0 holds bit 0 alone
        at = max(0, bucket) * 4096
        out[at:at + len(part)] = part
    return zlib.compress(bytes(out), 1)


def table_of(packed: bytes):
    """Function that tells for an array of 64-bit hashes which are in the table."""
    table_bytes = np.frombuffer(zlib.decompress(packed), np.uint8)

    def known(hashes: np.ndarray) -> np.ndarray:
        place = _bitmap_place(hashes.view(np.int64) & np.int64((1 << TABLE_BITS) - 1))
        return (table_bytes[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
    return known


def _bitmap_place(value: np.ndarray) -> np.ndarray:
    """Place of a value in the joined bitmaps: Spark's bucket of 32768 bits and its position there."""
    bucket = np.where(value > 0, 1 + (value - 1) // 32768, value // 32768)
    position = np.where(value > 0, (value - 1) % 32768, -value % 32768)
    return bucket * 32768 + position
