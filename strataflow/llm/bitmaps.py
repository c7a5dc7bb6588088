"""Bitmaps of a fixed size that let a scan skip what cannot match a later join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from strataflow.llm.arrow import in_arrow

#: Bits of a bitmap: 4 MB, whatever the corpus. A full one lets all rows pass, and the join decides alone.
BITS = 25


def bitmap_of(df: DataFrame, col: str) -> Broadcast:
    """Broadcast bitmap of a long column's values; the driver gets at most 2**(BITS - 6) rows."""
    place = F.shiftrightunsigned(F.col(col), 64 - BITS)
    words = df.select(F.shiftright(place, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - BITS}) & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    table = words.toArrow()
    if table.num_rows:
        out[table["w"].to_numpy()] = table["b"].to_numpy().view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(out)


def passing(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values (int64 or uint64) have their bit set."""
    place = values.view(np.uint64) >> np.uint64(64 - BITS)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def only_passing(df: DataFrame, col: str, bitmap: Broadcast, bit: bool = True) -> DataFrame:
    """Rows whose value has its bit set: all that match, and few others; or with ``bit`` False the rows left, none of which match."""
    at = df.columns.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passing(bitmap.value, batch.column(at).to_numpy()) == bit))

    return df.transform(in_arrow, run, df.schema)
