"""Ranks of rows by several integer keys: a distributed radix sort, least significant digit first.

Rows stand at positions, cut into chunks of CHUNK. Each pass takes one digit of the keys, from the
least significant one of the last key to the most significant one of the first. A chunk puts its rows in
order by a stable counting sort and tells how many it has of each digit; sums of these counts over
smaller digits, and over earlier chunks of the same digit, give every row its position for the next pass.
No task holds more than one chunk, and nothing but the keys' ranges goes to the driver.

Rows of equal keys get neighbouring ranks in any order. A key must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.llm.shared import ship, written

DIGIT_BITS = 12
CHUNK = 1 << 17
U64 = np.uint64


def _counting_pass(key: str, low: int, shift: int, names: list[str], first: bool):
    """Sorts one chunk by one digit; `pos` gives the order the rows are in before."""

    def work(table: pa.Table) -> pa.Table:
        n = table.num_rows
        before = np.arange(n)
        if not first:
            pos = table.column("pos").to_numpy()
            before = np.empty(n, dtype=np.int64)
            before[pos % CHUNK] = np.arange(n)
        value = table.column(key).to_numpy()[before]
        digit = ((value.view(U64) - np.int64(low).view(U64)) >> U64(shift)).astype(U64) & U64((1 << DIGIT_BITS) - 1)
        digit = digit.astype(np.uint16)
        count = np.bincount(digit, minlength=1 << DIGIT_BITS)
        order = np.argsort(digit, kind="stable")
        within = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
        out = table.take(pa.array(before[order]))
        columns = [out.column(c) for c in names]
        return pa.table([*columns, out.column("chunk"), pa.array(digit[order].astype(np.int32)), pa.array(within)], [*names, "chunk", "digit", "within"])

    return work


def ranks(rows: DataFrame, row: str, keys: Sequence[str]) -> DataFrame:
    """`row` and `rank` (from 1) of every row, by the keys in ascending order, the first one most significant."""
    spark = rows.sparkSession
    ship(spark)
    names = [row, *keys]
    rows = written(rows.select(*names), "sort-keys")
    span = rows.agg(F.count(F.lit(1)), *[f(k) for k in keys for f in (F.min, F.max)]).first()
    total = span[0]
    if not total:
        return rows.select(row, F.lit(0).cast("long").alias("rank"))
    chunks = -(-total // CHUNK)
    passes = []
    for i in reversed(range(len(keys))):
        low, high = span[1 + 2 * i], span[2 + 2 * i]
        passes += [(keys[i], low, s) for s in range(0, (high - low).bit_length(), DIGIT_BITS)]
    passes = passes or [(keys[0], span[1], 0)]
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in [*names, "chunk"]], T.StructField("digit", T.IntegerType()), T.StructField("within", T.LongType())])
    at = rows.select(*names, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"), F.lit(0).cast("long").alias("pos"))
    for number, (key, low, shift) in enumerate(passes):
        dealt = written(at.groupBy("chunk").applyInArrow(_counting_pass(key, low, shift, names, number == 0), schema), "sort-pass")
        held = dealt.groupBy("digit", "chunk").agg(F.count(F.lit(1)).alias("c"))
        # At most 2 ** DIGIT_BITS rows, one for each digit.
        digits = held.groupBy("digit").agg(F.sum("c").alias("c"))
        before = F.coalesce(F.sum("c").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        digits = digits.select("digit", before.alias("start"))
        earlier = F.coalesce(F.sum("c").over(Window.partitionBy("digit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = held.select("digit", "chunk", earlier.alias("earlier")).join(digits, "digit").select("digit", "chunk", (F.col("start") + F.col("earlier")).alias("offset"))
        at = dealt.join(offsets, ["chunk", "digit"]).select(*names, (F.col("offset") + F.col("within")).alias("pos"))
        at = at.select(*names, F.expr(f"pos div {CHUNK}").alias("chunk"), "pos")
    return at.select(row, (F.col("pos") + 1).alias("rank"))
