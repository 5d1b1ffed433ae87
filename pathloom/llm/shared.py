"""Helpers of the Spark side: written tables in the shared folder, even dealing out, plain sources."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.scratch import shared_folder


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this library where their path does not hold it yet."""
    root = Path(__file__).resolve().parents[2]
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(root) in [os.path.realpath(p) for p in paths if p] or getattr(spark.sparkContext, "_pathloom_shipped", False):
        return
    file = Path(tempfile.mkdtemp(prefix="ship-")) / "pathloom_library.zip"
    with zipfile.ZipFile(file, "w") as z:
        for module in [p for top in ("pathloom", "workload") for p in sorted((root / top).rglob("*.py"))]:
            z.write(module, module.relative_to(root))
    spark.sparkContext.addPyFile(str(file))
    spark.sparkContext._pathloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again.

    This cuts the lineage, so that a lost executor costs no recomputation, and gives the planner the
    true size, by which it may choose a broadcast.
    """
    spark = df.sparkSession
    ship(spark)
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def parts(spark: SparkSession) -> int:
    """How many ways work that is shuffled is split: the session's own number of partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n numbers of which hash partitioning into n partitions sends one to each."""
    rows = (
        spark.range(0, 40 * n + 200, 1, 1)
        .select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p"))
        .groupBy("p")
        .agg(F.min("id").alias("id"))
        .collect()
    )
    found = {r["p"]: r["id"] for r in rows}
    spare = 40 * n + 200
    return [found.get(i, spare + i) for i in range(n)]


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def shielded(df: DataFrame, used: set[str]) -> DataFrame:
    """`df` with plain names for the columns an operator does not use, so that none can clash with its own; `toDF` gives them back."""
    return df.toDF(*[c if c in used else f"further{i}" for i, c in enumerate(df.columns)])


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


#: Rows of one number each that are broadcast at most: about 64 MB.
MOST_BROADCAST = 4_000_000


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Inner join of `left` with `right`, whose keys are unique, where a few keys may hold most rows of `left`.

    `right` tells in column `c`, which goes, how many rows of `left` a key has, and is read more than once. A key with
    more than its share is dealt to several tasks by a hash of the column `spread`, and its row of `right` goes to each
    of them. Fewer than 4 keys a partition can be so; these alone are broadcast.
    """
    spark = left.sparkSession
    fair = 4 * parts(spark)
    total, most = right.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.max("c"), F.lit(0))).first()
    if most * fair <= total or total <= fair:
        return left.join(right.drop("c"), keys)
    hot = right.where(F.col("c") * fair > total).select(*keys, F.ceil(F.col("c") * fair / total).cast("int").alias("__salts"))
    hot = F.broadcast(spark.createDataFrame([tuple(r) for r in hot.collect()], hot.schema))
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int"), F.lit(0))
    left = left.join(hot, keys, "left").withColumn("__salt", salt).drop("__salts")
    right = right.drop("c").join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key `ids` has, null included; `ids` is broadcast where it is small enough, and read more than once."""
    ids = ids.select(F.col(key).alias("__id"))
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    return rows.join(ids, rows[key].eqNullSafe(F.col("__id")), "left_semi")
