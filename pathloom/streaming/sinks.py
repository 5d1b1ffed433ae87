"""Streaming sinks and their trigger, rows packed for a message queue, and rows written apart from rejected texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pathloom.functions.records import sql_name
from pathloom.operators.extract import parse_json, split_rejects

SINKS = ("kafka", "parquet", "console")
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


def pack_rows(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """``key`` and ``value`` of a message for each row: all columns as one JSON object, NULLs included.

    The key is the text of one column, or the JSON object of several; without any it is NULL, and the queue
    deals rows out as it likes. Binary columns are base64 text, as in any JSON of Spark.
    """
    named = lambda columns: F.to_json(F.struct(*[F.col(sql_name(c)) for c in columns]), {"ignoreNullFields": "false"})
    missing = [c for c in key if c not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing} to make a key of")
    packed_key = F.lit(None).cast("string") if not key else F.col(sql_name(key[0])).cast("string") if len(key) == 1 else named(key)
    return df.select(packed_key.alias("key"), named(df.columns).alias("value"))


def unpack_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that ``pack_rows`` made messages of."""
    return parse_json(df, schema)


def write_stream(
    df: DataFrame,
    sink: str,
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
    key: Sequence[str] = (),
) -> DataStreamWriter:
    """Append-mode writer for the named sink; ``checkpointLocation`` is one of the options.

    Writes a micro-batch every ten seconds unless a trigger is given, such as
    ``{"availableNow": True}``. For Kafka, rows without a column ``value`` are packed (``pack_rows``) by ``key``.
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}, expected one of {SINKS}")
    options = dict(options or {})
    if sink == "kafka" and "value" not in df.columns:
        df = pack_rows(df, key)
    if sink == "parquet" and "path" not in options:
        raise ValueError("the parquet sink needs a path")
    writer = df.writeStream.format(sink).outputMode("append").options(**options)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def write_with_rejects(
    df: DataFrame, column: str, path: str, rejects_path: str, keep: Sequence[str] = (), trigger: Mapping[str, object] | None = None, checkpoint: str | None = None
) -> DataStreamWriter | None:
    """Writes rows and rejected texts (``column``, with ``keep``) as Parquet to two places, from one parse.

    A batch is written at once. For a stream the writer to be started is returned: each micro-batch goes to a folder of
    its number below both paths (``batch=0``, …) and replaces it when it is tried anew, so a restart neither loses nor
    repeats rows.
    """

    def write(rows: DataFrame, rows_to: str, rejects_to: str, mode: str) -> None:
        held = rows.persist()  # both writes read it; what is lost is parsed again
        try:
            parts = split_rejects(held, column, keep)
            parts.rows.write.mode(mode).parquet(rows_to)
            parts.rejects.write.mode(mode).parquet(rejects_to)
        finally:
            held.unpersist()

    if not df.isStreaming:
        write(df, path, rejects_path, "append")
        return None
    if not checkpoint:
        raise ValueError("a stream needs a folder for its progress")

    def each(rows: DataFrame, number: int) -> None:
        write(rows, f"{path}/batch={number}", f"{rejects_path}/batch={number}", "overwrite")

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))
