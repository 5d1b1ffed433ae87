"""Messages made from the driver tables.

No message grows without bound: an order message holds one customer's orders of one block of
keys, so a customer with a third of all orders is spread over many messages and tasks.
Document messages are made row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_BLOCK = 4096
LINE_BLOCK = 8
MESSAGE_KEYS = ("customer", "order_block", "line_block")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer, order_block, line_block, name, segment, order_count, orders`` where ``orders``
    is an array of ``(key, Status, Priority, lines)`` and ``lines`` one of ``(key, Qty, Flag)``."""
    orders = table(spark, sf_dir, "orders")
    line = F.struct(
        F.col("l_linenumber").cast("string").alias("key"),
        F.col("qty").cast("string").alias("Qty"),
        F.col("flag").alias("Flag"),
    )
    order = F.struct(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("Priority"),
        F.coalesce("lines", F.array()).alias("lines"),
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .withColumn("line_block", F.expr(f"l_linenumber div {LINE_BLOCK}"))
        .groupBy("l_orderkey", "line_block", "l_linenumber")
        .agg(F.sum("l_quantity").cast("bigint").alias("qty"), F.max("l_returnflag").alias("flag"))
        .groupBy("l_orderkey", "line_block")
        .agg(F.collect_list(line).alias("lines"))
    )
    blocks = (
        orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .withColumn("order_block", F.expr(f"o_orderkey div {ORDER_BLOCK}"))
        .withColumn("line_block", F.coalesce("line_block", F.lit(0)))
        .withColumnRenamed("o_custkey", "customer")
        .groupBy(*MESSAGE_KEYS)
        .agg(F.collect_list(order).alias("orders"))
    )
    counts = orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("order_count"))
    profiles = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("customer"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
        .join(counts, "customer", "left")
    )
    # An inner join, as only that lets the adaptive skew join split a hot customer's messages among tasks.
    messages = profiles.where("order_count IS NOT NULL").join(blocks, "customer")
    silent = profiles.where("order_count IS NULL")
    return messages.unionByName(silent, allowMissingColumns=True).select(
        "customer",
        F.coalesce("order_block", F.lit(0)).alias("order_block"),
        F.coalesce("line_block", F.lit(0)).alias("line_block"),
        "name",
        "segment",
        "order_count",
        "orders",
    )


def _keyed(items: Column, body) -> Column:
    entries = F.transform(items, lambda i: F.struct(i.getField("key"), body(i)))
    return F.when(F.size(items) > 0, F.map_from_entries(entries))


def order_messages(spark: SparkSession, sf_dir: str, without_flag: str | None = None) -> DataFrame:
    """Nested messages: ``Device.Profile``, ``Device.Sales.Order.{i}.Line.{i}``.

    ``without_flag`` leaves out the line flags of that value.
    """

    def line(item: Column) -> Column:
        flag = item.getField("Flag")
        if without_flag is not None:
            flag = F.when(flag != without_flag, flag)
        return F.struct(item.getField("Qty").alias("Qty"), flag.alias("Flag"))

    def order(item: Column) -> Column:
        return F.struct(
            item.getField("Status").alias("Status"),
            item.getField("Priority").alias("Priority"),
            _keyed(item.getField("lines"), line).alias("Line"),
        )

    device = F.struct(
        F.struct(F.col("name").alias("Name"), F.col("segment").alias("Segment")).alias("Profile"),
        F.struct(
            F.col("order_count").alias("OrderCount"), _keyed(F.col("orders"), order).alias("Order")
        ).alias("Sales"),
    )
    records = order_records(spark, sf_dir)
    return records.select(*MESSAGE_KEYS, F.to_json(F.struct(device.alias("Device"))).alias("value"))


def flat_order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with dotted paths as keys."""

    def pair(path: Column, value: Column) -> Column:
        return F.struct(path.alias("key"), value.alias("value"))

    def fields(prefix: Column, item: Column, names: list[str]) -> Column:
        return F.array(*[pair(F.concat(prefix, F.lit(f".{n}")), item.getField(n)) for n in names])

    def of_order(order: Column) -> Column:
        prefix = F.concat(F.lit("Device.Sales.Order."), order.getField("key"))

        def of_line(line: Column) -> Column:
            return fields(F.concat(prefix, F.lit(".Line."), line.getField("key")), line, ["Qty", "Flag"])

        lines = F.flatten(F.transform(order.getField("lines"), of_line))
        return F.concat(fields(prefix, order, ["Status", "Priority"]), lines)

    entries = F.concat(
        F.array(
            pair(F.lit("Device.Profile.Name"), F.col("name")),
            pair(F.lit("Device.Profile.Segment"), F.col("segment")),
        ),
        F.when(
            F.size("orders") > 0,
            F.concat(
                F.array(pair(F.lit("Device.Sales.OrderCount"), F.col("order_count").cast("string"))),
                F.flatten(F.transform("orders", of_order)),
            ),
        ).otherwise(F.array()),
    )
    records = order_records(spark, sf_dir)
    return records.select(*MESSAGE_KEYS, F.to_json(F.map_from_entries(entries)).alias("value"))


def document_messages(spark: SparkSession, sf_dir: str, id_prefix: str = "") -> DataFrame:
    """``Document.Body.Paragraph.{i}.Sentence.{i}.Text`` of every document's whole text."""

    def numbered(items: Column, body) -> Column:
        return F.map_from_entries(
            F.transform(
                items, lambda item, n: F.struct(F.concat(F.lit(id_prefix), (n + 1).cast("string")), body(item))
            )
        )

    def paragraph(text: Column) -> Column:
        sentences = numbered(F.split(text, "[.] "), lambda s: F.struct(s.alias("Text")))
        return F.struct(F.length(text).alias("Chars"), sentences.alias("Sentence"))

    document = F.struct(
        F.col("lang").alias("Lang"),
        F.col("source").alias("Source"),
        numbered(F.split("text", "\n"), paragraph).alias("Paragraph"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.to_json(F.struct(F.struct(document.alias("Body")).alias("Document"))).alias("value")
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as bytes, the way a message queue hands them over."""
    return table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))


def damaged_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties, cut short for errors, missing for clicks, an array for purchases."""
    props = F.col("props")
    value = (
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_type") == "click", F.lit(None))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
    )
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))
