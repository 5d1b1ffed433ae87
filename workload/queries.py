"""Queries over the driver tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom import (
    JobSpec,
    build_schema,
    extract_csv,
    extract_json,
    flatten_groups,
    flatten_paths,
    infer_all,
    infer_schema,
    load_mapping,
    pack_rows,
    path_map,
    prune_paths,
    read_csv,
    read_parquet,
    read_stream,
    run,
    unpack_rows,
    write_stream,
    write_with_rejects,
)
from pathloom.operators.extract import parse_csv, parse_json, project
from workload import payloads
from workload.scratch import shared_folder

KEYS = list(payloads.MESSAGE_KEYS)

# Templates of the order messages.
ORDER_COUNT = "Device.Sales.OrderCount"
ORDER_FIELDS = ["Device.Sales.Order.{i}.Priority", "Device.Sales.Order.{i}.Status"]
LINE_FIELDS = ["Device.Sales.Order.{i}.Line.{i}.Flag", "Device.Sales.Order.{i}.Line.{i}.Qty"]
PROFILE_FIELDS = ["Device.Profile.Name", "Device.Profile.Segment"]
SALES_FIELDS = [ORDER_COUNT, *ORDER_FIELDS, *LINE_FIELDS]
# Templates of the document messages.
DOCUMENT_FIELDS = [
    "Document.Body.Lang",
    "Document.Body.Source",
    "Document.Body.Paragraph.{i}.Chars",
    "Document.Body.Paragraph.{i}.Sentence.{i}.Text",
]

PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType())])
PROPS_MAPPING = [("k", "k", "int"), ("k_text", "k", "string"), ("k_decimal", "k", "decimal(10,2)")]
PART_FIELDS = [
    ("p_partkey", "long"),
    ("p_name", "string"),
    ("p_brand", "string"),
    ("p_type", "string"),
    ("p_size", "int"),
    ("p_retailprice", "double"),
]
PART_MAPPING = [(name, name, type_name) for name, type_name in PART_FIELDS]


def extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_json(payloads.event_messages(spark, sf_dir), PROPS_SCHEMA, PROPS_MAPPING, keep=["event_id"])


def extract_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema and output columns both come from files, as a deployed job has them."""
    sample, mapping = shared_folder(spark, "sample"), shared_folder(spark, "mapping")
    spark.createDataFrame([('{"k": 1}',)], "value string").coalesce(1).write.text(sample)
    spark.createDataFrame(PROPS_MAPPING, "name string, path string, type string").coalesce(1).write.csv(mapping)
    return extract_json(
        payloads.event_messages(spark, sf_dir),
        infer_schema(spark, sample),
        load_mapping(spark, mapping),
        keep=["event_id"],
    )


def extract_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = payloads.damaged_event_messages(spark, sf_dir)
    return extract_json(messages, PROPS_SCHEMA, PROPS_MAPPING, keep=["event_id"])


def extract_inferred_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema is merged from all messages, in one pass."""
    messages = payloads.event_messages(spark, sf_dir)
    return extract_json(messages, infer_all(messages), PROPS_MAPPING, keep=["event_id"])


def extract_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that come as variants."""
    messages = payloads.table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("value"))
    return extract_json(messages, PROPS_SCHEMA, PROPS_MAPPING, keep=["event_id"])


def extract_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths in another case than the message's, as the session finds columns."""
    mapping = [(name, path.upper(), type_name) for name, path, type_name in PROPS_MAPPING]
    return extract_json(payloads.event_messages(spark, sf_dir), PROPS_SCHEMA, mapping, keep=["event_id"])


def extract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed messages with their text, kept apart from the rows of all messages, both written from one parse."""
    messages = payloads.damaged_event_messages(spark, sf_dir)
    tagged = extract_json(messages, PROPS_SCHEMA, PROPS_MAPPING, keep=["event_id"], rejects="unread")
    rows, rejects = shared_folder(spark, "rows"), shared_folder(spark, "rejects")
    write_with_rejects(tagged, "unread", rows, rejects, keep=["event_id"])
    read = read_parquet(spark, rows).select("event_id", "k", F.lit(None).cast("string").alias("unread"))
    return read.unionByName(read_parquet(spark, rejects).select("event_id", F.lit(None).cast("int").alias("k"), "unread"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``extract_rejects`` from a file stream, by one micro-batch writer with two targets."""
    source, rows, rejects = (shared_folder(spark, n) for n in ("damaged", "rows", "rejects"))
    payloads.damaged_event_messages(spark, sf_dir).write.parquet(source)
    messages = read_stream(spark, "parquet", path=source, schema=read_parquet(spark, source).schema)
    tagged = extract_json(messages, PROPS_SCHEMA, PROPS_MAPPING, keep=["event_id"], rejects="unread")
    writer = write_with_rejects(tagged, "unread", rows, rejects, ["event_id"], {"availableNow": True}, rows + "-progress")
    writer.start().awaitTermination()
    read = read_parquet(spark, rows).select("event_id", "k", F.lit(None).cast("string").alias("unread"))
    return read.unionByName(read_parquet(spark, rejects).select("event_id", F.lit(None).cast("int").alias("k"), "unread"))


def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values each cast could not read, counted while the rows are written."""
    part = payloads.table(spark, sf_dir, "part").withColumn("p_retailprice", F.col("p_retailprice").cast("string"))
    mapping = [("price", "p_retailprice", "int"), ("name", "p_name", "int"), ("brand", "p_brand", "string"), ("kind", "p_type", "date")]
    lost = Observation("lost")
    project(part, mapping, observe=lost).write.parquet(shared_folder(spark, "parts"))
    return spark.createDataFrame(sorted(lost.get.items()), "output string, lost long")


def star_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = build_schema([("k", "long"), {"missing": "String"}])
    return parse_json(payloads.event_messages(spark, sf_dir), schema, keep=["event_id"])


CAST_FIELDS = [
    ("l_orderkey", "l_orderkey", "long"),
    ("l_suppkey", "l_suppkey", "int"),
    ("l_linenumber_short", "l_linenumber", "short"),
    ("l_linenumber_byte", "l_linenumber", "byte"),
    ("l_quantity", "l_quantity", "float"),
    ("l_extendedprice", "l_extendedprice", "double"),
    ("l_extendedprice_decimal", "l_extendedprice", "decimal(12,2)"),
    ("l_returnflag", "l_returnflag", "string"),
    ("l_shipdate", "l_shipdate", "date"),
    ("l_shiptime", "l_shipdate", "timestamp"),
    ("l_open", "l_open", "boolean"),
]


def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared types, cast from text."""
    fields = list(dict.fromkeys(path for _, path, _ in CAST_FIELDS))
    lines = payloads.table(spark, sf_dir, "lineitem").withColumn("l_open", F.col("l_linestatus") == "O")
    texts = F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in fields]))
    schema = build_schema([(f, "string") for f in fields])
    return extract_json(lines.select(texts.alias("value")), schema, CAST_FIELDS)


def cast_bad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text no type can read is NULL; a decimal tail is cut for the integer types."""
    bad = ["int", "double", "float", "long", "short", "byte", "date", "boolean", "timestamp"]
    mapping = [("p_partkey", "p_partkey", "long"), ("price", "p_retailprice", "int")]
    mapping += [(f"name_{t}", "p_name", t) for t in bad] + [("name_decimal", "p_name", "decimal(10,2)")]
    part = payloads.table(spark, sf_dir, "part")
    return project(part.withColumn("p_retailprice", F.col("p_retailprice").cast("string")), mapping)


def array_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path through an array of objects gives an array, here of all paragraphs of a text."""
    paragraphs = F.transform(
        F.split("text", "\n"), lambda text, n: F.struct((n + 1).alias("number"), text.alias("text"))
    )
    documents = payloads.table(spark, sf_dir, "documents").select(
        "doc_id", F.to_json(F.struct(F.struct(paragraphs.alias("paragraph")).alias("doc"))).alias("value")
    )
    schema = T.StructType.fromDDL("doc struct<paragraph array<struct<number int, text string>>>")
    mapping = [("numbers", "doc.paragraph.number", "string"), ("texts", "doc.paragraph.text", "string")]
    return extract_json(documents, schema, mapping, keep=["doc_id"])


def dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold dots, reached with back-ticks."""
    events = payloads.table(spark, sf_dir, "events")
    parameters = F.struct(
        F.col("event_type").alias("Device.Event.1.Type"), F.col("user_id").alias("Device.Event.1.User")
    )
    messages = events.select("event_id", F.to_json(F.struct(parameters.alias("parameters"))).alias("value"))
    inner = build_schema([("Device.Event.1.Type", "string"), ("Device.Event.1.User", "long")])
    schema = T.StructType([T.StructField("parameters", inner)])
    mapping = [
        ("type", "parameters.`Device.Event.1.Type`", "string"),
        ("user", "parameters.`Device.Event.1.User`", "long"),
    ]
    return extract_json(messages, schema, mapping, keep=["event_id"])


def csv_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = payloads.table(spark, sf_dir, "part")
    messages = part.select(F.to_csv(F.struct(*[name for name, _ in PART_FIELDS])).alias("value"))
    return extract_csv(messages, build_schema(PART_FIELDS), PART_MAPPING)


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV payloads parsed and expanded as they are, without output columns."""
    part = payloads.table(spark, sf_dir, "part")
    messages = part.select(F.to_csv(F.struct(*[name for name, _ in PART_FIELDS])).alias("value"))
    return parse_csv(messages, build_schema(PART_FIELDS))


def read_csv_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless CSV and Parquet files read back."""
    csv, parquet = shared_folder(spark, "supplier-csv"), shared_folder(spark, "supplier-parquet")
    payloads.table(spark, sf_dir, "supplier").write.csv(csv)
    named = read_csv(spark, csv).toDF("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    named.write.parquet(parquet)
    mapping = [("s_suppkey", "s_suppkey", "long"), ("s_name", "s_name", "string"), ("s_acctbal", "s_acctbal", "double")]
    return project(read_parquet(spark, parquet), mapping)


def path_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = payloads.order_messages(spark, sf_dir)
    return messages.select(*KEYS, F.explode(path_map(F.col("value"))).alias("path", "leaf"))


def flat_keys_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat keys, narrowed to the ones two templates ask for."""
    wanted = prune_paths(path_map(F.col("value")), [ORDER_FIELDS[1], LINE_FIELDS[1]])
    messages = payloads.flat_order_messages(spark, sf_dir)
    return messages.select(*KEYS, F.explode(wanted).alias("path", "leaf"))


def flatten_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(payloads.order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS)


def flatten_lines_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(payloads.order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS, strategy="variant")


def flatten_lines_path_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(
        payloads.order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS, strategy="path_map", ordered=True
    )


def flatten_flat_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(payloads.flat_order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS, layout="flat")


def flatten_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(payloads.order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS, mode="siblings")


def flatten_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_paths(payloads.order_messages(spark, sf_dir), PROFILE_FIELDS, keep=KEYS)


def flatten_spine_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a flag have no row while any line of the message has one."""
    messages = payloads.order_messages(spark, sf_dir, without_flag="N")
    return flatten_paths(messages, LINE_FIELDS, keep=KEYS)


def flatten_spine_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = payloads.order_messages(spark, sf_dir, without_flag="N")
    return flatten_paths(messages, LINE_FIELDS, keep=KEYS, spine="any")


def flatten_any_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances named by words instead of numbers."""
    messages = payloads.document_messages(spark, sf_dir, id_prefix="part-")
    return flatten_paths(messages, ["Document.Body.Paragraph.{i}.Chars"], keep=["doc_id"], spine="any", ids="any")


def flatten_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = payloads.order_messages(spark, sf_dir)
    return flatten_paths(messages, [*PROFILE_FIELDS, *SALES_FIELDS], keep=KEYS)


def flatten_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups put together again, from one scan and one parse."""
    return flatten_groups(payloads.order_messages(spark, sf_dir), [*PROFILE_FIELDS, *SALES_FIELDS], keep=KEYS).union()


def flatten_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups stored as tables of their own from one scan, then aligned and put together."""
    groups = flatten_groups(payloads.order_messages(spark, sf_dir), [*PROFILE_FIELDS, *SALES_FIELDS], keep=KEYS)
    first, *others = groups.store(shared_folder(spark, "groups"))
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def flatten_keep_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every source of the table, without values where it is another's."""
    body = F.struct(F.col("lang").alias("Lang"), F.create_map("source", F.struct(F.col("n_chars").alias("Chars"))).alias("Feed"))
    documents = payloads.table(spark, sf_dir, "documents")
    messages = documents.select("doc_id", F.to_json(F.struct(F.struct(body.alias("Body")).alias("Document"))).alias("value"))
    templates = ["Document.Body.Lang", "Document.Body.Feed.{i}.Chars"]
    return flatten_paths(messages, templates, keep=["doc_id"], ids="any", keep_absent=True)


def flatten_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named by the templates, and a template that ends in an instance, which names no leaf."""
    templates = [(LINE_FIELDS[0], "flag"), (LINE_FIELDS[1], "amount"), "Device.Sales.Order.{i}.Line.{i}", "Device.Sales.Order.{i}"]
    names = {"Device.Sales.Order": "order_key", "Device.Sales.Order.{i}.Line": "line_number"}
    return flatten_paths(payloads.order_messages(spark, sf_dir), templates, keep=KEYS, id_names=names)


def flatten_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates that start at a sub-tree; its keys hold dots in every other record."""
    devices = payloads.order_messages(spark, sf_dir).select(*KEYS, F.concat(F.lit('{"store.7":{"tree":'), "value", F.lit("}}")).alias("value"))
    return flatten_paths(devices, SALES_FIELDS, keep=KEYS, root=["store.7", "tree"])


def flatten_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a record in text order of their ids, with their places."""
    return flatten_paths(payloads.order_messages(spark, sf_dir), LINE_FIELDS, keep=KEYS, ordered=True, position="place")


def flatten_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every whole text."""
    messages = payloads.document_messages(spark, sf_dir)
    id_names = {"Document.Body.Paragraph": "paragraph", "Document.Body.Paragraph.{i}.Sentence": "sentence"}
    return flatten_paths(messages, DOCUMENT_FIELDS, keep=["doc_id"], id_names=id_names)


def flatten_odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records a fast parse would bend or a variant refuse: repeated keys, a scalar among instances, a null or
    object as leaf, a 38-digit number, single quotes, strings that look like objects. Every strategy reads them alike."""
    shapes = [
        '{"Device":{"Entry":{"1":{"X":"%s"},"2":{"X":"b"}}},"Z":1,"Z":2}',
        '{"Device":{"Entry":{"Total":3,"1":{"X":"a"}}},"Z":1,"Z":2}',
        '{"Device":{"Entry":{"1":{"X":null}}},"Z":1,"Z":2}',
        '{"Device":{"Entry":{"1":{"X":{"q":1}}}},"Z":1,"Z":2}',
        '{"Device":{"Entry":{"1":{"X":"a"},"1":{"X":"b"}}}}',
        '{"Device":{"Entry":{"1":{"X":12345678901234567890123456789012345678}}}}',
        '{"Device":{"Entry":{"1":{"X":"a","X":"c"}}}}',
        "{'Device':{'Entry':{'1':{'X':'a'}}}}",
        r'{"Device":{"Entry":{"1":{"X":"{\"a\":1}"}}},"Z":1,"Z":2}',
        r'{"Device":{"Entry":{"1":{"X":["~\"",{"k":"{}"}]},"~2":{"X":1},"3":{"X":"~x\\"}}},"Z":"}","Z":2}',
    ]
    events = payloads.table(spark, sf_dir, "events")
    texts = F.element_at(F.array(*[F.lit(s) for s in shapes]), (F.pmod("event_id", F.lit(len(shapes))) + 1).cast("int"))
    messages = events.select("event_id", F.replace(texts, F.lit("%s"), F.col("event_type")).alias("value"))
    found = [
        flatten_paths(messages, ["Device.Entry.{i}.X"], keep=["event_id"], strategy=s).withColumn("strategy", F.lit(s))
        for s in ("auto", "variant", "path_map")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def flatten_half_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are dotted in part, or not at all; an object at a leaf's place gives no row."""
    shapes = ['{"Device.Entry":{"e1":{"X":"%s"}}}', '{"Device":{"Entry":{"e1":{"X":"%s"}}}}', '{"Device.Entry.e1":{"X":{"z":"%s"}}}']
    events = payloads.table(spark, sf_dir, "events")
    texts = F.element_at(F.array(*[F.lit(s) for s in shapes]), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    messages = events.select("event_id", F.replace(texts, F.lit("%s"), F.col("event_type")).alias("value"))
    return flatten_paths(messages, ["Device.Entry.{i}.X"], keep=["event_id"], layout="flat", ids="any")


def path_map_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty levels, a path that is there twice, and a key repeated in one object."""
    deep = F.concat(F.repeat(F.lit('{"a":'), 40), F.lit('"'), "event_type", F.lit('"'), F.repeat(F.lit("}"), 40))
    twice = F.lit(',"p.q":"first","p":{"q":"second"}')
    again = F.when(F.col("event_id") % 2 == 1, ',"r":1,"r":2').otherwise("")
    text = F.concat(F.regexp_replace(deep, "[}]$", ""), twice, again, F.lit("}"))
    messages = payloads.table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return messages.select("event_id", F.explode(path_map(F.col("value"))).alias("path", "leaf"))


def flatten_mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with scalars beside instances, JSON nulls, fractions, booleans, arrays, empty
    objects and text that looks like an object, depending on the event."""
    kind = F.col("event_type")
    special = (
        F.when(kind == "view", F.lit("null"))
        .when(kind == "click", F.lit('"{\\"a\\": 1}"'))
        .when(kind == "error", F.lit("[1,2]"))
        .when(kind == "purchase", F.lit("{}"))
        .otherwise(F.lit("123456789.5"))
    )
    first = F.format_string('{"Kind":%s,"Open":true}', special)
    second = F.format_string('{"Kind":"%s"}', kind)
    count = F.when(kind == "signup", F.lit('"Count":2,')).otherwise("")
    value = F.format_string('{"Log":{"Entry":{%s"1":%s,"2":%s}}}', count, first, second)
    messages = payloads.table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return flatten_paths(messages, ["Log.Entry.{i}.Kind", "Log.Entry.{i}.Open"], keep=["event_id"])


def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stream to Parquet with a checkpoint, run until the files are done."""
    schema = payloads.table(spark, sf_dir, "events").schema
    events = read_stream(spark, "parquet", {"pathGlobFilter": "events.parquet"}, sf_dir, schema)
    extracted = extract_json(events, PROPS_SCHEMA, PROPS_MAPPING, value="props", keep=["event_id"])
    return _finish(spark, extracted)


def stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared job: CSV file stream, declared schema, output columns, Parquet sink."""
    source, mapping, target = (shared_folder(spark, n) for n in ("part-csv", "part-mapping", "part-out"))
    payloads.table(spark, sf_dir, "part").write.csv(source)
    spark.createDataFrame(PART_MAPPING, "name string, path string, type string").coalesce(1).write.csv(mapping)
    spec = JobSpec.from_dict(
        {
            "appName": "parts",
            "inputSchema": [{name: type_name} for name, type_name in PART_FIELDS],
            "dataProcessor": {"type": "csv", "properties": {"outputSchemaPath": mapping}},
            "inputProperties": {"writer": "csv", "confProperties": {}, "metaData": {"path": source}},
            "writerProperties": {
                "writer": "parquet",
                "confProperties": {"path": target, "checkpointLocation": target + "-progress"},
            },
        }
    )
    run(spark, spec, trigger={"availableNow": True}).awaitTermination()
    return read_parquet(spark, target)


def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = shared_folder(spark, "messages")
    payloads.order_messages(spark, sf_dir).write.parquet(source)
    schema = read_parquet(spark, source).schema
    messages = read_stream(spark, "parquet", path=source, schema=schema)
    return _finish(spark, flatten_paths(messages, SALES_FIELDS, keep=KEYS))


def stream_json_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared job: text file stream of JSON messages, schema by a sample, output columns, Parquet sink."""
    source, sample, mapping, target = (shared_folder(spark, n) for n in ("props", "sample", "mapping", "out"))
    payloads.table(spark, sf_dir, "events").select("props").write.text(source)
    spark.createDataFrame([('{"k": 1}',)], "value string").coalesce(1).write.text(sample)
    spark.createDataFrame(PROPS_MAPPING, "name string, path string, type string").coalesce(1).write.csv(mapping)
    processor = {"type": "json", "properties": {"path": sample, "outputSchemaPath": mapping}}
    return _run_job(spark, "props", processor, {"writer": "text", "confProperties": {}, "metaData": {"path": source}}, target)


def stream_paths_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared job: messages in a column of a Parquet stream, flattened by templates."""
    source, target = shared_folder(spark, "messages"), shared_folder(spark, "out")
    messages = payloads.order_messages(spark, sf_dir).select(*KEYS, F.col("value").alias("message"))
    messages.write.parquet(source)
    processor = {"type": "paths", "properties": {"templates": SALES_FIELDS, "keep": KEYS, "payload": "message"}}
    fields = [{f.name: {"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())} for f in messages.schema]
    return _run_job(spark, "paths", processor, {"writer": "parquet", "confProperties": {}, "metaData": {"path": source}}, target, fields)


def _run_job(spark: SparkSession, name: str, processor: dict, source: dict, target: str, fields: list | None = None) -> DataFrame:
    sink = {"writer": "parquet", "confProperties": {"path": target, "checkpointLocation": target + "-progress"}}
    spec = {"appName": name, "inputSchema": fields or [], "dataProcessor": processor, "inputProperties": source, "writerProperties": sink}
    run(spark, spec, trigger={"availableNow": True}).awaitTermination()
    return read_parquet(spark, target)


def pack_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened rows made messages of for a queue, and read back from them."""
    rows = flatten_paths(payloads.order_messages(spark, sf_dir), SALES_FIELDS, keep=KEYS)
    packed = pack_rows(rows, key=["customer"])
    return unpack_rows(packed.where("key IS NOT NULL"), rows.schema)


def _finish(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = shared_folder(spark, "stream-out")
    options = {"path": target, "checkpointLocation": target + "-progress"}
    write_stream(stream, "parquet", options, {"availableNow": True}).start().awaitTermination()
    return read_parquet(spark, target)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        extract_props,
        extract_inferred,
        extract_inferred_all,
        extract_malformed,
        extract_rejects,
        extract_variant,
        extract_case,
        cast_losses,
        star_expand,
        cast_types,
        cast_bad_text,
        array_path,
        dotted_names,
        csv_payload,
        csv_rows,
        read_csv_batch,
        path_map_rows,
        flat_keys_match,
        flatten_lines,
        flatten_lines_variant,
        flatten_lines_path_map,
        flatten_flat_keys,
        flatten_siblings,
        flatten_scalars,
        flatten_spine_driver,
        flatten_spine_any,
        flatten_any_ids,
        flatten_stack,
        flatten_union,
        flatten_split,
        flatten_keep_absent,
        flatten_aliases,
        flatten_root,
        flatten_positions,
        flatten_documents,
        flatten_mixed_shapes,
        flatten_odd_records,
        flatten_half_flat,
        path_map_deep,
        stream_extract,
        stream_csv,
        stream_flatten,
        stream_json_job,
        stream_paths_job,
        stream_rejects,
        pack_roundtrip,
    )
}
