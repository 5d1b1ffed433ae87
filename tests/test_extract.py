import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom import extract_csv, extract_json, infer_all, infer_schema, load_mapping, split_rejects, write_with_rejects
from pathloom.functions.types import build_schema
from pathloom.operators.extract import parse_json, path_type, project, prune_schema, split_path

ORDER = {
    "order": {
        "id": "o1",
        "value": "Shop",
        "basket": {"goods": [{"value": "Tea", "note": "hot"}, {"value": "Salt", "note": "fine"}]},
    }
}


@pytest.fixture(scope="module")
def order_schema(spark):
    return T.StructType.fromDDL(
        "order struct<id string, value string, basket struct<goods array<struct<note string, value string>>>>"
    )


def messages(spark, *texts):
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")


def test_sample_schema_and_mapping_files(spark, tmp_path):
    sample, mapping = tmp_path / "sample.json", tmp_path / "mapping.csv"
    sample.write_text(json.dumps(ORDER, indent=2))
    mapping.write_text('id,order.id,int\nvalue,order.value,string\nprice,order.value,"decimal(10,2)"\n')
    schema = infer_schema(spark, str(sample))
    rows = extract_json(messages(spark, json.dumps(ORDER)), schema, load_mapping(spark, str(mapping)))
    assert rows.columns == ["id", "value", "price"]
    assert [tuple(r) for r in rows.collect()] == [(None, "Shop", None)]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"b": 1, "a": null, "c": {"x": [1.5]}}')
    assert infer_schema(spark, str(tmp_path / "s.json")).simpleString() == (
        "struct<a:string,b:bigint,c:struct<x:array<double>>>"
    )


@pytest.mark.parametrize("load", [infer_schema, load_mapping])
@pytest.mark.parametrize("path", [None, ""])
def test_missing_paths(spark, load, path):
    with pytest.raises(ValueError):
        load(spark, path)


def test_rows_out_equal_rows_in(spark):
    texts = ['{"k": 1}', None, "", "{bad", '[{"k": 1}]', '{"k": "x"}', '{"z": 1}', '{"k": 2, "s": {"t": 5}}']
    schema = T.StructType.fromDDL("k long, s struct<t string>")
    rows = extract_json(messages(spark, *texts), schema, [("k", "k", "int"), ("t", "s.t", "int")], keep=["n"])
    assert [tuple(r) for r in rows.orderBy("n").collect()] == [
        (0, 1, None),
        *[(n, None, None) for n in range(1, 7)],
        (7, 2, 5),
    ]


def test_binary_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"k": 7}'),)], "value binary")
    assert extract_json(df, build_schema([("k", "int")]), [("k", "k", "long")]).first().k == 7


def test_names_read_from_the_message_as_it_came(spark):
    df = spark.createDataFrame([("1", "2")], "id string, v string")
    assert tuple(project(df, [("id", "v", "int"), ("v", "id", "int")]).first()) == (2, 1)


def test_bad_mappings(spark):
    df = messages(spark, "{}")
    schema = build_schema([("k", "int")])
    for mapping in (
        [("a", "k", "int"), ("a", "k", "int")],
        [("a", "k", "number")],
        [("a", "nope", "int")],
        [("a", "k")],
        [],
    ):
        with pytest.raises(ValueError):
            extract_json(df, schema, mapping)


def test_path_through_array(spark, order_schema):
    rows = extract_json(messages(spark, json.dumps(ORDER)), order_schema, [("v", "order.basket.goods.value", "string")])
    assert rows.first().v == "[Tea, Salt]"


def test_dotted_keys(spark):
    schema = T.StructType.fromDDL("p struct<`A.1.B` string>")
    rows = extract_json(messages(spark, '{"p": {"A.1.B": "x"}}'), schema, [("b", "p.`A.1.B`", "string")])
    assert rows.first().b == "x"
    assert split_path("a.`b.c`.d") == ["a", "b.c", "d"]
    for bad in ("", "a.`b", "a..b", "`a`b"):
        with pytest.raises(ValueError):
            split_path(bad)


def test_only_wanted_fields_are_parsed(spark, order_schema):
    pruned = prune_schema(order_schema, [["order", "basket", "goods", "value"], ["order", "id"]])
    assert pruned.simpleString() == (
        "struct<order:struct<id:string,basket:struct<goods:array<struct<value:string>>>>>"
    )
    assert path_type(order_schema, ["order", "basket", "goods", "value"]) == T.ArrayType(T.StringType())
    plan = extract_json(messages(spark, "{}"), order_schema, [("id", "order.id", "string")])
    assert "note" not in plan._jdf.queryExecution().executedPlan().toString()


def test_star_expand(spark):
    rows = parse_json(messages(spark, '{"a": 1, "b": "x"}'), build_schema([("a", "int"), ("b", "string")]))
    assert rows.columns == ["a", "b"] and tuple(rows.first()) == (1, "x")


def test_csv_payload(spark):
    schema = build_schema([("a", "int"), ("b", "string"), ("c", "decimal(6,2)")])
    mapping = [("c", "c", "double"), ("a", "a", "string"), ("b", "b", "string")]
    rows = extract_csv(messages(spark, '1,"x,y",2.50', "oops,z,", None), schema, mapping, keep=["n"])
    assert [tuple(r) for r in rows.orderBy("n").collect()] == [
        (0, 2.5, "1", "x,y"),
        (1, None, None, "z"),
        (2, None, None, None),
    ]
    typed = spark.createDataFrame([(1, "x", None)], schema)
    assert tuple(project(typed, mapping).first()) == (None, "1", "x")


def test_paths_follow_the_sessions_case_rule(spark, order_schema):
    df = messages(spark, json.dumps(ORDER))
    rows = extract_json(df, order_schema, [("id", "ORDER.Id", "string"), ("v", "Order.basket.GOODS.value", "string")])
    assert rows.collect()[0]["id"] == "o1"
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="no field"):
            extract_json(df, order_schema, [("id", "ORDER.Id", "string")])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_csv_payload_with_a_field_called_value(spark):
    """A payload is parsed, whatever its columns are called and typed."""
    payload = spark.createDataFrame([('"a,b"',)], "value string")
    text = build_schema([("value", "string")])
    assert [tuple(r) for r in extract_csv(payload, text, [("v", "value", "string")]).collect()] == [("a,b",)]
    numbers = T.StructType.fromDDL("value double, id int")
    rows = extract_csv(spark.createDataFrame([("7,2",)], "value string"), numbers, [("value", "value", "double"), ("id", "id", "int")])
    assert [tuple(r) for r in rows.collect()] == [(7.0, 2)]


TEXTS = ['{"k": 1}', None, "", "{bad", '[{"k": 1}]', '{"k": "x"}', '{"z": 1}', '{"k": 2, "s": {"t": 5}}', '{"k": null}', "7", "  "]
INNER = T.StructType([T.StructField("t", T.StringType())])
DATES = T.ArrayType(T.StructType([T.StructField("d", T.DateType())]))
FIELDS = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", INNER), T.StructField("w", DATES)])
COLUMNS = [("k", "k", "int"), ("t", "s.t", "int")]


def test_rejects_are_the_messages_that_do_not_fit(spark):
    df = messages(spark, *TEXTS)
    tagged = extract_json(df, FIELDS, COLUMNS, keep=["n"], rejects="why")
    rows, rejects = split_rejects(tagged, "why", keep=["n"])
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, extract_json(df, FIELDS, COLUMNS, keep=["n"]).collect()))
    assert {r.n: r.why for r in rejects.collect()} == {n: TEXTS[n] for n in (3, 4, 5, 9)}
    csv = extract_csv(messages(spark, "1,a", "x,b", None, "2"), build_schema([("a", "int"), ("b", "string")]), [("a", "a", "int")], keep=["n"], rejects="why")
    assert {r.n: r.why for r in csv.collect()} == {0: None, 1: "x,b", 2: None, 3: "2"}


def test_batch_of_rejects_is_written_apart(spark, tmp_path):
    tagged = extract_json(messages(spark, *TEXTS), FIELDS, COLUMNS, keep=["n"], rejects="why")
    assert write_with_rejects(tagged, "why", str(tmp_path / "rows"), str(tmp_path / "bad"), keep=["n"]) is None
    assert spark.read.parquet(str(tmp_path / "rows")).count() == len(TEXTS)
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert bad.columns == ["n", "why"] and {r.n for r in bad.collect()} == {3, 4, 5, 9}


def test_variants_are_taken_as_they_are(spark):
    texts = [*TEXTS, '{"w": [{"d": "2024-02-03"}, {"d": "x"}], "s": {"t": "8"}}']
    texts[3] = None  # no variant
    variants = messages(spark, *texts).select("n", F.try_parse_json("value").alias("value"))
    mapping = [*COLUMNS, ("s", "s", "string"), ("d", "w.d", "string")]
    rows = {r.n: tuple(r)[1:] for r in extract_json(variants, FIELDS, mapping, keep=["n"]).collect()}
    plain = {r.n: tuple(r)[1:] for r in extract_json(messages(spark, *texts), FIELDS, mapping, keep=["n"]).collect()}
    assert {n: r for n, r in rows.items() if n != 11} == {n: r for n, r in plain.items() if n != 11}
    assert rows[11][:3] == (None, 8, "{8}")
    found = {r.n: r.why for r in extract_json(variants, FIELDS, COLUMNS, keep=["n"], rejects="why").collect()}
    assert {n for n, why in found.items() if why is not None} == {4, 5, 9} and found[5] == '{"k":"x"}'


def test_lost_values_are_counted_on_the_way(spark, tmp_path):
    df = messages(spark, '{"k": 5, "s": {"t": "9"}}', '{"k": 3000000000, "s": {"t": "x"}}', '{"s": {"t": "4.7"}}', "{bad")
    lost = Observation("lost")
    rows = extract_json(df, FIELDS, [("a b", "k", "int"), ("t", "s.t", "int"), ("u", "s.t", "string")], keep=["n"], observe=lost)
    assert rows.columns == ["n", "a b", "t", "u"] and len(rows.collect()) == 4
    assert lost.get == {"a b": 1, "t": 1, "u": 0}
    variant = Observation("variant")
    extract_json(df.select(F.try_parse_json("value").alias("value")), FIELDS, [("t", "s.t", "int")], observe=variant).collect()
    assert variant.get == {"t": 1}
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("n int, value string").parquet(str(tmp_path / "in"))
    counted = extract_json(stream, FIELDS, [("t", "s.t", "int")], observe="casts", rejects="why")
    query = counted.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p["observedMetrics"]["casts"]["t"] for p in query.recentProgress if p["numInputRows"]] == [1]


def test_schema_of_all_messages(spark):
    texts = ['{"a": {"b c": [{"d": 1, "e": null}]}, "VOID": true, "x": 1}', None, "{bad", "[1]", '{"a": {"b c": [{"f": "t"}]}, "x": "y", "OBJECT": {"z": 1}}']
    schema = infer_all(messages(spark, *texts))
    assert schema == T.StructType.fromDDL("OBJECT struct<z bigint>, VOID boolean, a struct<`b c` array<struct<d bigint, e string, f string>>>, x string")
    assert infer_all(messages(spark, None, "[1]")) == T.StructType()
    rows = extract_json(messages(spark, *texts), schema, [("f", "a.`b c`.f", "string"), ("x", "x", "string")], keep=["n"])
    assert tuple(rows.where("n = 4").first()) == (4, "[t]", "y")
    binary = spark.createDataFrame([(bytearray(b'{"k": 1}'),)], "value binary")
    assert infer_all(binary) == T.StructType.fromDDL("k bigint")
