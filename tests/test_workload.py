import json

import pytest
from pyspark.sql import functions as F

from pathloom.__main__ import main
from workload import payloads
from workload.scratch import shared_folder


@pytest.fixture
def hot_tables(spark, tmp_path):
    """One customer holds nearly all orders, one order nearly all lines."""
    spark.range(3).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "'S' AS c_mktsegment").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    spark.range(40).selectExpr(
        "id AS o_orderkey", "CAST(id = 0 AS bigint) AS o_custkey", "'O' AS o_orderstatus", "'1' AS o_orderpriority"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(50).selectExpr(
        "if(id < 30, 7, id - 29) AS l_orderkey", "CAST(id AS int) AS l_linenumber", "1.0D AS l_quantity", "'A' AS l_returnflag"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_messages_stay_bounded_and_whole(spark, hot_tables, monkeypatch):
    monkeypatch.setattr(payloads, "ORDER_BLOCK", 4)
    monkeypatch.setattr(payloads, "LINE_BLOCK", 5)
    orders, lines = set(), []
    for row in payloads.order_messages(spark, hot_tables).collect():
        found = json.loads(row.value)["Device"]["Sales"].get("Order", {})
        assert len(found) <= 4
        for key, order in found.items():
            assert len(order.get("Line", {})) <= 5
            orders.add(int(key))
            lines += [(int(key), int(n)) for n in order.get("Line", {})]
    assert orders == set(range(40))
    wanted = spark.read.parquet(hot_tables + "/lineitem.parquet").select("l_orderkey", "l_linenumber")
    assert sorted(lines) == sorted(map(tuple, wanted.collect()))


def test_documents_keep_their_whole_text(spark, sf_dir):
    documents = payloads.table(spark, sf_dir, "documents").select("doc_id", "text")
    for row in payloads.document_messages(spark, sf_dir).join(documents, "doc_id").collect():
        paragraphs = json.loads(row.value)["Document"]["Body"]["Paragraph"]
        texts = [". ".join(s["Text"] for s in p["Sentence"].values()) for p in paragraphs.values()]
        assert "\n".join(texts) == row.text


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and first.startswith(base)


def test_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(ValueError):
        shared_folder(Cluster, "x")


def test_flat_and_nested_messages_hold_the_same(spark, sf_dir):
    nested = payloads.order_messages(spark, sf_dir).select(*payloads.MESSAGE_KEYS, F.col("value").alias("nested"))
    both = nested.join(payloads.flat_order_messages(spark, sf_dir), list(payloads.MESSAGE_KEYS), "full")
    for row in both.collect():
        assert flat_paths(json.loads(row.nested)) == {k: str(v) for k, v in json.loads(row.value).items()}


def flat_paths(value, path=()):
    if isinstance(value, dict):
        return {k: v for key, child in value.items() for k, v in flat_paths(child, (*path, key)).items()}
    return {".".join(path): str(value)}


@pytest.mark.parametrize("arguments", [[], ["a", "b"]])
def test_command_line_needs_one_job(arguments):
    with pytest.raises(SystemExit):
        main(arguments)
