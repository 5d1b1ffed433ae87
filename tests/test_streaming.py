import json

import pytest

from pathloom import JobSpec, extract_json, flatten_paths, pack_rows, read_csv, read_json, read_parquet, read_stream, run, unpack_rows, write_stream, write_with_rejects
from pathloom.functions.types import build_schema
from pathloom.sources import readers
from pathloom.streaming.job import process, read_source, sink_writer
from pathloom.streaming.sinks import DEFAULT_TRIGGER

ONCE = {"availableNow": True}
TEMPLATES = ["R.s.A.{i}.v", "R.s.Count"]


def write_messages(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def record(*ids):
    return {"R": {"s": {"Count": len(ids), "A": {i: {"v": f"v{i}"} for i in ids}}}}


def job(processor, source, sink, **more):
    return {"appName": "test", "dataProcessor": processor, "inputProperties": source, "writerProperties": sink, **more}


def parquet_sink(folder):
    return {"writer": "parquet", "confProperties": {"path": str(folder / "out"), "checkpointLocation": str(folder / "progress")}}


def test_batch_equals_stream_and_restart_adds_nothing(spark, tmp_path):
    source = tmp_path / "in"
    write_messages(source, "1.txt", record("1", "2"), record("3"), {})
    spec = job(
        {"type": "paths", "properties": {"templates": TEMPLATES}},
        {"writer": "text", "confProperties": {"path": str(source)}},
        parquet_sink(tmp_path),
    )
    batch = lambda: sorted(flatten_paths(spark.read.text(str(source)), TEMPLATES).collect())
    result = lambda: sorted(read_parquet(spark, str(tmp_path / "out")).collect())
    for _ in range(2):
        run(spark, spec, ONCE).awaitTermination()
        assert result() == batch()
    write_messages(source, "2.txt", record("7"))
    run(spark, spec, ONCE).awaitTermination()
    assert result() == batch() and len(result()) == 4


def test_json_job(spark, tmp_path):
    write_messages(tmp_path / "in", "1.txt", {"k": "5", "s": {"t": "x"}}, {"k": "oops"})
    (tmp_path / "sample.json").write_text('{"k": "1",\n "s": {"t": "y"}}')
    (tmp_path / "columns.csv").write_text("number,k,int\ntext,s.t,string\n")
    properties = {"path": str(tmp_path / "sample.json"), "outputSchemaPath": str(tmp_path / "columns.csv")}
    spec = job(
        {"type": "json", "properties": properties},
        {"writer": "text", "confProperties": {}, "metaData": {"path": str(tmp_path / "in")}},
        parquet_sink(tmp_path),
        sparkProperties={"spark.master": "local[*]"},
    )
    path = tmp_path / "job.json"
    path.write_text(json.dumps(spec))
    run(spark, JobSpec.from_file(str(path)), ONCE).awaitTermination()
    found = read_parquet(spark, str(tmp_path / "out"))
    assert found.columns == ["number", "text"]
    assert sorted(map(tuple, found.collect()), key=repr) == [(5, "x"), (None, None)]


def test_csv_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text('1,"a,b"\nx,c\n')
    (tmp_path / "columns.csv").write_text("name,col2,string\nid,col1,long\n")
    spec = job(
        {"type": "csv", "properties": {"outputSchemaPath": str(tmp_path / "columns.csv")}},
        {"writer": "csv", "confProperties": {}, "metaData": {"path": str(tmp_path / "in")}},
        parquet_sink(tmp_path),
        inputSchema=[{"col1": "int"}, {"col2": "string"}],
    )
    run(spark, spec, ONCE).awaitTermination()
    found = read_parquet(spark, str(tmp_path / "out")).collect()
    assert sorted(map(tuple, found), key=repr) == [("a,b", 1), ("c", None)]


def test_console_sink(spark, tmp_path):
    write_messages(tmp_path / "in", "1.txt", {"k": "seen"})
    stream = read_stream(spark, "text", path=str(tmp_path / "in"))
    extracted = extract_json(stream, build_schema([("k", "string")]), [("k", "k", "string")])
    query = write_stream(extracted, "console", {"checkpointLocation": str(tmp_path / "progress")}, ONCE).start()
    query.awaitTermination()
    assert query.exception() is None
    progress = query.recentProgress[0]
    assert "ConsoleTable" in progress["sink"]["description"] and progress["sink"]["numOutputRows"] == 1


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls[name] = args or kwargs
            return self

        return note


@pytest.mark.parametrize("source", ["kafka", "socket"])
def test_message_sources_pass_options_through(source):
    class Session:
        readStream = Recorder()

    options = {"kafka.bootstrap.servers": "somewhere:1", "subscribe": "topic"}
    read_stream(Session, source, options)
    assert Session.readStream.calls["format"] == (source,)
    assert Session.readStream.calls["options"] == options
    assert "load" in Session.readStream.calls and "schema" not in Session.readStream.calls


class Frame:
    def __init__(self, *columns):
        self.columns, self.writeStream = list(columns), Recorder()


def test_kafka_sink_passes_values_on():
    frame = Frame("key", "value")
    write_stream(frame, "kafka", {"topic": "t"})
    calls = frame.writeStream.calls
    assert calls["format"] == ("kafka",) and calls["outputMode"] == ("append",)
    assert calls["options"] == {"topic": "t"} and calls["trigger"] == DEFAULT_TRIGGER == {"processingTime": "10 seconds"}


def test_kafka_sink_packs_rows(spark, monkeypatch, tmp_path):
    """A job of templates whose rows go to a queue: they are packed, by the key that the sink names."""
    write_messages(tmp_path / "in", "1.txt", record("1", "2"), record("3"))
    spec = JobSpec.from_dict(
        job(
            {"type": "paths", "properties": {"templates": TEMPLATES}},
            {"writer": "text", "confProperties": {"path": str(tmp_path / "in")}},
            {"writer": "kafka", "confProperties": {"topic": "t"}, "metaData": {"key": "A, Count"}},
        )
    )
    seen = {}
    monkeypatch.setattr("pathloom.streaming.sinks.pack_rows", lambda df, key: seen.update(df=df, key=list(key)) or Frame("key", "value"))
    sink_writer(process(spark, read_source(spark, spec), spec), spec)
    assert seen["key"] == ["A", "Count"] and seen["df"].isStreaming
    rows = flatten_paths(spark.read.text(str(tmp_path / "in")), TEMPLATES)
    packed = pack_rows(rows, ["A", "Count"])
    assert packed.columns == ["key", "value"] and {json.loads(r.key)["A"] for r in packed.collect()} == {"1", "2", "3"}
    assert sorted(unpack_rows(packed, rows.schema).collect()) == sorted(rows.collect())
    assert {r.key for r in pack_rows(rows, ["A"]).collect()} == {"1", "2", "3"} and {r.key for r in pack_rows(rows).collect()} == {None}
    typed = spark.createDataFrame([(1, None, "x y")], "a int, `b.c` string, d string")
    assert json.loads(pack_rows(typed).first().value) == {"a": 1, "b.c": None, "d": "x y"}
    with pytest.raises(ValueError):
        pack_rows(rows, ["nope"])


def test_bad_sources_and_sinks(spark, tmp_path):
    df = spark.range(1)
    for source, options in (("smoke", {}), ("csv", {}), ("csv", {"path": str(tmp_path)}), ("text", {})):
        with pytest.raises(ValueError):
            read_stream(spark, source, options)
    for sink, options in (("smoke", {}), ("parquet", {})):
        with pytest.raises(ValueError):
            write_stream(df, sink, options)
    for processor in ({"type": "xml"}, {"type": "csv"}, {"type": "json"}, {"type": "paths"}):
        spec = JobSpec.from_dict(job(processor, {"writer": "kafka"}, {"writer": "console"}))
        with pytest.raises(ValueError):
            process(spark, df, spec)


def test_declared_schema_only_goes_to_file_sources(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr("pathloom.streaming.job.read_stream", lambda *args: seen.setdefault("args", args))
    spec = job({"type": "json"}, {"writer": "kafka"}, {"writer": "console"}, inputSchema=[{"a": "string"}])
    read_source(spark, JobSpec.from_dict(spec))
    assert seen["args"][1:] == ("kafka", {}, None, None)


def test_batch_readers(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": {"b": 1}\n}')
    (tmp_path / "d.csv").write_text('x, y,"p,q"\n')
    assert read_json(spark, str(tmp_path / "d.json")).first().a.b == 1
    assert tuple(read_csv(spark, str(tmp_path / "d.csv")).first()) == ("x", " y", "p,q")
    assert read_csv(spark, str(tmp_path / "d.csv"), build_schema([("a", "string")])).columns == ["a"]
    read_csv(spark, str(tmp_path / "d.csv")).write.parquet(str(tmp_path / "d.parquet"))
    assert read_parquet(spark, str(tmp_path / "d.parquet")).count() == 1
    assert "kafka" in readers.STREAM_SOURCES


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_source_tells_messages_from_typed_rows(spark, tmp_path, kind):
    """Not the names of columns: a typed column may be called value, a payload may not."""
    (tmp_path / "columns.csv").write_text("id,value,string\n")
    (tmp_path / "sample.json").write_text('{"value": "x"}')
    properties = {"outputSchemaPath": str(tmp_path / "columns.csv"), "path": str(tmp_path / "sample.json")}
    text = {"json": '{"value": "a,b"}', "csv": '"a,b"'}[kind]
    for source, payload, column, wanted in (("parquet", None, "value", text), ("text", None, "value", "a,b"), ("parquet", "body", "body", "a,b"), ("kafka", "key", "key", "a,b")):
        spec = job({"type": kind, "properties": {**properties, **({"payload": payload} if payload else {})}}, {"writer": source}, {"writer": "console"}, inputSchema=[{"value": "string"}])
        df = spark.createDataFrame([(text,)], f"{column} string")
        assert [tuple(r) for r in process(spark, df, JobSpec.from_dict(spec)).collect()] == [(wanted,)]


def test_json_job_over_rows_the_source_has_typed(spark, tmp_path):
    mapping = tmp_path / "columns.csv"
    mapping.write_text("id,order.id,int\n")
    spec = job({"type": "json", "properties": {"outputSchemaPath": str(mapping)}}, {"writer": "json"}, {"writer": "console"})
    df = spark.createDataFrame([(("7",),)], "order struct<id string>")
    assert [tuple(r) for r in process(spark, df, JobSpec.from_dict(spec)).collect()] == [(7,)]


def test_stream_of_rejects_restarts_without_repeats(spark, tmp_path):
    write_messages(tmp_path / "in", "1.txt", {"k": 1}, {"k": "x"}, [{"k": 2}])
    places = str(tmp_path / "rows"), str(tmp_path / "bad")

    def once():
        stream = read_stream(spark, "text", path=str(tmp_path / "in"))
        tagged = extract_json(stream, build_schema([("k", "long")]), [("k", "k", "long")], rejects="why")
        write_with_rejects(tagged, "why", *places, trigger=ONCE, checkpoint=str(tmp_path / "progress")).start().awaitTermination()
        return [sorted((r[0] for r in read_parquet(spark, p).collect()), key=repr) for p in places]

    bad = ['[{"k": 2}]', '{"k": "x"}']
    assert once() == once() == [[1, None, None], sorted(bad, key=repr)]
    write_messages(tmp_path / "in", "2.txt", {"k": 3}, 7)
    assert once() == [[1, 3, None, None, None], sorted([*bad, "7"], key=repr)]
    with pytest.raises(ValueError):
        write_with_rejects(read_stream(spark, "text", path=str(tmp_path / "in")), "value", *places)
