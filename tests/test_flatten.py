"""Path maps and flattening against hand-written rows and a plain Python reading of the rules."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from pathloom import flatten_groups, flatten_paths, path_map, prune_paths
from pathloom.functions.leaves import leaves, plain_paths
from pathloom.functions.records import TypedRecord, template_regex, trie_regex
from pathloom.operators.flatten import OPEN_FILES, STRATEGIES
from pathloom.operators.pathmap import sql_path_map
from pathloom.plans.templates import normalise, plan_groups

PEN = "Device.Farm.Yard.Pen.{i}."
COW = PEN + "Cow.{i}."
FARM = [COW + "Alive", COW + "Colour", COW + "Insect.{i}.Kind", COW + "Insect.{i}.Legs"]


def frame(spark, *records):
    texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")


def rows_of(df):
    return sorted((tuple(r.asDict().items()) for r in df.collect()), key=repr)


def expected(columns, *rows):
    return sorted((tuple(zip(columns, row)) for row in rows), key=repr)


def clients(**pools):
    return {"Device": {"Farm": {"Yard": {"Pen": pools}}}}


def client(active, *addresses):
    found = {"Alive": active, "Colour": f"mac-{active}"}
    if addresses:
        found["Insect"] = {i: {"Kind": a} for i, a in addresses}
    return found


TREE = clients(
    **{
        "1": {"Cow": {"1": client("a", ("1", "10.0.0.1"), ("2", "10.0.0.2")), "10": client("b")}},
        "2": {"Cow": {"2": client("c", ("1", "10.0.0.3"))}},
    }
)
FARM_COLUMNS = ["n", "Pen", "Cow", "Insect", "Alive", "Colour", "Kind", "Legs"]

every_strategy = pytest.mark.parametrize("strategy", STRATEGIES)


@every_strategy
def test_ancestors(spark, strategy):
    df = flatten_paths(frame(spark, TREE), FARM, keep=["n"], strategy=strategy)
    assert rows_of(df) == expected(
        FARM_COLUMNS,
        (0, "1", "1", "1", "a", "mac-a", "10.0.0.1", None),
        (0, "1", "1", "2", "a", "mac-a", "10.0.0.2", None),
        (0, "2", "2", "1", "c", "mac-c", "10.0.0.3", None),
    )


@every_strategy
def test_siblings(spark, strategy):
    df = flatten_paths(frame(spark, TREE), FARM, keep=["n"], mode="siblings", strategy=strategy)
    assert rows_of(df) == expected(
        FARM_COLUMNS,
        (0, "1", "1", "1", None, None, "10.0.0.1", None),
        (0, "1", "1", "2", None, None, "10.0.0.2", None),
        (0, "2", "2", "1", None, None, "10.0.0.3", None),
        (0, "1", "1", None, "a", "mac-a", None, None),
        (0, "1", "10", None, "b", "mac-b", None, None),
        (0, "2", "2", None, "c", "mac-c", None, None),
    )


@every_strategy
def test_falls_back_record_by_record(spark, strategy):
    plain = clients(**{"1": {"Cow": {"1": client("a"), "2": client("b")}}})
    df = flatten_paths(frame(spark, TREE, plain, {}), FARM, keep=["n"], strategy=strategy)
    assert rows_of(df.filter("n > 0")) == expected(
        FARM_COLUMNS,
        (1, "1", "1", None, "a", "mac-a", None, None),
        (1, "1", "2", None, "b", "mac-b", None, None),
    )


@every_strategy
def test_spines(spark, strategy):
    record = {"R": {"s": {"A": {"1": {"x": "1"}, "2": {"y": "2"}, "3": {"x": None}, "4": {"z": "4"}}}}}
    options = dict(keep=["n"], strategy=strategy)
    templates, columns = ["R.s.A.{i}.x", "R.s.A.{i}.y"], ["n", "A", "x", "y"]
    assert rows_of(flatten_paths(frame(spark, record), templates, **options)) == expected(
        columns, (0, "1", "1", None), (0, "3", None, None)
    )
    assert rows_of(flatten_paths(frame(spark, record), templates, spine="any", **options)) == expected(
        columns, (0, "1", "1", None), (0, "2", None, "2"), (0, "3", None, None)
    )
    no_x = {"R": {"s": {"A": {"2": {"y": "2"}}}}}
    assert rows_of(flatten_paths(frame(spark, no_x), templates, **options)) == expected(columns, (0, "2", None, "2"))


@every_strategy
def test_scalars(spark, strategy):
    records = [{"D": {"I": {"a": 1, "b": {"c": True}}}}, {"D": {"I": {"a": {}}}}, "{bad", None, "", "[1]"]
    df = flatten_paths(frame(spark, *records), ["D.I.a", ("D.I.b.c", "flag")], keep=["n"], strategy=strategy)
    assert rows_of(df) == expected(
        ["n", "a", "flag"], (0, "1", "true"), *[(n, None, None) for n in range(1, len(records))]
    )


@every_strategy
def test_scalars_repeat_and_groups_stack(spark, strategy):
    record = {"D": {"I": {"a": "x"}, "W": {"Count": 2, "P": {"1": {"v": "p"}, "2": {"v": "q"}}}}}
    templates = ["D.I.a", "D.W.Count", "D.W.P.{i}.v"]
    df = flatten_paths(frame(spark, record), templates, keep=["n"], strategy=strategy)
    assert rows_of(df) == expected(
        ["n", "P", "Count", "a", "v"],
        (0, "1", "2", None, "p"),
        (0, "2", "2", None, "q"),
        (0, None, None, "x", None),
    )
    first, second = flatten_groups(frame(spark, record), templates, keep=["n"], strategy=strategy)
    assert (first.columns, second.columns) == (["n", "a"], ["n", "P", "Count", "v"])
    union = first.unionByName(second, allowMissingColumns=True).select(df.columns)
    assert rows_of(union) == rows_of(df)


@every_strategy
def test_leaf_texts(spark, strategy):
    leaves = {
        "1": '"text"',
        "2": "17",
        "3": "-1.5",
        "4": "1.50",
        "5": "123456789.5",
        "6": "0.00001",
        "7": "true",
        "8": "false",
        "9": "null",
        "10": '[1, {"b": 2.5, "a": [1]}]',
        "11": "{}",
        "12": '{"x": 1}',
        "13": '"{\\"x\\": 1}"',
        "14": '"{"',
        "15": '"1.50"',
        "16": '"\\u007b}"',
        "17": "12345678901234567890",
        "18": '"[1, 2]"',
        "19": '""',
        "20": "12345678901.123456789",
    }
    texts = ['{"R": {"s": {"A": {"%s": {"v": %s}}}}}' % item for item in leaves.items()]
    df = flatten_paths(frame(spark, *texts), ["R.s.A.{i}.v"], strategy=strategy)
    assert {r.A: r.v for r in df.collect()} == {
        "1": "text",
        "2": "17",
        "3": "-1.5",
        "4": "1.5",
        "5": "123456789.5",
        "6": "0.00001",
        "7": "true",
        "8": "false",
        "9": None,
        "10": '[1,{"a":[1],"b":2.5}]',
        "13": '{"x": 1}',
        "14": "{",
        "15": "1.50",
        "16": "{}",
        "17": "12345678901234567890",
        "18": "[1, 2]",
        "19": "",
        "20": "12345678901.123456789",
    }


@every_strategy
def test_odd_shapes(spark, strategy):
    collections = [
        {"1": {"v": "a"}, "Count": 5, "2": "scalar", "3": ["array"], "x": {"v": "word"}},
        {"1": {"v": "a"}, "2": None, "3": {}},
        "scalar",
        ["array"],
        None,
    ]
    df = flatten_paths(
        frame(spark, *[{"R": {"s": {"A": c}}} for c in collections]), ["R.s.A.{i}.v"], keep=["n"], strategy=strategy
    )
    assert rows_of(df) == expected(["n", "A", "v"], (0, "1", "a"), (1, "1", "a"))


@every_strategy
def test_any_names(spark, strategy):
    record = {"R": {"s": {"A": {"eth0": {"v": "a", "B": {"x y": {"w": "1"}}}, "7": {"v": "b"}}}}}
    df = flatten_paths(
        frame(spark, record), ["R.s.A.{i}.B.{i}.w", "R.s.A.{i}.v"], keep=["n"], ids="any", mode="siblings",
        strategy=strategy,
    )
    assert rows_of(df) == expected(
        ["n", "A", "B", "v", "w"], (0, "eth0", "x y", None, "1"), (0, "eth0", None, "a", None), (0, "7", None, "b", None)
    )


@every_strategy
def test_literal_parts_are_not_patterns(spark, strategy):
    record = {"R": {"s": {"A-1": {"1": {"v(x)": "a"}, "2": {"vxx": "b"}}, "Ab1": {"3": {"v(x)": "c"}}}}}
    df = flatten_paths(frame(spark, record), [("R.s.A-1.{i}.v(x)", "v")], strategy=strategy)
    assert [tuple(r) for r in df.collect()] == [("1", "a")]


@every_strategy
def test_root_and_id_names(spark, strategy):
    record = {"dev.1": {"tree": {"R": {"s": {"A": {"1": {"A": {"2": {"v": "a"}}}}}}}}}
    df = flatten_paths(
        frame(spark, record),
        ["R.s.A.{i}.A.{i}.v"],
        root=["dev.1", "tree"],
        id_names={"R.s.A.{i}.A": "inner"},
        strategy=strategy,
    )
    assert rows_of(df) == expected(["A", "inner", "v"], ("1", "2", "a"))


def test_templates_no_single_schema_fits(spark):
    record = {"R": {"s": {"A": {"1": {"v": "a"}, "Count": "1"}, "B": "leaf", "b": "other"}}}
    templates = ["R.s.A.{i}.v", "R.s.A.Count", ("R.s.B", "upper"), ("R.s.b", "lower_b"), "R.s.B.deep"]
    for strategy in STRATEGIES:
        df = flatten_paths(frame(spark, record), templates, strategy=strategy)
        assert [r.asDict() for r in df.collect()] == [
            {"A": "1", "v": "a", "Count": "1", "upper": "leaf", "lower_b": "other", "deep": None}
        ]


def test_rows_in_text_order(spark):
    instances = {str(n): {"v": str(n)} for n in (10, 2, 1, 33, 3)}
    for strategy in STRATEGIES:
        df = flatten_paths(
            frame(spark, {"R": {"s": {"A": instances}}}), ["R.s.A.{i}.v"], strategy=strategy, ordered=True
        )
        assert [r.A for r in df.collect()] == ["1", "10", "2", "3", "33"]


def test_flat_keys(spark):
    record = {"dev": {"parameters": {"R.s.A.1.v": "a", "R.s.A.1.B.2.w": 5, "R.s.A.2.v": None, "R.s.Count": "2"}}}
    df = flatten_paths(
        frame(spark, record),
        ["R.s.A.{i}.v", "R.s.A.{i}.B.{i}.w", "R.s.Count"],
        root="dev.parameters",
        mode="siblings",
        layout="flat",
    )
    assert rows_of(df) == expected(
        ["A", "B", "Count", "v", "w"], ("1", "2", "2", None, "5"), ("1", None, "2", "a", None), ("2", None, "2", None, None)
    )


@pytest.mark.parametrize("ids", ["numeric", "any"])
def test_plain_parts_where_others_have_ids(spark, ids):
    """A.b and A.7 beside A.{i}: a part is an id or a name by the template, and a key may be of two templates."""
    record = {"R": {"s": {"A": {"b": "scalar", "7": "seven", "1": {"x": "p", "b": {"u": "q"}}, "b-": {"x": "r"}}}}}
    flat_record = {f"R.s.A.{k}": v for k, v in {"b": "scalar", "7": "seven", "1.x": "p", "1.b.u": "q", "b-.x": "r"}.items()}
    templates = ["R.s.A.b", ("R.s.A.7", "seven"), "R.s.A.{i}.x", "R.s.A.{i}.b.u"]
    wanted = [("1", "scalar", "seven", "q", "p")] + ([("b-", "scalar", "seven", None, "r")] if ids == "any" else [])
    for df, options in ((frame(spark, record), {"strategy": s}) for s in STRATEGIES):
        assert rows_of(flatten_paths(df, templates, ids=ids, spine="any", **options)) == expected(["A", "b", "seven", "u", "x"], *wanted)
    assert rows_of(flatten_paths(frame(spark, flat_record), templates, ids=ids, spine="any", layout="flat")) == expected(["A", "b", "seven", "u", "x"], *wanted)


def test_trie_of_templates():
    templates = normalise(["A.b", "A.b.c", "A.{i}.x", "A.{i}.B.{i}.u", "A.{i}.B.{i}.w", "Z"])
    trie = trie_regex(templates, "[0-9]+")
    keys = ["A.b", "A.b.c", "A.1.x", "A.1.B.22.u", "A.1.B.2.w", "Z", "A", "A.1.B.2", "A.1.x.y", "Ab", "A.x.x", "A.b.", ""]
    assert [bool(re.search(trie, k)) for k in keys] == [any(re.search(template_regex(t, "[0-9]+"), k) for t in templates) for k in keys]
    assert trie.count("B") == 1  # what templates share is written once


def test_flat_keys_with_odd_values(spark):
    values = ['"t"', "1", "1.50", "123456789.5", "null", '{"x": 1}', "{}", '"{\\"x\\": 1}"', "[1, 2.5]", "true", '"2.50"']
    texts = ['{"R.s.A.%d.v": %s, "R.s.n": 7}' % (n, v) for n, v in enumerate(values)]
    together = "{%s}" % ", ".join('"R.s.A.%d.v": %s' % item for item in enumerate(values))
    wanted = ["t", "1", "1.5", "123456789.5", None, '{"x": 1}', "[1,2.5]", "true", "2.50"]
    ids = ["0", "1", "2", "3", "4", "7", "8", "9", "10"]
    for records in (texts, [together], ["[1]", "{bad", None, "", together]):
        df = flatten_paths(frame(spark, *records), ["R.s.A.{i}.v"], layout="flat")
        assert rows_of(df) == expected(["A", "v"], *zip(ids, wanted))
    rooted = flatten_paths(frame(spark, '{"d": {"p.q": %s}, "e": 1}' % together, '{"d": 5}'), ["R.s.A.{i}.v"],
                           root=["d", "p.q"], layout="flat")
    assert rows_of(rooted) == expected(["A", "v"], *zip(ids, wanted))


def test_path_map(spark):
    text = '{"a": {"b": 1, "c": {"d": null, "e": [1, 2], "f": {}}}, "g": "{}", "a.b": 2}'
    df = frame(spark, text, "{bad", None, "[1]", "{}")
    found = [r[0] for r in df.orderBy("n").select(path_map(F.col("value"))).collect()]
    assert found[0] == {"a.b": "1", "a.c.d": None, "a.c.e": "[1,2]", "g": "{}"}
    assert found[1:] == [None, None, None, {}]
    rooted = df.filter("n = 0").select(path_map(F.col("value"), root="a")).first()[0]
    assert rooted == {"b": "1", "c.d": None, "c.e": "[1,2]"}


def test_prune_paths(spark):
    paths = F.create_map(*map(F.lit, ("A.1.x", "a", "A.n.x", "b", "A.1.xx", "c", "Ax1xx", "d")))
    df = spark.range(1)
    assert df.select(prune_paths(paths, ["A.{i}.x"])).first()[0] == {"A.1.x": "a"}
    assert df.select(prune_paths(paths, ["A.{i}.x"], ids="any")).first()[0] == {"A.1.x": "a", "A.n.x": "b"}


def test_bad_arguments(spark):
    df = frame(spark, "{}")
    for wrong in ({"spine": "x"}, {"ids": "x"}, {"layout": "x"}, {"strategy": "x"}, {"mode": "x"}, {"keep": ["v"]}):
        with pytest.raises(ValueError):
            flatten_paths(df.withColumn("v", F.lit(1)), ["R.s.A.{i}.v"], **wrong)


def test_no_shuffle_and_one_parse(spark):
    df = flatten_paths(frame(spark, TREE), [*FARM, "Device.Info.Class"], keep=["n"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan
    # One typed parse; the string maps of the fall-back stand behind a CASE for records no variant can hold.
    assert plan.count(" AS __typed#") == 1 and plan.count("__unexpected") > 0
    reading = [line for line in plan.splitlines() if " AS __typed#" in line]
    assert sum(line.count("from_json(StructField(R") + line.count("from_json(StructField") for line in reading) == 1


@every_strategy
def test_strings_that_look_like_objects(spark, strategy):
    """No variant holds these records, as a key is there twice; strings stay strings all the same."""
    leaf = {"1": '{"a":1}', "2": "[1]", "3": '~"~', "4": "\\", "5": "{", "6": "n\nl \u00e9"}
    body = json.dumps({"D": {"E": {k: {"X": v} for k, v in leaf.items()} | {"7": {"X": ["{}", '"~', {"k": "~"}]}, "8": {"X": {"y": "z"}}}}})
    texts = [body[:-1] + more for more in (', "Z": 1, "Z": 2}', ', "Z": {"a": 1, "a": {"b": "}"}}}', "}")]
    df = flatten_paths(frame(spark, *texts), ["D.E.{i}.X"], keep=["n"], strategy=strategy)
    assert rows_of(df) == expected(["n", "E", "X"], *[(n, k, v) for n in range(3) for k, v in [*leaf.items(), ("7", '["{}","\\"~",{"k":"~"}]')]])
    nested = '{"D": {"E": {"1": {"X": "in"}}, "E": {"2": {"X": "{}", "X": 5}}}, "D.E.2.X": "later"}'
    df = flatten_paths(frame(spark, nested), ["D.E.{i}.X"], strategy=strategy)
    assert rows_of(df) == expected(["E", "X"], ("2", "5"))


def test_path_map_opens_each_node_once(spark):
    """Leaves of all depths beside each other, arrays that hold objects, and equal paths."""
    record = {"a": {"b": {"c": {"d": 1}}, "b.c": {"d": 2}}, "x": [{"y": {"z": 1}}], "e": {"f": {}, "g": [[]]}, "h": None}
    leaves = {"a.b.c.d": "1", "x": '[{"y":{"z":1}}]', "e.g": "[[]]", "h": None}
    text = json.dumps(record)
    found = frame(spark, text, text[:-1] + ', "h": 1, "h": null}').select(path_map(F.col("value"))).collect()
    assert [r[0] for r in found] == [leaves, leaves]
    wide = {f"k{i}": {f"l{j}": {"m": i * j} for j in range(30)} for i in range(40)}
    assert frame(spark, wide).select(path_map(F.col("value"))).first()[0] == {f"k{i}.l{j}.m": str(i * j) for i in range(40) for j in range(30)}


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan ")


@every_strategy
def test_groups_as_tables(spark, tmp_path, strategy):
    records = [TREE, clients(), {"Device": {"Info": {"Class": "c", "Kind": "k"}}}, "{bad", None]
    templates = [*FARM, "Device.Info.Class", ("Device.Info.Kind", "InfoKind")]
    df, options = frame(spark, *records), dict(keep=["n"], strategy=strategy, mode="siblings")
    groups = flatten_groups(df, templates, **options)
    assert len(groups) == 3 and groups[0].columns == groups.columns(0)
    stacked = flatten_paths(df, templates, **options)
    aligned = groups[0]
    for other in groups[1:]:
        aligned = aligned.unionByName(other, allowMissingColumns=True)
    assert rows_of(groups.union()) == rows_of(stacked) == rows_of(aligned.select(*stacked.columns))
    stored = groups.store(str(tmp_path / strategy))
    assert [rows_of(t) for t in stored] == [rows_of(t) for t in groups] and [t.columns for t in stored] == [t.columns for t in groups]
    assert set(groups.union([0, 2]).columns) == {*groups.columns(0), *groups.columns(2)}
    tagged = groups.tagged("which")
    assert sorted(r["count"] for r in tagged.groupBy("which").count().collect()) == sorted(t.count() for t in groups)


def test_groups_from_one_scan(spark, tmp_path):
    frame(spark, TREE).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    groups = flatten_groups(df, [*FARM, "Device.Info.Class"], keep=["n"])
    stacked = flatten_paths(df, [*FARM, "Device.Info.Class"], keep=["n"])
    for one in (groups.union(), groups.tagged(), stacked):
        assert scans(one) == 1
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Union" not in plan
        assert sum(line.count("from_json(StructField") for line in plan.splitlines() if " AS __typed#" in line) == 1


@every_strategy
def test_absent_instances(spark, strategy):
    records = [
        {"R": {"s": {"Count": 2, "A": {"1": {"x": "a", "B": {"7": {"u": "p"}}}, "2": {"x": "b"}}}}},
        {"R": {"s": {"Count": 1, "A": {"3": {"x": None}}}}},
        {"R": {"s": {}}},
        "{bad",
    ]
    templates = ["R.s.Count", "R.s.A.{i}.x", "R.s.A.{i}.B.{i}.u"]
    options = dict(keep=["n"], mode="siblings", strategy=strategy, keep_absent=True)
    df = flatten_paths(frame(spark, *records), templates, ordered=True, position="place", **options)
    columns = ["n", "A", "B", "Count", "u", "x", "place"]
    outer = lambda n, count, *x: [(n, i, None, count, None, x[k], k + 1) for k, i in enumerate("123")]
    assert rows_of(df) == expected(
        columns,
        (0, "1", "7", "2", "p", None, 0), *outer(0, "2", "a", "b", None),
        (1, "1", "7", "1", None, None, 0), *outer(1, "1", None, None, None),
        (2, "1", "7", None, None, None, 0), *outer(2, None, None, None, None),
        (3, "1", "7", None, None, None, 0), *outer(3, None, None, None, None),
    )
    scalars = flatten_paths(frame(spark, *records), ["R.s.Count"], keep=["n"], keep_absent=True, strategy=strategy)
    assert sorted(map(tuple, scalars.collect())) == sorted([(0, "2"), (1, "1"), (2, None), (3, None)], key=lambda r: r[0])
    assert flatten_paths(frame(spark, *records).limit(0), templates, **options).count() == 0
    with pytest.raises(ValueError, match="max_instances"):
        flatten_paths(frame(spark, *records), templates, max_instances=2, **options)


def test_absent_instances_of_random_records(spark, random_records):
    templates = ["R.s.Count", "R.s.A.{i}.x", "R.s.A.{i}.y"]
    (group,) = plan_groups(templates)
    own = [brute_force(r, group, "any") for r in random_records]
    every = {row["A"] for rows in own for row in rows}
    wanted = []
    for n, (record, rows) in enumerate(zip(random_records, own)):
        leaves = flat(record) if isinstance(record, dict) else {}
        held = {row["A"]: row for row in rows}
        for a in every:
            row = held.get(a, {})
            wanted.append((n, a, leaves.get("R.s.Count"), row.get("x"), row.get("y")))
    for strategy in STRATEGIES:
        df = flatten_paths(frame(spark, *random_records), templates, keep=["n"], spine="any", strategy=strategy, keep_absent=True)
        assert df.columns == ["n", "A", "Count", "x", "y"]
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(wanted, key=repr)


def test_no_absent_instances_on_streams(spark, tmp_path):
    frame(spark, TREE).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("n int, value string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="stream"):
        flatten_paths(stream, FARM, keep_absent=True)
    with pytest.raises(ValueError, match="stream"):
        flatten_groups(stream, FARM).store(str(tmp_path / "out"))


@every_strategy
def test_positions(spark, strategy):
    instances = {str(n): {"v": str(n)} for n in (10, 2, 1)}
    df = flatten_paths(frame(spark, {"R": {"s": {"A": instances}}}), ["R.s.A.{i}.v"], strategy=strategy, ordered=True, position="at")
    assert [(r["at"], r.A) for r in df.collect()] == [(0, "1"), (1, "10"), (2, "2")]
    with pytest.raises(ValueError):
        flatten_paths(frame(spark, "{}"), ["R.s.A.{i}.v"], position="v")


def test_odd_leaves_are_noticed(spark):
    """The scan of the text notices whatever the fast parse would bend, escaped keys too."""
    leaves = ["null", "1.50", "[1]", '{"a":1}', "1e3", "1" * 40, '"NaN"', "true", '"null"', " null "]
    texts = ['{"R":{"s":{"A":{"1":{"v":%s}}}}}' % v for v in leaves]
    texts += ['{"R":{"s":{"A":{"1":{"\\u0076":%s}}}}}' % v for v in ("null", "1.50", '"x"')]
    texts += ['{"R":{"s":{"A":{"1":{"v":"a"},"1":{"v":"b"},"2":{"v":"c"}}}}}']
    found = [rows_of(flatten_paths(frame(spark, *texts), ["R.s.A.{i}.v"], keep=["n"], strategy=s)) for s in STRATEGIES]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts) - 1 + 1


# Random records against the rules in plain Python, one group at a time.

RANDOM_TEMPLATES = [
    "R.s.Count", "R.s.A.{i}.x", "R.s.A.{i}.y", "R.s.A.{i}.B.{i}.u", "R.s.A.{i}.B.{i}.w", "R.s.A.{i}.C.{i}.q", "R.t.z",
]


def flat(value, path=()):
    if isinstance(value, dict):
        return {k: v for key, child in value.items() for k, v in flat(child, (*path, key)).items()}
    text = value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))
    return {".".join(path): text}


def brute_force(record, group, spine):
    leaves = flat(record) if isinstance(record, dict) else {}
    scalars = {t.alias: leaves.get(t.path) for t in group.templates if not t.depth}
    if not group.depth:
        return [scalars]
    regexes = {t: re.compile(re.escape(t.path).replace(r"\{i\}", "([0-9]+)")) for t in group.templates}
    found = {t: {m.groups() for k in leaves if (m := regexes[t].fullmatch(k))} for t in group.templates if t.depth}
    for depth in range(group.depth, 0, -1):
        level = [found[t] for t in group.templates if t.depth == depth and found[t]]
        if level:
            ids_here = set().union(*level) if spine == "any" else level[0]
            break
    else:
        return []
    names = [keys[-1] for keys in group.collections]
    rows = []
    for ids in ids_here:
        row = dict(scalars, **dict(zip(names, ids)))
        for t in found:
            if t.depth <= len(ids):
                parts = iter(ids)
                row[t.alias] = leaves.get(re.sub(r"\{i\}", lambda _: next(parts), t.path))
        rows.append(row)
    return rows


def random_record(rng):
    def leaf():
        return rng.choice(["a", "b", "", None, 5, -2, True, [1, 2], {}, {"k": 1}, "{", '{"k": 1}', 2.5, "2.50"])

    def some(fields):
        return {k: v() for k, v in fields.items() if rng.random() < 0.6}

    def instances(body):
        found = {str(rng.randrange(1, 30)): body() for _ in range(rng.randrange(4))}
        if rng.random() < 0.15:
            found["Total"] = rng.choice([3, "t", None, {"x": "no"}])
        return found

    inner = {"u": leaf, "w": leaf}
    outer = {
        "x": leaf,
        "y": leaf,
        "B": lambda: instances(lambda: some(inner)),
        "C": lambda: instances(lambda: some({"q": leaf})),
    }
    record = {"R": {"s": some({"Count": leaf, "A": lambda: instances(lambda: some(outer))}), "t": some({"z": leaf})}}
    return record if rng.random() < 0.95 else rng.choice([None, "{bad", [record], 5, {"R": 1}])


@pytest.fixture(scope="module")
def random_records():
    rng = random.Random(7)
    return [random_record(rng) for _ in range(400)]


def random_texts(records):
    """Texts of the records; every third object repeats a key, so that no variant can hold it."""
    twice = ', "Z": "{\\"q\\": 1}", "Z": ["~", "}"]}'
    texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
    return [t[:-1] + twice if n % 3 == 0 and isinstance(r, dict) else t for n, (t, r) in enumerate(zip(texts, records))]


@pytest.mark.parametrize(
    "mode, spine, strategy", list(itertools.product(["ancestors", "siblings"], ["driver", "any"], STRATEGIES))
)
def test_random_records(spark, random_records, mode, spine, strategy):
    df = flatten_paths(
        frame(spark, *random_texts(random_records)), RANDOM_TEMPLATES, keep=["n"], mode=mode, spine=spine, strategy=strategy
    )
    columns = df.columns
    wanted = [
        tuple({"n": n, **row}.get(c) for c in columns)
        for n, record in enumerate(random_records)
        for group in plan_groups(RANDOM_TEMPLATES, mode)
        for row in brute_force(record, group, spine)
    ]
    found = [tuple(r) for r in df.collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len(found) > 400


def test_groups_are_stored_without_a_sort(spark, tmp_path):
    groups = flatten_groups(frame(spark, TREE).repartition(1), ["Device.Farm.Size", *FARM], keep=["n"])
    sorts = []
    real = type(spark.range(1).write).parquet

    def parquet(writer, path):
        sorts.append(int(spark.conf.get(OPEN_FILES)))
        return real(writer, path)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1).write), "parquet", parquet)
        stored = groups.store(str(tmp_path / "groups"))
    assert sorts == [len(groups)] and spark.conf.get(OPEN_FILES) == "0"
    assert [rows_of(df) for df in stored] == [rows_of(groups[n]) for n in range(len(groups))]


PLAIN = [
    '{"D":{"e":{"1":{"X":"a","Y":2},"03":{"X":true},"b":{"X":"c"},"2":{"Y":-7}}},"n":null}',
    '{"D.e.1":{"X":"dotted"},"D":{"e":{"1":{"X":"nested"},"2":{"X":"x"}}}}',
    '{"D":{"e":{"1":{"X":1}}},"D":{"e":{"1":{"X":5,"X":6},"2":{"X":7}}}}',
    '{"D":{"e":{"10":{"X":"ü\\n"},"9":{"X":"","Z":{"q":"r"}}},"":{"":"empty"}}}',
    '{"a":' * 40 + '"deep"' + "}" * 40,
]
NOT_PLAIN = [
    '{"D":{"e":{"1":{"X":1.50}}}}', '{"D":{"e":{"1":{"X":[1,{"a":2}]}}}}', '{"D":{"e":{"1":{"X":12345678901234567890}}}}',
    '{"D":{"e":{"1":{"X":"\\ud83d"}}}}', '{"D":{"e":{"1":{"X":-0}}}}', '{"D":{"e":{"1":{"X":NaN}}}}', '{"D":{}}', "{}", "[1]", "1", "", "{",
    '{"D":{"e":{"1":{"X":1}}}} x', '{"D":{"e":{"1":{"X":"' + "x" * 70_000 + '"}}}}', None,
]


def test_plain_records_need_no_sql():
    assert [leaves(t) is not None for t in [*PLAIN, *NOT_PLAIN]][: len(PLAIN)] == [True] * len(PLAIN)
    assert all(leaves(t) is None for t in NOT_PLAIN if t is None or len(t) < 60_000)
    assert leaves(PLAIN[1]) == {"D.e.1.X": "nested", "D.e.2.X": "x"}
    assert leaves(PLAIN[2], ["D"]) == {"e.1.X": "6", "e.2.X": "7"}


@pytest.mark.parametrize("root", [None, "D"])
def test_batches_read_as_sql_does(spark, root):
    texts = frame(spark, *PLAIN, *NOT_PLAIN).union(spark.sql("SELECT 99, cast(X'7B2261223A2280227D' AS string)"))
    keys = [root] if root else []
    both = texts.select(path_map(F.col("value"), root).alias("found"), sql_path_map(F.col("value"), keys).alias("wanted"), plain_paths(F.col("value"), keys).alias("plain"))
    rows = both.collect()
    assert [r.found for r in rows] == [r.wanted for r in rows]
    assert sum(r.plain is not None for r in rows) >= len(PLAIN) - 1


@pytest.mark.parametrize("ids", ["numeric", "any"])
@pytest.mark.parametrize("layout", ["nested", "flat"])
def test_plain_records_give_the_rows_of_sql(spark, monkeypatch, ids, layout):
    texts = frame(spark, *PLAIN, *NOT_PLAIN, '{"D":{"e":{"1":{"X":null},"2":{"X":1}}},"n":5}')
    options = dict(keep=["n"], strategy="path_map", layout=layout, ids=ids, position="place")
    wanted = ["D.e.{i}.X", "D.e.{i}.Y", ("n", "N"), ("D.q", "Q")]
    quick = flatten_paths(texts.withColumnRenamed("n", "k"), wanted, **options | {"keep": ["k"]})
    found = rows_of(quick)
    assert any(name.startswith("__plain") for name in re.findall(r"__\w+", quick._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(TypedRecord, "try_build", classmethod(lambda *_: None))
    assert found == rows_of(flatten_paths(texts.withColumnRenamed("n", "k"), wanted, **options | {"keep": ["k"]}))
