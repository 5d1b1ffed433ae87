import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.functions.types import TYPE_NAMES, build_schema, data_type, permissive_cast, struct_field


def test_type_names():
    assert sorted(TYPE_NAMES) == [
        "boolean", "byte", "date", "double", "float", "int", "long", "short", "string", "timestamp",
    ]
    assert data_type("decimal(10,2)") == T.DecimalType(10, 2)
    assert data_type("decimal( 5 , 0 )") == T.DecimalType(5, 0)


@pytest.mark.parametrize("name", ["Int", "decimal", "decimal(x,2)", "decimal(39,0)", "decimal(2,3)", "struct", ""])
def test_unknown_output_type(name):
    with pytest.raises(ValueError):
        data_type(name)


def test_input_types_in_any_case():
    assert struct_field("a", "INT") == T.StructField("a", T.IntegerType(), True)
    assert struct_field("a", "Decimal(4,1)").dataType == T.DecimalType(4, 1)


def test_schema_from_pairs_and_mappings():
    expected = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert build_schema([("a", "string"), ("b", "long")]) == expected
    assert build_schema([{"a": "string"}, {"b": "Long"}]) == expected
    with pytest.raises(ValueError):
        build_schema([("a", "array")])


@pytest.mark.parametrize(
    "text, type_name, expected",
    [
        ("file", "int", None),
        ("3.7", "int", 3),
        (" -3.9 ", "int", -3),
        ("5.", "long", 5),
        ("1e3", "int", None),
        ("300", "byte", None),
        ("99999999999", "int", None),
        ("99999999999.5", "long", 99999999999),
        ("1.25", "double", 1.25),
        ("x", "double", None),
        ("1.255", "decimal(10,2)", Decimal("1.26")),
        ("12345", "decimal(3,0)", None),
        ("true", "boolean", True),
        ("maybe", "boolean", None),
        ("2020-02-30", "date", None),
        ("2020-02-29", "date", datetime.date(2020, 2, 29)),
        ("2020-02-29 01:02:03", "timestamp", datetime.datetime(2020, 2, 29, 1, 2, 3)),
        (None, "int", None),
    ],
)
def test_permissive_cast(spark, text, type_name, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(permissive_cast(F.col("c"), data_type(type_name))).first()[0] == expected


def test_permissive_cast_of_typed_columns(spark):
    df = spark.createDataFrame([(3.7, 70000)], "d double, n long")
    cast = df.select(
        permissive_cast(F.col("d"), T.IntegerType(), T.DoubleType()).alias("d"),
        permissive_cast(F.col("n"), T.ShortType(), T.LongType()).alias("n"),
        permissive_cast(F.col("n"), T.StringType(), T.LongType()).alias("t"),
    )
    assert tuple(cast.first()) == (3, None, "70000")
