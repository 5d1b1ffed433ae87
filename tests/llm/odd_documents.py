import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves, on columns they do not own.
        *(T.StructField(c, T.StringType()) for c in ("row", "n", "rank", "score", "kept", "label", "part")),
    ]
)
PROSE = "the cat sat on the mat and looked at a bird that sang in the old tree near our quiet house by the river"


def odd_texts():
    return [
        None,
        "",
        "   \n\t ",
        "one",
        "One two three four",
        PROSE,
        PROSE.upper(),
        PROSE,
        PROSE + " today",
        "line a\nline b\nline a\n" * 30,
        "# * $ % " * 40,
        "é" * 5000,
        "long " * 30_000,
        "x" * 20_000,
        "call +1 (269) 555-3296 4556737586899855 or a.b@mail.example.com at 10.20.30.40",
        "日本語 テスト 😀   wide　space",
    ]


@pytest.fixture
def documents(spark):
    def make(texts=None):
        texts = odd_texts() if texts is None else texts
        rows = [(i, t, ["en", None, "de"][i % 3], ["s1", "s2", None][i % 3], None if t is None else len(t), *["x"] * 7) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
