import base64

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codec
from millrace.sources.messages import publish_rows

TOKENS = {
    "QUI=": "AB",
    "QQ==": "A",
    "QQ": "A",
    "QUJDRA": "ABCD",
    "": "",
    "w6k=": "é",
    "/w==": "�",
    "QQ=": None,
    "Q": None,
    "QU JD": None,
    "QUJ\nD": None,
    "QUI=\n": None,
    "QUJD\n": None,
    "QUJD\r\n": None,
    "QUJD\u2028": None,
    "QUJD ": None,
    "\n": None,
    "####": None,
    "_-8=": None,
    "=": None,
    "QUI=QUI=": None,
    None: None,
}


def test_base64_text_is_strict(spark):
    rows = spark.createDataFrame([(t,) for t in TOKENS], "token string")
    codec.register_converter(spark)
    out = rows.select("token", codec.base64_text(F.col("token")), F.expr("converter(token)"))
    for token, text, by_sql in out.collect():
        assert text == TOKENS[token], token
        assert by_sql == text


def test_long_tokens_have_no_line_breaks(spark):
    text = "länger " * 5000
    row = spark.createDataFrame([(text,)], "x string").select(
        codec.base64_token(F.col("x")).alias("t")
    )
    token = row.first()[0]
    assert token == base64.b64encode(text.encode()).decode()
    assert row.select(codec.base64_text(F.col("t"))).first()[0] == text


@pytest.mark.parametrize(
    "message, kept, dropped",
    [
        ("a,b", ["a", "b"], ["a", "b"]),
        ("a,,b,,", ["a", "", "b", "", ""], ["a", "", "b"]),
        (",,", ["", "", ""], []),
        (",a", ["", "a"], ["", "a"]),
        ("", [""], [""]),
        (None, None, None),
    ],
)
def test_split_fields(spark, message, kept, dropped):
    row = spark.createDataFrame([(message,)], "m string").select(
        codec.split_fields(F.col("m")), codec.split_fields(F.col("m"), drop_trailing_empty=True)
    )
    assert list(row.first()) == [kept, dropped]


def test_rows_to_messages_spells_nulls(spark, work):
    rows = spark.createDataFrame([(1, None, "x,y"), (None, "a", None)], "a int, b string, c string")
    assert [r.value for r in codec.rows_to_messages(rows).collect()] == ["1,null,x,y", "null,a,null"]
    publish_rows(rows, {"path": work.path("out")}, fmt="text")
    assert spark.read.text(work.path("out")).count() == 2


def test_decode_records_quarantines(spark):
    def b64(*fields):
        return ",".join(base64.b64encode(f.encode()).decode() for f in fields)

    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())]
    )
    messages = {
        b64("1", "x"): (1, "x", None),
        b64("2", ""): (2, "", None),
        "null," + b64("z"): (None, "z", None),
        b64("", "z"): (None, "z", None),
        b64("8") + ",null": (8, None, None),
        b64("3"): (None, None, b64("3")),
        "null": (None, None, "null"),
        b64("4", "y", "z"): (None, None, b64("4", "y", "z")),
        b64("five", "y"): (None, None, b64("five", "y")),
        b64("6") + ",#": (None, None, b64("6") + ",#"),
        "": (None, None, ""),
        None: (None, None, ""),
    }
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    out = codec.decode_records(df, schema)
    assert [tuple(r) for r in out.collect()] == list(messages.values())
    plan = plan_of(out)
    assert "Python" not in plan and "Exchange" not in plan
    assert "lambda" not in plan
    # Each field is decoded once, however often its text is used.
    assert plan.count("unbase64") == len(schema)


def test_decoding_stays_native(spark):
    df = spark.createDataFrame([("QQ==,QUI=",)], "m string")
    plan = plan_of(df.select(codec.decode_fields(F.col("m"))))
    assert "Python" not in plan
