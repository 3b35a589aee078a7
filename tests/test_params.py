import random

from conftest import plan_of
from pyspark.sql import functions as F

from millrace.functions.params import extract_params

BLANK = "".join(map(chr, range(33)))


def expected(tokens, fields, separator):
    found = {}
    for token in tokens:
        at = token.find(separator)
        key, value = token, token
        if at > 0:
            key, value = token[:at].strip(BLANK), token[at + len(separator):].strip(BLANK)
        if key in fields:
            found[key] = value
    return found


def run(spark, lists, fields, separator="="):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, t array<string>")
    out = df.select("i", extract_params(F.col("t"), fields, separator).alias("p"))
    return [r.p for r in out.orderBy("i").collect()]


def test_examples(spark):
    lists = [
        ["a=1", "b=2", "c=3"],
        ["a = x=y ", "\ta\t=\n2"],
        ["a", "=a", "b=", " b"],
        ["a=1", "a"],
        [],
    ]
    assert run(spark, lists, ["a", "b"]) == [
        {"a": "1", "b": "2"},
        {"a": "2"},
        {"a": "a", "b": ""},
        {"a": "a"},
        {},
    ]


def test_random_tokens_match_brute_force(spark):
    pick = random.Random(7)
    for separator in ["=", "::"]:
        lists = [
            [
                "".join(pick.choice("ab=: \t") for _ in range(pick.randint(0, 7)))
                for _ in range(pick.randint(0, 6))
            ]
            for _ in range(400)
        ]
        fields = ["a", "b", "ab", "", "=a", "a "]
        got = run(spark, lists, fields, separator)
        assert got == [expected(x, fields, separator) for x in lists]


def test_no_fields_and_no_shuffle(spark):
    assert run(spark, [["a=1"]], []) == [{}]
    df = spark.createDataFrame([(["a=1"],)], "t array<string>")
    plan = plan_of(df.select(extract_params(F.col("t"), ["a"])))
    assert "Exchange" not in plan and "Python" not in plan
