"""Objects cut out of JSON texts, at any depth."""

import json
import random

import pytest
from pyspark.sql import functions as F

from streamloom.functions.json import DEPTH, raw_object, to_rows


def cut(spark, texts, name="data"):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(raw_object(F.col("t"), name)).collect()]


@pytest.mark.parametrize("depth", [1, DEPTH, DEPTH + 1, DEPTH + 2, 40, 400])
def test_deep_objects_come_as_they_stand(spark, depth):
    value = '{"a": [' * depth + '100.10 , "]}\\"{"' + "]}" * depth
    texts = [f'{{"type":"insert", "data" : {value} , "x":{{"data":[1]}}}}', f'{{"x":{value},"data":{value}}}', f'{{"x":{{"data":{value}}}}}']
    assert cut(spark, texts) == [value, value, None]


def test_names_that_are_not_the_member(spark):
    deep = "[" * 12 + "1.0" + "]" * 12
    texts = [
        f'{{"k":"data","data":{deep}}}', f'{{"k":["data",{deep}],"data":{deep}}}', f'{{"data":1,"k":{deep}}}', f'{{"data":"x","k":{deep}}}',
        f'{{"data":"data","data":{deep}}}', f'{{"a":"{{\\"data\\":[2]}}","data":{deep}}}', "", None, "[1]", '{"data":[[1}', '{"data"',
    ]
    assert cut(spark, texts) == [deep, deep, None, None, deep, deep, None, None, None, None, None]


def test_random_objects_against_the_writer(spark):
    rnd = random.Random(5)

    def value(depth):
        kind = rnd.random()
        if depth and kind < 0.7:
            return {rnd.choice("ab{\"data"): value(depth - 1) for _ in range(2)} if kind < 0.4 else [value(depth - 1)]
        return rnd.choice([1, 2.5, None, True, "x", "}{", 'a"b', "\\", "data"])

    texts, want = [], []
    for _ in range(150):
        members = {"type": value(1), "x": value(12), "data": {"v": value(14)}, "y": value(3)}
        names = rnd.sample(list(members), 4)
        texts.append("{" + ",".join(f"{json.dumps(n)}: {json.dumps(members[n])}" for n in names) + "}")
        want.append(json.dumps(members["data"]))
    assert cut(spark, texts) == want


def test_plain_values_stay_as_parsed(spark):
    deep = '{"n":' * 11 + "100.10" + "}" * 11
    df = spark.createDataFrame([(1, f'{{"data":{deep}}}'), (2, '{"data":"text {"}'), (3, '{"data":7}'), (4, "broken"), (5, None)], "i int, t string")
    got = to_rows(df, "t", {"data": "string"}, raw=("data",)).orderBy("i").collect()
    assert [r["data"] for r in got] == [deep, "text {", "7", None, None]
