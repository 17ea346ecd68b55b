"""Documents printed as the database prints them."""

import pytest
from pyspark.sql import functions as F

from biblioscope.functions.documents import database_text, flag

CASES = [
    ('["a","b"]', '["a", "b"]'), ('[ "a" ,\n "b"]', '["a", "b"]'), ("[]", "[]"), ("{}", "{}"), ("[[],{}]", "[[], {}]"),
    ('{"bb":1,"a":2,"aa":3,"é":4}', '{"a": 2, "aa": 3, "bb": 1, "é": 4}'), ('{"a":1,"b":2,"a":3}', '{"a": 3, "b": 2}'),
    ('{"value":"x","id":{"zz":null,"y":[true,false]}}', '{"id": {"y": [true, false], "zz": null}, "value": "x"}'),
    ("[1.50,0.10,10,-3,0,-0,-0.0,100]", "[1.50, 0.10, 10, -3, 0, 0, 0.0, 100]"),
    ("[1e2,1.5E+3,1.505e2,1.50e-1,25e-3,1e-3,-2e0]", "[100, 1500, 150.5, 0.150, 0.025, 0.001, -2]"),
    ("[123456789012345678901234567890.12345678901234567890]", "[123456789012345678901234567890.12345678901234567890]"),
    (r'["éé\/\n\t\"\\","1.50","-1","a:b,c","[1,2]",""]', r'["éé/\n\t\"\\", "1.50", "-1", "a:b,c", "[1,2]", ""]'),
    ('{"k-1":"2020-01-02T03:04:05","n":-1.0}', '{"n": -1.0, "k-1": "2020-01-02T03:04:05"}'),
    ('"plain text, 1:2"', "plain text, 1:2"), ('"7"', "7"), ("1.50", "1.50"), ("true", "true"), ("null", None),
]


def test_values_are_printed_as_the_database_does(spark):
    documents = spark.createDataFrame([(i, f'{{"x": 1, "value": {text}, "y": [2]}}') for i, (text, _) in enumerate(CASES)], "i int, document string")
    found = dict(documents.select("i", database_text(F.col("document"), "value")).collect())
    assert [found[i] for i in range(len(CASES))] == [printed for _, printed in CASES]


def test_paths_and_what_is_absent(spark):
    documents = spark.createDataFrame([('{"a": {"b": [1, {"c": "x"}]}}',), ("{}",), (None,)], "document string")
    document = F.col("document")
    found = documents.select(database_text(document, "a"), database_text(document, "a", "b", 1), database_text(document, "a", "b", 1, "c"), database_text(document, "z")).collect()
    assert [tuple(r) for r in found] == [('{"b": [1, {"c": "x"}]}', '{"c": "x"}', "x", None), (None,) * 4, (None,) * 4]


def test_deeper_nesting_is_an_error(spark):
    document = F.lit('{"a": [["x"]]}')
    assert spark.range(1).select(database_text(document, "a", depth=2)).first()[0] == '[["x"]]'
    with pytest.raises(Exception, match="nested deeper"):
        spark.range(1).select(database_text(document, "a", depth=1)).collect()


@pytest.mark.parametrize("value, meant", [("on", True), ("off", False), ("True", True), (" f ", False), (True, True), (False, False), (None, False)])
def test_flags_in_any_writing(spark, value, meant):
    column = F.lit(value).cast("string") if value is None else F.lit(value)
    assert spark.range(1).select(flag(column)).first()[0] is meant
