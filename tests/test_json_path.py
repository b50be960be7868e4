import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import clean_json
from tributary.functions.json_path import field, find, find_one, has, keys, matches, steps

DOC = {"a": {"b": [{"c": 1}, {"c": "x"}, {"d": 2}]}, "list": [[1, 2], [3]], "text": '{"in":{"n":7}}', "flag": True, "n": 2.0, "": 0}


@pytest.mark.parametrize(
    "path, found",
    [
        ("a/b/c", [1, "x"]),
        ("/a//b/[1]/c", ["x"]),
        ("a/b/[9]", []),
        ("a/?/c", [1, "x"]),
        ("*/c", [1, "x"]),
        ("*/n", [2.0]),
        ("list/*/[0]", [1, 3]),
        ("list/?/?", [1, 2, 3]),
        ("text/in/n", []),
        ("missing/x", []),
        ("flag", [True]),
        ("[0]", []),
    ],
)
def test_paths(path, found):
    assert sorted(matches(DOC, steps(path)), key=str) == sorted(found, key=str)


def test_everything_below():
    assert sorted(json.dumps(v) for v in matches({"a": {"b": [1]}}, ["*"])) == sorted(json.dumps(v) for v in ({"a": {"b": [1]}}, {"b": [1]}, [1], 1))


def test_expand_reads_json_in_strings():
    assert matches(DOC, steps("text/in/n"), expand=True) == [7]
    assert matches({"t": "no json"}, steps("t/x"), expand=True) == []
    assert matches({"t": "no json"}, steps("t"), expand=True) == ["no json"]


def test_lists_keep_wildcards_in_presence():
    assert matches([{"*": 1}], ["*"], lists_take_wildcards=False) == matches({"*": 1}, ["*"])
    assert matches([1, 2], ["?"], lists_take_wildcards=False) == []


json_values = st.recursive(st.none() | st.booleans() | st.integers(-(2**60), 2**60) | st.text("ab", max_size=2), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from("abc"), x, max_size=3), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(json_values)
def test_deep_search_finds_every_member(value):
    def every(v):
        if isinstance(v, dict):
            return [w for k, w in v.items() if k == "a"] + [x for w in v.values() for x in every(w)]
        return [x for w in v for x in every(w)] if isinstance(v, list) else []

    if isinstance(value, dict):
        assert sorted(map(json.dumps, matches(value, ["*", "a"]))) == sorted(map(json.dumps, every(value)))


def test_columns(spark):
    rows = spark.createDataFrame([(1, json.dumps(DOC)), (2, None), (3, "no"), (4, '{"n":1e5}'), (5, '{"n":18446744073709551615,"s":"5"}')], "i int, t string")
    got = {r.i: r for r in rows.select("i", find("t", "*/c", "any").alias("c"), find_one("t", "n", "int").alias("n"), has("t", "a/b").alias("ab"), has("t", "").alias("any")).collect()}
    assert sorted(got[1].c) == ['"x"', "1"] and got[2].c is None and got[3].c is None and got[4].c is None
    assert got[1].n is None and int(got[5].n) == 18446744073709551615
    assert [got[i].ab for i in range(1, 6)] == [True, False, False, False, False]
    assert [got[i].any for i in range(1, 6)] == [True, False, False, False, True]
    v = clean_json.parse(F.col("t"))
    out = {r.i: r for r in rows.select("i", field(v, "s", "int").alias("s"), field(v, "s").alias("text"), field(v, "n", "int").alias("n"), keys(v).alias("keys"), field(v, "a/b/[0]/c", "int").alias("c"), field(v, "flag", "bool").alias("flag")).collect()}
    assert out[5].s is None and out[5].text == "5" and int(out[5].n) == 2**64 - 1 and sorted(out[5]["keys"]) == ["n", "s"]
    assert out[4].n is None and int(out[1].c) == 1 and out[1].flag is True


@pytest.mark.parametrize("text, clean", [("1", True), ("-9223372036854775808", True), ("-9223372036854775809", False), ("18446744073709551616", False), ("1e5", False), ("1.5e5", True), ('"1e5 99999999999999999999"', True), ("0.12345678901234567890123", True)])
def test_numbers(spark, text, clean):
    doc = f'{{"a":[{text}]}}'
    assert (clean_json.loads(doc) is not None) == clean
    assert spark.createDataFrame([(doc,)], "t string").select(clean_json.is_clean(F.col("t"))).first()[0] == clean


def test_wildcards_need_find():
    with pytest.raises(ValueError):
        field(F.lit(1), "a/*") if False else __import__("tributary.functions.json_path", fromlist=["_variant_path"])._variant_path("a/*")
