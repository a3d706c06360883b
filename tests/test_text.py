import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.functions import json_text as js, text as tx, tokens as tk
from leafmill.functions.latex import format_units, latex_normalize


def test_white_space_is_pythons():
    assert {c for c in map(chr, range(0x110000)) if c.isspace()} == set(tx.WHITESPACE)


def test_strip_equals_python(texts):
    values = ["", " a ", "\x1c a b　\n", "​a", "\t\r\n", *[f"{c}x{c}" for c in tx.WHITESPACE]]
    assert texts(values, tx.strip) == [v.strip() for v in values]


def test_squeeze_and_newlines(texts):
    values = ["a \t\n b", " \x1fa", "plain"]
    assert texts(values, tx.squeeze) == ["a b", " a", "plain"]
    assert texts(["a\r\nb\rc\n\r"], tx.unix_newlines) == ["a\nb\nc\n\n"]


def test_file_names(texts):
    names = ["a/b/x.tar.gz", "x", ".hidden", "a/..b", "v1.2.JSON", "dir.d/plain"]
    assert texts(names, tx.file_name) == ["x.tar.gz", "x", ".hidden", "..b", "v1.2.JSON", "plain"]
    assert texts(["x.tar.gz", "x", ".hidden", "..b"], tx.file_ext) == ["gz", "", "", "b"]
    assert texts(["x.tar.gz", "x", ".hidden"], tx.file_stem) == ["x.tar", "x", ".hidden"]


def test_human_size(spark):
    sizes = [0, 1023, 1024, 1025, 2560, 3584, 1048575, 1048577, 1310720, 1835008, 52428800]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    got = [r[0] for r in df.orderBy("n").select(tx.human_size(F.col("n"))).collect()]
    # 2560 and 3584 are halves: 2.5 and 3.5 KB go to the even side; so do 1.25 and 1.75 MB.
    assert got == ["0 B", "1023 B", "1 KB", "1 KB", "2 KB", "4 KB", "1024 KB", "1.0 MB", "1.2 MB", "1.8 MB", "50.0 MB"]


def test_latex(texts):
    values = ["  E \\\\\\= m   \\frac{a}{b}  ", "\\\\\\\\alpha\\beta", "a\n\tb"]
    first = texts(values, latex_normalize)
    assert first == ["E \\= m \\frac{a}{b}", "\\alpha\\beta", "a b"]
    assert texts(first, latex_normalize) == first


def test_units(texts):
    values = [None, "", "Dimensionless", "m s^{-2}", "m^{2} kg^{3} s^{-1}", "m^{4}"]
    expected = ["dimensionless"] * 3 + ["m s⁻²", "m² kg³ s⁻¹", "m^{4}"]
    assert texts(values, format_units) == expected
    assert texts(expected, format_units) == expected


def test_token_windows(texts):
    windows = lambda size: lambda c: tk.token_windows(tk.tokens(c), size)
    assert texts(["one two  three\nfour five "], windows(2)) == [["one two", "  three\nfour", " five "]]
    assert texts(["", "a", " "], windows(2)) == [[], ["a"], [" "]]
    with pytest.raises(ValueError):
        tk.token_windows(F.col("t"), 0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabé😀.", max_size=60), min_size=20, max_size=60), st.integers(1, 7))
def test_windows_put_together_are_the_text(spark, values, size):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    counted = df.withColumn("t", tk.tokens(F.col("text"))).select(
        "i", tk.token_count(F.col("text")).alias("n"), tk.token_windows(F.col("t"), size).alias("w"))
    for row in counted.collect():
        assert "".join(row.w) == values[row.i]
        assert len(row.w) == -(-row.n // size)


JSON_TEXTS = [
    "not json", "[]", "{}", "null", "```json\n[]\n```", '[{"equation":"E"}] trailing', '{"a":"A"}{"a":"B"}', "{'a':'E'}",
    '[{"a":"E"', '[{"a":"E"},"x"]', '{"a":"E"}', '[1], "w": 2', '[{"a":"E"}]} junk', "[1]] junk", "", " ", '  {"a":1}  ',
    '\n[{"a":[1, 2.50,1e5],"b":{"c" : null}}]', '{"a":01}', "[1,]", "[,1]", '{"a":1,}', '"{\\"a\\":1}"', "5", "true",
    '[{"a":"x","a":"y"}]', '{"a":"tab\there"}', '[{"a":"\\u00e9\\ud83d\\ude00"}]', "[1] // c", '{"a":"\\x"}', "{a:1}",
    "[+1]", "1,2", "[]]", "﻿[]", '{"a":null}', '[{"a":1} {"b":2}]', '"a" "b"', "[[{}]]", "\x00[]", "[1]\x0b", "[1] ",
]


def _valid(text):
    try:
        return json.loads(text) is not None
    except ValueError:
        return False


def test_strict_json_accepts_what_a_json_parser_accepts(texts):
    assert [v is not None for v in texts(JSON_TEXTS, js.strict_value)] == [_valid(t) for t in JSON_TEXTS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet='{}[]":, a1\\', max_size=12), min_size=100, max_size=300))
def test_strict_json_on_random_texts(texts, values):
    got = texts(values, js.strict_value)
    assert [v for v, g in zip(values, got) if (g is not None) != _valid(v)] == []
