import json

import pytest
from pyspark.sql import functions as F

from leafmill.functions import answers
from leafmill.operators import equations, parsing


@pytest.fixture
def completions(spark):
    return lambda *values: spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, completion string")


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("id", "pos").select(*columns).collect()]


def test_section_texts(texts):
    every = lambda c: answers.section_texts(c, min_chars=0)
    assert texts(["###a##b"], every) == [["", "#a", "b"]]
    assert texts(['a "q" \\ b\nc'], every) == [['a \\"q\\" \\\\ b c']]


def test_section_length_counts_after_escaping(completions):
    df = completions("##" + "x" * 99 + "##" + "y" * 100, "## " + "z" * 98 + '"', "## " + "z" * 97 + '"', "", "##")
    assert rows(parsing.cpt_sections(df), "id", "pos", "text") == [(0, 0, "y" * 100), (1, 0, "z" * 98 + '\\"')]


QA = [
    ("Q1: What is DNA: x?\nA1: It is acid.\nmore\n\nQ2: two?\nA2: ans two\nQ10: ten?\nA10: tenans",
     [("What is DNA: x?", "x?"), ("two?", "ans two")]),
    ("Q1: a?\nQ2: b?\nA2: c", [("a?", "c")]),
    ("no pairs here", []),
    ("", []),
    ("Q: plain?\nA: yes", [("plain?", "yes")]),
    ("\n\n Q1:  spaced?  \nA1:\n later line\n", [("spaced?", "later line")]),
    ("Q1: one? still one?\nA1: a\u0085b", [("one? still one?", "a\u0085b")]),
]


def test_qa_pairs(completions):
    df = completions(*[text for text, _ in QA])
    expected = [(i, *pair) for i, (_, pairs) in enumerate(QA) for pair in pairs]
    assert rows(parsing.qa_pairs(df), "id", "question", "answer") == expected


def test_qa_pairs_without_the_limits(completions):
    df = completions(QA[0][0])
    fixed = parsing.qa_pairs(df, multi_digit=True, full_answer=True)
    assert rows(fixed, "question", "answer") == [
        ("What is DNA: x?", "It is acid.\nmore"), ("two?", "ans two"), ("ten?", "tenans"),
    ]


def test_synth_pieces(completions):
    head = "=== SYNTHETIC CONTENT 1 ==="
    df = completions(
        f"intro{head}\n" + "a" * 50 + f"\n====synthetic content====" + "b" * 51,
        "c" * 100 + "\n\n" + "d" * 101 + "\n\n\n" + "e" * 120,
        head + "short",
        f"{head} " + "f" * 40 + "\n\n" + "g" * 101,
    )
    assert rows(parsing.synth_pieces(df), "id", "pos", "text") == [
        (0, 0, "b" * 51), (1, 0, "d" * 101), (1, 1, "e" * 120),
        (3, 0, "f" * 40 + "\n\n" + "g" * 101),
    ]


def test_synth_fallback_when_headed_pieces_are_short(completions):
    df = completions("=== SYNTHETIC CONTENT ===\nshort\n\n=== SYNTHETIC CONTENT 2 ===")
    assert rows(parsing.synth_pieces(df), "text") == []


def test_equation_entries_and_quarantine(completions):
    bad = ["not json", "null", "7", '"text"', "```json\n[]\n```", '[{"equation":"E"}] trailing',
           '{"equation":"A"}{"equation":"B"}', "{'equation':'E'}", '[{"equation":"E"', None]
    df = completions(*bad, "[]", "{}", '[{"equation":"E"},"x",null,3]', '{"equation":"single"}')
    entries = parsing.equation_entries(df)
    got = entries.select("id", "pos", F.col("fields")["equation"].alias("equation"))
    n = len(bad)
    assert rows(got, "id", "pos", "equation") == [(n + 2, 0, "E"), (n + 3, 0, "single")]
    rejects = dict.fromkeys(range(n), None)
    found = rows(parsing.equation_rejects(df), "id", "pos", "reason")
    for i, _, reason in found:
        rejects[i] = reason
    assert [rejects[i] for i in range(n)] == [
        "invalid_json", "no_entries", "no_entries", "no_entries", *["invalid_json"] * 6,
    ]
    assert [(p, r) for i, p, r in found if i == n + 2] == [(1, "not_an_object"), (2, "not_an_object"), (3, "not_an_object")]


def test_fences_are_opt_in(completions):
    df = completions('```json\n{"equation":"E"}\n```', "plain ``` text")
    assert parsing.equation_entries(df).count() == 0
    assert parsing.equation_entries(parsing.strip_fences(df)).count() == 1


def test_equation_json_docs(completions):
    df = completions('[ {"equation": "E"} ]', "[]", "{}", "null", "0", "bad", '"s"', '{"a": "é"}')
    got = parsing.equation_json_docs(df).orderBy("id").collect()
    assert [(r.id, json.loads(r.json)) for r in got] == [(0, [{"equation": "E"}]), (7, {"a": "é"})]


FULL = {
    "equation": "E = mc^2", "description": "Mass-energy equivalence",
    "symbols": {"E": {"description": "Energy", "unit": "J"}, "c": {"description": "Speed of light", "unit": "m s^{-1}"}},
    "conditions": ["Rest frame"], "source": "Einstein 1905",
}


@pytest.fixture
def typed(spark):
    def make(*entries):
        df = spark.createDataFrame([(i, json.dumps(e, ensure_ascii=False)) for i, e in enumerate(entries)], "id int, completion string")
        return equations.typed_entries(parsing.equation_entries(df))

    return make


def test_pretraining_text(typed):
    df = equations.equation_pretraining(typed(
        FULL, {"equation": "x"},
        {"equation": "y", "symbols": {"a": {"unit": "kg"}, "b": "text", "c": {"description": "C", "unit": "Dimensionless"}}},
        {"equation": "z", "conditions": ["One", "Two"], "source": "Unknown Source"},
        {"equation": "w", "conditions": "Alone", "symbols": {}, "source": ""},
    ))
    assert rows(df, "text") == [(t,) for t in [
        "The equation $E = mc^2$ represents mass-energy equivalence In this equation, $E$ is the energy (in J),\n and $c$ is "
        "the speed of light (in m s⁻¹). This equation is applicable under the following conditions: rest frame. This "
        "relationship is documented in Einstein 1905.",
        "The equation $x$ represents no description available. ",
        "The equation $y$ represents no description available. In this equation, $a$ is the no description available. (in kg),\n "
        "$b$ is the no description available.,\n and $c$ is the c. ",
        "The equation $z$ represents no description available. This equation is applicable under the following conditions: "
        "one,\n two. ",
        "The equation $w$ represents no description available. This equation is applicable under the following conditions: "
        "alone. This relationship is documented in .",
    ]]


def test_finetuning_pair(typed):
    df = equations.equation_finetuning(typed(FULL, {"equation": "x"}, {"equation": "y", "symbols": {"b": "text"}}))
    assert rows(df, "id", "question", "answer") == [
        (0, "What does the equation $E = mc^2$ represent?",
         "Mass-energy equivalence The symbols in this equation represent:\n• $E$: Energy (units: J)\n• $c$: Speed of light "
         "(units: m s⁻¹)\n\nThis equation is typically used under these conditions: rest frame."),
        (1, "What does the equation $x$ represent?", "No description available. "),
    ]


def test_instruction_pair(typed):
    df = equations.equation_instruction(typed({"description": "D"}, {"equation": " x "}, {"equation": "", "description": None}))
    ask = "What does the following equation represent?"
    assert rows(df, "input", "response") == [(ask, "D"), (f"{ask}\n\nx", "No explanation provided."), (ask, None)]


def test_symbols_keep_their_order_and_the_last_of_a_repeated_key(spark):
    text = '{"equation":"e","symbols":{"z":{"description":"Z"},"a":{"description":"A1"},"a":{"description":"A2","unit":""}}}'
    df = spark.createDataFrame([(0, text)], "id int, completion string")
    symbols = equations.symbol_info(equations.typed_entries(parsing.equation_entries(df)))
    assert [tuple(r)[2:] for r in symbols.orderBy("symbol_pos").collect()] == [
        (0, "z", "Z", "dimensionless"), (1, "a", "A2", "dimensionless"),
    ]


def test_unrenderable_entries_go_to_quarantine_and_the_rest_continue(typed):
    entries = typed(
        {"description": "no equation"}, {"equation": "a", "description": None}, {"equation": "b", "symbols": ["s"]},
        {"equation": "c", "symbols": {"s": {"description": None}}}, {"equation": "d", "symbols": {"s": 3}},
        {"equation": "e", "conditions": ["x", None]}, FULL,
    )
    got = equations.render_rejects(entries).orderBy("id").collect()
    assert [(r.id, r.pretraining_reason, r.finetuning_reason) for r in got] == [
        (0, "missing_equation", "missing_equation"), (1, "null_description", "null_description"),
        (2, "symbols_not_object", "symbols_not_object"), (3, "null_symbol_description", "null_symbol_description"),
        (4, None, "symbol_not_object"), (5, "null_condition", "null_condition"),
    ]
    counts = {r.dataset: r["count"] for r in equations.equation_datasets(entries).groupBy("dataset").count().collect()}
    assert counts == {"pretraining": 2, "finetuning": 1, "conversation": 7}
    assert "conversation" not in [r.dataset for r in equations.equation_datasets(entries, False).collect()]


def test_instruction_json_keeps_null(typed):
    made = equations.equation_datasets(typed({"equation": "x", "description": None})).collect()
    assert [json.loads(r.json) for r in made] == [
        {"input": "What does the following equation represent?\n\nx", "response": None}]
