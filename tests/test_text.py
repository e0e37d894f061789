"""Text helpers against plain restatements of their rules."""

import random

import pytest
from pyspark.sql import functions as F

from grovekit.fixed import DROP_MARKERS, LANGUAGES
from grovekit.functions import nodes as N, text as T
from grovekit.functions.names import extract_name
from grovekit.operators import filters as OF


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, code string")
    return [r[1] for r in sorted(df.select("i", expression.alias("x")).collect())]


def walked_metrics(code):
    """The list walk: it changes the list it walks over."""
    rest = code.strip().split("\n")
    at = 0
    while at < len(rest):
        current = rest[at]
        if not current:
            del rest[at]
        elif current[-1] == "\\":
            rest[at] = current[:-1] + current
            del rest[at - 1]
        at += 1
    if not rest:
        return 0.0, 0
    total, n = sum(map(len, rest)), len(rest)
    return (200 * total + n) // (2 * n) / 100, n


def test_clean_metrics(spark):
    rng = random.Random(7)
    texts = ["", " ", "\n\n", "a", "a\\", "a\\\nb", "a\\\n\\\nb\\", "\\", "\\\n\\\n\\", "x\n\n\\\n\ny", " a \x1f"]
    texts += ["".join(rng.choice(["a", "é ", "\n", "\n", "\\\n", "\\"]) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    found = column(spark, texts, T.clean_metrics("code"))
    assert [(r.avg_line_length, r.line_count) for r in found] == [walked_metrics(t) for t in texts]


def test_clean_metrics_corrected(spark):
    texts = ["a\n\n\n\nbb", "a\\\nb\n\nccc", ""]
    found = column(spark, texts, T.clean_metrics("code", "corrected"))
    assert [tuple(r) for r in found] == [(1.5, 2), (2.5, 2), (0.0, 0)]
    with pytest.raises(ValueError):
        T.clean_metrics("code", "other")


def test_raw_metrics(spark):
    texts = ["", "a", "a\n", "\n\n", "éé\nb"]
    assert column(spark, texts, T.line_count_raw("code")) == [t.count("\n") + 1 for t in texts]
    assert column(spark, texts, T.avg_line_length_raw("code")) == [
        sum(map(len, t.split("\n"))) / len(t.split("\n")) for t in texts]
    assert column(spark, texts, T.line_offsets("code")) == [
        [0] + [i + 1 for i, c in enumerate(t) if c == "\n"] for t in texts]


def test_cleaning(spark):
    assert column(spark, ["a<filename>\nb\n", None, "<gh_stars>"], T.drop_lines_containing("code", ["<gh_stars>", "<filename>"])) == ["b\n", None, ""]
    assert column(spark, ["a.*b", None], T.replace_literal("code", ".*")) == ["ab", None]
    assert column(spark, ["x"], T.replace_literal("code", "")) == ["x"]
    df = spark.createDataFrame([(1, "a<jupyter_code>"), (2, None), (3, "b<|endoftext|>\n<reponame>z")], "id int, code string")
    assert {r.id: r.code for r in OF.clean_samples(df).collect()} == {2: None, 3: "b"}
    assert OF.contains_any_count(df, "code", DROP_MARKERS).first()[0] == 1
    assert OF.contains_any_count(df, "absent", DROP_MARKERS).first()[0] == 0
    assert OF.contains_any_count(df, "code", []).first()[0] == 0
    assert OF.drop_rows_containing(df, "code", []).count() == 3


def test_normalize_text(spark):
    assert column(spark, ["﻿a\x07 \t\n\n\n\nb"], T.normalize_text("code")) == ["a\n\nb"]


def test_select_languages(spark):
    df = spark.createDataFrame([(x,) for x in LANGUAGES], "language string")
    assert [r[0] for r in OF.select_languages(df, 5).collect()] == ["scala", "typescript"]
    assert OF.select_languages(df).count() == 10
    with pytest.raises(ValueError):
        OF.select_languages(df, 6)


NAMES = [
    ("python", "def main():\n  pass", "main"), ("python", "class A(B):\n", "A(B)"), ("python", "x = 1", "unknown"),
    ("python", "a def f(x) def g(y)", "f"), ("python", "", "unknown"), ("python", None, "unknown"),
    ("c", "int main(void) {", "main"), ("c", "struct S { int x; }", "S"), ("cpp", "a struct", "unknown"),
    ("java", "public void run() {", "run"), ("java", "interface I", "I"), ("c_sharp", "bool  ok(int a)", "ok"),
    ("c", "unsigned f()", "unknown"), ("java", "void class", "class"),
    ("javascript", "async function f (a) {}", "f"), ("javascript", "class A extends B {", "A"),
    ("typescript", "const g = (x) => x", "g"), ("javascript", " = (x) => x", None), ("javascript", "let h = function() {", "h"),
    ("typescript", "let y = 1", "unknown"), ("javascript", "x => x", "x"),
    ("go", "func Add(a int) int", "Add"), ("go", "func (r *R) Run(x int)", "Run"), ("go", "func (r", None),
    ("go", "type T struct {", "T"), ("go", "type I interface {", "I"), ("go", "var x", "unknown"),
    ("ruby", "def go(a)\n", "go"), ("ruby", "def go\n  x", "go"), ("ruby", "def go", "go"),
    ("ruby", "class A < B\n", "A"), ("ruby", "module M\n", "M"), ("ruby", "def a b (c", "a b"),
    ("scala", "def f[T](x: T)", "f"), ("scala", "def f(x: Int)", "f"), ("scala", "def f: Int = 1", "f"),
    ("scala", "class A(x: Int) extends B", "A"), ("scala", "object O extends App {", "O"), ("scala", "trait T[A] extends B", "T"),
    ("scala", "class A", "A"), ("pascal", "def f()", "unknown"),
]


def test_extract_name(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(NAMES)], "i int, language string, t string")
    found = df.select("i", extract_name("t", "language").alias("name")).orderBy("i").collect()
    assert [r.name for r in found] == [c for _, _, c in NAMES]


def test_json(spark):
    docs = ['{"k": 1}', "{'k': 2}", "{", None, '{"a":[{"type":"x\\"y"},{"b":{"type":"z"}}],"t":"\\"type\\": \\"no\\""}']
    parsed = column(spark, docs, F.try_variant_get(N.safe_parse_json("code"), "$.k", "int"))
    assert parsed == [1, 2, None, None, None]
    assert column(spark, docs, N.collect_types("code")) == [[], [], None, None, ['x"y', "z"]]
    assert column(spark, docs, N.unparsed("code")) == [False, False, True, False, False]
    deep = '{"type":' * 60 + '"x"' + "}" * 60
    odd = [deep, '{"t\\u0079pe": "a", "b": {"type" : "c\\\\"}}', "[]", "3", '{"type": 3}', "{'type': 'it', \"b\": [{'type': 'b'}]}", '{"type":"x"']
    assert column(spark, odd, N.collect_types("code")) == [["x"], ["c\\", "a"], [], [], [], ["b", "it"], None]
    shaped = ['{"ast":{"nodes":[]},"type":"r"}', '{"ast":{},"type":"r"}', '[{"type":"a"},{"type":"b"}]',
              '{"ast":{"nodes":[{"type":"a"},{"x":{"type":"b"}}]}}']
    assert column(spark, shaped, N.node_types("code")) == [[], ["r"], ["a"], ["a", "b"]]


def test_line_offsets_of_long_texts(spark):
    texts = ["", "a", "\n", "é\n\nb", "\n".join("x" * (i % 5) for i in range(1000)), "\n" * 255, "\n" * 256, "\n" * 257, None]
    found = column(spark, texts, T.line_offsets("code"))
    for text, offsets in zip(texts, found):
        expected = None if text is None else [0, *[i + 1 for i, c in enumerate(text) if c == "\n"]]
        assert offsets == expected


def test_rows_without_a_metric_stay_until_the_caps(spark):
    lengths = [1.0, 2.0, 3.0, 4.0, 100.0, None, float("nan")]
    df = spark.createDataFrame([(i, "c", i + 1, v) for i, v in enumerate(lengths)] + [(9, "go", 1, None)],
                               "id int, language string, line_count int, avg_line_length double")
    assert {r.id for r in OF.iqr_filter(df, ["language"], "avg_line_length").collect()} == {0, 1, 2, 3, 5, 6, 9}
    in_turn = OF.percentile_cap(OF.iqr_filter(df, ["language"], "avg_line_length"), ["language"])
    assert {r.id for r in OF.statistical_filter(df, ["language"]).collect()} == {r.id for r in in_turn.collect()}
