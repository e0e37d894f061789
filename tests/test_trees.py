"""Tree operators against recursive walks on random trees."""

import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from grovekit.operators import records as OR, trees as OT
from grovekit.functions.nodes import category, graph_label, node_types

TYPES = ["block", "identifier", "call", "if_statement", "string", "import_statement", "class_declaration",
         "variable_declarator", "variable_declaration", "type_spec", "type_declaration", "function_definition"]
TEXTS = ["x", "(", " end ", '"""doc"""', "foo(1)", "def f(a):", "", "class A { }"]


def random_tree(rng, record):
    rows, depth = [], 0
    for seq in range(rng.randint(1, 60)):
        depth = 0 if seq == 0 else rng.randint(1, depth + 1)
        rows.append((record, seq, depth, rng.choice(TYPES) if seq else "program", rng.choice(TEXTS)))
    return rows


def skipped(kind, text, parent):
    plain = text.strip()
    return (plain in ("(", "end") or kind in ("block", "program")
            or kind == "string" and plain.startswith('"""')
            or kind == "variable_declarator" and parent == "variable_declaration" and plain != ""
            or kind == "type_spec" and parent == "type_declaration" and plain != "")


def walk(rows):
    """(seq -> id, parent, direct) of kept nodes, with an explicit stack."""
    path, out, next_id = [], {}, 0
    for _, seq, depth, kind, text in rows:
        del path[depth:]
        parent = path[-1] if path else None
        keep = not skipped(kind, text, parent[1] if parent else None)
        held = [p for p in path if p[2] is not None]
        node_id = None
        if keep:
            node_id, next_id = next_id, next_id + 1
            up = held[-1] if held else None
            out[seq] = (node_id, up[2] if up else None, up is not None and up[0] == parent[0])
        path.append((seq, kind, node_id))
    return out


@pytest.fixture(scope="module")
def trees(spark):
    rng = random.Random(11)
    rows = [r for record in range(150) for r in random_tree(rng, record)]
    df = spark.createDataFrame(rows, "record int, seq int, depth int, type string, text string")
    point = F.struct(F.lit(0).alias("row"), F.col("seq").alias("column"))
    return rows, df.withColumns({"start_point": point, "end_point": point}).repartition(4).cache()


def expected(rows):
    by_record = {}
    for r in rows:
        by_record.setdefault(r[0], []).append(r)
    return {k: walk(v) for k, v in by_record.items()}


def test_prune(trees):
    rows, df = trees
    want = {(k, s): v for k, tree in expected(rows).items() for s, v in tree.items()}
    pruned = OT.prune(df, "record").where("keep")
    assert {(r.record, r.seq): (r.id, r.parent, r.direct) for r in pruned.collect()} == want
    children = {}
    for (record, _), (node, parent, direct) in want.items():
        if direct:
            children.setdefault((record, parent), []).append(node)
    found = OT.children_ids(pruned, "record").collect()
    assert {(r.record, r.id): r.children for r in found} == {k: sorted(v) for k, v in children.items()}


def test_records(trees, spark):
    rows, df = trees
    want = expected(rows)
    samples = spark.range(152).select(
        F.col("id").cast("int").alias("record"), F.lit("python").alias("language"), F.lit("code").alias("code"),
        F.lit(None).cast("int").alias("line_count"), F.lit(2.5).alias("avg_line_length"))
    records = OR.universal_records(samples, df, "record")
    found = {r.record: r.universal for r in records.collect()}
    assert found[150] is None and found[151] is None
    for record, tree in want.items():
        got = found[record]
        assert got.ast.root == "program" and got.metadata.nodes == len(tree) and got.metadata.lines == 0
        ids = {v[0]: v for v in tree.values()}
        assert [n.id for n in got.ast.nodes] == list(range(len(tree)))
        for n in got.ast.nodes:
            assert n.parent == ids[n.id][1]
            assert n.children == sorted(i for i, (_, p, direct) in ids.items() if direct and p == n.id)
        calls = [n.id for n in got.ast.nodes if n.type == "call"]
        assert got.node_categories.expressions.calls == calls
        functions = got.cross_language_map.function_declarations
        texts = {n.id: n.text for n in got.ast.nodes if n.type == "function_definition" and n.text}
        assert {f.node_id: f.text_snippet for f in functions} == texts
    json = records.where("record < 150").select("record", OR.to_record_json("universal").alias("json"))
    back = OR.read_record(json, "record", "json")
    assert back.count() == sum(map(len, want.values()))
    clean = OR.record_violations(json, "record", "json").where(F.size("violations") > 0)
    # Lists name direct children only, so no rule is broken by lifted nodes.
    assert clean.count() == 0


def test_dump_round_trip(trees):
    rows, df = trees
    plain = df.select("record", "seq", "depth", "type", "text").where(F.col("type") != "")
    back = OT.read_dump(OT.write_dump(plain, "record", "dump"), "record", "dump")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in plain.collect()}


def test_dump_with_delimiter_types(spark):
    df = spark.createDataFrame([(1, '(program) "f(a)"\n  (() "("\n  ()) ")"\n  (string) "a\\nb"')], "record int, dump string")
    found = OT.read_dump(df, "record", "dump").orderBy("seq").collect()
    assert [(r.depth, r.type, r.text) for r in found] == [
        (0, "program", "f(a)"), (1, "(", "("), (1, ")", ")"), (1, "string", "a\nb")]


def test_text_nodes(spark):
    texts = {1: "ab  c\n\né 1.", 2: "", 3: "x\n"}
    df = spark.createDataFrame(list(texts.items()), "record int, code string")
    nodes = OT.text_nodes(df, "record", "code").collect()
    for record, text in texts.items():
        mine = sorted((n for n in nodes if n.record == record), key=lambda n: n.seq)
        assert [n.seq for n in mine] == list(range(len(mine)))
        assert [n.text for n in mine if n.depth == 1] == text.split("\n")
        assert [n.text for n in mine if n.depth == 2] == [t for line in text.split("\n") for t in line.split(" ") if t]
        for n in mine:
            assert text[n.start:n.end] == n.text
            assert text.encode()[n.start_byte:n.end_byte].decode() == n.text
            line = text.split("\n")[n.start_point.row].encode()
            assert line[n.start_point.column:][:1] == n.text.split("\n")[0].encode()[:1]
    counts = {r.record: r.n for r in df.select("record", OT.text_node_count("code").alias("n")).collect()}
    assert counts == {r: sum(n.record == r for n in nodes) for r in texts}


def test_node_text(spark):
    code = "é" * 300 + "abc" * 200 + "﻿z"
    df = spark.createDataFrame([(1, code)], "record int, code string")
    spans = [(0, 2), (10, 700), (255, 258), (598, 1200), (1198, 1204), (5000, 5003), (4, 4)]
    nodes = spark.createDataFrame([(1, i, a, b, "") for i, (a, b) in enumerate(spans)],
                                  "record int, seq int, start_byte int, end_byte int, text string")
    shifted = OT.node_text(nodes, df, "record").orderBy("seq").collect()
    assert [r.text for r in shifted] == [code[a:b] for a, b in spans]
    exact = OT.node_text(nodes, df, "record", mode="corrected").orderBy("seq").collect()
    for r, (a, b) in zip(exact, spans):
        if not (a, b) == (255, 258):  # cuts a character in two
            assert r.text == code.encode()[a:b].decode()


def test_tag_nodes(spark):
    df = spark.createDataFrame([(1, "<html><P>x<br>y</P><ul><li>a</li><li/></ul></html>")], "record int, html string")
    found = OT.tag_nodes(df, "record", "html").orderBy("seq").collect()
    assert [(n.type, n.depth) for n in found] == [("html", 0), ("p", 1), ("br", 2), ("ul", 1), ("li", 2), ("li", 2)]


# Node types of a published sample tree and the categories they fall into.
SAMPLE_TYPES = """function_definition identifier parameters assignment identifier = integer if_statement
comparison_operator identifier >= integer call identifier argument_list string else_clause call identifier
argument_list string call identifier argument_list""".split()
SAMPLE_CATEGORIES = {
    "statements.conditionals": 7, "expressions.literals": 4, "expressions.calls": 3, "declarations.functions": 1,
    "statements.assignments": 1, "expressions.binary_operations": 1, None: 7,
}


def test_categories(spark):
    df = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "type string")
    found = df.groupBy(category("type").alias("c")).count().collect()
    assert {r.c: r["count"] for r in found} == SAMPLE_CATEGORIES
    words = ["identifier", "for_statement", "method_invocation", "namespace_identifier", "argument_list", "Struct"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "i int, type string")
    ref = [r.c for r in df.orderBy("i").select(category("type").alias("c")).collect()]
    assert ref == ["statements.conditionals", "statements.loops", "declarations.functions", "declarations.modules", None, "declarations.classes"]
    fixed = [r.c for r in df.orderBy("i").select(category("type", "corrected").alias("c")).collect()]
    assert fixed[0] == "expressions.identifiers"


def test_graph_label(spark):
    df = spark.createDataFrame([("t", "a" * 30), ("t", "a" * 31)], "type string, text string")
    assert sorted(r[0] for r in df.select(graph_label("type", "text")).collect()) == sorted(
        ["t\n" + "a" * 30, "t\n(" + "a" * 30 + "...)"])


def test_partitions_follow_the_text(spark):
    # Six megabytes: adaptive execution must not gather them in one task before the rows multiply.
    line = "word " * 400 + "\n"
    df = spark.range(300).select("id", F.repeat(F.lit(line), 10).alias("code"))
    nodes = OT.text_nodes(df, "id", "code")
    assert nodes.select(F.spark_partition_id().alias("p")).distinct().count() >= 3
    assert nodes.count() == 300 * (1 + 11 + 10 * 400)
    assert OT.place_by_record(df.limit(0), "id", "code").count() == 0


def test_trees_return_every_node(spark, tmp_path):
    from grovekit.catalog import all_queries

    rows = [(1, "a b.\nC 7", "en", "s"), (2, "x", "de", "s"), (None, "y z", "fr", "t"), (4, None, "en", "t")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {name: all_queries()[name](spark, str(tmp_path)) for name in ("pruned_tree", "read_record", "graph_nodes")}
    assert [list(df.columns) for df in found.values()] == [
        ["doc_id", "seq", "id", "parent", "type", "text"],
        ["doc_id", "id", "type", "digest", "parent", "start_row", "start_column"],
        ["doc_id", "id", "label", "color", "shape"]]
    counts = {name: df.where("doc_id = 1").count() for name, df in found.items()}
    assert counts["pruned_tree"] > 1 and len(set(counts.values())) == 1


def test_category_lowers_a_type_once(spark):
    df = spark.createDataFrame([("If_Statement",)], "type string")
    for mode in ("reference", "corrected"):
        found = df.select(category("type", mode).alias("c"))
        assert found.first().c == "statements.conditionals"
        assert found._jdf.queryExecution().optimizedPlan().toString().count("lower(") <= 1


def test_only_inner_nodes_are_looked_at_as_parents(spark):
    df = spark.createDataFrame([(1, "a b\n\nc"), (2, ""), (3, " ")], "record int, code string")
    nodes = OT.text_nodes(df, "record", "code")
    rows = sorted(nodes.collect(), key=lambda n: (n.record, n.seq))
    follows = [b.record == a.record and b.depth > a.depth for a, b in zip(rows, rows[1:])] + [False]
    assert [n.has_children for n in rows] == follows
    bare = nodes.drop("has_children", "parent_seq", "parent_type")
    known = nodes.drop("parent_seq", "parent_type")
    for found in (OT.with_parent(known, "record"), OT.with_parent(bare, "record")):
        got = {(n.record, n.seq): (n.parent_seq, n.parent_type) for n in found.collect()}
        assert got == {(n.record, n.seq): (n.parent_seq, n.parent_type) for n in rows}
    both = [{(n.record, n.seq, n.keep, n.id, n.parent, n.direct) for n in OT.prune(x, "record").collect()} for x in (known, bare)]
    assert both[0] == both[1]


def test_a_task_holds_one_megabyte_of_text(spark):
    df = spark.range(400).select("id", F.repeat(F.lit("word "), 2000).alias("code"))
    assert OT.text_nodes(df, "id", "code").rdd.getNumPartitions() == 4


def test_read_dumps_stay_where_they_are(spark, tmp_path):
    from grovekit.catalog import all_queries

    texts = {i: " ".join(f"w{(i * 7 + k * k) % 90}" for k in range(60)) + f"\nx {i}" for i in range(300)} | {900: "", 901: "a  b\n\n"}
    rows = [(k, t, "en", "s") for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = all_queries()["read_dump"](spark, str(tmp_path))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    want = set()
    for k, t in texts.items():
        nodes = [(0, t)] + [n for line in t.split("\n") for n in [(1, line), *((2, x) for x in line.split(" ") if x)]]
        want |= {(k, seq, depth, sha256(x.encode()).hexdigest()) for seq, (depth, x) in enumerate(nodes)}
    got = found.withColumn("p", F.spark_partition_id()).collect()
    assert {(r.doc_id, r.seq, r.depth, r.digest) for r in got} == want and len(got) == len(want)
    by_task = {}
    for r in got:
        by_task.setdefault(r.p, []).append(r.digest)
    for digests in by_task.values():
        assert sum(a != b for a, b in zip(digests, [None] + digests)) == len(set(digests))


def test_dump_parent_needs_one_exchange(spark):
    df = spark.createDataFrame([(i, '(a) "x"\n  (b) "y"\n    (c) "z"\n  (d) "y"') for i in range(20)] + [(99, None)], "record int, dump string")
    placed, loose = (OT.read_dump(df, "record", "dump", place=p) for p in (True, False))
    assert {tuple(r) for r in placed.collect()} == {tuple(r) for r in loose.collect()} and loose.count() == 80
    parents = OT.with_parent(placed, "record")
    assert parents._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.seq, r.parent_seq) for r in parents.collect()} == {(0, None), (1, 0), (2, 1), (3, 0)}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_category_is_searched_outside_of_lambdas(spark):
    df = spark.createDataFrame([("If_Statement",), ("block",), (None,)], "type string")
    for mode in ("reference", "corrected"):
        found = OR.with_category(df, mode)
        assert [r.category for r in found.collect()] == ["statements.conditionals", None, None] and found.columns == ["type", "category"]
        assert "lambda" not in optimized(found) and optimized(found).count("lower(") == 1


def test_records_are_parsed_once(spark):
    rows = [(1, '{"ast":{"nodes":[{"id":0,"type":"a"},null,{"id":2,"type":"b"}]}}'), (2, '{"ast":{"nodes":[]}}'), (3, "{"), (4, None), (5, '{"ast":5}')]
    df = spark.createDataFrame(rows, "record int, json string")
    found = OR.read_record(df, "record", "json")
    assert [(r.record, r.id, r.type) for r in found.collect()] == [(1, 0, "a"), (1, None, None), (1, 2, "b")]
    assert optimized(found).count("from_json(") == 1


def test_violations_of_odd_values(spark):
    good = '"language":"go","success":true,"metadata":{"lines":1,"avg_line_length":2.5,"nodes":1,"errors":0}'

    def tree(nodes):
        return "{" + good + ',"ast":{"root":"r","nodes":' + nodes + "}}"

    want = {
        tree('[{"id":0,"type":"a","text":"","children":[]}]'): [], tree("[]"): [], tree("5"): ["ast.nodes wrong type"],
        tree("null"): ["ast.nodes wrong type"], tree('{"0":1}'): ["ast.nodes wrong type"],
        tree('[{"id":0.5,"type":"a","text":""}]'): ["node fields"], tree('[{"id":0,"text":""}]'): ["node fields"],
        tree('[{"id":0,"type":null,"text":""}]'): ["node fields"],
        "{" + good + "}": ["ast missing", "ast.root missing", "ast.nodes missing"],
        "{" + good + ',"ast":[1]}': ["ast wrong type", "ast.root missing", "ast.nodes missing"],
        "{" + good + ',"ast":null}': ["ast wrong type", "ast.root missing", "ast.nodes missing"],
        tree("[]").replace('"metadata":{', '"metadata":3,"x":{'): ["metadata wrong type", *[f"metadata.{n} missing" for n in ("lines", "avg_line_length", "nodes", "errors")]],
        tree("[]").replace('"lines":1', '"lines":{"a":1}').replace("2.5", "true"): ["metadata.lines wrong type", "metadata.avg_line_length wrong type"],
        "7": ["language missing", "success missing", "metadata missing", "ast missing", *[f"metadata.{n} missing" for n in ("lines", "avg_line_length", "nodes", "errors")], "ast.root missing", "ast.nodes missing"],
    }
    df = spark.createDataFrame([(i, json) for i, json in enumerate(want)], "record int, json string")
    checked = OR.record_violations(df, "record", "json")
    found = {r.record: r.violations for r in checked.collect()}
    assert [found[i] for i in range(len(want))] == list(want.values())
    # The type of the whole tree, which is put together from those of all its nodes, is not asked for.
    assert "schemaOfVariant(try_variant_get" in optimized(checked)
    assert not re.search(r"schemaOfVariant\((try_variant_get\()+_value#\d+, \$\.ast(\.nodes)?,", optimized(checked))


def test_types_of_plain_and_odd_nodes(spark):
    want = {
        '{"ast":{"nodes":[{"type":"a","x":{"type":"y"}},{"type":"b\\"c"}]}}': ["a", 'b"c'], '{"ast":{"nodes":[]}}': [],
        '{"ast":{"nodes":[{"type":1.50},{"type":"b"}]}}': ["1.5", "b"], '{"ast":{"nodes":[{"x":{"type":"deep"}},{"type":"b"}]}}': ["deep", "b"],
        '{"ast":{"nodes":[{"type":null},{"type":"b"}]}}': ["b"], '{"ast":{"nodes":[5,{"type":"b"}]}}': ["b"],
        '[{"ast":{"nodes":[{"type":"first"}]}},{"type":"second"}]': ["first"], '{"ast":{"nodes":7},"type":"top"}': ["top"],
        "{'ast':{'nodes':[{'type':'quoted'}]}}": ["quoted"], "{": None,
    }
    df = spark.createDataFrame([(i, json) for i, json in enumerate(want)], "record int, json string")
    types = node_types("json")
    found = {r.record: r.types for r in df.select("record", types.alias("types")).collect()}
    assert [found[i] for i in range(len(want))] == list(want.values())
    # Records of the usual kind are not written as text and parsed again.
    assert "ArrayType(StructType(StructField(type,VariantType" in optimized(df.select(types))
