"""Records: assembling, reading and checking one nested value per sample."""

from functools import reduce

from pyspark.sql import functions as F

from grovekit.fixed import (
    CATEGORY_FIELDS, DECLARED_LANGUAGES, LANGUAGES, RECORD_SCHEMA, RECORD_TYPE,
)
from grovekit.functions.names import extract_name
from grovekit.functions.nodes import category_in, graph_colour, graph_label, searched_type, snippet
from grovekit.functions.schema import violations
from grovekit.functions.text import (
    double_or_zero, int_or_zero, invalid_reason, let, normalize_language, source_hash,
)
from grovekit.operators.trees import prune


def with_category(nodes, mode="reference"):
    """Add ``category`` as ``group.name``; null for none."""
    # In a step of its own the text searched is made once per node, and the search is compiled; inside a lambda it is not.
    searched = nodes.withColumn("_searched", searched_type("type", mode))
    return searched.withColumn("category", category_in("_searched", mode)).drop("_searched")


def category_counts(nodes, by):
    """Categorized nodes per key and category; needs ``category``."""
    return (
        nodes.where(F.col("category").isNotNull())
        .groupBy(*by, "category").agg(F.count(F.lit(1)).alias("nodes"))
    )


def categorized_count(nodes, record):
    """Categorized nodes per record."""
    return nodes.groupBy(record).agg(F.count("category").cast("int").alias("categorized_nodes"))


def _index_of(nodes):
    """Category struct from an array of nodes in id order."""
    held = F.filter(nodes, lambda n: n["category"].isNotNull())
    return let(
        F.transform(held, lambda n: F.struct(n["category"].alias("category"), n["id"].alias("id"))),
        lambda entries: F.struct(*[
            F.struct(*[_ids(entries, f"{group}.{name}").alias(name) for name in names]).alias(group)
            for group, names in CATEGORY_FIELDS.items()
        ]),
    )


def _ids(entries, wanted):
    return F.transform(F.filter(entries, lambda e: e["category"] == wanted), lambda e: e["id"])


def category_index(nodes, record):
    """One struct of id lists per record, empty lists included; needs ``id`` and ``category``."""
    entries = F.sort_array(F.collect_list(F.struct("id", "category")))
    return nodes.groupBy(record).agg(entries.alias("_entries")).select(
        record, _index_of(F.col("_entries")).alias("node_categories")
    )


_DECLARED = ("declarations.functions", "declarations.classes")
_MAPPED = {
    "declarations.functions": ("function_declarations", "function"),
    "declarations.classes": ("class_declarations", "class"),
    "declarations.imports": ("import_statements", None),
}


def cross_language_entries(nodes, record):
    """Functions, classes and imports in long form; needs ``id``, ``category``, ``language``.

    Entries of nodes without text, or whose name cannot be cut out, are left out.
    """
    wanted = nodes.where(F.col("category").isin(*_MAPPED) & (F.col("text") != ""))
    is_import = F.col("category") == "declarations.imports"
    kind = F.when(is_import, "import_statements")
    universal = F.lit(None).cast("string")
    for name, (listed, label) in _MAPPED.items():
        if label:
            kind = kind.when(F.col("category") == name, listed)
            universal = F.when(F.col("category") == name, label).otherwise(universal)
    return wanted.select(
        record, kind.alias("kind"), F.col("id").alias("node_id"), universal.alias("universal_type"),
        F.when(~is_import, extract_name("text", "language")).alias("name"),
        F.when(is_import, F.col("text")).otherwise(snippet("text")).alias("text"),
    ).where(is_import_kind() | F.col("name").isNotNull())


def is_import_kind():
    return F.col("kind") == "import_statements"


def universal_records(samples, nodes, record, languages=LANGUAGES):
    """Samples with ``universal``, their record; null for unusable rows and without a tree.

    ``samples`` has ``record, language, code, line_count, avg_line_length``; ``nodes`` is
    the raw node table of the samples with points. Nodes are grouped once per record;
    child lists, categories, map and counts are read off the grouped arrays.
    """
    pruned = with_category(prune(nodes, record))
    entry = F.when(F.col("keep"), F.struct(
        "id", "type", "text", "parent", "start_point", "end_point", "category",
    ))
    link = F.when(F.col("direct"), F.struct("parent", "id"))
    trees = pruned.groupBy(record).agg(
        F.max(F.when(F.col("seq") == 0, F.col("type"))).alias("_root"),
        F.sort_array(F.collect_list(entry)).alias("_nodes"),
        F.collect_list(link).alias("_links"),
    ).withColumn("_children", _child_lists(F.size("_nodes"), F.col("_links"))).drop("_links")
    usable = F.col("_root").isNotNull() & invalid_reason("language", "code", languages).isNull()
    joined = samples.join(trees, record, "left").withColumn("_language", normalize_language("language"))
    return joined.select(*samples.columns, F.when(usable, _record()).alias("universal"))


def _child_lists(count, links):
    """Children per node id as comma-separated text, from (parent, id) pairs.

    Every node gets a marker that sorts before its children; the sorted ids are written
    in a row and split at the markers, which takes one pass however many nodes there are.
    """
    marker = F.lit(-1)
    marks = F.when(count > 0, F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("parent"), marker.alias("id"))
    )).otherwise(F.array().cast("array<struct<parent:int,id:int>>"))
    row = F.transform(
        F.sort_array(F.concat(marks, links)),
        lambda pair: F.when(pair["id"] == marker, ";").otherwise(
            F.concat(pair["id"].cast("string"), F.lit(","))),
    )
    return F.split(F.array_join(row, ""), ";", -1)


def _record():
    nodes = F.col("_nodes")

    def children(i):
        # Most nodes have none, and their text is not trimmed and split.
        listed = F.get(F.col("_children"), i + 1)
        return F.when(listed == "", F.array().cast("array<int>")).otherwise(
            F.split(F.rtrim(listed, F.lit(",")), ",").cast("array<int>"))

    held = F.filter(nodes, lambda n: n["category"].isin(*_DECLARED) & (n["text"] != ""))
    named = F.filter(
        F.transform(held, lambda n: F.struct(
            n["category"].alias("category"), n["id"].alias("node_id"), n["text"].alias("text"),
            extract_name(n["text"], "_language").alias("name"),
        )),
        lambda e: e["name"].isNotNull(),
    )

    def declared(entries, wanted, label):
        return F.transform(F.filter(entries, lambda e: e["category"] == wanted), lambda e: F.struct(
            e["node_id"].alias("node_id"), F.lit(label).alias("universal_type"),
            e["name"].alias("name"), snippet(e["text"]).alias("text_snippet"),
        ))

    imports = F.filter(
        nodes, lambda n: (n["category"] == "declarations.imports") & (n["text"] != "")
    )
    categorized = F.size(F.filter(nodes, lambda n: n["category"].isNotNull()))
    return F.struct(
        F.col("_language").alias("language"),
        F.lit(True).alias("success"),
        F.struct(
            int_or_zero("line_count").alias("lines"),
            double_or_zero("avg_line_length").alias("avg_line_length"),
            F.size(nodes).alias("nodes"), F.lit(0).alias("errors"),
            source_hash("code").alias("source_hash"), categorized.alias("categorized_nodes"),
        ).alias("metadata"),
        F.struct(
            F.col("_root").alias("root"),
            F.transform(nodes, lambda n, i: F.struct(
                *[n[f].alias(f) for f in ("id", "type", "text", "parent")],
                children(i).alias("children"),
                n["start_point"].alias("start_point"), n["end_point"].alias("end_point"),
            )).alias("nodes"),
        ).alias("ast"),
        _index_of(nodes).alias("node_categories"),
        let(named, lambda entries: F.struct(
            declared(entries, "declarations.functions", "function").alias("function_declarations"),
            declared(entries, "declarations.classes", "class").alias("class_declarations"),
            F.transform(imports, lambda n: F.struct(
                n["id"].alias("node_id"), n["text"].alias("text"),
            )).alias("import_statements"),
        )).alias("cross_language_map"),
        F.col("code").alias("original_source_code"),
    )


def to_record_json(record):
    """Record as JSON with nulls written out, so that roots keep ``parent``."""
    return F.to_json(F.col(record), {"ignoreNullFields": "false"})


def read_record(df, record, json, carry=()):
    """JSON records back to a node table.

    The outer form is exploded: for the other one the JSON is parsed a second time, to leave out records without nodes
    beforehand. Only they have no position.
    """
    parsed = F.from_json(F.col(json), RECORD_TYPE)
    return (
        df.select(record, *carry, parsed.alias("_record"))
        .select(record, *carry, F.posexplode_outer("_record.ast.nodes").alias("_place", "_node"))
        .where(F.col("_place").isNotNull())
        .select(record, *carry, "_node.*")
    )


# Required fields and their types in the declared schema.
REQUIRED_TOP = (
    ("language", ("STRING",)), ("success", ("BOOLEAN",)), ("metadata", ("OBJECT",)), ("ast", ("OBJECT",)),
)
REQUIRED_METADATA = (
    ("lines", ("BIGINT",)), ("avg_line_length", ("BIGINT", "DECIMAL", "DOUBLE")),
    ("nodes", ("BIGINT",)), ("errors", ("BIGINT",)),
)
REQUIRED_AST = (("root", ("STRING",)), ("nodes", ("ARRAY",)))
REQUIRED_NODE = (("id", ("BIGINT",)), ("type", ("STRING",)), ("text", ("STRING",)))


def _kind(value):
    """Leading word of a variant's type; null when the value is absent."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _has_kind(value, at, kinds):
    """Whether the value at a path is of one of the kinds; objects and lists are not gone through for it."""
    tests = [F.try_variant_get(value, at, shape).isNotNull()
             for kind, shape in (("OBJECT", "struct<>"), ("ARRAY", "array<struct<>>")) if kind in kinds]
    plain = [k for k in kinds if k not in ("OBJECT", "ARRAY")]
    if plain:
        tests.append(F.coalesce(_kind(F.try_variant_get(value, at, "variant")).isin(*plain), F.lit(False)))
    return reduce(lambda a, b: a | b, tests)


def _problems(value, path, fields):
    checks = []
    for name, kinds in fields:
        at = f"$.{path}{name}"
        checks.append(F.when(~_has_kind(value, at, kinds), F.when(
            F.try_variant_get(value, at, "variant").isNull(), F.lit(f"{path}{name} missing")
        ).otherwise(F.lit(f"{path}{name} wrong type"))))
    return checks


def record_violations(df, record, json, languages=DECLARED_LANGUAGES):
    """``(record, violations)``: what the declared schema and the tree rules object to.

    Tree rules: ids are dense and ascending, a parent comes before its node, and a listed
    child names the node as its parent.
    """
    value = F.col("_value")
    language = F.try_variant_get(value, "$.language", "string")
    # Of a node only the required fields become variants of their own; what is no object becomes null, so its fields are absent.
    fields = ",".join(f"{name}:variant" for name, _ in REQUIRED_NODE)
    nodes = F.try_variant_get(value, "$.ast.nodes", f"array<struct<{fields}>>")
    tree = F.from_json(F.col(json), "struct<ast:struct<nodes:array<struct<id:int,parent:int,children:array<int>>>>>")
    tree = tree["ast"]["nodes"]

    def bad_node(node):
        found = F.lit(False)
        for name, kinds in REQUIRED_NODE:
            # These kinds are whole names, so no word is cut out.
            found = found | F.coalesce(~F.schema_of_variant(node[name]).isin(*kinds), F.lit(True))
        return found

    checks = [
        *_problems(value, "", REQUIRED_TOP),
        F.when((_kind(F.try_variant_get(value, "$.language", "variant")) == "STRING")
               & ~language.isin(*languages), F.lit("language not declared")),
        *_problems(value, "metadata.", REQUIRED_METADATA),
        *_problems(value, "ast.", REQUIRED_AST),
        F.when(F.exists(nodes, bad_node), F.lit("node fields")),
        F.when(F.exists(F.transform(F.col("_tree"), lambda n, i: n["id"] != i), lambda x: x),
               F.lit("node ids not dense")),
        F.when(F.exists(F.col("_tree"), lambda n: n["parent"] >= n["id"]), F.lit("parent after node")),
        F.when(F.exists(F.col("_tree"), lambda n: F.exists(
            n["children"], lambda c: F.coalesce(F.get(F.col("_tree"), c)["parent"] != n["id"], F.lit(True)))),
            F.lit("child of another parent")),
    ]
    found = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return (
        df.select(record, F.try_parse_json(F.col(json)).alias("_value"), tree.alias("_tree"))
        .select(
            record,
            F.when(value.isNull(), F.array(F.lit("not JSON"))).otherwise(found).alias("violations"),
        )
    )


def schema_violations(df, record, json, schema=RECORD_SCHEMA, carry=()):
    """``(record, path, rule)``: one row per place where a JSON text breaks the schema, none for valid texts."""
    found = df.select(record, *carry, violations(json, schema).alias("_found"))
    # The outer form: for the other one the texts are checked a second time, to leave out those without violations beforehand.
    return found.select(record, *carry, F.inline_outer("_found")).where(F.col("rule").isNotNull())


def violation_report(found):
    """Violations and records per rule and path; positions in lists are written ``[*]``."""
    key = found.columns[0]
    place = F.regexp_replace("path", r"\[\d+\]", "[*]")
    per_record = found.groupBy(key, "rule", place.alias("path")).agg(F.count(F.lit(1)).alias("_n"))
    return per_record.groupBy("rule", "path").agg(F.sum("_n").alias("violations"), F.count(F.lit(1)).alias("records"))


def graph_nodes(nodes, record):
    """Drawable nodes."""
    return nodes.select(
        record, "id", graph_label("type", "text").alias("label"),
        graph_colour("parent").alias("color"), F.lit("box").alias("shape"),
    )


def graph_edges(nodes, record):
    """Edges from parent to node."""
    return nodes.where(F.col("parent").isNotNull()).select(
        record, F.col("parent").alias("source"), F.col("id").alias("target")
    )
