"""Column helpers on nodes and on serialized records."""

from functools import reduce

from pyspark.sql import functions as F

from grovekit.fixed import (
    CATEGORIES, NODE_COLOUR, ROOT_COLOUR, SKIP_TEXTS, SKIP_TYPES, SKIP_UNDER_PARENT,
)
from grovekit.functions.text import let, python_strip

SNIPPET_CHARS = 100
LABEL_CHARS = 30
_TYPE_PAIR = r'"type":("(?:[^"\\]|\\.)*")'


def _any(conditions):
    return reduce(lambda a, b: a | b, conditions)


def searched_type(node_type, mode="reference"):
    """What ``category_in`` looks for keywords in: the type in small letters, or its words."""
    if mode not in ("reference", "corrected"):
        raise ValueError(f"unknown mode: {mode}")
    lowered = F.lower(F.col(node_type) if isinstance(node_type, str) else node_type)
    return lowered if mode == "reference" else F.split(lowered, "[_ ]")


def category_in(searched, mode="reference"):
    """``group.name`` of the first category row with a keyword in a searched type; null without one."""
    value = F.col(searched) if isinstance(searched, str) else searched
    # A chain of branches, not one nested in the other: a row found early ends the search.
    rows = [
        (_any([value.contains(k) if mode == "reference" else F.array_contains(value, k.strip()) for k in keywords]),
         F.lit(f"{group}.{name}"))
        for group, name, keywords in CATEGORIES
    ]
    result = F.when(*rows[0])
    for found, label in rows[1:]:
        result = result.when(found, label)
    return result


def category(node_type, mode="reference"):
    """``group.name`` of the first category row with a keyword in the type; null without one.

    ``reference`` looks for the keyword anywhere in the type, ``corrected`` only as one of
    its words.
    """
    return let(searched_type(node_type, mode), lambda value: category_in(value, mode))


def skip_flag(node_type, text, parent_type):
    """True for a node that gets no entry in the record."""
    node_type, parent_type = F.col(node_type), F.coalesce(F.col(parent_type), F.lit(""))
    stripped = F.coalesce(python_strip(text), F.lit(""))
    repeats_parent = _any([
        (node_type == child) & parent_type.isin(*parents) & (stripped != "")
        for child, parents in SKIP_UNDER_PARENT
    ])
    quoted = (node_type == "string") & (stripped.startswith('"""') | stripped.startswith("'''"))
    return stripped.isin(*SKIP_TEXTS) | node_type.isin(*SKIP_TYPES) | quoted | repeats_parent


def snippet(text):
    return F.substring(text, 1, SNIPPET_CHARS)


def graph_label(node_type, text):
    """Type over text; a long text is cut, put in brackets and marked."""
    text = F.col(text)
    long = F.concat(F.lit("("), F.substring(text, 1, LABEL_CHARS), F.lit("...)"))
    return F.concat(
        F.col(node_type), F.lit("\n"), F.when(F.length(text) > LABEL_CHARS, long).otherwise(text)
    )


def graph_colour(parent):
    return F.when(F.col(parent).isNull(), F.lit(ROOT_COLOUR)).otherwise(F.lit(NODE_COLOUR))


def safe_parse_json(column):
    """Parsed value; a text that fails is tried again with double for single quotes."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(
        F.try_parse_json(text), F.try_parse_json(F.replace(text, F.lit("'"), F.lit('"')))
    )


def _once(value, use):
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def parsed_text(column):
    """The parsed value as text in one spelling: no white space, plain letters for escaped ones, keys in order.

    Null for a text that cannot be parsed.
    """
    return F.to_json(safe_parse_json(column))


def unparsed(column):
    """True for a text that cannot be parsed, not even after the second try."""
    text = F.col(column) if isinstance(column, str) else column
    return text.isNotNull() & safe_parse_json(column).isNull()


def _types_in(text):
    """Strings under a key ``type`` of a text in one spelling, where a quote inside a string is always escaped."""
    quoted = F.regexp_extract_all(text, F.lit(_TYPE_PAIR), F.lit(1))
    return F.from_json(F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")), "array<string>")


def collect_types(json):
    """Every string under a key ``type``, at any depth, with keys in order; null for what cannot be parsed."""
    return _types_in(parsed_text(json))


def node_types(json):
    """Types of ``ast.nodes``; of the whole value where there is no such list.

    A list stands for its first element; a node without a type is searched at any depth.
    Null for what cannot be parsed, which counts nothing. Where every node is an object with a string as its type, the types
    are taken from the parsed value, and nothing is written as text and parsed again.
    """
    def of_node(node):
        return _once(F.get_json_object(node, "$.type"), lambda own: F.when(own.isNotNull(), F.array(own)).otherwise(_types_in(node)))

    def of_value(value):
        listed = F.from_json(value, "struct<ast:struct<nodes:array<string>>>")["ast"]["nodes"]
        return _once(listed, lambda nodes: F.when(nodes.isNotNull(), F.flatten(F.transform(nodes, of_node))).otherwise(_types_in(value)))

    def of_text(text):
        return _once(F.when(text.startswith("["), F.get_json_object(text, "$[0]")).otherwise(text), of_value)

    def own_types(value):
        return F.transform(
            F.try_variant_get(value, "$.ast.nodes", "array<struct<type:variant>>"),
            lambda node: F.when(F.schema_of_variant(node["type"]) == "STRING", F.try_variant_get(node["type"], "$", "string")))

    def of_parsed(value):
        return _once(own_types(value), lambda names: F.when(
            F.coalesce(~F.exists(names, lambda name: name.isNull()), F.lit(False)), names).otherwise(_once(F.to_json(value), of_text)))

    return _once(safe_parse_json(json), of_parsed)
