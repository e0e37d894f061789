"""Trees as node tables: one row per node, in pre-order, with its depth.

A node table has ``record, seq, depth, type, text`` and whatever else it carries. Parents
follow from order and depth alone, so every step below is a window over one record;
readers place the rows by record once, before rows multiply, and no later step moves
them again.
"""

from pyspark.sql import Window, functions as F

from grovekit.fixed import VOID_TAGS
from grovekit.functions.nodes import skip_flag
from grovekit.functions.text import dump_node_count, error_count, lines

#: Bytes of text whose nodes one task holds; a node table takes up to a hundred times as much to sort.
TEXT_PER_TASK = 1_000_000
_TAG = r"(</?[a-zA-Z][a-zA-Z0-9]*[^>]*>)"
_PIECE = 256
_DUMP_LINE = r'(?s)^( *)\((.*?)\) "(.*)"$'


def _before(*order, by):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def place_by_record(df, record, text):
    """Rows placed by record, in as many partitions as the bytes of their texts ask for.

    Rows multiply after this, and their sorts must fit a task however large the input
    is. One pass over the text column adds up its bytes; without a fixed number of partitions
    adaptive execution would gather them by their size before the rows multiply.
    """
    held = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return df.repartition(max(1, -(-held // TEXT_PER_TASK)), record)


def token_type(column):
    token = F.col(column)
    initial = F.substring(token, 1, 1)
    return (
        F.when(token.rlike(r"^[0-9]+[.,]?\z"), "number_literal")
        .when(token.rlike(r"[.,]\z"), "punctuated_word")
        .when(initial != F.lower(initial), "capital_name")
        .otherwise("word")
    )


def text_nodes(df, record, text, carry=()):
    """Document, line and token nodes of a text.

    Offsets count characters (``start``, ``end``) and UTF-8 bytes (``start_byte``,
    ``end_byte``); points are a row and a byte column. Parents, the depth of the node
    before and whether a child follows are known here and come along.
    """
    placed = place_by_record(df.select(record, F.col(text).alias("_text"), *carry), record, "_text")
    by_line = placed.select(
        record, *carry,
        F.posexplode(F.concat(F.array("_text"), lines("_text"))).alias("_row", "_line"),
        F.length("_text").alias("_chars"), F.octet_length("_text").alias("_bytes"),
    )
    whole = F.col("_row") == 0
    pieces = F.when(whole, F.array("_line")).otherwise(
        F.concat(F.array("_line"), F.split("_line", " ", -1))
    )
    exploded = by_line.select(
        record, *carry, (F.col("_row") - 1).alias("row"), F.posexplode(pieces).alias("_k", "text"),
    )
    token = F.col("_k") > 0
    kept = ~token | (F.col("text") != "")
    order = _before("row", "_k", by=[record])

    def passed(size):
        return F.coalesce(F.sum(F.when(token, size + 1).otherwise(0)).over(order), F.lit(0))

    whole = F.col("row") < 0
    depth = F.when(whole, 0).when(~token, 1).otherwise(2)
    numbered = exploded.select(
        record, *carry, "row", "_k", "text", depth.alias("depth"),
        F.last(F.when(kept, depth), True).over(order).alias("previous_depth"),
        F.coalesce(F.sum(kept.cast("int")).over(order), F.lit(0)).cast("int").alias("seq"),
        passed(F.length("text")).alias("start"),
        passed(F.octet_length("text")).alias("start_byte"),
    )
    so_far = (
        Window.partitionBy(record).orderBy("row", "_k")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    size, byte_size = F.length("text"), F.octet_length("text")
    last_line = F.element_at(lines("text"), -1)
    return (
        numbered.withColumns({
            "_line_byte": F.last(F.when(~token, F.col("start_byte")), True).over(so_far),
            "_line_seq": F.last(F.when(~token, F.col("seq")), True).over(so_far),
        })
        .where(kept)
        .withColumn("_next_depth", F.lead("depth").over(Window.partitionBy(record).orderBy("row", "_k")))
        .select(
            record, *carry, "seq", "depth", "previous_depth",
            F.coalesce(F.col("_next_depth") > F.col("depth"), F.lit(False)).alias("has_children"),
            F.when(token, F.col("_line_seq")).when(~whole, 0).alias("parent_seq"),
            F.when(token, "line").when(~whole, "document").alias("parent_type"),
            F.when(whole, "document").when(~token, "line").otherwise(token_type("text")).alias("type"),
            "text", "start", (F.col("start") + size).alias("end"),
            "start_byte", (F.col("start_byte") + byte_size).alias("end_byte"),
            F.struct(
                F.greatest("row", F.lit(0)).alias("row"),
                (F.col("start_byte") - F.col("_line_byte")).cast("int").alias("column"),
            ).alias("start_point"),
            F.struct(
                F.when(whole, F.size(lines("text")) - 1).otherwise(F.col("row")).alias("row"),
                F.when(whole, F.octet_length(last_line))
                .otherwise(F.col("start_byte") - F.col("_line_byte") + byte_size)
                .cast("int").alias("column"),
            ).alias("end_point"),
        )
    )


def text_node_count(text):
    """Nodes ``text_nodes`` would give, without building them."""
    text = F.col(text) if isinstance(text, str) else text
    tokens = F.regexp_count(text, F.lit(r"[^ \n]+"))
    return (1 + F.size(lines(text)) + tokens).cast("int")


def tag_nodes(df, record, html, carry=()):
    """Nested nodes of the tags of a page; ``text`` is the tag."""
    placed = place_by_record(df.select(record, html, *carry), record, html)
    tags = placed.select(
        record, *carry,
        F.posexplode(F.regexp_extract_all(F.col(html), F.lit(_TAG), F.lit(1))).alias("_pos", "text"),
    ).withColumn("type", F.lower(F.regexp_extract("text", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1)))
    closing = F.col("text").startswith("</")
    alone = F.col("type").isin(*VOID_TAGS) | F.col("text").endswith("/>")
    step = F.when(closing, -1).when(alone, 0).otherwise(1)
    order = _before("_pos", by=[record])
    return (
        tags.withColumns({
            "depth": F.greatest(F.lit(0), F.coalesce(F.sum(step).over(order), F.lit(0)).cast("int")),
            "seq": F.coalesce(F.sum((~closing).cast("int")).over(order), F.lit(0)).cast("int"),
        })
        .withColumn("previous_depth", F.last(F.when(~closing, F.col("depth")), True).over(order))
        .where(~closing)
        .select(record, *carry, "seq", "depth", "previous_depth", "type", "text")
    )


def read_dump(df, record, dump, carry=(), place=True):
    """Node table of an indented text dump; line breaks of snippets come back.

    A dump is cut into its lines one after the other, so nothing is held or sorted here. Dumps
    take several times as much as their texts: with ``place`` false they stay where they
    are, for steps that need no whole record in one task.
    """
    dumps = df.select(record, dump, *carry).where(F.col(dump).isNotNull())
    if place:
        dumps = place_by_record(dumps, record, dump)
    listed = dumps.select(record, *carry, F.posexplode(F.split(dump, "\n", -1)).alias("seq", "_line"))

    def part(i):
        return F.regexp_extract("_line", _DUMP_LINE, i)

    return listed.select(
        record, *carry, "seq",
        F.call_function("div", F.length(part(1)), F.lit(2)).cast("int").alias("depth"),
        part(2).alias("type"),
        F.replace(part(3), F.lit("\\n"), F.lit("\n")).alias("text"),
    )


def write_dump(nodes, record, name="lang_specific_parse"):
    """Indented text dump per record."""
    line = F.concat(
        F.repeat(F.lit("  "), F.col("depth")), F.lit("("), F.col("type"), F.lit(') "'),
        F.replace(F.col("text"), F.lit("\n"), F.lit("\\n")), F.lit('"'),
    )
    listed = F.sort_array(F.collect_list(F.struct("seq", line.alias("line"))))
    return nodes.groupBy(record).agg(
        F.array_join(F.transform(listed, lambda entry: entry["line"]), "\n").alias(name)
    )


def parse_columns(samples, nodes, record):
    """Samples with dump, node count and error count; three nulls without nodes."""
    dumps = write_dump(nodes, record)
    return samples.join(dumps, record, "left").withColumns({
        "ast_node_count": dump_node_count("lang_specific_parse"),
        "num_errors": error_count("lang_specific_parse"),
    })


def node_text(nodes, samples, record, code="code", mode="reference"):
    """Slice of the source per node, from byte offsets.

    ``reference`` applies the byte offsets to characters, which shifts text behind a
    character of several bytes; ``corrected`` slices bytes. The source is cut into short
    pieces once per record, so a slice costs its own length and not its distance from
    the start.
    """
    if mode not in ("reference", "corrected"):
        raise ValueError(f"unknown mode: {mode}")
    text = F.col(code)
    if mode == "corrected":
        # One character per byte.
        text = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    start, size = F.col("start_byte").cast("int"), (F.col("end_byte") - F.col("start_byte")).cast("int")
    first = F.call_function("div", start, F.lit(_PIECE)).cast("int")
    last = F.call_function("div", start + size - 1, F.lit(_PIECE)).cast("int")
    offset = start % _PIECE + 1
    sliced = F.when(size <= 0, "").when(
        first == last, F.coalesce(F.substring(F.get("_pieces", first), offset, size), F.lit(""))
    ).otherwise(
        F.substring(F.array_join(F.slice("_pieces", first + 1, last - first + 1), ""), offset, size)
    )
    if mode == "corrected":
        sliced = F.encode(sliced, "ISO-8859-1").cast("string")
    cut = samples.select(record, pieces.alias("_pieces"))
    return nodes.drop("text").join(cut, record).withColumn("text", sliced).drop("_pieces")


def nearest_above(nodes, record, level, found, name, when=None):
    """Struct ``name`` of the last row before each row that stands one level up.

    Every row is placed one level up as a question, and rows that can be parents (``when``)
    on their own level too; the last parent before a question answers it. Only questions
    carry the other columns.
    """
    parent = F.struct(*found)
    both = F.array(F.lit(0), F.lit(1))
    places = both if when is None else F.when(when, both).otherwise(F.array(F.lit(1)))
    placed = nodes.select(
        record, F.col("seq"), F.explode(places).alias("_asks"),
        *[c for c in nodes.columns if c not in (record, "seq")],
    )
    asks = F.col("_asks") == 1
    others = [c for c in nodes.columns if c not in (record, "seq")]
    placed = placed.select(
        record, "seq", "_asks",
        (F.col(level) - F.col("_asks")).alias("_key"),
        F.when(~asks, parent).alias("_parent"),
        *[F.when(asks, F.col(c)).alias(c) for c in others],
    )
    answered = placed.withColumn(name, F.last("_parent", True).over(_before("seq", by=[record, "_key"])))
    return answered.where(asks).select(*nodes.columns, name)


def with_parent(nodes, record):
    """Add ``parent_seq`` and ``parent_type``; null for roots.

    Where the node table tells which nodes ``has_children``, only those are looked at as parents.
    """
    nodes = nodes.drop("parent_seq", "parent_type")
    inner = F.col("has_children") if "has_children" in nodes.columns else None
    found = nearest_above(nodes, record, "depth", ["seq", "type"], "_up", when=inner)
    return found.select(
        *nodes.columns, F.col("_up.seq").alias("parent_seq"), F.col("_up.type").alias("parent_type")
    )


def with_keep(nodes):
    """Add ``keep``: false for nodes that get no entry. Needs ``parent_type``."""
    return nodes.withColumn("keep", ~skip_flag("type", "text", "parent_type"))


def with_kept_depth(nodes, record):
    """Add ``kept_depth``, the number of kept ancestors, ``has_children`` and the dense ``id``
    of kept nodes.

    A first child adds the node before it, its parent, to the kept ancestors. A node
    above the depth of the one before takes off what it leaves: the open inner node of
    every depth from its own up to the one before, which is the last node on that depth
    and so one row back among the events of the depth. The running balance is the answer.
    """
    known = "has_children" in nodes.columns
    others = [c for c in nodes.columns if c not in (record, "has_children")]
    if "previous_depth" not in nodes.columns:
        nodes = nodes.withColumn(
            "previous_depth", F.lag("depth").over(Window.partitionBy(record).orderBy("seq")))
    left = F.when(
        F.col("previous_depth") > F.col("depth"),
        F.sequence(F.col("depth"), F.col("previous_depth") - 1),
    ).otherwise(F.array().cast("array<int>"))
    events = nodes.withColumn("_level", F.explode(F.concat(F.array(F.lit(-1)), left)))
    is_node = F.col("_level") < 0
    events = events.select(
        record,
        F.col("seq").alias("_at"),
        F.when(is_node, F.col("depth")).otherwise(F.col("_level")).alias("_level"),
        F.when(is_node, 1).otherwise(0).alias("_node"),
        F.when(is_node, F.col("depth") > F.col("previous_depth")).alias("_first"),
        *[F.when(is_node, F.col(c)).alias(c) for c in others],
        *([F.when(is_node, F.col("has_children")).alias("has_children")] if known else []),
    )
    on_level = Window.partitionBy(record, "_level").orderBy("_at", "_node")
    events = events.withColumn("_left", F.lag("keep").over(on_level))
    is_node = F.col("_node") == 1
    in_order = Window.partitionBy(record).orderBy("_at", "_node")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    balance = (
        F.when(~is_node, -F.col("_left").cast("int"))
        .when(F.col("_first"), F.col("_above").cast("int"))
        .otherwise(0)
    )
    return (
        events.withColumn("_above", F.last(F.when(is_node, F.col("keep")), True).over(before))
        .withColumns({
            "kept_depth": F.sum(balance).over(so_far).cast("int"),
            "id": F.coalesce(F.sum(F.when(is_node & F.col("keep"), 1)).over(before), F.lit(0)).cast("int"),
            "has_children": F.col("has_children") if known else F.coalesce(F.lead("_first").over(in_order), F.lit(False)),
        })
        .where(is_node)
        .select(record, *others, "kept_depth", "has_children", F.when(F.col("keep"), F.col("id")).alias("id"))
    )


def prune(nodes, record):
    """Kept nodes with dense ids, nearest kept ancestor and direct-child flag.

    Columns ``parent_seq`` and ``parent_type``, ``previous_depth``, ``has_children`` and ``keep``
    are taken where the node table has them.

    Roots of the raw tree stay as rows without an id, so that their type is known.
    """
    if "parent_seq" not in nodes.columns:
        nodes = with_parent(nodes, record)
    if "keep" not in nodes.columns:
        nodes = with_keep(nodes)
    deep = with_kept_depth(nodes, record).where(F.col("keep") | (F.col("seq") == 0))
    linked = nearest_above(
        deep, record, "kept_depth", ["id", "seq"], "_up",
        when=F.col("keep") & F.col("has_children"))
    return linked.select(
        *deep.columns,
        F.when(F.col("keep"), F.col("_up.id")).alias("parent"),
        F.coalesce(F.col("_up.seq") == F.col("parent_seq"), F.lit(False)).alias("direct"),
    )


def children_ids(pruned, record):
    """Ascending ids of direct children per kept node that has some.

    Nodes lifted through a skipped one keep the parent but are not listed.
    """
    return (
        pruned.where(F.col("keep") & F.col("direct"))
        .groupBy(record, F.col("parent").alias("id"))
        .agg(F.sort_array(F.collect_list("id")).alias("children"))
    )


def category_nodes(nodes, wanted):
    """Nodes of one category across all languages; needs ``category``."""
    return nodes.where(F.col("category") == wanted)
