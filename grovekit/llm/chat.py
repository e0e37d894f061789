"""Chat formatting into a prefix tree: shared opening turns are written once.

Every turn is a node, named by one rolling hash of the turns up to it, so conversations that begin
alike share nodes. Nodes are laid out depth first; a node carries the position of its first
token on its path, and, as attention intervals, the stretches of the layout that hold its
ancestors. A token is a code point. Conversations are ranked by their paths; a node belongs to
the first of those that pass through it, and nodes in the order of rank and depth are the tree depth
first. What a conversation adds is one stretch, so the stretches of its whole path are found once for
all its nodes. No tree is gathered: one opening turn may be shared by any number of
conversations. Rows, sorts and joins grow in proportion to the turns, also for long conversations.

Template: ``### role:`` line break, text, ``</turn>`` line break. Inside roles and texts a
backslash is doubled and one is set before ``### `` and ``</turn>`` (in roles also before
a colon), which ``unescape`` takes back exactly. The loss mask covers the texts of assistants.

Defined results: null texts and roles are empty; turns are ordered by number, null first,
ties by role and text; repeated rows are turns of their own; rows without a conversation id
form one conversation; an empty table gives no rows. Further columns are ignored.
"""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.session import staged

LOSS_ROLE = "assistant"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _escape(text, more=()):
    for control in ("\\", "### ", "</turn>", *more):
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


def unescape(text):
    return _ESCAPED.sub(r"\1", text)


def parse(formatted):
    """(role, text) of the turns of a formatted text; raises when it is not of the template."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


def _turns(rows):
    """Turns with their formatted text, the names of their node, its parent and its tree, and the length of all before."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit("### "), _escape(role, (":",)), F.lit(":\n"))
    body = _escape(text)
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
    ).withColumn("formatted", F.concat(head, body, F.lit("</turn>\n"))).withColumn(
        # where the loss mask starts and ends within the turn
        "mask", F.when(F.col("role") == LOSS_ROLE, F.struct(F.length(head).alias("start"), (F.length(head) + F.length(body)).alias("end"))))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("depth", F.row_number().over(by_turn) - 1).withColumn("length", F.length("formatted").cast("long"))
    # The rolling hash is the exclusive or of the hashes of (depth, turn), in two halves.
    digest = F.md5(F.concat_ws(":", "depth", "formatted").cast("binary"))
    by_depth = Window.partitionBy("conv_id").orderBy("depth")
    upto = by_depth.rowsBetween(Window.unboundedPreceding, 0)

    def half(start):
        rolled = F.bit_xor(F.conv(F.substring("digest", start, 16), 16, -10).cast("long")).over(upto)
        return F.lpad(F.hex(rolled), 16, "0")

    turns = turns.withColumn("digest", digest).withColumn("node", F.unhex(F.concat(half(1), half(17))))
    return turns.select(
        "conv_id", "depth", "node", F.lag("node").over(by_depth).alias("parent"), F.first("node").over(upto).alias("tree"),
        "length", (F.sum("length").over(upto) - F.col("length")).alias("position"), "formatted", "mask")


def prefix_tree(rows: DataFrame):
    """Nodes of the tree and the path of each conversation, as two tables.

    nodes: node, parent, tree (node of the opening turn), depth, formatted, mask, start (place in the
    layout), length, position (of its first token on the path), attends (places of its
    ancestors, merged). paths: conv_id, nodes (from the opening turn on).
    """
    turns = staged(_turns(rows), "chat-turns")
    paths = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "node")))["node"].alias("nodes"))
    # The id breaks ties of equal conversations, which so need not stay together.
    paths = staged(
        paths.repartitionByRange("nodes", "conv_id").sortWithinPartitions("nodes", "conv_id").withColumn("rank", F.monotonically_increasing_id()),
        "chat-paths")
    ranks = paths.select(F.col("conv_id").alias("ranked"), "rank")
    kept = ("parent", "tree", "depth", "length", "position", "formatted", "mask")
    once = turns.join(ranks, F.col("conv_id").eqNullSafe(F.col("ranked"))).groupBy("node").agg(
        F.min("rank").alias("rank"), *(F.first(c).alias(c) for c in kept))
    ordered = once.repartitionByRange("rank", "depth").sortWithinPartitions("rank", "depth")
    carried = ("rank", "node", *kept)
    ddl = ("part int, at long, rank long, node binary, parent binary, tree binary, depth int, length long, position long, "
           "formatted string, mask struct<start:int,end:int>")
    schema = arrow_schema(ddl)

    def place(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            starts = []
            for n in batch.column("length").to_pylist():
                starts.append(at)
                at += n
            yield to_batch(schema, [[part] * len(starts), starts, *(batch.column(c).to_pylist() for c in carried)])

    laid = staged(ordered.select(*carried).mapInArrow(place, ddl), "chat-layout")
    # One row per partition: a small running sum and a small broadcast.
    totals = laid.groupBy("part").agg(F.sum("length").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = laid.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("at"))
    # Stretches of the layout along the paths of those conversations that have nodes of their own.
    along = paths.join(placed.select("rank").distinct(), "rank", "left_semi").select("rank", F.posexplode("nodes").alias("depth", "node")).join(
        placed.select("node", "start", (F.col("start") + F.col("length")).alias("end")), "node")
    by_depth = Window.partitionBy("rank").orderBy("depth")
    opens = F.coalesce(F.col("start") != F.lag("end").over(by_depth), F.lit(True)).cast("long")
    stretches = along.withColumn("opens", opens).withColumn("stretch", F.sum("opens").over(by_depth.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = stretches.groupBy("rank", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end")).groupBy("rank").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("stretches"))
    # A conversation's own nodes lie in its last stretch.
    last = F.element_at("stretches", -1)["start"]
    own = F.when(F.col("start") > last, F.array(F.struct(last.alias("start"), F.col("start").alias("end")))).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint>>"))
    nodes = placed.join(stretches, "rank").select(
        "node", "parent", "tree", "depth", "formatted", "mask", "start", "length", "position",
        F.concat(F.slice("stretches", F.lit(1), F.size("stretches") - 1), own).alias("attends"))
    return nodes, paths.select("conv_id", "nodes")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Conversations read from the tree: conv_id, formatted, turns (role, text), loss_text."""
    asked = paths.select("conv_id", F.posexplode("nodes").alias("n", "node"))
    whole = asked.join(nodes.select("node", "formatted", "mask"), "node").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "formatted", "mask"))).alias("parts"))
    ddl = "conv_id long, formatted string, turns array<struct<role:string,text:string>>, loss_text string"
    schema = arrow_schema(ddl)

    def read(batches):
        for batch in slices(batches, 64):
            out = []
            for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
                formatted = "".join(p["formatted"] for p in parts)
                loss = "".join(unescape(p["formatted"][p["mask"]["start"]:p["mask"]["end"]]) for p in parts if p["mask"])
                out.append((conv, formatted, [{"role": r, "text": t} for r, t in parse(formatted)], loss))
            yield to_batch(schema, list(zip(*out)) or [[]] * 4)

    return whole.mapInArrow(read, ddl)
