"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Roles by initial have to read ``(s?(ua)+)?``. Four costs per place of a conversation, one per
state of that expression, say what the rest costs at least. Going from the last row to the
first, each row turns one vector of costs into the next; less its smallest cost there are
only some dozens of such vectors. Their transitions are tabulated for every block of
``BLOCK`` rows (the Four Russians' method), so costs go over whole blocks by lookup. The
edits are then found by expanding blocks against that direction, from the first row on,
where of equally cheap edits the least letter can be taken at once.

A conversation of any length is spread over tasks. Rows are ranged by conversation and turn,
and what a conversation has in one range is a segment. A segment's table lookups are done
for every vector that can follow it; folding these short tables gives each segment its own,
and its edits are traced for each state it can be entered in; folding again picks one. Only
one letter per row is gathered per segment; texts are moved once, to the rows that stay.

Defined results: null roles and texts are one blank; rows are taken by turn (nulls first),
then role, first characters and hash of the text; rows with equal role and text are duplicates of the first;
a null conv_id is a conversation of its own; an empty table gives no rows; very long texts
are read whole. Further columns are ignored, whatever their names.
"""

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.operators.bounded import key_join
from grovekit.session import staged

BLOCK = 4
RELABEL, REMOVE, ADD, UNFINISHED = 3, 4, 3, 3
_SPACE = " \t\n\x0b\f\r"
_HEAD = 64
#: States: nothing yet, after s, after u, after a. Empty and after a are complete.
_FRESH, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEEDS = {_FRESH: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3
#: Symbols: 2 * initial + truncated, a row that has to go, and no row at all.
_GONE, _NO_ROW, _SYMBOLS = 8, 9, 10
_END = (0, 6, 3, 0)
_LETTER = 65


def _kept_state(symbol, state):
    """State after keeping a row as it is; None where that is not allowed."""
    initial = symbol // 2
    if initial == 0:
        return _SYSTEM if state == _FRESH else None
    return initial + 1 if initial in (1, 2) and _NEEDS[state] == initial + 1 else None


def _choices(symbol, state):
    """(letter, cost, state after) of the edits that use up a row."""
    out = [("D", REMOVE, state)]
    if symbol != _GONE:
        extra = UNFINISHED * (symbol % 2)
        if (kept := _kept_state(symbol, state)) is not None:
            out.append(("K", extra, kept))
        out.append(("R", RELABEL + extra, _NEEDS[state]))
    return out


def _before(costs, symbol):
    """Costs before a row, from those after it."""
    if symbol == _NO_ROW:
        return costs
    out = [min(c + costs[s] for _, c, s in _choices(symbol, state)) for state in range(4)]
    for _ in range(2):  # an added row leads to the state it fills; two in a row reach all
        out = [min(c, ADD + out[_NEEDS[state]]) for state, c in enumerate(out)]
    return tuple(out)


class Tables:
    """Reduced cost vectors and their transitions, by row and by block."""

    def __init__(self, block=BLOCK):
        self.block = block
        self.vectors, numbers = [_END], {_END: 0}
        step, cost = [], []
        for vector in self.vectors:  # grows while it is read
            step.append([])
            cost.append([])
            for symbol in range(_SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                reduced = tuple(c - least for c in costs)
                if reduced not in numbers:
                    numbers[reduced] = len(self.vectors)
                    self.vectors.append(reduced)
                step[-1].append(numbers[reduced])
                cost[-1].append(least)
        self.step, self._cost = np.array(step, np.int32), np.array(cost)
        self.after = self.step
        for _ in range(block - 1):  # the first row of a block is met last
            self.after = np.moveaxis(self.step[self.after], 2, 1).reshape(len(self.vectors), -1)
        self._weights = _SYMBOLS ** np.arange(block - 1, -1, -1)
        self.edits = [[[self._edits(v, symbol, state) for state in range(4)] for symbol in range(_GONE + 1)]
                      for v in range(len(self.vectors))]

    def _edits(self, after, symbol, state):
        """(letters up to the one that uses up the row, state after each, cost, state), the least letters of the cheapest."""
        costs, rest, letters, states, paid = _before(self.vectors[after], symbol), self.vectors[after], "", "", 0
        while not letters.strip("I"):
            options = [(a, c, s, c + rest[s]) for a, c, s in _choices(symbol, state)]
            options.append(("I", ADD, _NEEDS[state], ADD + costs[_NEEDS[state]]))
            letter, cost, state, _ = min(o for o in options if o[3] == costs[state])
            letters, states, paid = letters + letter, states + str(state), paid + cost
        return letters, states, paid, state

    def blocks(self, symbols):
        """Numbers of the blocks of a segment; it is filled up with no rows at its front."""
        padded = np.full(-(-len(symbols) // self.block) * self.block, _NO_ROW)
        padded[len(padded) - len(symbols):] = symbols
        return padded.reshape(-1, self.block) @ self._weights

    def transfer(self, symbols):
        """Vector before a segment for every vector after it."""
        at = np.arange(len(self.vectors))
        for b in self.blocks(symbols)[::-1].tolist():
            at = self.after[at, b]
        return at

    def trace(self, symbols, after, starts, last):
        """(state after, cost, letters, state after each letter) for each start; ``last`` closes the conversation."""
        borders = [after]
        for b in self.blocks(symbols)[::-1].tolist():
            borders.append(int(self.after[borders[-1], b]))
        lead = -len(symbols) % self.block
        found = [[s, 0, [], []] for s in starts]
        for i, border in enumerate(reversed(borders[:-1])):
            inside = symbols[max(0, i * self.block - lead):(i + 1) * self.block - lead]
            following = [border]
            for symbol in reversed(inside[1:]):
                following.append(int(self.step[following[-1], symbol]))
            for symbol, v in zip(inside, reversed(following)):
                moves = self.edits[v][symbol]
                for f in found:
                    letters, states, cost, f[0] = moves[f[0]]
                    f[1] += cost
                    f[2].append(letters)
                    f[3].append(states)
        if last:
            for f in found:
                while f[0] in (_SYSTEM, _USER):
                    f[0], f[1] = _NEEDS[f[0]], f[1] + ADD
                    f[2].append("I")
                    f[3].append(str(f[0]))
        return [(s, c, "".join(a), "".join(b)) for s, c, a, b in found]


@lru_cache(maxsize=1)
def tables():
    return Tables()


def _symbols(codes):
    """Symbols of a segment's letters, which hold four faults for each of four initials."""
    codes = np.frombuffer(codes.encode("ascii"), np.uint8).astype(np.int64) - _LETTER
    initial, fault = codes >> 2, codes & 3
    gone = (fault == _BLANK) | (fault == _DUPLICATE)
    return initial, fault, np.where(gone, _GONE, 2 * initial + (fault == _TRUNCATED)).tolist()


def _illegal(before, after):
    return ~(((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1)))


def _read(rows):
    """Rows with their order, identity and what can be told of one row alone."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    solid = F.rtrim(F.col("text"), F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    return rows.withColumns({
        "hash": F.unhex(F.sha2(F.col("text").cast("binary"), 256)),
        "initial": F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3),
        "blank": solid == "",
        "truncated": ~F.substring(solid, -1, 1).isin(".", "!", "?"),
    })


def _placed(read):
    """Rows without texts, numbered in order; the upper bits number the range a row lies in."""
    order = ["conv_id", "turn", "role", "head", "hash"]
    light = read.withColumn("head", F.substring("text", 1, _HEAD)).drop("text").withColumn(
        "salt", F.monotonically_increasing_id())  # parts even rows that are equal
    ranged = light.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt").drop("salt", "head")
    return staged(ranged.withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def _segments(placed):
    """One row per conversation and range: a letter per row, and the turns."""
    first = placed.where(~F.col("blank")).groupBy("conv_id", "role", "hash").agg(F.min("pos").alias("pos"))
    marked = placed.join(first.select("pos", F.lit(True).alias("is_first")), "pos", "left")
    fault = (F.when(F.col("blank"), _BLANK).when(F.col("is_first").isNull(), _DUPLICATE)
             .when(F.col("truncated"), _TRUNCATED).otherwise(0))
    letter = F.char(F.lit(_LETTER) + 4 * F.col("initial") + fault)
    segments = marked.groupBy("conv_id", F.shiftright("pos", 33).alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("pos", letter.alias("letter")))).alias("rows"), F.min("pos").alias("pos"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).alias("turns"))
    segments = segments.withColumn("codes", F.array_join("rows.letter", "")).drop("rows")
    counts = segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("segment").alias("first"), F.max("segment").alias("last"))
    return staged(key_join(segments, counts, ["conv_id"]), "repair-segments")


def _goals(segments, conv_type):
    """Number of the cost vector after each segment of the conversations that have several."""
    moved, folded = f"conv_id {conv_type}, segment long, before array<int>", f"conv_id {conv_type}, segment long, goal int"
    moved_schema, folded_schema = arrow_schema(moved), arrow_schema(folded)

    def transfer(batches):
        for batch in slices(batches):
            codes = batch.column(2).to_pylist()
            yield to_batch(moved_schema, [batch.column(0), batch.column(1), [tables().transfer(_symbols(c)[2]) for c in codes]])

    def fold(batches):
        for batch in slices(batches, 64):
            out = [], [], []
            for conv_id, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = 0
                for part in reversed(parts):
                    for column, value in zip(out, (conv_id, part["segment"], at)):
                        column.append(value)
                    at = part["before"][at]
            yield to_batch(folded_schema, out)

    several = segments.where("n > 1").select("conv_id", "segment", "codes").repartition("conv_id", "segment")
    return several.mapInArrow(transfer, moved).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("segment", "before"))).alias("parts")).mapInArrow(fold, folded)


_PATH = "letters:string,states:string"
_PART = ("segment long, pos long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long,"
         f" opening int, closing int, paths array<struct<state:int,cost:long,{_PATH}>>")
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _columns(rows, schema):
    return list(zip(*rows)) if rows else [[] for _ in schema]


def _traced(segments, conv_type):
    """Counts of each segment and its edits, for every state it may be entered in."""
    schema = f"conv_id {conv_type}, {_PART}"
    out = arrow_schema(schema)

    def trace(batches):
        for batch in slices(batches, 64):
            rows = []
            for r in batch.to_pylist():
                initial, fault, symbols = _symbols(r["codes"])
                starts = [_FRESH] if r["segment"] == r["first"] else range(4)
                paths = tables().trace(symbols, r["goal"], starts, r["segment"] == r["last"])
                rows.append((
                    r["conv_id"], r["segment"], r["pos"], r["low"], r["high"], r["turns"],
                    *np.bincount(fault, minlength=4).tolist()[1:], int(_illegal(initial[:-1], initial[1:]).sum()),
                    int(initial[0]), int(initial[-1]), [dict(zip(("state", "cost", "letters", "states"), p)) for p in paths]))
            yield to_batch(out, _columns(rows, out))

    goals = key_join(segments, _goals(segments, conv_type), ["conv_id", "segment"], "left")
    return goals.withColumn("goal", F.coalesce("goal", F.lit(0))).mapInArrow(trace, schema)


def _joined(parts):
    """One conversation from its segments: the columns of the report, and the edits of each segment."""
    state, cost, illegal, turns, low, high, edits = _FRESH, 0, 0, 0, None, None, []
    for i, p in enumerate(parts):
        path = p["paths"][state if i else 0]
        edits.append({"pos": p["pos"], "letters": path["letters"], "states": path["states"]})
        state, cost = path["state"], cost + path["cost"]
        illegal += p["illegal"]
        if i:
            illegal += int(_illegal(np.array(parts[i - 1]["closing"]), np.array(p["opening"])))
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"]
    gaps = 0 if low is None else high - low + 1 - turns
    faults = [sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, cost, "".join(e["letters"] for e in edits), edits


def _rows_after(edits, conv_type):
    """One row per row that stays or is added: place, number of the old row, new role."""
    schema = f"conv_id {conv_type}, place long, pos long, new_role string"
    out = arrow_schema(schema)

    def write(batches):
        for batch in slices(batches, 64):
            rows = []
            for conv_id, pos, letters, states in zip(*[c.to_pylist() for c in batch.columns]):
                for place, (letter, state) in enumerate(zip(letters, states), pos >> 33 << 33):
                    if letter != "D":
                        rows.append((conv_id, place, None if letter == "I" else pos, None if letter == "K" else _ROLES[int(state)]))
                    pos += letter != "I"
            yield to_batch(out, _columns(rows, out))

    return edits.select("conv_id", F.inline("edits")).mapInArrow(write, schema)


def repair(rows):
    """(report, repaired rows) of conversations given as conv_id, turn, role and text.

    The report has one row per conversation: turns missing between first and last, rows by first
    fault, neighbours that may not follow each other, the cost and the letters of the edits
    (Keep, Rerole, Delete, Insert). Repaired rows are conv_id, place (ascending numbers), role and text.
    """
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    read = _read(rows)
    placed = _placed(read)
    traced = _traced(_segments(placed), conv_type)
    edit_type = f"edits array<struct<pos:long,{_PATH}>>"
    out = arrow_schema(f"conv_id {conv_type}, {_REPORT}, {edit_type}")

    def join(batches):
        for batch in slices(batches, 64):
            found = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield to_batch(out, _columns([(conv_id, *_joined(parts)) for conv_id, parts in found], out))

    parts = F.struct(*[c for c in traced.columns if c != "conv_id"])
    found = staged(traced.groupBy("conv_id").agg(F.sort_array(F.collect_list(parts)).alias("parts")).mapInArrow(
        join, f"conv_id {conv_type}, {_REPORT}, {edit_type}"), "repair-found")
    after = _rows_after(found.select("conv_id", "edits"), conv_type)
    # A row that stays is the first with its role and text, so its text is found by them.
    texts = read.where(~F.col("blank")).groupBy("conv_id", "role", "hash").agg(F.first("text").alias("text"))
    stay = after.where(F.col("pos").isNotNull()).join(placed.select("pos", "role", "hash"), "pos")
    stay = key_join(stay, texts, ["conv_id", "role", "hash"])
    added = after.where(F.col("pos").isNull()).select("conv_id", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return found.drop("edits"), stay.select(
        "conv_id", "place", F.coalesce("new_role", "role").alias("role"), "text").unionByName(added)


def row_digests(rows):
    """SHA-256 of ``role:text`` of a conversation's rows in order of place, joined by line breaks.

    Rows stream through sorted partitions, so no conversation is held in memory.
    """
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, sha256 string"
    out = arrow_schema(schema)

    def digest(batches):
        current, running = None, None
        for batch in slices(batches):
            done = []
            for conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                if running is None or conv_id != current:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = conv_id, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield to_batch(out, _columns(done, out))
        if running is not None:
            yield to_batch(out, [[current], [running.hexdigest()]])

    ordered = rows.select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(digest, schema)


def damage(rows):
    """Rows with faults by the hash of ``conv_id:turn``: dropped, emptied, unfinished, repeated, of another role."""
    def known(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    hit = rows.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"),
                      F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("_copies"))
    return hit.select("*", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop("_copies", "col")
