"""License templates, hard negatives and conversation repair against plain computations."""

import hashlib
import heapq
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import sys
from pathlib import Path
sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[2])]
from helpers import CLASHING, documents, odd_rows  # noqa: E402

from grovekit.llm import licenses, negatives, repair  # noqa: E402


# license templates

def accepted(items, words):
    """Number of words each way of reading ``words`` from its beginning takes."""
    ends = {0}
    for item in items:
        if isinstance(item, bytes):
            ends = {e + 1 for e in ends if words[e:e + 1] == [item]}
        elif item[0] == "opt":
            ends |= {e + n for e in ends for n in accepted(item[1], words[e:])}
        elif item[0] == "alt":
            ends = {e + n for e in ends for c in item[1] for n in accepted(c, words[e:])}
        else:
            ends = {e + n for e in ends for n in range(item[1], item[2] + 1) if e + n <= len(words)}
    return ends


def plain_matches(items, words):
    out, floor = [], 0
    for stop in range(len(words) + 1):
        starts = [i for i in range(floor, stop) if stop - i in accepted(items, words[i:stop])]
        if starts:
            out.append((max(starts), stop))
            floor = stop
    return out


word = st.sampled_from([b"a", b"b", b"c"])
region = st.one_of(
    word, word, st.tuples(st.just("opt"), st.lists(word, min_size=1, max_size=2)),
    st.tuples(st.just("any"), st.integers(0, 2), st.integers(2, 3)),
    st.tuples(st.just("alt"), st.lists(st.lists(word, min_size=1, max_size=2), min_size=1, max_size=3)))


@settings(max_examples=300, deadline=None)
@given(st.lists(region, min_size=1, max_size=6), st.lists(st.sampled_from([b"a", b"b", b"c", b"x"]), max_size=14))
def test_automaton_equals_plain_reading(items, words):
    items = [b"a", *items, b"b"]
    template = licenses.Template("a b")
    template._forward, template._back = licenses.Automaton(items), licenses.Automaton(licenses._turned(items))
    assert template.matches(words) == plain_matches(items, words)


def test_markup():
    assert licenses.parse("A <<var;1;3>> <<beginOptional>>b, <<alt;c d|E>><<endOptional>> f<g") == [
        b"a", ("any", 1, 3), ("opt", [b"b", ("alt", [[b"c", b"d"], [b"e"]])]), b"f", b"g"]
    for faulty in ("<<beginOptional>> a", "a <<endOptional>>", "<<var;3;1>> a", "<<alt;a", "<<var;0;2>>", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            licenses.Template(faulty)


def test_scan(spark):
    grant = re.sub(r"<<[^>]*>>", "", licenses.TEMPLATES["mit-grant"].replace("<<var;1;12>>", "this tool"))
    given = odd_rows() + [
        (20, "MIT License, mit\nlicense", "a"), (21, "x " * 30_000 + grant + " general public license", "b"),
        (22, grant.replace("without limitation", "with limits"), "b"), (22, grant, "b"), (23, "éMIT LICENSE mit licenseé", None)]
    got = defaultdict(list)
    for r in licenses.scan(documents(spark, given, clashing=True)).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(given)
    assert all(r.n_words == 0 and r.score == 0 and r.places == [] and r.matches == [] for k in (3, 4, 8) for r in got[k])
    assert [(p.label, p.word) for p in got[20][0].places] == [("mit", 0), ("mit", 2)] and got[20][0].score == 0.5
    long = got[21][0]
    assert [m.label for m in long.matches] == ["mit-grant"] and long.matches[0].start == 30_001 and long.score == 1
    assert long.places[0].label == "gpl" and long.places[0].word == long.n_words - 3
    changed, exact = sorted(got[22], key=lambda r: r.score)
    assert changed.matches == [] and 0 < changed.score < 0.9 and exact.score == 1
    assert got[23][0].places == [] and got[23][0].n_words == 4
    assert licenses.scan(documents(spark, [], clashing=True)).count() == 0


# hard negatives

@pytest.mark.parametrize("m, k, n", [(33, 64, 100), (65, 67, 129), (70, 130, 41), (1, 5, 7), (0, 4, 4), (100, 0, 40)])
def test_strassen_is_exact(m, k, n):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-2 ** 62, 2 ** 62, (m, k)), rng.integers(-2 ** 62, 2 ** 62, (k, n))
    exact = a.astype(object) @ b.astype(object)
    with np.errstate(all="ignore"):
        assert (negatives.strassen(a, b) == a @ b).all()
    assert (negatives.strassen(a.astype(object), b.astype(object)) == exact).all()
    limit = 2 ** 63 - 1
    assert (negatives.products(a, b) == np.clip(exact, -limit, limit).astype(np.int64)).all()


def plain_negatives(table, positives, size, window, step):
    rows = {}
    for vec_id, vector, label in table:
        if vec_id is None or label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        row = label, [math.floor(256 * x) for x in vector]
        rows[vec_id] = min(row, rows.get(vec_id, row))
    out = []
    for anchor, (label, a) in rows.items():
        if anchor % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i, other) for i, (other, b) in rows.items() if i != anchor)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(s, i) for s, i, other in scored if other != label and window[0] * -ps <= 100 * -s <= window[1] * -ps]
            out += [(anchor, p, r, i, -ps, -s) for r, (s, i) in enumerate(fits[:size], 1)]
    return sorted(out)


@pytest.mark.parametrize("group_bytes, parts", [(1 << 20, 1), (2000, 7)])
def test_negatives_equal_plain_search(spark, group_bytes, parts):
    rng = random.Random(5)
    table = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(rng.choice([6, 6, 6, 4]))], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    table += [(7, [9.0] * 6, 0), (None, [1.0], 0), (900, None, 0), (901, [1.0, None], 0), (902, [float("nan")], 1),
              (903, [float("inf")], 1), (910, [], 1), (920, [1.0] * 6, None), (930, [3e15, 1.0], 2), (940, [0.0] * 6, 77)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").repartition(parts)
    df = df.select("*", *[F.lit(1).alias(c) for c in (*CLASHING, "ints", "row", "slot", "rank")])
    got = negatives.mine(negatives.prepared(df), F.col("vec_id") % 10 == 0, 3, 4, (30, 90), group_bytes)
    assert sorted(map(tuple, got.collect())) == plain_negatives(table, 3, 4, (30, 90), 10)


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(negatives.prepared(df), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(negatives.prepared(one), F.col("vec_id") % 100 == 0).count() == 0


# conversation repair

def cheapest(rows):
    """(cost, letters) by search over all edits; rows are (initial, has to go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        if (i, roles[-1:]) in seen:
            continue
        seen.add((i, roles[-1:]))
        options = [(3, "I", i, r) for r in "ua"]
        if i < len(rows):
            initial, gone, late = rows[i]
            options.append((4, "D", i + 1, ""))
            if not gone:
                options += [(3 * late, "K", i + 1, initial), *[(3 + 3 * late, "R", i + 1, r) for r in "ua"]]
        for c, letter, j, r in options:
            if re.fullmatch("s?(ua)*u?", roles + r):
                heapq.heappush(heap, (cost + c, audit + letter, j, roles + r))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=10), st.integers(0, 10))
def test_tables_give_the_cheapest_edits(rows, cut):
    symbols = [8 if gone else 2 * "suax".index(c) + late for c, gone, late in rows]
    tables = repair.tables()
    state, cost, letters, states = tables.trace(symbols, 0, [0], True)[0]
    assert (cost, letters) == cheapest(rows) and len(states) == len(letters)
    after = int(tables.transfer(symbols[cut:])[0])
    first = tables.trace(symbols[:cut], after, [0], False)[0]
    second = tables.trace(symbols[cut:], 0, range(4), True)[first[0]]
    assert (first[1] + second[1], first[2] + second[2]) == (cost, letters)


def plain_repair(table):
    """Report, and digest of the repaired rows, by conversation."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1] if r[1][:1] in ("s", "u", "a") else "x", f in ("b", "d"), f == "t") for r, f in zip(rows, faults)])
        i, roles, lines = 0, "", []
        for letter in audit:
            if letter == "K":
                lines.append(f"{rows[i][1]}:{rows[i][2]}")
                roles += rows[i][1][0]
            elif letter in "RI":
                roles += "a" if roles[-1:] == "u" else "u"
                lines.append(f"{'user' if roles[-1] == 'u' else 'assistant'}:{rows[i][2] if letter == 'R' else ''}")
            i += letter != "I"
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None
        out[conv] = (gaps, *[faults.count(k) for k in "bdt"], illegal, cost, audit, digest)
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("parts", [2, 40])
def test_repair_equals_plain_search(spark, parts):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "", " \n\t", "half", "Well? \n", "Yes.", None, " ", "é", "long " * 2000 + "end."]
    table = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 12)):
            table.append((conv, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", "", None, "ally"]), rng.choice(texts)))
    table += [(100, i // 2, "user" if i % 3 else "assistant", f"turn {i % 700}{'.' if i % 5 else ''}") for i in range(1500)]
    table += [(101, None, "user", "same.")] * 300
    kept = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(table, CONVERSATIONS).select("*", *[F.lit(1).alias(c) for c in (*CLASHING, "pos", "place", "codes", "hash")])
        report, rows = repair.repair(df)
        digests = {r.conv_id: r.sha256 for r in repair.row_digests(rows).collect()}
        got = {r.conv_id: (*tuple(r)[1:], digests.get(r.conv_id)) for r in report.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept[1])
    expected = plain_repair(table)
    assert got.keys() == expected.keys() and {k: (got[k], v) for k, v in expected.items() if got[k] != v} == {}


def test_repair_of_nothing(spark):
    report, rows = repair.repair(spark.createDataFrame([], CONVERSATIONS))
    assert report.count() == 0 and rows.count() == 0 and repair.row_digests(rows).count() == 0
    assert repair.damage(spark.createDataFrame([(None, None, None, None)], CONVERSATIONS)).count() <= 2
