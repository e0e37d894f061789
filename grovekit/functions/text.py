"""Text metrics and text cleaning on one column."""

from functools import reduce

from pyspark.sql import Column, functions as F

from grovekit.fixed import (
    LANGUAGE_ALIASES, LANGUAGES, PYTHON_WHITESPACE,
)

PERMISSIVE_LICENSES = ("MIT", "Apache-2.0", "BSD")

# First phrase found names the licence.
LICENSE_PHRASES = (
    ("MIT License", "MIT"),
    ("Apache License, Version 2", "Apache-2.0"),
    ("BSD", "BSD"),
    ("GNU General Public License", "GPL"),
    ("CC BY-NC", "CC-BY-NC"),
)


def _col(column):
    return column if isinstance(column, Column) else F.col(column)


def let(value, body):
    """``body`` applied to ``value``, which is evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def python_strip(column):
    """What ``str.strip()`` leaves."""
    return F.btrim(_col(column), F.lit(PYTHON_WHITESPACE))


def lines(column):
    """Pieces between newlines; trailing empty pieces are kept."""
    return F.split(_col(column), "\n", -1)


def count_literal(column, literal):
    """Non-overlapping occurrences of a literal."""
    text = _col(column)
    removed = F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))
    return removed if len(literal) == 1 else _int_div(removed, F.lit(len(literal)))


def line_count_raw(column):
    """Number of pieces between newlines."""
    return (count_literal(column, "\n") + 1).cast("int")


def total_line_chars(column):
    """Characters outside newlines."""
    return F.length(F.replace(_col(column), F.lit("\n"), F.lit("")))


def avg_line_length_raw(column):
    """Mean length of the pieces between newlines, blank ones counted."""
    return total_line_chars(column) / line_count_raw(column)


def half_up_mean(total, count):
    """``total / count`` to two digits, ties away from zero, in integer arithmetic."""
    total, count = total.cast("bigint"), count.cast("bigint")
    return F.when(count == 0, F.lit(0.0)).otherwise(
        _int_div(200 * total + count, F.greatest(2 * count, F.lit(1))) / F.lit(100.0)
    )


def _int_div(a, b):
    return F.call_function("div", a, b)


def has_continuation(column):
    """Some line ends in a backslash."""
    text = _col(column)
    return text.contains("\\\n") | text.endswith("\\")


def _closed_metrics(stripped):
    # Of k blank lines in a row every second one survives: one goes per "\n\n" pair.
    newlines = count_literal(stripped, "\n")
    dropped = count_literal(stripped, "\n\n")
    return F.struct(
        (F.length(stripped) - newlines).cast("bigint").alias("total"),
        (newlines + 1 - dropped).cast("bigint").alias("count"),
    )


def _folded_metrics(stripped):
    # State of the fold: kept lines, their characters, length of the last kept line,
    # and whether the next line is passed over because the list has just shrunk.
    return let(lines(stripped), _folded_lines)


def _folded_lines(pieces):
    first, n = F.element_at(pieces, 1), F.size(pieces)
    leads = first.endswith("\\")
    doubled = (2 * F.length(first) - 1).cast("bigint")
    fresh = F.struct(
        F.lit(0).cast("bigint").alias("count"), F.lit(0).cast("bigint").alias("total"),
        F.lit(0).cast("bigint").alias("top"), F.lit(False).alias("passed"),
    )
    merged = F.struct(
        F.lit(1).cast("bigint").alias("count"), doubled.alias("total"),
        doubled.alias("top"), F.lit(False).alias("passed"),
    )

    def step(state, line):
        size = F.length(line).cast("bigint")
        twice = 2 * size - 1
        keep = F.struct(
            (state["count"] + 1).alias("count"), (state["total"] + size).alias("total"),
            size.alias("top"), F.lit(False).alias("passed"),
        )
        blank = F.struct(
            state["count"].alias("count"), state["total"].alias("total"),
            state["top"].alias("top"), F.lit(True).alias("passed"),
        )
        merge = F.struct(
            state["count"].alias("count"), (state["total"] - state["top"] + twice).alias("total"),
            twice.alias("top"), F.lit(True).alias("passed"),
        )
        return (
            F.when(state["passed"], keep)
            .when(size == 0, blank)
            .when(line.endswith("\\"), merge)
            .otherwise(keep)
        )

    # A leading continuation takes the last line of the text with it.
    body = F.when(leads, F.slice(pieces, 2, F.greatest(n - 2, F.lit(0)))).otherwise(pieces)
    start = F.when(leads & (n == 1), fresh).when(leads, merged).otherwise(fresh)
    return F.aggregate(
        body, start, step,
        lambda state: F.struct(state["total"].alias("total"), state["count"].alias("count")),
    )


def _corrected_metrics(stripped):
    joined = F.replace(stripped, F.lit("\\\n"), F.lit(""))
    squeezed = F.btrim(F.regexp_replace(joined, "\n+", "\n"), F.lit("\n"))
    return let(squeezed, lambda text: F.struct(
        F.length(F.replace(text, F.lit("\n"), F.lit(""))).cast("bigint").alias("total"),
        (count_literal(text, "\n") + 1).cast("bigint").alias("count"),
    ))


def clean_metrics(column, mode="reference"):
    """``(avg_line_length, line_count)`` of the stripped text without blank lines.

    ``reference`` keeps every second line of a blank run and doubles a line that ends in
    a backslash in place of the line before it; ``corrected`` drops all blank lines and
    joins continuation lines. Only texts with a continuation pay for the fold.
    """
    if mode not in ("reference", "corrected"):
        raise ValueError(f"unknown mode: {mode}")

    def counted(stripped):
        if mode == "corrected":
            return _corrected_metrics(stripped)
        return F.when(has_continuation(stripped), _folded_metrics(stripped)).otherwise(
            _closed_metrics(stripped)
        )

    none = F.lit(0).cast("bigint")
    nothing = F.struct(none.alias("total"), none.alias("count"))
    counts = let(python_strip(column), lambda s: F.when(s == "", nothing).otherwise(counted(s)))
    return let(counts, lambda c: F.struct(
        half_up_mean(c["total"], c["count"]).alias("avg_line_length"),
        c["count"].cast("int").alias("line_count"),
    ))


def contains_any(column, substrings):
    """True where the text holds one of the literal substrings; null counts as no."""
    hits = [_col(column).contains(s) for s in substrings]
    return F.coalesce(reduce(lambda a, b: a | b, hits, F.lit(False)), F.lit(False))


def drop_lines_containing(column, substrings):
    """Text without the lines that hold one of the substrings; null stays null."""
    text = _col(column)
    if not substrings:
        return text
    kept = F.filter(lines(text), lambda line: ~contains_any(line, substrings))
    return F.when(contains_any(text, substrings), F.array_join(kept, "\n")).otherwise(text)


def replace_literal(column, old, new=""):
    """Literal replacement; an empty ``old`` changes nothing."""
    text = _col(column)
    return F.replace(text, F.lit(old), F.lit(new)) if old else text


def normalize_text(column):
    """Without byte order marks, control characters, trailing blanks and long blank runs."""
    text = F.translate(_col(column), "﻿", "")
    text = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def license_label(column, phrases=LICENSE_PHRASES):
    """Name of the first licence phrase of the table found in the text, else ``none``."""
    label = F.lit("none")
    for phrase, name in reversed(phrases):
        label = F.when(_col(column).contains(phrase), F.lit(name)).otherwise(label)
    return label


def normalize_language(column, aliases=None):
    """One spelling per language."""
    language = _col(column)
    result = language
    for variant, name in (aliases or LANGUAGE_ALIASES).items():
        result = F.when(language == variant, F.lit(name)).otherwise(result)
    return result


def invalid_reason(language, code, languages=LANGUAGES):
    """Why a row cannot be converted; null for a usable row."""
    name = normalize_language(language)
    return (
        F.when(F.coalesce(_col(language), F.lit("")) == "", F.lit("language missing"))
        .when(F.coalesce(_col(code), F.lit("")) == "", F.lit("code missing"))
        .when(~name.isin(*languages), F.lit("language unsupported"))
    )


def source_hash(column):
    """SHA-256 of the UTF-8 text."""
    return F.sha2(F.encode(_col(column), "UTF-8"), 256)


_SUMMED_AT_ONCE = 256


def running_totals(numbers):
    """Sum of what stands before each number of a list.

    Sums are taken inside blocks and over blocks, so that no list grows number by number.
    """
    def summed(block, start):
        return F.aggregate(block, F.array(start), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))

    def of_blocks(blocks):
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, n: a + n))
        return F.flatten(F.zip_with(blocks, summed(totals, F.lit(0)), lambda block, start: F.coalesce(
            F.slice(summed(block, start), 1, F.size(block)), F.array().cast("array<int>"))))

    def of_list(listed):
        firsts = F.when(F.size(listed) > 0, F.sequence(F.lit(1), F.size(listed), F.lit(_SUMMED_AT_ONCE))).otherwise(
            F.array().cast("array<int>"))
        return F.get(F.transform(F.array(F.transform(firsts, lambda i: F.slice(listed, i, _SUMMED_AT_ONCE))), of_blocks), 0)

    return F.when(numbers.isNotNull(), F.get(F.transform(F.array(numbers), of_list), 0))


def line_offsets(column):
    """Character offset of every line start."""
    return running_totals(F.transform(lines(column), lambda line: F.length(line) + 1))


def error_count(column):
    """Occurrences of ``(ERROR)`` in a tree dump."""
    return count_literal(column, "(ERROR)").cast("int")


def dump_node_count(column):
    """Nodes of a tree dump: one per line."""
    return line_count_raw(column)


def int_or_zero(column):
    return F.coalesce(_col(column).cast("int"), F.lit(0))


def double_or_zero(column):
    return F.coalesce(_col(column).cast("double"), F.lit(0.0))


def status_label(column):
    return F.upper(_col(column))
