"""License scans: notices whose mandatory wording stands in a text word for word.

A template is wording with marked regions, as license lists publish them:

``<<beginOptional>> … <<endOptional>>``  wording that may be absent; regions nest
``<<var;m;n>>``                          any m to n words
``<<alt;a b|c>>``                        one of several wordings

It is compiled to an automaton over words: an arc asks for one word, or for any word inside
a replaceable region. Words of a text are read once. The automaton holds all places where a
template may have begun at the same time and is made deterministic as it is needed, so the
work per word does not depend on the wording. A text that lacks one of the mandatory runs of
words cannot be accepted, which a byte search tells before the automaton starts.

Each text is judged on its own inside a task: no shuffle, no broadcast but the templates.

Defined results: null and empty texts have no words, places or matches and score 0; long
texts are read whole; of overlapping matches of one template the one that ends first counts,
from the nearest place where it can begin; regions at the edges of a template are left out
of the span; each row of a repeated document is reported; an empty table gives no rows.
Further columns are ignored, whatever their names.
"""

import re

import pyarrow as pa

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.words import alnum_words

#: Phrases that name a license.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

#: Wording of public licenses and of the notices that point to them.
TEMPLATES = {
    "apache-2.0-notice": """<<beginOptional>>Copyright <<var;1;20>><<endOptional>> Licensed under the Apache License,
        Version 2.0 <<beginOptional>>(the "License"); you may not use this file except in compliance with the
        License.<<endOptional>>""",
    "bsd-grant": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<var;0;2>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer. <<var;0;2>> Redistributions in
        binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.""",
    "cc-by-nc-4.0-notice": """<<alt;licensed|released|distributed|available>> under <<beginOptional>><<alt;a|the
        terms of the|the>><<endOptional>> <<alt;CC BY-NC 4.0|Creative Commons Attribution-NonCommercial 4.0>>
        <<beginOptional>>International License<<endOptional>>""",
    "gpl-grant": """is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU <<beginOptional>>Lesser<<endOptional>>
        General Public License as published by the Free Software Foundation, either version <<var;1;2>> of the
        License, or <<beginOptional>>(at your option)<<endOptional>> any later version.""",
    "gpl-3.0-notice": """<<alt;licensed|released|distributed|available>> under the <<beginOptional>>terms of the
        <<endOptional>> GNU General Public License<<beginOptional>>,<<endOptional>> <<alt;version 3|v3|3>>""",
    "isc-grant": """Permission to use, copy, modify, <<beginOptional>>and/or<<endOptional>> distribute this software
        for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    "mit-grant": """<<beginOptional>>Copyright <<var;1;20>><<endOptional>> Permission is hereby granted, free of
        charge, to any person obtaining a copy of <<var;1;12>> to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next
        paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.""",
    "mit-notice": """<<alt;licensed|released|distributed|available>> under the <<beginOptional>>terms of the
        <<endOptional>> MIT License""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

_MAX_STATES = 20_000
_BEGIN = frozenset([0])
_RESULT = ("doc_id {doc_id}, n_words long, places array<struct<label:string,word:long>>,"
           " matches array<struct<label:string,start:long,stop:long>>, score double")


def parse(markup):
    """A template as nested items: ``word``, ``("opt", items)``, ``("any", m, n)``, ``("alt", [items])``."""
    items, rest = _items(markup)
    if rest:
        raise ValueError(f"unexpected end of a region: {rest[:40]!r}")
    return items


def _items(markup, closing=None):
    items = []
    while markup:
        if closing and markup.startswith(closing):
            return items, markup
        if markup.startswith("<<endOptional>>"):
            return items, markup
        if markup.startswith("<<beginOptional>>"):
            inner, markup = _items(markup[len("<<beginOptional>>"):], "<<endOptional>>")
            if not markup:
                raise ValueError("a region is not closed")
            markup = markup[len("<<endOptional>>"):]
            if inner:  # a region of punctuation alone has no words
                items.append(("opt", inner))
        elif m := re.match(r"<<var;(\d+);(\d+)>>", markup):
            low, high = int(m[1]), int(m[2])
            if not 0 <= low <= high:
                raise ValueError(f"no such number of words: {m[0]}")
            items.append(("any", low, high))
            markup = markup[m.end():]
        elif markup.startswith("<<alt;"):
            choices, markup = [], markup[len("<<alt;"):]
            while True:
                plain = re.match(r"[^<>|]*", markup)
                choices.append(alnum_words(plain[0]))
                markup = markup[plain.end():]
                if markup.startswith(">>"):
                    break
                if not markup.startswith("|"):
                    raise ValueError("a choice is not closed")
                markup = markup[1:]
            items.append(("alt", choices))
            markup = markup[2:]
        else:
            plain = re.match(r"[^<]+|<", markup)
            items += alnum_words(plain[0])
            markup = markup[plain.end():]
    return items, markup


def _core(items):
    """Items without regions at the edges that may be empty: these never decide."""
    def empty(item):
        return isinstance(item, tuple) and (item[0] == "opt" or item[0] == "any" and item[1] == 0)
    while items and empty(items[0]):
        items = items[1:]
    while items and empty(items[-1]):
        items = items[:-1]
    return items


def mandatory(items):
    """What every accepted text holds, in order: choices of word runs, mostly of one run."""
    parts, run = [], []
    for item in [*items, None]:
        if isinstance(item, bytes):
            run.append(item)
            continue
        if run:
            parts.append([run])
            run = []
        if item and item[0] == "alt" and all(item[1]):
            parts.append(item[1])
    return parts


def _turned(items):
    """The same items for a text read from its end."""
    turn = {"opt": lambda x: ("opt", _turned(x[1])), "any": lambda x: x, "alt": lambda x: ("alt", [_turned(c) for c in x[1]])}
    return [x if isinstance(x, bytes) else turn[x[0]](x) for x in reversed(items)]


class Automaton:
    """Token automaton of one template; state 0 is the beginning."""

    def __init__(self, items):
        self._on_word, self._on_any = [{}], [set()]
        self.final = frozenset(self._add(items, {0}))
        if 0 in self.final:
            raise ValueError("a template needs mandatory wording")
        self._words = set().union(*self._on_word)
        self._searching, self._anchored = {}, {}

    def _new(self):
        self._on_word.append({})
        self._on_any.append(set())
        return len(self._on_word) - 1

    def _add(self, items, begin):
        """States reached from ``begin`` after the items."""
        for item in items:
            if isinstance(item, bytes):
                new = self._new()
                for s in begin:
                    self._on_word[s].setdefault(item, set()).add(new)
                begin = {new}
            elif item[0] == "opt":
                begin = begin | self._add(item[1], begin)
            elif item[0] == "alt":
                begin = set().union(*[self._add(choice, begin) for choice in item[1]])
            else:
                _, low, high = item
                out = set(begin) if low == 0 else set()
                for i in range(1, high + 1):
                    new = self._new()
                    for s in begin:
                        self._on_any[s].add(new)
                    begin = {new}
                    if i >= low:
                        out.add(new)
                begin = out
        return begin

    def _next(self, states, word, known, again):
        """Deterministic move, with ``again`` added to it; moves found are kept, a bounded number."""
        key = states, word if word in self._words else None
        out = known.get(key)
        if out is None:
            if len(known) > _MAX_STATES:
                known.clear()
            out = set(again)
            for s in states:
                out |= self._on_any[s]
                out |= self._on_word[s].get(word, set())
            known[key] = out = frozenset(out)
        return out

    def ends(self, words):
        """Places after which an occurrence is complete; the search begins anew behind each."""
        found, states = [], _BEGIN
        for i, word in enumerate(words, 1):
            states = self._next(states, word, self._searching, _BEGIN)
            if not self.final.isdisjoint(states):
                found.append(i)
                states = _BEGIN
        return found

    def first_end(self, words):
        """Words read until the first occurrence that begins at the first word is complete."""
        states = _BEGIN
        for i, word in enumerate(words, 1):
            states = self._next(states, word, self._anchored, ())
            if not self.final.isdisjoint(states):
                return i
        return None


class Template:
    def __init__(self, markup):
        items = _core(parse(markup))
        parts = mandatory(items)
        if not any(len(choices) == 1 for choices in parts):
            raise ValueError("a template needs mandatory wording")
        self._parts = [(min(map(len, choices)), [b" " + b" ".join(c) + b" " for c in choices]) for choices in parts]
        self._size = sum(n for n, _ in self._parts)
        self._forward, self._back = Automaton(items), Automaton(_turned(items))

    def share(self, joined):
        """Share of the mandatory words that stand in runs the text holds."""
        return sum(n for n, choices in self._parts if any(c in joined for c in choices)) / self._size

    def matches(self, words):
        """(start, stop) of the accepted places, not overlapping."""
        out, floor = [], 0
        for stop in self._forward.ends(words):
            out.append((stop - self._back.first_end(words[floor:stop][::-1]), stop))
            floor = stop
        return out


def phrase_places(joined, phrase):
    """Numbers of the words where a phrase begins, in words joined and enclosed by blanks."""
    needle, out, at, n, seen = b" " + b" ".join(phrase) + b" ", [], joined.find(b" " + b" ".join(phrase) + b" "), 0, 0
    while at >= 0:
        n += joined.count(b" ", seen, at)
        seen = at
        out.append(n)
        at = joined.find(needle, at + 1)
    return out


def scan_text(text, phrases, templates):
    """(number of words, phrase places, template matches, score) of one text.

    The score is 1 for an accepted template, else the largest share of a template's
    mandatory words the text holds in whole runs, at most 0.9, and at least 0.5 with a phrase.
    """
    words = alnum_words(text)
    if not words:
        return 0, [], [], 0.0
    joined = b" " + b" ".join(words) + b" "
    places = [(at, label) for label, phrase in phrases.items() for at in phrase_places(joined, phrase)]
    matches, best = [], 0.0
    for label, template in templates.items():
        share = template.share(joined)
        if share == 1.0:
            matches += [(a, label, b) for a, b in template.matches(words)]
        best = max(best, min(share, 0.9))
    score = 1.0 if matches else max(best, 0.5 if places else 0.0)
    return (len(words), [{"label": k, "word": at} for at, k in sorted(places)],
            [{"label": k, "start": a, "stop": b} for a, k, b in sorted(matches)], score)


def scan(docs, phrases=None, templates=None):
    """``doc_id``, number of words, places of the phrases, matches of the templates and a score, per row."""
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    for markup in templates.values():
        Template(markup)  # a faulty template fails here, not in a task
    schema = _RESULT.format(doc_id=docs.schema["doc_id"].dataType.simpleString())
    out = arrow_schema(schema)

    def judge(batches):
        wording = {k: alnum_words(v) for k, v in phrases.items()}
        compiled = {k: Template(v) for k, v in templates.items()}
        for batch in slices(batches):
            found = [scan_text(t, wording, compiled) for t in batch.column(1).to_pylist()]
            columns = list(zip(*found)) if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *to_batch(pa.schema(list(out)[1:]), columns).columns], schema=out)

    return docs.select("doc_id", "text").mapInArrow(judge, schema)
