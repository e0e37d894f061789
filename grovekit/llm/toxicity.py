"""Toxicity by a learned lexicon, matched through spelling variants and read in context.

Learning. Of at most ``rows`` labelled documents, chosen by hash, those that hold a word, and
those that hold a word with a given stem, are counted by label. Words and stems that speak
for the label are candidates, all of them; on at most ``sample`` toxic ones the smallest set that explains
them is picked greedily, so that words which merely stand beside a toxic term drop out. Only the bounds of
labelled rows limit the lexicon. Texts stay in the tasks: the driver gets which candidates a toxic row holds, as numbers.

Matching. The trie of the lexicon is intersected with the Levenshtein automaton of distance
one; the result is made deterministic as words are read, so a word costs a few table lookups
and almost all die after some letters.

Context. A hit is quoted if quotation marks open before it and close after it within
``CONTEXT`` words. Hits on entries that are
almost always toxic, other hits and varied spellings, each plain or quoted, are four signs;
how often each combination is toxic is learned from the same rows and smoothed towards the
sum of the single signs. A text without signs is never predicted toxic, whatever few labels say: its rate stays below one half.

Scores depend on the text alone. Defined results: null and empty texts have no signs and get
the learned rate of texts without signs; labels without a document, null labels and null ids teach
nothing; of several labels of an id the highest counts; without any labelled row all scores
are 0; an empty table gives no rows. A column named like ``name`` is replaced.
"""

import heapq
import math
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.session import staged

ROWS = 100_000
SAMPLE = 5_000
CONTEXT = 8
FOLDS = 5
_STEMS = range(4, 8)
_LEAST_DOCUMENTS = 5
_LEAST_LOG_ODDS = 2.0
_SURE = 0.85
_VARIED_LENGTH = 5
_LETTERS = re.compile(r"[^\W\d_]+")
_OPENING, _CLOSING = "\"“„«‚‘'", "\"”“»’'"
_KNOWN_WORDS = 400_000
_STATES = 200_000


def held_out(doc_id):
    """True for ids whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


class Matcher:
    """2 for a word that is or starts with a sure entry, 1 for one with another entry or one letter off a sure term, else 0."""

    def __init__(self, entries):
        self._next, self._term, self._stem, self._varied = [{}], [0], [0], [False]
        for text, stem, sure in entries:
            node = self._insert(text)
            (self._stem if stem else self._term)[node] = 1 + sure
            self._varied[node] |= not stem and sure and len(text) >= _VARIED_LENGTH
        self._reset()

    def _insert(self, text):
        node = 0
        for c in text:
            if c not in self._next[node]:
                self._next[node][c] = len(self._next)
                self._next.append({})
                for flags in (self._term, self._stem, self._varied):
                    flags.append(0)
            node = self._next[node][c]
        return node

    def _reset(self):
        self._known, self._ids, self._states, self._steps = {}, {}, [], []
        self._start = self._state(frozenset({(0, 0)}))

    def _state(self, pairs):
        """State of the determinized automaton: trie nodes with the errors made so far."""
        full = set(pairs)
        for node, errors in pairs:
            if not errors:  # a letter of the term is missing in the word
                full.update((child, 1) for child in self._next[node].values())
        full = frozenset(p for p in full if p[1] == 0 or (p[0], 0) not in full)
        if full not in self._ids:
            self._ids[full] = len(self._states)
            whole = max((self._term[n] for n, e in full if not e), default=0)
            varied = int(any(self._varied[n] for n, e in full if e))
            self._states.append((full, max(whole, varied), max((self._stem[n] for n, e in full if not e), default=0)))
            self._steps.append({})
        return self._ids[full]

    def _step(self, state, c):
        after = set()
        for node, errors in self._states[state][0]:
            child = self._next[node].get(c)
            if child is not None:
                after.add((child, errors))
            if not errors:  # a letter too many, or another one
                after.add((node, 1))
                after.update((x, 1) for x in self._next[node].values())
        return self._state(frozenset(after)) if after else -1

    def __call__(self, word):
        found = self._known.get(word)
        if found is None:
            if len(self._known) > _KNOWN_WORDS or len(self._states) > _STATES:
                self._reset()
            state, found, stem = self._start, 0, 0
            for c in word:
                steps = self._steps[state]
                if c not in steps:
                    steps[c] = self._step(state, c)
                state = steps[c]
                if state < 0:
                    break
                stem = max(stem, self._states[state][2])
            else:
                found = self._states[state][1]
            found = self._known[word] = max(found, stem)
        return found


@lru_cache(maxsize=4)
def _matcher(entries):
    return Matcher(entries)


def signs(text, match):
    """Bits of the kinds of hits in a text (sure 1, weak 2, sure quoted 4, weak quoted 8) and their number."""
    bits = hits = 0
    words = _LETTERS.findall(text.lower()) if text else ()
    if not any(match(w) for w in set(words)):
        return 0, 0
    spans = [(m.start(), m.end()) for m in _LETTERS.finditer(text.lower())]
    low = text.lower()
    for i, (a, b) in enumerate(spans):
        kind = match(low[a:b])
        if kind:
            before = low[spans[max(0, i - CONTEXT)][0]:a]
            after = low[b:spans[min(len(spans) - 1, i + CONTEXT)][1]]
            quoted = any(before.count(o) % 2 and c in after if o == c else before.rfind(o) > before.rfind(c) and c in after
                         for o, c in zip(_OPENING, _CLOSING))
            bits |= (1 if kind == 2 else 2) << (2 * quoted)
            hits += 1
    return bits, hits


class Model:
    """Lexicon and rates; plain values, so it travels to the tasks whole. Its size is bounded by that of the labelled rows."""

    def __init__(self, entries=(), rates=None):
        self.entries = tuple(sorted(entries))  # (text, stem, sure)
        self.rates = rates or [0.0] * 16

    def score(self, text):
        bits, hits = signs(text, _matcher(self.entries))
        rate = self.rates[bits]
        # More hits move the score a little towards what their signs say.
        return rate if not 0 < rate < 1 or not hits else 1 / (1 + math.exp(-(
            math.log(rate / (1 - rate)) + math.copysign(0.2 * math.log1p(hits), rate - 0.5))))


def _labelled(docs, labels, rows):
    """Texts with their label, of at most ``rows`` labelled ids that are not held out, chosen by hash."""
    toxic = F.col("toxic").cast("int")
    known = labels.where(F.col("doc_id").isNotNull() & toxic.isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(toxic).alias("toxic"))
    sieve = max(1, known.count() // rows)
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(sieve)) == 0).orderBy(F.xxhash64(F.lit("drawn"), "doc_id")).limit(rows)
    # At most ``rows`` pairs of numbers, so texts need not move to meet their labels.
    texts = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    return staged(texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "toxicity-labelled")


def _counts(rows):
    """Documents by label that hold each word or stem; combined in the tasks before they are shuffled."""
    ddl = "entry string, stem boolean, toxic long, clean long"
    schema = arrow_schema(ddl)

    def count(batches):
        found = defaultdict(lambda: [0, 0])

        def flush():
            items = list(found.items())
            for i in range(0, len(items), 50_000):
                some = items[i:i + 50_000]
                yield to_batch(schema, [[e for (e, _), _ in some], [s for (_, s), _ in some], [c[1] for _, c in some], [c[0] for _, c in some]])
            found.clear()

        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = {w for w in _LETTERS.findall((text or "").lower()) if len(w) > 2}
                for w in words:
                    found[w, False][toxic] += 1
                for s in {w[:n] for w in words for n in _STEMS if len(w) > n}:
                    found[s, True][toxic] += 1
            if len(found) > 300_000:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(count, ddl).groupBy("entry", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _holds(texts, candidates):
    """For each text the numbers of the candidates it holds."""
    ddl = "held array<int>"
    schema = arrow_schema(ddl)
    words = {c[0]: i for i, c in enumerate(candidates) if not c[1]}
    stems = {c[0]: i for i, c in enumerate(candidates) if c[1]}

    def find(batches):
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                own = set(_LETTERS.findall((text or "").lower()))
                out.append([words[w] for w in own if w in words] + list(
                    {stems[w[:n]] for w in own for n in _STEMS if len(w) > n and w[:n] in stems}))
            yield to_batch(schema, [out])

    return texts.mapInArrow(find, ddl)


def _choose(candidates, held):
    """Greedy cover of the rows (numbers of candidates each) by entries, weighed by how rarely they are found in clean documents."""
    holds = defaultdict(set)
    for d, numbers in enumerate(held):
        for i in numbers:
            holds[i].add(d)
    open_, chosen = set(range(len(held))), []

    def place(i, gain):  # greatest gain first, then the shortest entry, then the last in the alphabet
        return -gain, len(candidates[i][0]), [-ord(c) for c in candidates[i][0]], not candidates[i][1], i

    heap = [place(i, len(s) * candidates[i][2]) for i, s in holds.items()]
    heapq.heapify(heap)
    while heap:
        gain, *_, i = heapq.heappop(heap)
        fresh = len(holds[i] & open_) * candidates[i][2]
        if fresh < -gain:  # what others have explained meanwhile no longer counts
            if fresh >= _LEAST_DOCUMENTS / 2:
                heapq.heappush(heap, place(i, fresh))
            continue
        chosen.append((*candidates[i][:2], candidates[i][2] >= _SURE))
        open_ -= holds[i]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, rows=ROWS, sample=SAMPLE) -> Model:
    """Model learned from at most ``rows`` labelled documents that are not held out."""
    rows = _labelled(docs, labels, rows)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic + clean:
        return Model()
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    purity = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    top = (
        _counts(rows).where((F.col("toxic") >= _LEAST_DOCUMENTS) & (odds >= _LEAST_LOG_ODDS))
        .select("entry", "stem", purity.alias("purity")).orderBy("entry", "stem").collect()
    )
    sieve = max(1, toxic // sample)
    # Equal texts would make the words of one text look like terms.
    texts = (
        rows.where((F.col("toxic") == 1) & (F.pmod(F.xxhash64("text"), F.lit(sieve)) == 0)).select("text").distinct()
        .orderBy(F.xxhash64("text")).limit(sample)
    )
    candidates = [(r["entry"], r["stem"], r["purity"]) for r in top]
    entries = _choose(candidates, [r["held"] for r in _holds(texts, candidates).collect()])
    return Model(entries, _rates(rows, Model(entries)))


def _rates(rows, model):
    """Share of toxic rows for each combination of signs, smoothed towards the sum of single signs."""
    ddl = "bits int, toxic long, clean long"
    schema = arrow_schema(ddl)
    entries = model.entries

    def count(batches):
        cells = np.zeros((16, 2), np.int64)
        match = _matcher(entries)
        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                cells[signs(text, match)[0], toxic] += 1
        yield to_batch(schema, [list(range(16)), cells[:, 1], cells[:, 0]])

    n = np.zeros((16, 2))
    for r in rows.mapInArrow(count, ddl).groupBy("bits").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).collect():
        n[r["bits"]] = r["c"], r["t"]
    total = n.sum(axis=0)
    rates = []
    for bits in range(16):
        logit = math.log((total[1] + 0.5) / (total[0] + 0.5))
        for k in range(4):
            has = [b for b in range(16) if (b >> k & 1) == (bits >> k & 1)]
            seen = n[has].sum(axis=0)
            logit += math.log((seen[1] + 0.5) / (total[1] + 1)) - math.log((seen[0] + 0.5) / (total[0] + 1))
        expected = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
        rates.append(float((n[bits][1] + 2 * expected) / (n[bits].sum() + 2)))
    # Else two labels, one of them toxic, would have the pipeline reject every document.
    rates[0] = min(rates[0], 0.49)
    return rates


def score(docs: DataFrame, model: Model, text_column="text", name="score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in ``name``."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, scored(F.col(text_column).cast("string")))
