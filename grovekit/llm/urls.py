"""URL filter: rules first, then a naive Bayes verdict on segmented hosts and paths.

Host names run words together. They are cut by a unigram Viterbi search: of all ways to
write a name as words, the one with the highest product of word probabilities wins, unknown
stretches being charged by length; of equal ways the one with the longest last word is taken. Word
frequencies come from the visible words of all pages; the substrings of the distinct names are looked up
by a join, long words by their beginning, so vocabulary, words and names may have any size and none is gathered. A multinomial naive Bayes model over the words of host
and path is learned from all urls that a rule decides, and judges the others.

Names, paths and tokens are counted once each with their frequency, and scores are joined
back to the urls, so a host that a third of all pages share is one row until then.

Defined results: a null url or one without ``://`` has an empty host and path and no tokens, and gets the
more frequent verdict (allow on a tie or without any decided url); repeated rows are judged
alike; an empty table gives no rows. Further columns are ignored.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.session import staged

ALLOW, BLOCK = "allow", "block"
#: (rule, verdict): host, and the start of the path.
RULES = (("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK))
_KEY = 20  # letters by which a word is looked up
_SMOOTHING = 1.0
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _folded(column):
    return F.translate(column, *_LOWER)


def split_urls(pages, url_column="url"):
    """``pages`` with host and path."""
    def part(i):
        return F.coalesce(F.regexp_extract(F.col(url_column).cast("string"), _PARTS, i), F.lit(""))

    return pages.withColumn("host", _folded(part(1))).withColumn("path", part(2))


def with_rule(urls, rules=RULES):
    """Adds the rule that fits and is longest, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # a longer one overrides
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit("/" + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("ruled", verdict)


def word_counts(texts: DataFrame, column) -> DataFrame:
    """Frequencies of the words in the visible text of pages: word, n."""
    visible = F.regexp_replace(F.regexp_replace(F.col(column).cast("string"), r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")
    words = F.explode(F.regexp_extract_all(F.lower(visible), F.lit(r"\p{L}+"), F.lit(0)))
    return texts.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def segment(name, counts, total):
    """Words of ``name`` of the highest unigram probability; ``counts`` has those of its substrings that are known."""
    log_total, letter = math.log(total + 1), math.log(10)
    lengths = sorted({len(w) for w in counts}, reverse=True)
    best, cut = [0.0], [0]
    opening = 0  # the start from which an unknown stretch is cheapest
    for end in range(1, len(name) + 1):
        if best[end - 1] + (end - 1) * letter > best[opening] + opening * letter:
            opening = end - 1
        # An unknown stretch is as rare as a word never seen, and ten times rarer per letter.
        way = (best[opening] - log_total - (end - opening) * letter, opening)
        for k in lengths:
            n = counts.get(name[end - k:end]) if k <= end else None
            if n and best[end - k] + math.log(n) - log_total > way[0]:
                way = (best[end - k] + math.log(n) - log_total, end - k)
        best.append(way[0])
        cut.append(way[1])
    words, end = [], len(name)
    while end:
        words.append(name[cut[end]:end])
        end = cut[end]
    return words[::-1]


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``names`` (name) with their words, by a join of their substrings with ``counts`` (word, n)."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    n = F.length("name")
    names = names.where(n > 0)
    starts = names.select("name", F.explode(F.sequence(F.lit(1), n)).alias("i"))
    pieces = starts.select("name", "i", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.lit(_KEY), n - F.col("i") + 1)), lambda k: F.substr("name", F.col("i"), k))).alias("key"))
    keyed = counts.withColumn("key", F.substring("word", 1, _KEY))
    # A longer word begins with its key; the rest of it must follow in the name.
    fits = (F.length("word") <= _KEY) | (F.substr("name", F.col("i"), F.length("word")) == F.col("word"))
    known = pieces.join(keyed, "key").where(fits).groupBy("name").agg(
        F.map_from_entries(F.collect_set(F.struct("word", "n"))).alias("known"))
    ddl = "name string, words array<string>"
    schema = arrow_schema(ddl)

    def cut(batches):
        for batch in slices(batches):
            found, known = batch.column("name").to_pylist(), batch.column("known").to_pylist()
            yield to_batch(schema, [found, [segment(x, dict(k or ()), total) for x, k in zip(found, known)]])

    return names.join(known, "name", "left").mapInArrow(cut, ddl)


def _tokens(urls, counts):
    """Distinct hosts and paths with their tokens: kind, part, token."""
    hosts = urls.select("host").distinct()
    labels = hosts.select("host", F.explode(F.split("host", r"[^\p{L}]+")).alias("name")).where("name <> ''")
    words = staged(segment_names(labels.select("name").distinct(), counts), "url-names")
    of_hosts = labels.join(words, "name").select(F.lit("h").alias("kind"), F.col("host").alias("part"), F.explode("words").alias("token"))
    paths = urls.select("path").distinct()
    of_paths = paths.select(F.lit("p").alias("kind"), F.col("path").alias("part"),
                            F.explode(F.split(F.lower("path"), r"[^\p{L}\p{N}]+")).alias("token")).where("token <> ''")
    return of_hosts.unionByName(of_paths)


def judge(pages: DataFrame, rules=RULES, url_column="url", text_column="html") -> DataFrame:
    """page_id, host, path, rule, verdict, and score (log odds of block) of every url."""
    urls = staged(with_rule(split_urls(pages, url_column), rules).select("page_id", "host", "path", "rule", "ruled"), "urls")
    counts = staged(word_counts(pages, text_column), "url-words")
    tokens = staged(_tokens(urls, counts), "url-tokens")
    decided = urls.where("ruled is not null")
    prior = {r["ruled"]: r["n"] for r in decided.groupBy("ruled").agg(F.count("*").alias("n")).collect()}
    bias = math.log((prior.get(BLOCK, 0) + _SMOOTHING) / (prior.get(ALLOW, 0) + _SMOOTHING))
    blocked = F.sum((F.col("ruled") == BLOCK).cast("long")).alias("blocked")
    by_part = (
        decided.groupBy(F.lit("h").alias("kind"), F.col("host").alias("part")).agg(F.count("*").alias("n"), blocked)
        .unionByName(decided.groupBy(F.lit("p").alias("kind"), F.col("path").alias("part")).agg(F.count("*").alias("n"), blocked))
    )
    seen = staged(
        tokens.join(by_part, ["kind", "part"]).groupBy("kind", "token").agg(
            F.sum("blocked").alias("blocked"), F.sum(F.col("n") - F.col("blocked")).alias("allowed")), "url-token-counts")
    # Hosts and paths have a vocabulary and totals of their own.
    totals = {r["kind"]: r for r in seen.groupBy("kind").agg(
        F.sum("blocked").alias("b"), F.sum("allowed").alias("a"), F.count("*").alias("v")).collect()}
    weight = F.lit(0.0)
    for kind, t in totals.items():
        weight = F.when(F.col("kind") == kind, F.log((F.col("blocked") + _SMOOTHING) / (t["b"] + _SMOOTHING * t["v"]))
                        - F.log((F.col("allowed") + _SMOOTHING) / (t["a"] + _SMOOTHING * t["v"]))).otherwise(weight)
    # A sum in fixed point does not depend on the order of its parts.
    weights = seen.select("kind", "token", F.round(weight * 1e9).cast("long").alias("w"))
    scores = staged(tokens.join(weights, ["kind", "token"]).groupBy("kind", "part").agg(F.sum("w").alias("w")), "url-scores")

    def of(kind, column):
        return scores.where(F.col("kind") == kind).select(F.col("part").alias(column), F.col("w").alias(f"w_{column}"))

    score = (F.coalesce("w_host", F.lit(0)) + F.coalesce("w_path", F.lit(0))) / 1e9 + bias
    return urls.join(of("h", "host"), "host", "left").join(of("p", "path"), "path", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(score > 0, BLOCK).otherwise(ALLOW)).alias("verdict"), score.alias("score"))
