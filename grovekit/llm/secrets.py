"""Secrets by fixed patterns and by a battery of randomness tests; DataFrame functions only.

Fixed patterns: assignments to names such as ``password``, access keys, and long hexadecimal
runs. Battery: every run of ``LEAST`` or more characters of an encoding (hexadecimal, base 32,
base 64) is tested for a uniform alphabet (chi-squared), for runs above and below the middle
of the alphabet, and for serial correlation of neighbours; the p-values are combined by
Fisher's method into one p, near 0 for words and uniform for random strings.

A string is reported when the battery does not refuse that it is random and it is a discovery
against the other reading, that it was written with the letters of ordinary text. How near to
uniform letters of text come by chance follows from their frequencies over all documents, outside
of candidates, and from the length of the string: the moments of the chi-squared statistic under
a multinomial law are exact, so short strings, which tell less, get larger p-values.
False discoveries among the candidates of an encoding are held at ``RATE`` by the procedure of
Benjamini and Hochberg on these p-values, counted in steps of an eighth of a power of two
and rounded up. It needs no least number of candidates, and any number will do.

Texts are read once; what is kept of them are spans and candidates. Defined results: a null
text is empty and has no spans; very long texts and texts of many matches are read whole, in
time that grows with them; repeated rows are judged alike; a candidate that overlaps a fixed span is not
reported again; equal p-values are reported or left out together; an empty table gives no
rows. Further columns are ignored.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.functions.text import running_totals
from grovekit.session import staged

#: Kinds in the order in which ties are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a whole run, as runs are taken from their first character on
LEAST = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}"
RATE = 0.05
#: The battery refuses that a string is random below this p.
REFUSED = 0.01
_STEPS = 8  # per power of two of a p-value
#: Encoding: what its strings look like, its alphabet, and the letters of it that texts are written with.
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", "abcdef"),
    "base32": (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^[A-Za-z0-9+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz"),
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _located(text, pattern, check_group=None, least=0):
    """Matches of ``pattern`` from left to right with their places, if ``check_group`` has ``least`` characters."""
    def matches(group):
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    whole = matches(0)
    checked = whole if check_group is None else matches(check_group)
    # What stands between the matches tells where they are.
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def placed(gaps, whole, checked):
        before = running_totals(F.zip_with(F.slice(gaps, 1, F.size(whole)), whole, lambda g, v: g + F.length(v)))
        found = F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("value"), checked.alias("checked"), before.alias("before")),
                         lambda x: F.length(x["checked"]) >= least)
        return F.transform(found, lambda x: F.struct(
            (x["before"] + x["gap"]).cast("long").alias("start"),
            (x["before"] + x["gap"] + F.length(x["value"])).cast("long").alias("end"), x["value"].alias("value")))

    # Each list is made once, however often it is used.
    lists = F.array(F.struct(gaps.alias("gaps"), whole.alias("whole"), checked.alias("checked")))
    spans = F.get(F.transform(lists, lambda x: placed(x["gaps"], x["whole"], x["checked"])), 0)
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(_SPANS))


def _labelled(spans, kind):
    return F.transform(spans, lambda x: F.struct(x["start"], F.lit(KINDS.index(kind)).alias("rank"), x["end"], x["value"]))


def _scanned(docs, least):
    """One row per document with its fixed spans, its candidates, and how often it has each letter outside of them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    fixed = F.array_sort(F.concat(
        _labelled(_located(F.col("text"), ASSIGN, 2, 6), "assign"), _labelled(_located(F.col("text"), ACCESS, 0, 20), "access"),
        _labelled(_located(F.col("text"), HEX), "hex")))
    plain = F.lower(F.regexp_replace("text", CANDIDATE % least, " "))
    read = read.select("doc_id", fixed.alias("fixed"), _located(F.col("text"), CANDIDATE % least).alias("runs"), plain.alias("plain"))

    def candidate(r):
        name = F.lit(None).cast("string")
        for encoding in reversed(ENCODINGS):
            name = F.when(F.rlike(r["value"], F.lit(ENCODINGS[encoding][0])), encoding).otherwise(name)
        return F.struct(r["start"], r["end"], r["value"], name.alias("encoding"))

    # Digits alone are numbers, which look random whatever they say.
    words = F.filter("runs", lambda r: ~F.rlike(r["value"], F.lit(r"^[0-9_+/-]+$")))
    letters = F.array(*[(F.length("plain") - F.length(F.replace("plain", F.lit(c), F.lit("")))).cast("long") for c in _LETTERS])
    return read.select(
        F.monotonically_increasing_id().alias("key"), "doc_id", "fixed", F.transform(words, candidate).alias("runs"), letters.alias("letters"))


def _free_runs(scanned):
    """Candidates that overlap no fixed span, a row each; spans are met in order, so their number does not matter."""
    def event(x, run):
        return F.struct(x["start"], x["end"], (x["value"] if run else F.lit(None).cast("string")).alias("value"),
                        (x["encoding"] if run else F.lit(None).cast("string")).alias("encoding"))

    events = F.concat(F.transform("runs", lambda x: event(x, True)), F.transform("fixed", lambda x: event(x, False)))
    rows = scanned.where(F.size("runs") > 0).select("key", F.explode(events).alias("e")).select("key", "e.*")
    fixed = F.col("encoding").isNull()
    before = Window.partitionBy("key").orderBy("start", F.desc(fixed))
    after = Window.partitionBy("key").orderBy(F.desc("start"), fixed)
    rows = rows.withColumn("reached", F.max(F.when(fixed, F.col("end"))).over(before)).withColumn(
        "next", F.min(F.when(fixed, F.col("start"))).over(after))
    clear = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    return rows.where(~fixed & clear).drop("reached", "next")


def _text_moments(scanned):
    """Per encoding the sums of squares and cubes of the letter frequencies of text, one added to each count."""
    counts = scanned.agg(*[F.sum(F.get("letters", i)).alias(c) for i, c in enumerate(_LETTERS)])

    def power_sum(letters, power):
        held = [F.coalesce(F.col(c), F.lit(0)) + 1.0 for c in letters]
        return sum(F.pow(x, F.lit(power)) for x in held) / F.pow(sum(held), F.lit(power))

    rows = F.array(*[F.struct(F.lit(name).alias("encoding"), F.lit(float(len(alphabet))).alias("width"),
                              power_sum(letters, 2).alias("squares"), power_sum(letters, 3).alias("cubes"))
                     for name, (_, alphabet, letters) in ENCODINGS.items()])
    return counts.select(F.inline(rows))


def _tail(z):
    """Probability of a standard normal value beyond ``z`` >= 0, within 2e-4."""
    return 1 / (1 + F.exp(F.least(F.lit(600.0), 1.5976 * z + 0.070566 * z * z * z)))


def with_randomness(strings: DataFrame, column="value", encoding="encoding") -> DataFrame:
    """Adds ``p``, the three tests combined, near 0 when the string is not random in its encoding, and the chi-squared ``uniformity``."""
    def by_encoding(value):
        out = F.lit(None)
        for name, (_, alphabet, _) in ENCODINGS.items():
            out = F.when(F.col(encoding) == name, F.lit(value(alphabet))).otherwise(out)
        return out

    # url-safe base 64 and upper-case hexadecimal are written with the standard letters
    plain = F.when(F.col(encoding) == "hex", F.lower(column)).otherwise(F.translate(F.col(column), "-_", "+/"))
    k = F.col("_k")
    df = strings.withColumn("_s", plain).withColumn("_a", by_encoding(lambda a: a)).withColumn("_k", F.length("_a").cast("double")).withColumn(
        "_n", F.length("_s").cast("double"))
    df = df.withColumn(
        "_v", F.transform(F.regexp_extract_all("_s", F.lit("."), F.lit(0)), lambda c: (F.position(c, F.col("_a")) - 1).cast("double")))
    total = F.lit(0.0)
    counts = F.transform(F.regexp_extract_all("_a", F.lit("."), F.lit(0)), lambda c: F.length("_s") - F.length(F.replace(F.col("_s"), c, F.lit(""))))
    df = df.withColumn("_x", k / F.col("_n") * F.aggregate(counts, total, lambda s, c: s + c * c) - F.col("_n"))
    free = 2 / (9 * (k - 1))
    chi = (F.pow(F.greatest(F.col("_x"), F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - free)) / F.sqrt(free)

    high = F.transform("_v", lambda v: (v >= k / 2).cast("int"))
    df = df.withColumn("_h", high).withColumn("_n1", F.aggregate("_h", F.lit(0), lambda s, x: s + x).cast("double")).withColumn(
        "_n2", F.col("_n") - F.col("_n1")).withColumn("_m", F.aggregate("_v", total, lambda s, x: s + x) / F.col("_n"))

    def neighbours(column, each):
        return F.zip_with(F.slice(column, 1, F.size(column) - 1), F.slice(column, 2, F.size(column) - 1), each)

    turns = F.aggregate(neighbours("_h", lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, x: s + x) + 1
    mixed = 2 * F.col("_n1") * F.col("_n2")
    spread = mixed * (mixed - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    runs = F.when((F.col("_n") > 1) & (spread > 0), (turns - mixed / F.col("_n") - 1) / F.sqrt(spread))
    m = F.col("_m")
    variance = F.aggregate("_v", total, lambda s, x: s + (x - m) * (x - m))
    together = F.aggregate(neighbours("_v", lambda a, b: (a - m) * (b - m)), total, lambda s, x: s + x)
    serial = F.when(variance > 0, (together / variance + 1 / F.col("_n")) * F.sqrt("_n"))
    df = df.withColumn("_chi", chi).withColumn("_runs", runs).withColumn("_serial", serial)
    # A test without a value had a string of one kind only, which no random source writes.
    h = sum(-F.log(F.greatest(F.coalesce(2 * _tail(F.abs(F.col(c))), F.lit(0.0)), F.lit(1e-100))) for c in ("_chi", "_runs", "_serial"))
    df = df.withColumn("_f", h).withColumn("p", F.exp(-F.col("_f")) * (1 + F.col("_f") + F.col("_f") * F.col("_f") / 2))
    return df.withColumnRenamed("_x", "uniformity").drop("_s", "_a", "_k", "_n", "_v", "_h", "_n1", "_n2", "_m", "_chi", "_runs", "_serial", "_f")


def with_text_chance(scored, moments):
    """Adds ``chance``: the probability that letters of text come as near to uniform as the string does."""
    n = F.length("value").cast("double")
    k, q2, q3 = F.col("width"), F.col("squares"), F.col("cubes")
    mean = k * ((n - 1) * q2 + 1) - n
    spread = F.sqrt(2 * n * (n - 1) * (q2 + 2 * (n - 2) * q3 - (2 * n - 3) * q2 * q2)) * k / n
    z = (F.col("uniformity") - mean) / spread
    chance = F.when(z < 0, _tail(-z)).otherwise(1 - _tail(z))
    # Three rows, one per encoding.
    return scored.join(F.broadcast(moments), "encoding").withColumn("chance", chance).drop("width", "squares", "cubes")


def _step(p):
    """Steps down from 1; the p-value counts as the upper end of its step."""
    return F.floor(-F.log2(F.greatest(p, F.lit(1e-290))) * _STEPS).cast("int")


def _bounds(judged, rate):
    """Least step of each encoding at which the discoveries from there on are within the rate."""
    cells = judged.groupBy("encoding", _step(F.col("chance")).alias("step")).agg(F.count_if("random").alias("found"), F.count(F.lit(1)).alias("all"))
    by_encoding = Window.partitionBy("encoding")  # a bounded number of steps
    held = cells.withColumn("m", F.sum("all").over(by_encoding)).withColumn(
        "from", F.sum("found").over(by_encoding.orderBy(F.desc("step"))))
    upper = F.pow(F.lit(2.0), -F.col("step") / _STEPS)
    return held.where(F.col("m") * upper <= rate * F.col("from")).groupBy("encoding").agg(F.min("step").alias("bound"))


def find_secrets(docs: DataFrame, least=LEAST, rate=RATE) -> DataFrame:
    """One row per document: doc_id, spans (start, rank of the kind, end, value; by start, then kind)."""
    scanned = staged(_scanned(docs, least), "secret-candidates")
    judged = with_text_chance(with_randomness(_free_runs(scanned)), _text_moments(scanned))
    judged = staged(judged.withColumn("random", F.col("p") >= REFUSED), "secret-scores")
    found = (
        judged.where("random").join(F.broadcast(_bounds(judged, rate)), "encoding")
        .where(_step(F.col("chance")) >= F.col("bound"))
        .groupBy("key").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("rank"), "end", "value")).alias("more"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")
    return scanned.select("key", "doc_id", "fixed").join(found, "key", "left").select(
        "doc_id", F.array_sort(F.concat("fixed", F.coalesce("more", none))).alias("spans"))
