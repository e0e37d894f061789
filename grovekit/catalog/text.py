"""Text metrics, filters and scalar functions."""

from pyspark.sql import functions as F

from grovekit.catalog.registry import (
    MEASURED, NL, RAW_AVG, RAW_COUNT, SAMPLES, SPREAD_LANGUAGE, digest, query, r6, samples,
    spread_language, table,
)
from grovekit.fixed import DROP_MARKERS, LANGUAGES, LINE_MARKERS
from grovekit.functions import nodes as N, paths, text as T
from grovekit.functions.names import extract_name
from grovekit.operators import filters as OF, profiling as OP
from grovekit.plans import preparation as P


@query("avg_line_length_raw", f"with {SAMPLES} select doc_id, round({RAW_AVG}, 6) as avg_line_length from samples")
def _(spark, d):
    return samples(spark, d).select("doc_id", r6(T.avg_line_length_raw("code")).alias("avg_line_length"))


@query("line_count_raw", f"with {SAMPLES} select doc_id, {RAW_COUNT} as line_count from samples")
def _(spark, d):
    return samples(spark, d).select("doc_id", T.line_count_raw("code").alias("line_count"))


# Blank runs of two and three lines, since the texts have none.
def _spaced(df):
    wide = F.replace("code", F.lit(". "), F.lit(".\n\n"))
    wider = F.replace("code", F.lit(". "), F.lit(".\n\n\n"))
    return df.withColumn("code", F.when(F.col("doc_id") % 3 == 0, wider).otherwise(wide))


_SPACED = f"""spaced as (select * replace (replace(code, '. ',
    case when doc_id % 3 = 0 then '.' || {NL} || {NL} || {NL} else '.' || {NL} || {NL} end) as code) from samples)"""
_CLEAN = f"""stripped as (select *, trim(code, ' ' || chr(9) || {NL} || chr(13)) as s from spaced),
counted as (select *, length(s) - length(replace(s, {NL}, '')) as newlines,
    (length(s) - length(replace(s, {NL} || {NL}, ''))) // 2 as dropped from stripped),
cleaned as (select doc_id, language, length(s) - newlines as total, newlines + 1 - dropped as n from counted),
metrics as (select doc_id, language, ((200 * total + n) // (2 * n)) / 100.0 as avg_line_length, n as line_count from cleaned)"""


@query("clean_metrics", f"""with {SAMPLES}, {_SPACED}, {_CLEAN}
select doc_id, cast(avg_line_length as double) as avg_line_length, line_count from metrics""")
def _(spark, d):
    return P.with_clean_metrics(_spaced(samples(spark, d))).select("doc_id", "avg_line_length", "line_count")


@query("metrics_report", f"""with {SAMPLES}, {_SPACED}, {_CLEAN}
select language, count(*) as total_rows, round(avg(line_count), 6) as avg_line_count,
    round(avg(cast(avg_line_length as double)), 6) as avg_avg_line_length
from metrics group by language""")
def _(spark, d):
    measured = P.with_clean_metrics(_spaced(samples(spark, d)))
    return OP.metrics_report(measured, ["language"]).withColumns({
        "avg_line_count": r6("avg_line_count"), "avg_avg_line_length": r6("avg_avg_line_length"),
    })


@query("drop_columns", "select doc_id, lang from documents")
def _(spark, d):
    stars = table(spark, d, "documents").select(
        "doc_id", "lang", F.col("source").alias("max_stars_repo_name"), F.col("n_chars").alias("max_stars_count"),
    )
    return P.drop_repository_columns(stars)


_CODED = f"coded as (select doc_id, {SPREAD_LANGUAGE} as language, text as code, source as file from documents)"


@query("select_languages", f"with {_CODED} select doc_id, language from coded where language in ('c_sharp', 'go')")
def _(spark, d):
    coded = samples(spark, d).withColumn("language", spread_language())
    return OF.select_languages(coded, part=2).select("doc_id", "language")


@query("normalize_language", """select doc_id, case doc_id % 4 when 0 then 'c_sharp' when 1 then 'c_sharp'
    when 2 then 'c_sharp' else 'go' end as language from documents""")
def _(spark, d):
    spelled = samples(spark, d).withColumn("language", F.element_at(
        F.array(*[F.lit(x) for x in ("csharp", "c-sharp", "c_sharp", "go")]), (F.col("doc_id") % 4 + 1).cast("int")
    ))
    return spelled.select("doc_id", T.normalize_language("language").alias("language"))


FENCED = """quartiles as (select language, quantile_cont(avg_line_length, 0.25) as q1,
    quantile_cont(avg_line_length, 0.75) as q3 from measured group by language),
fenced as (select m.* from measured m join quartiles q using (language)
    where avg_line_length between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""


def capped(source):
    return f"""line_caps as (select language, quantile_cont(line_count, 0.9) as cap from {source} group by language),
short as (select s.* from {source} s join line_caps using (language) where line_count <= cap),
length_caps as (select language, quantile_cont(avg_line_length, 0.8) as cap from short group by language),
capped as (select s.* from short s join length_caps using (language) where avg_line_length <= cap)"""


# Samples of which some have no line length, or one that is not a number.
UNMEASURED = """unmeasured as (select doc_id, language, line_count, case when doc_id % 29 = 0 then null
    when doc_id % 31 = 0 then 'nan'::double else avg_line_length end as avg_line_length from measured),
quartiles as (select language, quantile_cont(avg_line_length, 0.25) as q1, quantile_cont(avg_line_length, 0.75) as q3
    from unmeasured where not isnan(avg_line_length) group by language),
inside as (select u.* from unmeasured u left join quartiles q using (language) where avg_line_length is null or isnan(avg_line_length)
    or avg_line_length between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""


def unmeasured(spark, d):
    length = F.when(F.col("doc_id") % 29 == 0, None).when(F.col("doc_id") % 31 == 0, float("nan")).otherwise(F.col("avg_line_length"))
    return P.with_raw_metrics(samples(spark, d)).withColumn("avg_line_length", length)


@query("iqr_filter", f"""with {MEASURED}, {UNMEASURED} select doc_id, language,
    case when avg_line_length is null then -1 when isnan(avg_line_length) then -2 else round(avg_line_length, 6) end as avg_line_length from inside""")
def _(spark, d):
    kept = OF.iqr_filter(unmeasured(spark, d), ["language"], "avg_line_length")
    length = F.col("avg_line_length")
    return kept.select("doc_id", "language", F.when(length.isNull(), -1.0).when(F.isnan(length), -2.0).otherwise(r6(length)).alias("avg_line_length"))


@query("percentile_cap", f"""with {MEASURED}, {capped('measured')}
select doc_id, language, line_count, round(avg_line_length, 6) as avg_line_length from capped""")
def _(spark, d):
    measured = P.with_raw_metrics(samples(spark, d))
    return OF.percentile_cap(measured, ["language"]).select(
        "doc_id", "language", "line_count", r6("avg_line_length").alias("avg_line_length"))


@query("statistical_filter", f"""with {MEASURED}, {FENCED}, {capped('fenced')}
select doc_id, language, line_count, round(avg_line_length, 6) as avg_line_length from capped""")
def _(spark, d):
    measured = P.with_raw_metrics(samples(spark, d))
    return OF.statistical_filter(measured, ["language"]).select(
        "doc_id", "language", "line_count", r6("avg_line_length").alias("avg_line_length"))


_WORDS = ("License", "the ")


@query("contains_any_count", f"""with {SAMPLES}
select count(*) filter (where contains(code, 'License') or contains(code, 'the ')) as matching_rows from samples""")
def _(spark, d):
    return OF.contains_any_count(samples(spark, d), "code", _WORDS)


@query("drop_rows_containing", f"""with {SAMPLES} select doc_id from samples
where not (contains(code, 'License') or contains(code, 'the '))""")
def _(spark, d):
    return OF.drop_rows_containing(samples(spark, d), "code", _WORDS).select("doc_id")


@query("drop_lines_containing", f"""with {SAMPLES}, kept as (select doc_id, array_to_string(list_filter(
    string_split(code, {NL}), lambda x: not (contains(x, 'License') or contains(x, 'the '))), {NL}) as code from samples)
select doc_id, length(code) as chars, sha256(code) as digest from kept""")
def _(spark, d):
    kept = samples(spark, d).select("doc_id", T.drop_lines_containing("code", _WORDS).alias("code"))
    return kept.select("doc_id", F.length("code").alias("chars"), digest("code").alias("digest"))


@query("replace_literal", f"""with {SAMPLES}, changed as (select doc_id, replace(code, 'License', '') as code from samples)
select doc_id, length(code) as chars, sha256(code) as digest from changed""")
def _(spark, d):
    changed = samples(spark, d).select("doc_id", T.replace_literal("code", "License").alias("code"))
    return changed.select("doc_id", F.length("code").alias("chars"), digest("code").alias("digest"))


# Markers put where the texts have none.
def marked(df):
    text, i = F.col("code"), F.col("doc_id")
    return df.withColumn("code", (
        F.when(i % 13 == 0, F.concat(F.lit("<issue_start>"), text))
        .when(i % 7 == 0, F.concat(F.lit("<reponame>x\n"), text))
        .when(i % 5 == 0, F.concat(F.lit("<filename>y<|endoftext|>\n"), text))
        .when(i % 3 == 0, F.concat(text, F.lit("<|endoftext|>")))
        .otherwise(text)
    ))


_MARKED = f"""marked as (select * replace (case when doc_id % 13 = 0 then '<issue_start>' || code
    when doc_id % 7 = 0 then '<reponame>x' || {NL} || code
    when doc_id % 5 = 0 then '<filename>y<|endoftext|>' || {NL} || code
    when doc_id % 3 = 0 then code || '<|endoftext|>' else code end as code) from samples)"""
_DROP = "(" + " or ".join(f"contains(code, '{m}')" for m in DROP_MARKERS) + ")"
_LINE = " or ".join(f"contains(x, '{m}')" for m in LINE_MARKERS)
_TRIMMED = f"array_to_string(list_filter(string_split(code, {NL}), lambda x: not ({_LINE})), {NL})"


@query("clean_samples", f"""with {SAMPLES}, {_MARKED},
clean as (select doc_id, replace({_TRIMMED}, '<|endoftext|>', '') as code from marked where not {_DROP})
select doc_id, length(code) as chars, sha256(code) as digest from clean""")
def _(spark, d):
    return OF.clean_samples(marked(samples(spark, d))).select(
        "doc_id", F.length("code").alias("chars"), digest("code").alias("digest"))


@query("clean_report", f"""with {SAMPLES}, {_MARKED}, flags as (select language, {_DROP} as gone,
    contains({_TRIMMED}, '<|endoftext|>') as ended, code <> {_TRIMMED} as trimmed from marked)
select language, count(*) as rows_before, count(*) filter (where not gone) as rows_after,
    count(*) filter (where gone) as rows_removed,
    count(*) filter (where not gone and trimmed) as rows_with_marked_lines,
    count(*) filter (where not gone and ended) as rows_with_end_marker,
    round(100.0 * count(*) filter (where gone) / count(*), 6) as percent_removed
from flags group by language""")
def _(spark, d):
    report = OF.clean_report(marked(samples(spark, d)), ["language"])
    return report.withColumn("percent_removed", r6("percent_removed"))


# The whole preparation: seeded sample, bounds, cleaning, clean metrics.
@query("prepare_corpus", f"""with {SAMPLES}, {_MARKED}, ranked as (select *, row_number() over (partition by language
    order by md5(cast(doc_id as varchar) || '_42'), doc_id) as r from marked),
measured as (select *, {RAW_AVG} as avg_line_length, {RAW_COUNT} as line_count from ranked where r <= 200), {FENCED}, {capped('fenced')},
spaced as (select doc_id, language, replace({_TRIMMED}, '<|endoftext|>', '') as code from capped where not {_DROP}), {_CLEAN}
select doc_id, language, cast(avg_line_length as double) as avg_line_length, line_count from metrics""")
def _(spark, d):
    return P.prepare(marked(samples(spark, d)), "doc_id", per_language=200).select(
        "doc_id", "language", "avg_line_length", "line_count")


# Missing and unsupported languages and empty texts.
def spoiled(df):
    i = F.col("doc_id")
    return df.withColumn("language", (
        F.when(i % 9 == 0, F.lit(None).cast("string")).when(i % 11 == 0, "").when(i % 6 == 0, "pascal")
        .when(i % 4 == 0, "csharp").otherwise(spread_language())
    )).withColumn("code", F.when(i % 8 == 0, "").when(i % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("code")))


_SPOILED = f"""spoiled as (select doc_id, case when doc_id % 9 = 0 then null when doc_id % 11 = 0 then ''
    when doc_id % 6 = 0 then 'pascal' when doc_id % 4 = 0 then 'csharp' else {SPREAD_LANGUAGE} end as language,
    case when doc_id % 8 = 0 then '' when doc_id % 10 = 0 then null else code end as code from samples),
judged as (select doc_id, case when language = 'csharp' then 'c_sharp' else language end as language,
    case when coalesce(language, '') = '' then 'language missing' when coalesce(code, '') = '' then 'code missing'
    when language = 'pascal' then 'language unsupported' end as reason from spoiled)"""


@query("valid_rows", f"with {SAMPLES}, {_SPOILED} select doc_id, language from judged where reason is null")
def _(spark, d):
    return OF.valid_rows(spoiled(samples(spark, d))).select("doc_id", "language")


@query("rejected_rows", f"with {SAMPLES}, {_SPOILED} select doc_id, reason from judged where reason is not null")
def _(spark, d):
    return OF.rejected_rows(spoiled(samples(spark, d))).select("doc_id", "reason")


@query("drop_any_null", "select doc_id, quality, toxic from documents join labels using (doc_id)")
def _(spark, d):
    joined = samples(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return OF.drop_any_null(joined).select("doc_id", "quality", "toxic")


@query("line_range", f"with {MEASURED} select doc_id, line_count from measured where line_count between 10 and 10000")
def _(spark, d):
    return OF.line_range(P.with_raw_metrics(samples(spark, d))).select("doc_id", "line_count")


@query("normalize_text", rf"""with {SAMPLES}, soiled as (select doc_id, chr(65279) || replace(replace(code, '. ', '.  ' || {NL} || {NL}
    || {NL}), ', ', chr(7) || ', ') as code from samples), plain as (select doc_id, regexp_replace(regexp_replace(regexp_replace(
    replace(code, chr(65279), ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t]+\n', {NL}, 'g'),
    '\n\n\n+', {NL} || {NL}, 'g') as code from soiled)
select doc_id, length(code) as chars, sha256(code) as digest from plain""")
def _(spark, d):
    soiled = samples(spark, d).withColumn("code", F.concat(F.lit("﻿"), F.replace(
        F.replace("code", F.lit(". "), F.lit(".  \n\n\n")), F.lit(", "), F.lit("\x07, "))))
    plain = soiled.select("doc_id", T.normalize_text("code").alias("code"))
    return plain.select("doc_id", F.length("code").alias("chars"), digest("code").alias("digest"))


_LABEL = "case " + " ".join(f"when contains(code, '{p}') then '{n}'" for p, n in T.LICENSE_PHRASES) + " else 'none' end"


@query("license_filter", f"""with {SAMPLES}, labelled as (select doc_id, {_LABEL} as license from samples)
select doc_id, license from labelled where license in ('MIT', 'Apache-2.0', 'BSD')""")
def _(spark, d):
    return OF.license_filter(samples(spark, d)).select("doc_id", T.license_label("code").alias("license"))


@query("source_hash", f"with {SAMPLES} select doc_id, sha256(code) as source_hash from samples")
def _(spark, d):
    return samples(spark, d).select("doc_id", T.source_hash("code").alias("source_hash"))


@query("line_offsets", f"""with {SAMPLES}, pieces as (select doc_id, string_split(code, {NL}) as p from samples),
listed as (select doc_id, unnest(range(len(p))) as i, unnest(p) as line from pieces),
starts as (select doc_id, i, coalesce(sum(length(line) + 1) over (partition by doc_id order by i
    rows between unbounded preceding and 1 preceding), 0) as s from listed)
select doc_id, string_agg(cast(cast(s as bigint) as varchar), ',' order by i) as offsets from starts group by doc_id""")
def _(spark, d):
    return samples(spark, d).select("doc_id", F.array_join(
        F.transform(T.line_offsets("code"), lambda x: x.cast("string")), ",").alias("offsets"))


# Declarations in every language, with the text behind them.
def declared(df):
    i = F.col("doc_id")
    shape, text, n = F.pmod(F.call_function("div", i, F.lit(10)), F.lit(4)), F.col("code"), i.cast("string")

    def by_shape(*forms):
        built = [F.concat(*[n if p is None else text if p is Ellipsis else F.lit(p) for p in form]) for form in forms]
        return F.when(shape == 0, built[0]).when(shape == 1, built[1]).when(shape == 2, built[2]).otherwise(built[3])

    language = F.col("language")
    result = F.lit("")
    for name, forms in DECLARATIONS.items():
        result = F.when(language == name, by_shape(*forms)).otherwise(result)
    return df.withColumn("code", result)


# None stands for the key and ... for the text.
_C_FORMS = (("class K", None, " { ", ..., " }"), ("void f", None, "(int a) ", ...), (..., " struct S", None), ("static int g", None, " (", ...))
_JS_FORMS = (("function f", None, "(a) ", ...), ("class K", None, " extends B { ", ...), ("const a", None, " = (x) => ", ...), ("let b", None, " = function", ...))
DECLARATIONS = {
    "c": _C_FORMS, "cpp": _C_FORMS, "java": _C_FORMS, "c_sharp": _C_FORMS,
    "javascript": _JS_FORMS, "typescript": _JS_FORMS,
    "python": (("def f", None, "(a): ", ...), ("class K", None, "(B): ", ...), (...,), ("async def g", None, "()", ...)),
    "go": (("func F", None, "(a int) ", ...), ("func (r R) M", None, "(a) ", ...), ("type T", None, " struct ", ...), ("type I", None, " interface ", ...)),
    "ruby": (("def m", None, " ", ...), ("class K", None, " < B\n", ...), ("module M", None, "\n", ...), ("def q", None, "(a)\n", ...)),
    "scala": (("def f", None, "[T](a) ", ...), ("class K", None, "(a) extends B ", ...), ("object O", None, " extends B ", ...), ("trait T", None, "[A] ", ...)),
}


def _sql_form(form):
    return " || ".join(
        "cast(doc_id as varchar)" if p is None else "code" if p is Ellipsis else "'" + p.replace("\n", "' || chr(10) || '") + "'"
        for p in form)


_DECLARED = "declared as (select doc_id, language, case language " + " ".join(
    f"when '{name}' then case (doc_id // 10) % 4 " + " ".join(
        f"when {i} then {_sql_form(form)}" for i, form in enumerate(forms)) + " end"
    for name, forms in DECLARATIONS.items()) + " end as t from coded)"
_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _sp(text, word, i):
    return f"split_part({text}, '{word}', {i})"


def _tr(text):
    return f"trim({text}, {_WS})"


_PY = f"case when contains(t, 'def ') then {_tr(_sp(_sp('t', 'def ', 2), '(', 1))} when contains(t, 'class ') then {_tr(_sp(_sp('t', 'class ', 2), ':', 1))} else 'unknown' end"
_JS = f"""case when contains(t, 'function ') then {_tr(_sp(_sp('t', 'function ', 2), '(', 1))}
    when contains(t, 'class ') then {_tr(_sp(_sp(_sp('t', 'class ', 2), '{', 1), 'extends', 1))}
    when contains(t, '=') and (contains(t, '=>') or contains(t, 'function')) then
        list_extract(regexp_split_to_array({_tr(_sp('t', '=', 1))}, '\\s+'), -1) else 'unknown' end"""
_GO = f"""case when contains(t, 'func ') then case when {_tr(_sp('t', 'func ', 2))} like '(%'
        then {_tr(_sp(_sp(_sp('t', 'func ', 2), ')', 2), '(', 1))} else {_tr(_sp(_sp('t', 'func ', 2), '(', 1))} end
    when contains(t, 'type ') and contains(t, 'struct') then {_tr(_sp(_sp('t', 'type ', 2), 'struct', 1))}
    when contains(t, 'type ') and contains(t, 'interface') then {_tr(_sp(_sp('t', 'type ', 2), 'interface', 1))} else 'unknown' end"""


def _first_of(text, delimiters):
    return "case " + " ".join(
        f"when contains({text}, {x}) then {_tr(f'split_part({text}, {x}, 1)')}" for x in delimiters) + f" else {_tr(text)} end"


_RUBY = f"""case when contains(t, 'def ') then {_first_of(_sp('t', 'def ', 2), ["'('", "chr(10)", "chr(13)", "' '"])}
    when contains(t, 'class ') then {_first_of(_sp('t', 'class ', 2), ["'<'", "chr(10)", "chr(13)"])}
    when contains(t, 'module ') then {_tr(f"split_part({_sp('t', 'module ', 2)}, chr(10), 1)")} else 'unknown' end"""
_SCALA = f"""case when contains(t, 'def ') then case when contains({_sp('t', 'def ', 2)}, '[') then {_tr(_sp(_sp('t', 'def ', 2), '[', 1))}
        when contains({_sp('t', 'def ', 2)}, '(') then {_tr(_sp(_sp('t', 'def ', 2), '(', 1))}
        else {_tr(_sp(_sp(_sp('t', 'def ', 2), ':', 1), '=', 1))} end
    when contains(t, 'class ') then {_first_of(_sp('t', 'class ', 2), ["'['", "'('", "'extends'", "'{'"])}
    when contains(t, 'object ') then {_first_of(_sp('t', 'object ', 2), ["'extends'", "'{'", "chr(10)"])}
    when contains(t, 'trait ') then {_tr(_sp(_sp(_sp('t', 'trait ', 2), '[', 1), 'extends', 1))} else 'unknown' end"""
_C = """coalesce(list_extract(list_filter(list_transform(range(1, len(w) + 1), lambda i: case
    when list_contains(['class', 'struct', 'interface', 'union'], w[i]) and i < len(w) then w[i + 1]
    when i > 1 and list_contains(['void', 'int', 'string', 'bool'], w[i - 1]) then split_part(w[i], '(', 1) end),
    lambda x: x is not null), 1), 'unknown')"""


# Of a text ``t`` with words ``w``, by ``language``.
WORDS_SQL = f"regexp_split_to_array({_tr('t')}, '\\s+')"
NAME_SQL = f"""case when language = 'python' then {_PY} when language in ('javascript', 'typescript') then {_JS}
    when language = 'go' then {_GO} when language = 'ruby' then {_RUBY} when language = 'scala' then {_SCALA} else {_C} end"""


@query("extract_name", f"""with {_CODED}, {_DECLARED}, worded as (select *, {WORDS_SQL} as w from declared)
select doc_id, language, {NAME_SQL} as name from worded""")
def _(spark, d):
    coded = declared(samples(spark, d).withColumn("language", spread_language()))
    return coded.select("doc_id", "language", extract_name("code", "language").alias("name"))


@query("snippet", f"with {SAMPLES} select doc_id, substring(code, 1, 100) as text_snippet from samples")
def _(spark, d):
    return samples(spark, d).select("doc_id", N.snippet("code").alias("text_snippet"))


@query("graph_label", f"""with {SAMPLES} select doc_id, 'document' || {NL} || case when length(code) > 30
    then '(' || substring(code, 1, 30) || '...)' else code end as label from samples""")
def _(spark, d):
    return samples(spark, d).withColumn("type", F.lit("document")).select(
        "doc_id", N.graph_label("type", "code").alias("label"))


@query("file_parts", """select doc_id, lang || '_parsed_' || cast(doc_id % 4 as varchar) || '.parquet' as base_name,
    lang || '_parsed_' || cast(doc_id % 4 as varchar) as stem,
    lang || '_parsed_' || cast(doc_id % 4 as varchar) || '.parquet' as converted_name from documents""")
def _(spark, d):
    path = F.concat(F.lit("/data/"), F.col("file"), F.lit("/"), F.col("language"), F.lit("_parsed_"),
                    (F.col("doc_id") % 4).cast("string"), F.lit(".parquet"))
    return samples(spark, d).select(
        "doc_id", paths.base_name(path).alias("base_name"), paths.stem(path).alias("stem"),
        paths.converted_name(path).alias("converted_name"))


@query("safe_parse_json", """select event_id, case when event_id % 7 = 0 then -1
    else cast(json_extract(props, '$.k') as bigint) end as k from events""")
def _(spark, d):
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), F.col("props"))).when(
        F.col("event_id") % 3 == 0, F.replace("props", F.lit('"'), F.lit("'"))).otherwise(F.col("props"))
    parsed = table(spark, d, "events").withColumn("props", text).withColumn("v", N.safe_parse_json("props"))
    return parsed.select("event_id", F.coalesce(F.try_variant_get("v", "$.k", "bigint"), F.lit(-1)).alias("k"))


def typed_json(df):
    """A record with two typed nodes, one node without a type, and a type in another place."""
    kind = F.col("event_type")
    listed = F.concat(
        F.lit('{"type":"record","ast":{"nodes":[{"id":0,"type":"'), kind, F.lit('","text":"\\"type\\":\\"no\\""},{"id":1,"inner":{"type":"'),
        F.lower(kind), F.lit('_inner"}},{"type":"leaf"}]}}'))
    loose = F.concat(F.lit('[{"kind":{"type":"'), kind, F.lit('"},"more":[{"type" : "x"}]},{"type":"other"}]'))
    single = F.concat(F.lit("{'a': {'type': '"), kind, F.lit("'}, 'b': [1, {'t\\u0079pe': 'z'}]}"))
    i = F.col("event_id") % 7
    return df.withColumn("json", F.when(i == 5, single).when(i == 6, F.concat(F.lit('{"type":"cut"'), kind)).otherwise(
        F.when(F.col("event_id") % 2 == 0, listed).otherwise(loose)))


@query("collect_types", """select event_id, case when event_id % 7 = 5 then event_type || ',z' when event_id % 7 = 6 then 'unparsed'
    when event_id % 2 = 0 then event_type || ',' || event_type || '_inner,leaf,record' else event_type || ',x,other' end as types from events""")
def _(spark, d):
    return typed_json(table(spark, d, "events")).select(
        "event_id", F.coalesce(F.array_join(N.collect_types("json"), ","), F.lit("unparsed")).alias("types"))


@query("node_types", """select event_id, case when event_id % 7 = 5 then event_type || ',z' when event_id % 7 = 6 then 'unparsed'
    when event_id % 2 = 0 then event_type || ',' || event_type || '_inner,leaf' else event_type || ',x' end as types from events""")
def _(spark, d):
    return typed_json(table(spark, d, "events")).select(
        "event_id", F.coalesce(F.array_join(N.node_types("json"), ","), F.lit("unparsed")).alias("types"))


@query("error_count", f"""with {SAMPLES}, dumped as (select doc_id, replace(code, ', ', ' (ERROR) ') as dump from samples)
select doc_id, (length(dump) - length(replace(dump, '(ERROR)', ''))) // 7 as num_errors from dumped""")
def _(spark, d):
    return samples(spark, d).withColumn("dump", F.replace("code", F.lit(", "), F.lit(" (ERROR) "))).select(
        "doc_id", T.error_count("dump").alias("num_errors"))


@query("dump_node_count", f"with {SAMPLES} select doc_id, {RAW_COUNT} as ast_node_count from samples")
def _(spark, d):
    return samples(spark, d).select("doc_id", T.dump_node_count("code").alias("ast_node_count"))


@query("int_or_zero", """select doc_id, coalesce(quality, 0) as quality, cast(coalesce(quality, 0) as double) as weight
from documents left join labels using (doc_id)""")
def _(spark, d):
    joined = samples(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.select("doc_id", T.int_or_zero("quality").alias("quality"), T.double_or_zero("quality").alias("weight"))


@query("status_label", "select doc_id, upper(lang) as label from documents")
def _(spark, d):
    return samples(spark, d).select("doc_id", T.status_label("language").alias("label"))
