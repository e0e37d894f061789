"""Node tables, pruned trees, records."""

from pyspark.sql import Window, functions as F

from grovekit.catalog.registry import (
    NL, RAW_COUNT, SAMPLES, SPREAD_LANGUAGE, digest, query, samples, spread_language, sql_digest, table, whole_digest,
)
from grovekit.catalog.profile import rounded
from grovekit.catalog.text import NAME_SQL, WORDS_SQL
from grovekit.fixed import CATEGORIES, SKIP_TEXTS, SKIP_TYPES, VOID_TAGS
from grovekit.functions import nodes as N
from grovekit.operators import records as OR, trees as OT
from grovekit.plans import conversion as C, preparation as P
from grovekit.session import staged

# Nodes of the documents: document, line, token.
NODES = f"""pieces as (select doc_id, language, code, string_split(code, {NL}) as p from samples),
listed as (select doc_id, unnest(range(len(p))) as r, unnest(p) as line from pieces),
cut as (select doc_id, r, line, string_split(line, ' ') as t from listed),
tokens as (select doc_id, r, unnest(range(len(t))) as k, unnest(t) as text from cut),
placed as (select *, coalesce(sum(length(text) + 1) over w, 0) as s, coalesce(sum(strlen(text) + 1) over w, 0) as sb from tokens
    window w as (partition by doc_id order by r, k rows between unbounded preceding and 1 preceding)),
line_starts as (select doc_id, r, s, sb from placed where k = 0),
gathered as (
    select doc_id, -1 as r, -1 as k, 0 as depth, 'document' as type, code as text, 0 as s, 0 as sb, 0 as c from pieces
    union all select l.doc_id, l.r, -1, 1, 'line', l.line, b.s, b.sb, 0 from listed l join line_starts b on l.doc_id = b.doc_id and l.r = b.r
    union all select p.doc_id, p.r, p.k, 2, case when regexp_full_match(text, '[0-9]+[.,]?') then 'number_literal'
        when text like '%.' or text like '%,' then 'punctuated_word'
        when substring(text, 1, 1) <> lower(substring(text, 1, 1)) then 'capital_name' else 'word' end,
        text, p.s, p.sb, p.sb - b.sb from placed p join line_starts b on p.doc_id = b.doc_id and p.r = b.r where text <> ''),
nodes as (select doc_id, row_number() over (partition by doc_id order by r, k) - 1 as seq, depth, type, text,
    s, s + length(text) as e, sb, sb + strlen(text) as eb, greatest(r, 0) as row, c from gathered)"""
DOCS = f"{SAMPLES}, {NODES}"


def text_nodes(spark, d, carry=()):
    return OT.text_nodes(samples(spark, d), "doc_id", "code", carry)


@query("structure_nodes", f"with {DOCS} select doc_id, seq, depth, type, cast(s as bigint) as s, cast(e as bigint) as e from nodes")
def _(spark, d):
    return text_nodes(spark, d).select("doc_id", "seq", "depth", "type", F.col("start").alias("s"), F.col("end").alias("e"))


@query("node_points", f"""with {DOCS} select doc_id, seq, row as start_row, cast(c as bigint) as start_column,
    case when depth = 0 then len(string_split(text, {NL})) - 1 else row end as end_row,
    case when depth = 0 then strlen(list_extract(string_split(text, {NL}), -1)) else cast(c + eb - sb as bigint) end as end_column
from nodes""")
def _(spark, d):
    return text_nodes(spark, d).select(
        "doc_id", "seq", F.col("start_point.row").alias("start_row"), F.col("start_point.column").alias("start_column"),
        F.col("end_point.row").alias("end_row"), F.col("end_point.column").alias("end_column"))


TAGS = f"""found as (select page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) as language,
    regexp_extract_all(html, '(</?[a-zA-Z][a-zA-Z0-9]*[^>]*>)', 1) as t from pages),
tags as (select page_id, language, unnest(range(len(t))) as pos, unnest(t) as text from found),
typed as (select *, lower(regexp_extract(text, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) as type, text like '</%' as closing from tags),
stepped as (select *, case when closing then -1 when type in ({', '.join(f"'{v}'" for v in VOID_TAGS)}) or text like '%/>' then 0 else 1 end as step from typed),
nested as (select *, greatest(0, coalesce(sum(step) over w, 0)) as depth, coalesce(sum((not closing)::int) over w, 0) as seq from stepped
    window w as (partition by page_id order by pos rows between unbounded preceding and 1 preceding)),
page_nodes as (select page_id as id, page_id, language, cast(seq as int) as seq, cast(depth as int) as depth, type, text from nested where not closing)"""


def tag_nodes(spark, d):
    pages = table(spark, d, "pages").withColumn("language", F.regexp_extract("html", '<html lang="([a-z]+)"', 1))
    return OT.tag_nodes(pages, "page_id", "html", ["language"])


@query("tag_depth", f"with {TAGS} select page_id, seq, depth, type, text from page_nodes")
def _(spark, d):
    return tag_nodes(spark, d).drop("language", "previous_depth")


# Dumps: every node of a page, and every document.
@query("write_dump", f"""with {TAGS} select page_id, string_agg(repeat('  ', depth) || '(' || type || ') "' || replace(text, {NL}, '\\n') || '"',
    {NL} order by seq) as dump from page_nodes group by page_id""")
def _(spark, d):
    return OT.write_dump(tag_nodes(spark, d), "page_id", "dump")


@query("read_dump", f"with {DOCS} select doc_id, seq, depth, type, sha256(text) as digest from nodes")
def _(spark, d):
    dumps = staged(OT.write_dump(text_nodes(spark, d), "doc_id", "dump"), "dumps")
    # Equal texts of a task side by side: a file keeps their digest once, where it would keep it for nearly every node.
    found = OT.read_dump(dumps, "doc_id", "dump", place=False).sortWithinPartitions("text")
    return found.select("doc_id", "seq", "depth", "type", digest("text").alias("digest"))


@query("dump_parent", f"""with {TAGS} select page_id, seq, coalesce((select max(b.seq) from page_nodes b
    where b.page_id = a.page_id and b.seq < a.seq and b.depth = a.depth - 1), -1) as parent_seq from page_nodes a""")
def _(spark, d):
    dumps = staged(OT.write_dump(tag_nodes(spark, d), "page_id", "dump"), "dumps")
    return OT.with_parent(OT.read_dump(dumps, "page_id", "dump"), "page_id").select(
        "page_id", "seq", F.coalesce("parent_seq", F.lit(-1)).alias("parent_seq"))


@query("parse_columns", f"""with {DOCS}, dumps as (select doc_id, string_agg(repeat('  ', depth) || '(' || type || ') "' ||
    replace(text, {NL}, '\\n') || '"', {NL} order by seq) as dump from nodes where doc_id % 17 <> 0 group by doc_id)
select s.doc_id, coalesce(sha256(dump), '') as digest, coalesce(len(string_split(dump, {NL})), -1) as ast_node_count,
    coalesce((length(dump) - length(replace(dump, '(ERROR)', ''))) // 7, -1) as num_errors from samples s left join dumps using (doc_id)""")
def _(spark, d):
    # Every 17th text has no tree.
    nodes = text_nodes(spark, d).where(F.col("doc_id") % 17 != 0)
    parsed = OT.parse_columns(samples(spark, d), nodes, "doc_id")
    return parsed.select(
        "doc_id", F.coalesce(digest("lang_specific_parse"), F.lit("")).alias("digest"),
        F.coalesce("ast_node_count", F.lit(-1)).alias("ast_node_count"),
        F.coalesce("num_errors", F.lit(-1)).alias("num_errors"))


@query("node_text", f"""with {DOCS}, sliced as (select n.doc_id, n.seq, substring(code, cast(sb + 1 as bigint), cast(eb - sb as bigint)) as text
from nodes n join samples using (doc_id)) select doc_id, {sql_digest(['seq', 'text'], 'seq')} from sliced group by doc_id""")
def _(spark, d):
    found = OT.node_text(text_nodes(spark, d), samples(spark, d), "doc_id")
    return whole_digest(found, ["seq", "text"], "seq")


@query("node_text_corrected", f"with {DOCS} select doc_id, {sql_digest(['seq', 'text'], 'seq')} from nodes group by doc_id")
def _(spark, d):
    found = OT.node_text(text_nodes(spark, d), samples(spark, d), "doc_id", mode="corrected")
    return whole_digest(found, ["seq", "text"], "seq")


@query("parent_child", f"""with {DOCS} select doc_id, seq, case depth when 0 then -1 when 1 then 0 else
    max(case when depth = 1 then seq end) over (partition by doc_id order by seq) end as parent_seq from nodes""")
def _(spark, d):
    return OT.with_parent(text_nodes(spark, d), "doc_id").select(
        "doc_id", "seq", F.coalesce("parent_seq", F.lit(-1)).alias("parent_seq"))


# Node types of program code put on the document trees.
_LINE_TYPES = ("variable_declaration", "type_declaration", "function_definition", "class_body", "import_statement")
_TOKEN_TYPES = ("variable_declarator", "type_spec", "string", "identifier", "comment", "call_expression",
                "import_clause", "method_invocation", "=", "class_declaration", "integer", "if_statement", "block")


def _pick(names, i):
    return F.element_at(F.array(*[F.lit(x) for x in names]), (i % len(names) + 1).cast("int"))


def retyped(nodes):
    return nodes.drop("parent_seq", "parent_type").withColumn("type", (
        F.when(F.col("depth") == 0, "program").when(F.col("depth") == 1, _pick(_LINE_TYPES, F.col("seq")))
        .otherwise(_pick(_TOKEN_TYPES, F.col("seq")))))


def _sql_pick(names, i):
    return "list_extract([" + ", ".join(f"'{x}'" for x in names) + f"], cast({i} % {len(names)} + 1 as int))"


def _sql_list(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


RETYPED = f"""retyped as (select * replace (case depth when 0 then 'program' when 1 then {_sql_pick(_LINE_TYPES, 'seq')}
    else {_sql_pick(_TOKEN_TYPES, 'seq')} end as type) from nodes),
parented as (select *, case depth when 0 then null when 1 then 0 else max(case when depth = 1 then seq end) over w end as raw_parent,
    case depth when 0 then '' when 1 then 'program' else arg_max(type, seq) filter (where depth = 1) over w end as parent_type
    from retyped window w as (partition by doc_id order by seq)),
judged as (select *, trim(text, ' ' || chr(9) || {NL} || chr(13)) as stripped from parented),
kept as (select *, not (stripped in ({_sql_list(SKIP_TEXTS)}) or type in ({_sql_list(SKIP_TYPES)})
    or (type = 'string' and (stripped like '\"\"\"%' or stripped like '''''''%'))
    or (type = 'variable_declarator' and parent_type in ('variable_declaration', 'lexical_declaration') and stripped <> '')
    or (type = 'type_spec' and parent_type = 'type_declaration' and stripped <> '')) as keep from judged)""".replace('\\"', '"')
# The trees have three levels, so a parent is the last line or the root.
LINKED = RETYPED + """, numbered as (select *, sum(keep::int) over (partition by doc_id order by seq) - 1 as nid from kept),
lifted as (select *, first_value(keep) over w as root_keep, first_value(nid) over w as root_id,
    arg_max(keep, seq) filter (where depth = 1) over w as line_keep, arg_max(nid, seq) filter (where depth = 1) over w as line_id
    from numbered window w as (partition by doc_id order by seq)),
linked as (select *, case when depth = 2 and line_keep then line_id when depth > 0 and root_keep then root_id end as parent,
    case depth when 1 then root_keep when 2 then line_keep else false end as direct from lifted where keep)"""


@query("skip_nodes", f"with {DOCS}, {RETYPED} select doc_id, seq, not keep as skip from kept")
def _(spark, d):
    nodes = OT.with_keep(OT.with_parent(retyped(text_nodes(spark, d)), "doc_id"))
    return nodes.select("doc_id", "seq", (~F.col("keep")).alias("skip"))


# Page trees without their frame, so that nodes are lifted over several levels.
_FRAME = ("html", "head", "body", "div", "ul")


def unframed(spark, d):
    nodes = OT.with_parent(tag_nodes(spark, d), "page_id").withColumn("keep", ~F.col("type").isin(*_FRAME))
    return OT.prune(nodes, "page_id").where("keep")


_PAGE_TREES = TAGS + f""", pa as (select a.id, a.seq, a.type not in ({_sql_list(_FRAME)}) as keep,
    (select max(b.seq) from page_nodes b where b.id = a.id and b.seq < a.seq and b.depth = a.depth - 1) as parent from page_nodes a),
r as (select id, seq, parent as anc from pa union all
    select r.id, r.seq, q.parent from r join pa q on r.id = q.id and r.anc = q.seq where not q.keep),
nearest as (select r.id, r.seq, max(anc) filter (where q.keep) as anc from r left join pa q on r.id = q.id and r.anc = q.seq group by all),
dense as (select id, seq, sum(keep::int) over (partition by id order by seq) - 1 as nid, keep from pa)"""


@query("preorder_id", f"with recursive {_PAGE_TREES} select id as page_id, seq, cast(nid as bigint) as id from dense where keep")
def _(spark, d):
    return unframed(spark, d).select("page_id", "seq", "id")


@query("reparent", f"""with recursive {_PAGE_TREES} select n.id as page_id, cast(o.nid as bigint) as id, cast(coalesce(a.nid, -1) as bigint) as parent
from nearest n join dense o on n.id = o.id and n.seq = o.seq left join dense a on n.id = a.id and n.anc = a.seq where o.keep""")
def _(spark, d):
    return unframed(spark, d).select("page_id", "id", F.coalesce("parent", F.lit(-1)).alias("parent"))


@query("children_ids", f"""with recursive {_PAGE_TREES} select c.id as page_id, cast(p.nid as bigint) as id,
    string_agg(cast(cast(k.nid as bigint) as varchar), ',' order by k.nid) as children
from pa c join dense k on c.id = k.id and c.seq = k.seq join dense p on c.id = p.id and c.parent = p.seq
where c.keep and p.keep group by c.id, p.nid""")
def _(spark, d):
    return OT.children_ids(unframed(spark, d), "page_id").select(
        "page_id", "id", F.array_join("children", ",").alias("children"))


# Trees of the documents under program types, pruned by the real rules.
def pruned(spark, d, carry=("language",)):
    coded = samples(spark, d).withColumn("language", spread_language())
    return OR.with_category(OT.prune(retyped(OT.text_nodes(coded, "doc_id", "code", carry)), "doc_id")).where("keep")


_CATEGORY = "case " + " ".join(
    "when " + " or ".join(f"contains(lower(type), '{k}')" for k in words) + f" then '{group}.{name}'"
    for group, name, words in CATEGORIES) + " end"
RECORDS = DOCS + ", " + LINKED + f", categorized as (select *, {_CATEGORY} as category from linked)"


_ID, _PARENT = "cast(nid as bigint)", "cast(parent as bigint)"


@query("pruned_tree", f"""with {DOCS}, {LINKED} select doc_id, seq, {_ID} as id, cast(coalesce(parent, -1) as bigint) as parent,
    type, text from linked""")
def _(spark, d):
    return pruned(spark, d).select("doc_id", "seq", "id", F.coalesce("parent", F.lit(-1)).alias("parent"), "type", "text")


@query("categorize", f"""with {RECORDS} select type, coalesce(category, 'none') as category, count(*) as nodes from categorized group by all""")
def _(spark, d):
    return pruned(spark, d).groupBy("type", F.coalesce("category", F.lit("none")).alias("category")).agg(
        F.count(F.lit(1)).alias("nodes"))


@query("category_index", f"""with {RECORDS}, ids as (select doc_id, category, string_agg(cast(cast(nid as bigint) as varchar), ',' order by nid) as ids
    from categorized where category is not null group by all)
select s.doc_id, {', '.join(f"coalesce(max(ids) filter (where category = '{g}.{n}'), '') as {n}" for g, n, _ in CATEGORIES)}
from (select distinct doc_id from categorized) s left join ids using (doc_id) group by s.doc_id""")
def _(spark, d):
    index = OR.category_index(pruned(spark, d), "doc_id")
    return index.select("doc_id", *[
        F.array_join(f"node_categories.{g}.{n}", ",").alias(n) for g, n, _ in CATEGORIES])


@query("category_counts", f"""with {RECORDS} select doc_id, category, count(*) as nodes from categorized
where category is not null group by all""")
def _(spark, d):
    return OR.category_counts(pruned(spark, d), ["doc_id"])


@query("category_node_lookup", f"""with {RECORDS} select doc_id, {sql_digest([_ID, 'category', 'type', 'text'])}
from categorized where category is not null group by doc_id""")
def _(spark, d):
    nodes = pruned(spark, d)
    # Ids are dense, so the node of an id is at its place; one row a record on both sides keeps the nodes where they are.
    held = nodes.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("id", "type", "text"))).alias("_held"))

    def listed(group, name):
        return F.transform(f"node_categories.{group}.{name}", lambda i: F.struct(
            F.lit(f"{group}.{name}").alias("listed"), i.alias("id"), F.get("_held", i)["type"].alias("type"), F.get("_held", i)["text"].alias("text")))

    found = OR.category_index(nodes, "doc_id").join(held, "doc_id").select(
        "doc_id", F.inline(F.concat(*[listed(g, n) for g, n, _ in CATEGORIES])))
    return whole_digest(found, ["id", "listed", "type", "text"])


@query("nodes_of_category", f"""with {RECORDS} select category, doc_id, {sql_digest([SPREAD_LANGUAGE, _ID, 'text'])}
from categorized where category in ('declarations.functions', 'declarations.classes') group by category, doc_id""")
def _(spark, d):
    found = [whole_digest(OT.category_nodes(pruned(spark, d), c), ["language", "id", "text"]).withColumn("category", F.lit(c))
             for c in ("declarations.functions", "declarations.classes")]
    return found[0].unionByName(found[1])


@query("cross_language_map", f"""with {RECORDS}, entries as (select *, {SPREAD_LANGUAGE} as language, text as t,
    case category when 'declarations.functions' then 'function_declarations' when 'declarations.classes' then 'class_declarations'
        else 'import_statements' end as kind,
    case category when 'declarations.functions' then 'function' when 'declarations.classes' then 'class' end as universal_type
    from categorized where category in ('declarations.functions', 'declarations.classes', 'declarations.imports') and text <> ''),
worded as (select *, {WORDS_SQL} as w from entries),
named as (select *, case when kind <> 'import_statements' then {NAME_SQL} end as name,
    case when kind = 'import_statements' then text else substring(text, 1, 100) end as shown from worded)
select doc_id, {sql_digest(['kind', _ID, 'universal_type', 'name', 'shown'])} from named
where kind = 'import_statements' or name is not null group by doc_id""")
def _(spark, d):
    entries = OR.cross_language_entries(pruned(spark, d), "doc_id")
    return whole_digest(entries, ["kind", "node_id", "universal_type", "name", "text"], "node_id")


def _record_inputs(spark, d):
    coded = P.with_raw_metrics(samples(spark, d).withColumn("language", spread_language()))
    return coded, retyped(OT.text_nodes(coded, "doc_id", "code"))


def universal(spark, d):
    coded, nodes = _record_inputs(spark, d)
    return OR.universal_records(coded, nodes, "doc_id")


@query("universal_record", f"""with {RECORDS}, counted as (select doc_id, count(*) as nodes, count(category) as categorized,
    count(*) filter (where category = 'declarations.functions') as functions,
    count(*) filter (where category = 'declarations.imports') as imports, count(*) filter (where direct) as children,
    count(*) filter (where parent is null) as roots from categorized group by doc_id)
select s.doc_id, {SPREAD_LANGUAGE} as language, 'program' as root, {RAW_COUNT} as lines,
    round((length(code) - ({RAW_COUNT} - 1)) / {RAW_COUNT}, 6) as avg_line_length, sha256(code) as source_hash,
    coalesce(nodes, 0) as nodes, coalesce(categorized, 0) as categorized_nodes, coalesce(functions, 0) as functions,
    coalesce(imports, 0) as imports, coalesce(children, 0) as children, coalesce(roots, 0) as roots
from samples s left join counted c using (doc_id)""")
def _(spark, d):
    u = F.col("universal")
    nodes = u["ast"]["nodes"]
    return universal(spark, d).select(
        "doc_id", u["language"].alias("language"), u["ast"]["root"].alias("root"), u["metadata"]["lines"].alias("lines"),
        F.round(u["metadata"]["avg_line_length"], 6).alias("avg_line_length"), u["metadata"]["source_hash"].alias("source_hash"),
        u["metadata"]["nodes"].alias("nodes"), u["metadata"]["categorized_nodes"].alias("categorized_nodes"),
        F.size(u["cross_language_map"]["function_declarations"]).alias("functions"),
        F.size(u["cross_language_map"]["import_statements"]).alias("imports"),
        F.aggregate(nodes, F.lit(0), lambda s, n: s + F.size(n["children"])).alias("children"),
        F.size(F.filter(nodes, lambda n: n["parent"].isNull())).alias("roots"))


def record_json(spark, d):
    return universal(spark, d).select("doc_id", OR.to_record_json("universal").alias("json"))


@query("to_record_json", f"""with {RECORDS},
kids as (select doc_id, cast(parent as bigint) as nid, string_agg(cast({_ID} as varchar), ',' order by nid) as ids
    from categorized where direct group by doc_id, parent),
held as (select c.* replace (cast(c.nid as bigint) as nid), coalesce(k.ids, '') as ids from categorized c left join kids k on k.doc_id = c.doc_id and k.nid = c.nid),
digested as (select doc_id, {sql_digest(['nid', _PARENT, 'ids', 'type', 'text', "coalesce(category, '')"])} from held group by doc_id)
select s.doc_id, {SPREAD_LANGUAGE} as language, sha256(code) as source_hash, sha256(code) as code_hash, coalesce(rows, 0) as rows,
    coalesce(digest, '') as digest from samples s left join digested d using (doc_id)""")
def _(spark, d):
    records = staged(record_json(spark, d), "record-json")
    shape = "struct<node_categories:struct<" + ",".join(
        f"{group}:struct<{','.join(f'{n}:array<int>' for g, n, _ in CATEGORIES if g == group)}>" for group in dict.fromkeys(g for g, _, _ in CATEGORIES)) + ">>"

    def listed(group, name):
        return F.transform(F.col(f"p.node_categories.{group}.{name}"), lambda i: F.struct(i.alias("id"), F.lit(f"{group}.{name}").alias("category")))

    # The outer form: for the other one the JSON is parsed again, to leave out records without entries beforehand.
    categories = records.select("doc_id", F.from_json("json", shape).alias("p")).select(
        "doc_id", F.inline_outer(F.concat(*[listed(g, n) for g, n, _ in CATEGORIES]))).where(F.col("id").isNotNull())
    nodes = OR.read_record(records, "doc_id", "json").withColumn("ids", F.concat_ws(",", F.transform("children", lambda x: x.cast("string"))))
    nodes = nodes.join(categories, ["doc_id", "id"], "left").withColumn("category", F.coalesce("category", F.lit("")))
    found = whole_digest(nodes, ["id", "parent", "ids", "type", "text", "category"])
    head = records.select(
        "doc_id", F.get_json_object("json", "$.language").alias("language"), F.get_json_object("json", "$.metadata.source_hash").alias("source_hash"),
        digest(F.get_json_object("json", "$.original_source_code")).alias("code_hash"))
    return head.join(found, "doc_id", "left").fillna({"rows": 0, "digest": ""})


@query("read_record", f"""with {RECORDS} select doc_id, {_ID} as id, type, sha256(text) as digest,
    cast(coalesce(parent, -1) as bigint) as parent, row as start_row, cast(c as bigint) as start_column from categorized""")
def _(spark, d):
    nodes = OR.read_record(record_json(spark, d), "doc_id", "json")
    return nodes.select("doc_id", "id", "type", digest("text").alias("digest"), F.coalesce("parent", F.lit(-1)).alias("parent"),
                        F.col("start_point.row").alias("start_row"), F.col("start_point.column").alias("start_column"))


@query("graph_nodes", f"""with {RECORDS} select doc_id, {_ID} as id, type || {NL} || case when length(text) > 30
    then '(' || substring(text, 1, 30) || '...)' else text end as label,
    case when parent is null then '#00c2ff' else '#ffaa00' end as color, 'box' as shape from categorized""")
def _(spark, d):
    return OR.graph_nodes(pruned(spark, d), "doc_id")


@query("graph_edges", f"""with {RECORDS} select doc_id, {sql_digest([_PARENT, _ID])}
from categorized where parent is not null group by doc_id""")
def _(spark, d):
    return whole_digest(OR.graph_edges(pruned(spark, d), "doc_id"), ["source", "target"], "target")


# Records spoiled in one way each.
def spoiled_json(df):
    i, j = F.col("doc_id") % 8, F.col("json")
    return df.withColumn("json", (
        F.when(i == 0, F.replace(j, F.lit('"success":true,'), F.lit("")))
        .when(i == 1, F.replace(j, F.lit('"errors":0'), F.lit('"errors":"0"')))
        .when(i == 2, F.replace(j, F.lit('"root":"program",'), F.lit("")))
        .when(i == 3, F.substring(j, 1, 20))
        .when(i == 4, F.replace(j, F.lit('"id":0,'), F.lit('"id":7,')))
        .otherwise(j)))


@query("validate_record", f"""with {RECORDS}, sized as (select s.doc_id, count(c.doc_id) as n,
    count(c.doc_id) filter (where c.parent = 0) as under_first from samples s left join categorized c using (doc_id) group by 1),
spoilt as (select doc_id, case doc_id % 8 when 0 then 'success missing' when 1 then 'metadata.errors wrong type' when 2 then 'ast.root missing'
    when 3 then 'not JSON' end as spoiled, doc_id % 10 = 2 and doc_id % 8 <> 3 as undeclared,
    doc_id % 8 = 4 and n > 0 as shifted from sized)
select doc_id, coalesce(spoiled, '') as spoiled, undeclared, shifted from spoilt""")
def _(spark, d):
    found = OR.record_violations(spoiled_json(record_json(spark, d)), "doc_id", "json")
    has = lambda x: F.array_contains("violations", x)
    return found.select(
        "doc_id",
        F.when(has("success missing"), "success missing").when(has("metadata.errors wrong type"), "metadata.errors wrong type")
        .when(has("ast.root missing"), "ast.root missing").when(has("not JSON"), "not JSON").otherwise("").alias("spoiled"),
        has("language not declared").alias("undeclared"), has("node ids not dense").alias("shifted"))


# One fault per kind of rule, all places of it, in records of every document: what is replaced, by what.
_FAULTS = (
    ('"success":true,', ''), ('"errors":0', '"errors":"0"'), ('"root":"program",', ''), ('"success":true', '"success":1'),
    ('"lines":', '"lines":0.5,"x":'), ('"ast":{', '"ast":0,"x":{'), ('"metadata":{', '"x":{'),
    ('"source_hash":"', '"source_hash":null,"x":"'), ('"parent":0,', '"parent":"0",'), ('"type":"block",', ''),
    ('"children":[]', '"children":["x"]'), ('"start_point":{"row":0,', '"start_point":{"row":null,'), ('"language":', '"language":'),
)
_BROKEN_AT = (
    ("$.success", "required"), ("$.metadata.errors", "type"), ("$.ast.root", "required"), ("$.success", "type"),
    ("$.metadata.lines", "type"), ("$.ast", "type"), ("$.metadata", "required"), ("$.metadata.source_hash", "type"),
)


def faulty_json(df):
    json, kind = F.col("json"), F.col("doc_id") % (len(_FAULTS) + 1)
    result = F.substring(json, 1, 20)
    for i, (old, new) in enumerate(_FAULTS):
        result = F.when(kind == i, F.replace(json, F.lit(old), F.lit(new))).otherwise(result)
    return df.withColumn("json", result)


@query("schema_violations", f"""with {RECORDS},
parents as (select distinct doc_id, parent from categorized where direct),
nodes_hit as (select c.doc_id, cast(c.nid as bigint) as nid, case c.doc_id % {len(_FAULTS) + 1}
    when 8 then case when c.parent = 0 then '.parent' end when 9 then case when c.type = 'block' then '.type' end
    when 10 then case when p.doc_id is null then '.children[0]' end when 11 then case when c.row = 0 then '.start_point.row' end end as field
    from categorized c left join parents p on p.doc_id = c.doc_id and p.parent = c.nid),
read as (select doc_id, doc_id % {len(_FAULTS) + 1} as kind, coalesce(code, '') <> '' and doc_id % {len(_FAULTS) + 1} <> {len(_FAULTS)} as readable from samples)
select doc_id, '$' as path, 'json' as rule from read where not readable
union all select doc_id, '$.language', 'enum' from read where readable and doc_id % 10 = 2
union all select doc_id, list_extract([{', '.join(f"'{p}'" for p, _ in _BROKEN_AT)}], cast(kind + 1 as int)),
    list_extract([{', '.join(f"'{r}'" for _, r in _BROKEN_AT)}], cast(kind + 1 as int)) from read where readable and kind < {len(_BROKEN_AT)}
union all select doc_id, '$.ast.nodes[' || nid || ']' || field, case field when '.type' then 'required' else 'type' end
    from nodes_hit where field is not null""")
def _(spark, d):
    return OR.schema_violations(faulty_json(record_json(spark, d)), "doc_id", "json")


def converted(spark, d):
    coded = P.with_raw_metrics(samples(spark, d).withColumn("language", F.when(
        F.col("doc_id") % 19 == 0, "pascal").otherwise(spread_language())))
    return C.convert_samples(coded, "doc_id")


@query("convert_folder", f"""with {SAMPLES} select coalesce(file, 'TOTAL') as file, count(*) as total_rows,
    count(*) filter (where doc_id % 19 <> 0 and code <> '') as successful_conversions,
    round(count(*) filter (where doc_id % 19 <> 0 and code <> '') / count(*), 6) as success_rate
from samples group by rollup (file)""")
def _(spark, d):
    return rounded(C.convert_folder_summary(converted(spark, d)), "success_rate")


@query("convert_samples", f"""with {SAMPLES} select doc_id, file, doc_id % 19 <> 0 and code <> '' as converted,
    case when doc_id % 19 <> 0 and code <> '' then sha256(code) else '' end as source_hash from samples""")
def _(spark, d):
    found = F.get_json_object("universal_schema", "$.metadata.source_hash")
    return converted(spark, d).select(
        "doc_id", "file", F.col("universal_schema").isNotNull().alias("converted"),
        F.coalesce(found, F.lit("")).alias("source_hash"))
