"""Registered queries of the corpus operators; each derives its columns from an operator's output."""

import corpus_pipeline
from pyspark.sql import functions as F

from grovekit.llm import (
    benchmark, chat, idstore, licenses, lines, minhash, negatives, packing, repair, secrets, toxicity, urls, vectors,
)
from grovekit.operators.bounded import key_join
from grovekit.session import stage_path

CORPUS_QUERIES = {}
CORPUS_SQL = {}


def _query(function):
    CORPUS_QUERIES[function.__name__] = function
    return function


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op3_token_store(spark, folder):
    path = idstore.write_store(_table(spark, folder, "documents"), stage_path(spark, "token-store"))
    return idstore.read_store(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op2_pattern_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@_query
def op5_prefix_decontamination(spark, folder):
    found = benchmark.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), "contaminated")


@_query
def op6_minhash_near_duplicates(spark, folder):
    return minhash.near_duplicates(_table(spark, folder, "documents")).withColumn(
        "n_shingles", F.col("n_shingles").cast("long"))


@_query
def op4_site_spread_lines(spark, folder):
    out = lines.remove_boilerplate(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


CORPUS_SQL["op4_site_spread_lines"] = """
with lines as (
  select doc_id, source, trim(line) as line, pos, raw from (
    select doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(string_split(text, chr(10))) as raw,
           unnest(range(len(string_split(text, chr(10))))) as pos from documents)
), spread as (
  select line, min(doc_id) as first from lines where line <> '' group by line having count(distinct source) >= 8
), marked as (
  select l.doc_id, l.pos, l.raw, s.line is not null and l.doc_id <> s.first as gone
  from lines l left join spread s on l.line = s.line
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
       sha256(coalesce(string_agg(raw, chr(10) order by pos) filter (where not gone), '')) as text_sha256
from marked group by doc_id
"""


@_query
def op8_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op7_chat_prefix_tree(spark, folder):
    added = spark.createDataFrame(
        [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")],
        "conv_id long, turn long, role string, text string")
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    read = chat.read_back(*chat.prefix_tree(rows))
    whole = F.array_join(F.flatten(F.transform("turns", lambda t: F.array(F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


CORPUS_SQL["op7_chat_prefix_tree"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped as (
  select *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') as body,
         replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':', '\:') as head
  from turns
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(head) + length(body) + length('### :') + length('</turn>') + 2)::bigint as formatted_chars
from escaped group by conv_id
"""


@_query
def op9_projection_neighbours(spark, folder):
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


CORPUS_SQL["op9_projection_neighbours"] = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as u, b.vec_id as v from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(u, v) as (
  select u, v from links union select r.u, l.v from reach r join links l on r.v = l.u
), counted as (select u, count(*) as n from links group by u), smallest as (select u, min(v) as m from reach group by u)
select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(m, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) as kept
from embeddings e left join counted c on e.vec_id = c.u left join smallest s on e.vec_id = s.u
"""


@_query
def op1_url_filter(spark, folder):
    return urls.judge(_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@_query
def op10_secret_battery(spark, folder):
    found = secrets.find_secrets(_table(spark, folder, "documents"))

    def counted(kind):
        return F.size(F.filter("spans", lambda x: x["rank"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    def listed(spans):
        name = F.array(*[F.lit(k) for k in secrets.KINDS])
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["rank"]), x["start"], x["end"])), ",")

    base = F.filter("spans", lambda x: x["rank"] < secrets.KINDS.index("random"))
    return found.select(
        "doc_id", counted("assign"), counted("access"), counted("hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@_query
def op11_license_templates(spark, folder):
    found = licenses.scan(_table(spark, folder, "documents"))

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"), listed(F.col("places.label")).alias("base_labels"),
        listed(F.concat("places.label", "matches.label")).alias("labels"), "score")


def _license_sql():
    """The scan by regular expressions over words followed by blanks; the automaton has no part in it."""
    def expression(items):
        out = ""
        for x in items:
            if isinstance(x, bytes):
                out += x.decode() + " "
            elif x[0] == "any":
                out += f"(?:[^ ]+ ){{{x[1]},{x[2]}}}"
            elif x[0] == "opt":
                out += f"(?:{expression(x[1])})?"
            else:
                out += f"(?:{'|'.join(map(expression, x[1]))})"
        return out

    parsed = {k: licenses.parse(v) for k, v in licenses.TEMPLATES.items()}
    own = ", ".join(f"case when regexp_matches(s, ' {expression(v)}') then '{k}' end" for k, v in parsed.items())
    shares = []
    for items in parsed.values():
        parts = licenses.mandatory(items)
        held = " + ".join(
            f"case when {' or '.join(f"""contains(s, ' {' '.join(w.decode() for w in c)} ')""" for c in choices)} then {min(map(len, choices))} else 0 end"
            for choices in parts)
        shares.append(f"({held}) / {sum(min(map(len, choices)) for choices in parts)}")
    places = ", ".join(
        "list_transform(list_filter(range(len(w)), lambda i: " + " and ".join(f"w[i + {n}] = '{x}'" for n, x in enumerate(v.split(), 1))
        + f"), lambda i: {{'label': '{k}', 'word': i}})" for k, v in licenses.PHRASES.items())
    return fr"""
with lowered as (
  select doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) as t from documents
), worded as (
  select doc_id, ' ' || t || ' ' as s, case when t = '' then [] else string_split(t, ' ') end as w from lowered
), found as (
  select doc_id, len(w) as n_words, flatten([{places}]) as p, list_filter([{own}], lambda x: x is not null) as own,
         greatest({', '.join(shares)}) as share from worded
)
select doc_id, n_words, len(p) as n_base, list_min(list_transform(p, lambda x: x.word)) as first_word,
       list_max(list_transform(p, lambda x: x.word)) as last_word,
       array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), own))), ',') as labels,
       (case when len(own) > 0 then 1 else greatest(least(share, 0.9), case when len(p) > 0 then 0.5 else 0 end) end)::double as score
from found
"""


CORPUS_SQL["op11_license_templates"] = _license_sql()


@_query
def op12_strassen_hard_negatives(spark, folder):
    shifted = _table(spark, folder, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(negatives.prepared(shifted), F.col("vec_id") % 100 == 0)


CORPUS_SQL["op12_strassen_hard_negatives"] = """
with rows as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as materialized (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as score
  from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), positives as (
  select * from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id)::int as rank,
       n.vec_id as negative_id, p.score::bigint as positive_score, n.score::bigint as negative_score
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
     and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""


@_query
def op13_conversation_repair(spark, folder):
    rows = _table(spark, folder, "conversations")
    report, repaired = repair.repair(repair.damage(rows))
    found = key_join(rows.select("conv_id").distinct(), report, ["conv_id"], "left")
    found = key_join(found, repair.row_digests(repaired), ["conv_id"], "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _repair_sql():
    """Costs and letters of every state go from row to row as one text that sorts by cost, then letters."""
    def after(state, cost, letter):
        return f"lpad(cast(cast(left({state}, 8) as int) + {cost} as varchar), 8, '0') || substr({state}, 9) || '{letter}'"

    def best(*options):
        return f"least({', '.join(options)})"

    user = best("s2", *[after(s, 3, "I") for s in ("s0", "s1", "s3")])
    keep, rerole = "case when fault in ('', 'truncated') and i = '{}' then {} end", "case when fault in ('', 'truncated') then {} end"
    late = "case when fault = 'truncated' then 3 else 0 end"
    open_states = ("s0", "s1", "u3")
    to_user = [keep.format("u", after(s, late, "K")) for s in open_states] + [rerole.format(after(s, f"(3 + {late})", "R")) for s in open_states]
    return fr"""
with recursive damaged as (
  select *, crc32_of % 20 as fate from (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(k))::bigint), lambda i: ascii(k[i + 1])::bigint)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
               lambda v, z: case when v % 2 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)) as not_crc,
           4294967295::bigint - not_crc as crc32_of
    from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations))
), copied as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(range(case when fate = 0 then 0 when fate = 3 then 2 else 1 end)) from damaged)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, left(text, 64), sha256(text)) as pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid, left(role, 1) as i from copied
), faulty as (
  select *, lag(i) over (partition by conv_id order by pos) || i as pair,
         case when solid = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
              when right(solid, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from placed
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
         count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, max(pos) as n from faulty group by conv_id
), costs(conv_id, pos, s0, s1, s2, s3) as (
  select conv_id, 0::bigint, '00000000', null::varchar, null::varchar, null::varchar from counted
  union all
  select conv_id, pos, {after('s0', 4, 'D')}, {best(after('s1', 4, 'D'), keep.format('s', after('s0', late, 'K')))},
         {best(after('u2', 4, 'D'), *to_user)},
         {best(after('u3', 4, 'D'), keep.format('a', after('u2', late, 'K')), rerole.format(after('u2', f'(3 + {late})', 'R')))}
  from (select *, {best('s3', after('u2', 3, 'I'))} as u3 from (
    select f.conv_id, f.pos, f.fault, f.i, c.s0, c.s1, c.s3, {user} as u2
    from costs c join faulty f on f.conv_id is not distinct from c.conv_id and f.pos = c.pos + 1))
), ended as (
  select conv_id, cast(left(v, 8) as bigint) as cost, substr(v, 9) as audit from (
    select c.conv_id, {best('s0', 's3', after('u2', 3, 'I'))} as v from (
      select c.conv_id, s0, s3, {user} as u2 from costs c join counted n on c.conv_id is not distinct from n.conv_id and c.pos = n.n) c)
), letters as (
  select conv_id, nth, audit[nth] as letter, len(replace(left(audit, nth), 'I', '')) as pos, len(replace(left(audit, nth), 'D', '')) as out
  from (select conv_id, audit, unnest(range(1, len(audit) + 1)) as nth from ended)
), written as (
  select l.*, f.role, f.text, coalesce(max((l.letter = 'K' and l.out = 1 and f.i = 's')::int) over (partition by l.conv_id), 0) as has_system
  from letters l left join faulty f on l.letter <> 'I' and f.conv_id is not distinct from l.conv_id and f.pos = l.pos where l.letter <> 'D'
), digests as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role when (out - has_system) % 2 = 1 then 'user' else 'assistant' end
                                    || ':' || case when letter = 'I' then '' else text end, chr(10) order by nth)) as h
  from written group by conv_id
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
       coalesce(h, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counted n on o.conv_id is not distinct from n.conv_id
  left join ended e on o.conv_id is not distinct from e.conv_id left join digests d on o.conv_id is not distinct from d.conv_id
"""


CORPUS_SQL["op13_conversation_repair"] = _repair_sql()


@_query
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL is not None:
    CORPUS_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
