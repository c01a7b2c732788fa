"""The operators as queries over the given tables, and the SQL for those that SQL can say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import (
    bpe, chat_format, html_extract, merkle, ngram_join, packing, periodic, piece_table, secret_scan, topk, toxicity, url_filter, winnowing,
)
from loglake.llm.common import table

#: The score from which a text counts as toxic.
TOXIC = 0.3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Words of hosts whose pages make the list of op1.
BAD_HOSTS = r"(^|[.-])(adult|ads|spam|casino|pills|bets)([.-]|$)"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the canonical URLs of all pages on hosts of ill repute."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = pages.filter(url_filter.url_host(F.col("url")).rlike(BAD_HOSTS))
    judged = url_filter.judge_urls(pages, bad.select(url_filter.canonical_url(F.col("url")).alias("canonical")), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100).select(
        "doc_id", "n_shingles", "component_id")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast(conversations.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(conversations.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.read_back(chat_format.format_chat(conversations.unionByName(probe)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = winnowing.compare_edited(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", winnowing.spelled(F.col("hashes")).alias("fingerprint"),
        winnowing.spelled(F.col("edited_hashes")).alias("edited_fingerprint"), "near_edited", "near_next",
        winnowing.spelled(F.col("positions")).alias("positions"),
        winnowing.spelled(F.col("edited_positions")).alias("edited_positions"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return whole.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.named(F.col("base")), 256).alias("base_sha256"),
        secret_scan.named(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering lower-cases the text of a fifth of the documents, by the checksum of their ids."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                      merkle.leaf(text=F.translate("text", UPPER, UPPER.lower())))
    proofs = merkle.prove(merkle.build(table(spark, sf_dir, "documents"), {"tampered": tampered}))
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("siblings"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def planted_period(documents: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents, by the checksum of their ids, repeat from some word on."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    draw = F.floor(F.col("sum") / 10)
    marked = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("sum"))
    marked = marked.withColumn("words", F.when(F.col("sum") % 10 == 0, words)).withColumn(
        "first", draw % F.size("words")).withColumn(
        "period", 1 + F.floor((F.size("words") - F.col("first")) / (3 + draw % 8)))
    copied = lambda w, i: F.when(i < F.col("first"), w).otherwise(
        F.element_at("words", (F.col("first") + (i - F.col("first")) % F.col("period") + 1).cast("int")))
    return marked.select("doc_id", F.when(F.size("words") > 0, F.array_join(F.transform("words", copied), " ")).otherwise(
        F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted_period(table(spark, sf_dir, "documents")))
    # Runs come in order of start and period, so the first of equals stays.
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", nothing, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    spelled = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.array_join(F.transform(spelled, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    whole = piece_table.decode(piece_table.encode(table(spark, sf_dir, "documents"), path), path)
    return whole.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_packing, op3_ngram_join, op4_chat_format, op5_toxicity, op6_winnowing, op7_bpe, op8_topk, op9_html_extract,
    op10_secret_scan, op11_merkle, op12_periodic_runs, op13_sentencepiece)}

ORACLE: dict[str, str] = {}

ORACLE["op4_chat_format"] = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(role) + 5 + 6 + length(regexp_replace(
           text, '(\\*)(</?s>|\[/?INST\]|<</?SYS>>|<\|)', '\1\1\\\2', 'g')) as chars,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         count(*) over (partition by conv_id) as n
  from rows_),
summed as (select *, sum(chars) over (partition by conv_id order by pos) as upto from sized)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(upto) filter (role = 'assistant' or pos = n) as bigint) as formatted_chars
from summed group by conv_id
"""

ORACLE["op8_topk"] = """
with v as materialized (
  select row_number() over () as row_, vec_id, list_transform(embedding, lambda x : floor(256 * cast(x as double))) as vector from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0),
scored as (
  select q.row_ as query, q.vec_id as query_id, d.vec_id, cast(list_inner_product(q.vector, d.vector) as bigint) as score
  from v q join v d on q.row_ <> d.row_ where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query order by score desc, vec_id) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

ORACLE["op1_url_filter"] = r"""
with parts as (
  select page_id, url,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path,
         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^?#]*[?]([^#]*)', 1), '&'),
           lambda p : p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) as params
  from pages),
named as (
  select *, case when regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') <> '' then
      regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end end as canonical
  from parts),
listed as (
  select distinct canonical from named
  where regexp_matches(host, '(^|[.-])(adult|ads|spam|casino|pills|bets)([.-]|$)') and canonical is not null),
rules(verdict, rule) as (values ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                                ('allow', 'com/fr/'), ('block', 'com/de/')),
best as (
  select page_id, url, arg_max(rule, length(rule)) as rule, arg_max(r.verdict, length(rule)) as verdict
  from (select distinct page_id, url, host, path from named) n
  join rules r on (host = split_part(rule, '/', 1) or host like '%.' || split_part(rule, '/', 1))
   and starts_with(path, substr(rule, strpos(rule, '/')))
  group by page_id, url)
select n.page_id, host, path, b.rule as rule,
       coalesce(b.verdict, case when l.canonical is not null then 'block' else 'allow' end) as verdict,
       l.canonical is not null as listed
from named n left join best b on n.page_id = b.page_id and n.url is not distinct from b.url
left join listed l on n.canonical = l.canonical
"""

ORACLE["op3_ngram_join"] = r"""
with recursive words_ as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w : w <> '') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words_),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
common as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as n, any_value(b.n) as m, count(*) as c
  from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from common where 100 * c >= 90 * (n + m - c)),
reach as (select doc_id, doc_id as to_id from documents union select r.doc_id, l.y from reach r join links l on r.to_id = l.x)
select s.doc_id, any_value(len(s.s)) as n_shingles, min(r.to_id) as component_id
from sets s join reach r using (doc_id) group by s.doc_id
"""

ORACLE["op10_secret_scan"] = r"""
with d as (select doc_id, coalesce(text, '') as text, md5(coalesce(text, '')) as same, coalesce(source, '') as owner from documents),
kinds(kind, k, pattern) as (values
  ('assign', 0, '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]{32,}'), ('live', 3, '[A-Za-z0-9+/_-]{20,}')),
found as (
  select doc_id, same, owner, 'assign' as kind, 0 as k, regexp_extract_all(text, (select pattern from kinds where k = 0)) as hits,
         string_split_regex(text, (select pattern from kinds where k = 0)) as gaps from d
  union all select doc_id, same, owner, 'access', 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+') from d
  union all select doc_id, same, owner, 'hex', 2, regexp_extract_all(text, '[0-9a-f]{32,}'), string_split_regex(text, '[0-9a-f]{32,}') from d
  union all select doc_id, same, owner, 'live', 3, regexp_extract_all(text, '[A-Za-z0-9+/_-]{20,}'), string_split_regex(text, '[A-Za-z0-9+/_-]{20,}') from d),
each as (
  select doc_id, same, owner, kind, k, hits[i] as hit,
         cast(list_sum(list_transform(gaps[1:i], lambda x : length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x : length(x))), 0) as bigint) as a
  from (select *, unnest(range(1, len(hits) + 1)) as i from found where len(hits) > 0)),
spans as (
  select *, a + length(hit) as b,
         case when k = 0 then regexp_extract(hit, (select pattern from kinds where k = 0), 1) else hit end as value
  from each),
base as (select * from spans where k = 0 and length(value) >= 8 or k = 1 and length(value) >= 16 or k = 2),
tokens as (
  select * from spans t where k = 3 and (
    regexp_matches(hit, '^(ghp_|gho_|ghs_|github_pat_|glpat-|xox[bp]-|sk_live_|rk_live_|AIza|npm_|pypi-)[A-Za-z0-9_-]{16,}')
    or len(list_filter(string_split_regex(hit, '[/_-]'), lambda p :
      length(p) >= 16 and regexp_matches(p, '[a-z]') and regexp_matches(p, '[A-Z]') and regexp_matches(p, '[0-9].*[A-Za-z].*[0-9]')
      or length(p) >= 20 and regexp_matches(p, '([0-9]+[A-Za-z]+){4}'))) > 0)
  and not exists (select 1 from base b where b.doc_id = t.doc_id and b.a < t.b and t.a < b.b)),
places as (
  select value, same, min(owner) as owner from (select * from base union all select * from tokens) group by value, same),
owned as (select value, count(distinct owner) <= 10 as live from places group by value),
shown as (
  select s.*, o.live from (select * from base union all select * from tokens) s join owned o using (value) where k < 3 or live)
select d.doc_id, count(*) filter (s.k = 0) as n_assign, count(*) filter (s.k = 1) as n_access, count(*) filter (s.k = 2) as n_hex,
       sha256(coalesce(string_agg(s.kind || ':' || s.a || ':' || s.b, ',' order by s.a, s.k) filter (s.k < 3), '')) as base_sha256,
       coalesce(string_agg(s.kind || ':' || s.a || ':' || s.b, ',' order by s.a, s.k), '') as spans,
       count(*) filter (s.live) as n_live
from d left join shown s on d.doc_id = s.doc_id group by d.doc_id
"""

#: The checksum of the decimal ``doc_id``, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c : cast(unicode(c) as bigint))),
  lambda c, b : list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda s, x : xor(s >> 1, 3988292384 * (s & 1)))))"""

ORACLE["op11_merkle"] = rf"""
with recursive rows_ as (
  select doc_id, source, text, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
         {CRC32} as checksum
  from documents),
leaves as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         case when checksum % 5 = 0 then
           sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as tampered
  from rows_),
placed as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree, count(*) over (partition by source) as n,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i from leaves),
nodes(tree, level, i, n, digest) as (
  select tree, 0, i, n, leaf from placed
  union all
  select tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by i)) from nodes where n > 1
  group by tree, level, i // 16, n),
subroots as (select tree, digest from nodes where n = 1),
upper_(level, i, n, digest) as (
  select 0, tree, count(*) over (), digest from subroots
  union all
  select level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by i)) from upper_ where n > 1
  group by level, i // 16, n),
runs as (
  select tree, level, i // 16 as run, list(digest order by i) as d from nodes where n > 1 group by 1, 2, 3
  union all select -1, level, i // 16, list(digest order by i) from upper_ where n > 1 group by 1, 2, 3),
way(doc_id, leaf, tree, level, i, folded, proof) as (
  select doc_id, leaf, tree, 0, i, coalesce(tampered, leaf), '' from placed
  union all
  select w.doc_id, w.leaf, w.tree, w.level + 1, w.i // 16,
         sha256(array_to_string(r.d[1:w.i % 16], '') || folded || array_to_string(r.d[w.i % 16 + 2:], '')),
         proof || array_to_string(r.d[1:w.i % 16], '') || array_to_string(r.d[w.i % 16 + 2:], '')
  from way w join runs r on r.tree = w.tree and r.level = w.level and r.run = w.i // 16),
heights as (select tree, max(level) as height from nodes group by tree),
on_(doc_id, leaf, tree, level, i, folded, proof) as (
  select doc_id, leaf, w.tree, 0, w.tree, folded, proof from way w join heights h on h.tree = w.tree and h.height = w.level
  union all
  select w.doc_id, w.leaf, w.tree, w.level + 1, w.i // 16,
         sha256(array_to_string(r.d[1:w.i % 16], '') || folded || array_to_string(r.d[w.i % 16 + 2:], '')),
         proof || array_to_string(r.d[1:w.i % 16], '') || array_to_string(r.d[w.i % 16 + 2:], '')
  from on_ w join runs r on r.tree = -1 and r.level = w.level and r.run = w.i // 16)
select doc_id, leaf, s.digest as subroot, u.digest as root, sha256(proof) as proof_sha256, folded as folded_root,
       folded = u.digest as verified
from on_ w join subroots s on s.tree = w.tree join upper_ u on u.n = 1 and w.level = u.level
"""

ORACLE["op12_periodic_runs"] = rf"""
with split_ as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x : x <> '') as w, {CRC32} as h from documents),
drawn as (select *, len(w) as n, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from split_),
planted as (
  select doc_id, n, case when a is null then w else list_transform(range(n), lambda i :
    case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] end) end as w from drawn),
words_ as (select doc_id, n, unnest(range(n)) as i, unnest(w) as word from planted),
equal_ as (
  select x.doc_id, y.i - x.i as q, x.i, x.i - row_number() over (partition by x.doc_id, y.i - x.i order by x.i) as island
  from words_ x join words_ y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n),
stretches as (select doc_id, q, min(i) as start, count(*) + q as length from equal_ group by doc_id, q, island),
runs_ as (
  select doc_id, start, length, min(q) as period from stretches where length >= greatest(24, 3 * q) group by doc_id, start, length),
ranked as (
  select *, row_number() over (partition by doc_id order by cast(length as hugeint) * 1000000000000 // period desc, start, period) as place
  from runs_),
told as (
  select doc_id, count(*) as n_runs, any_value(start) filter (place = 1) as start, any_value(length) filter (place = 1) as length,
         any_value(period) filter (place = 1) as period,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from ranked group by doc_id),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as collapsed from words_ x
  where not exists (select 1 from runs_ r where r.doc_id = x.doc_id and x.i >= r.start + r.period and x.i < r.start + r.length)
  group by doc_id)
select p.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from planted p left join told t on t.doc_id = p.doc_id left join kept k on k.doc_id = p.doc_id
"""
