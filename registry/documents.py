"""Documents: shaping, mapping, upsert, display and search."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import documents as ops
from loglake.operators import search
from loglake.sinks.lake import compact_docs, read_docs, write_docs
from loglake.session import new_path
from loglake.sinks.text_index import TextIndex
from registry.base import (
    ALOG, DOC_ID, DOC_TYPE, DOCS, NOW, SECONDS, alog, docs_sql, query, table, written_once,
)

MONTH = "strftime(timestamp, '%Y.%m')"
DAY = "strftime(timestamp, '%Y.%m.%d')"


def _docs(spark, sf_dir, **options):
    return ops.to_docs(alog(spark, sf_dir), **options)


@query("to_docs", f"with {ALOG}, {DOCS} select * from docs")
def _(spark, sf_dir):
    return _docs(spark, sf_dir)


@query("doc_type", f"with {ALOG} select id, {DOC_TYPE} as doc_type from alog")
def _(spark, sf_dir):
    return alog(spark, sf_dir).select("id", ops.doc_type().alias("doc_type"))


@query("doc_type_override", f"with {ALOG} select id, 'alarm' as doc_type from alog")
def _(spark, sf_dir):
    return alog(spark, sf_dir).select("id", ops.doc_type("alarm").alias("doc_type"))


@query("doc_index", f"""
    with {ALOG} select id, case when {DOC_TYPE} = 'opslog' then 'numbers' else 'texts' end as doc_index from alog""")
def _(spark, sf_dir):
    return alog(spark, sf_dir).select("id", ops.doc_index("texts", "numbers").alias("doc_index"))


@query("doc_value", f"""
    with {ALOG}, {DOCS} select _id, _type, keywvalue, keywvalue_num, keywvalue_nan from docs""")
def _(spark, sf_dir):
    return _docs(spark, sf_dir).select("_id", "_type", "keywvalue", "keywvalue_num")


# The same record by database and by archive: one id where the time is a whole second.
@query("doc_id_across_sources", f"""
    with {ALOG}, {SECONDS.replace("alog as", "cut as", 1)}
    select a.id, a.timestamp = c.timestamp as same
    from alog a join cut c using (id)""")
def _(spark, sf_dir):
    records = alog(spark, sf_dir)
    cut = records.withColumn("timestamp", F.date_trunc("second", "timestamp"))
    ids = lambda rows, name: rows.select("id", ops.doc_id().alias(name))
    return ids(records, "x").join(ids(cut, "y"), "id").select("id", (F.col("x") == F.col("y")).alias("same"))


@query("doc_id", f"with {ALOG} select id, {DOC_ID} as doc_id from alog")
def _(spark, sf_dir):
    return alog(spark, sf_dir).select("id", ops.doc_id().alias("doc_id"))


LIMITED = ", ".join(
    f"case when length({c}) <= {n} then {c} end as {c}_keyword"
    for c, n in [("envname", 20), ("errlocation", 20), ("errseverity", 20), ("errstack", 20),
                 ("keywname", 100), ("loghost", 20), ("module", 20), ("procname", 20)]
)


@query("apply_mapping", f"""
    with {ALOG}, {DOCS} select * replace (cast(cast(keywvalue_num as float) as double) as keywvalue_num), {LIMITED},
    case when _type <> 'opslog' and length(keywvalue) <= 100 then keywvalue end as keywvalue_keyword,
    case when length(logtext) <= case when _type = 'fevt' then 20 else 256 end then logtext end as logtext_keyword
    from docs""")
def _(spark, sf_dir):
    mapped = ops.apply_mapping(_docs(spark, sf_dir))
    return mapped.withColumn("keywvalue_num", F.col("keywvalue_num").cast("double"))


@query("sparse_doc_json", f"""
    with {ALOG} select '{{' || concat_ws(',',
      '"@timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"',
      '"loghost":' || cast(to_json(nullif(loghost, '')) as varchar), '"envname":' || cast(to_json(nullif(env, '')) as varchar),
      '"procname":' || cast(to_json(nullif(procname, '')) as varchar), '"procid":' || cast(procid as varchar),
      '"module":' || cast(to_json(nullif(module, '')) as varchar),
      '"keywname":' || cast(to_json(nullif(keywname, '')) as varchar),
      '"keywvalue":' || cast(to_json(nullif(keywvalue, '')) as varchar),
      '"logtext":' || cast(to_json(nullif(logtext, '')) as varchar)) || '}}' as value from alog""")
def _(spark, sf_dir):
    return ops.sparse_doc_json(alog(spark, sf_dir))


FLAT = "replace({0}, chr(10), ' ')"


@query("format_hits", f"""
    with {ALOG}, {DOCS} select concat('/', _index, '/', _type, '/', _id, ' (', left("@timestamp", 19), '):',
      chr(9), 'loghost: ', loghost, chr(9), 'envname: ', envname, chr(9), 'procname: ', procname,
      chr(9), 'procid: ', cast(procid as varchar), chr(9), 'module: ', module,
      chr(10), repeat(' ', 54), chr(9), 'keywname: ', keywname, chr(9), ' keywvalue: ', keywvalue,
      chr(10), repeat(' ', 54), chr(9), 'logtext: ', left({FLAT.format('logtext')}, 80),
      chr(10), repeat(' ', 63), chr(9), ' ', substr({FLAT.format('logtext')}, 81)) as value from docs""")
def _(spark, sf_dir):
    return ops.format_hits(_docs(spark, sf_dir))


# All documents, then those of errors and warnings again with an edited text.
@query("upsert_docs", f"""
    with {ALOG}, {DOCS} select * replace (case when _type = 'err' then upper(logtext) else logtext end as logtext)
    from docs""")
def _(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    edited = docs.where(F.col("_type") == "err").withColumn("logtext", F.upper("logtext"))
    first, second = F.lit("2024-02-01").cast("timestamp"), F.lit("2024-02-02").cast("timestamp")
    both = docs.withColumn("load_time", first).unionByName(edited.withColumn("load_time", second))
    return ops.upsert_docs(both).drop("load_time")


def _stored(spark, sf_dir, frequency="MONTHLY"):
    def write(path):
        write_docs(_docs(spark, sf_dir, frequency=frequency), path, NOW)

    return written_once(spark, sf_dir, f"docs-{frequency.lower()}", write)


@query("write_docs_monthly", f"with {ALOG}, {docs_sql(suffix=MONTH)} select * from docs")
def _(spark, sf_dir):
    return read_docs(spark, _stored(spark, sf_dir))


@query("write_docs_daily", f"with {ALOG}, {docs_sql(suffix=DAY)} select * from docs")
def _(spark, sf_dir):
    return read_docs(spark, _stored(spark, sf_dir, "DAILY"))


@query("read_docs", f"""
    with {ALOG}, {docs_sql(suffix=MONTH)} select * from docs
    where _index = 'logs-2024.01' and _type = 'err' and "@timestamp" <= '2024-01-12 00:00:00'""")
def _(spark, sf_dir):
    return read_docs(spark, _stored(spark, sf_dir), "logs-2024.01", "err", high="2024-01-12 00:00:00")


# Loaded twice and folded in place.
@query("compact_docs", f"with {ALOG}, {docs_sql(suffix=MONTH)} select * from docs")
def _(spark, sf_dir):
    def write(path):
        docs = _docs(spark, sf_dir, frequency="MONTHLY")
        write_docs(docs, path, NOW)
        write_docs(docs, path, NOW)
        compact_docs(spark, path, ["logs-2024.01", "opslog-2024.01"])

    return read_docs(spark, written_once(spark, sf_dir, "docs-compacted", write), latest=False)


# --- search over the given texts --------------------------------------------------------------

QUERY = "The data-driven systems, der Garten"
TERMS = "('the', 'data', 'driven', 'systems', 'der', 'garten')"
TOKENS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda w : w <> '')"
TOKENISED = f"t as (select doc_id, lang, source, text, {TOKENS} as words from documents)"
MATCHES = "list_has_any(words, ['the', 'data', 'driven', 'systems', 'der', 'garten'])"


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("match_text", f"with {TOKENISED} select doc_id from t where {MATCHES}")
def _(spark, sf_dir):
    return _texts(spark, sf_dir).where(search.match_text(F.col("text"), QUERY)).select("doc_id")


@query("must_not_term", f"with {TOKENISED} select doc_id from t where not list_contains(words, 'the')")
def _(spark, sf_dir):
    return _texts(spark, sf_dir).where(search.must_not_term(F.col("text"), "the")).select("doc_id")


@query("term_filter", "select doc_id, text from documents where lang = 'en'")
def _(spark, sf_dir):
    return _texts(spark, sf_dir).where(search.term_filter("lang", "en")).select("doc_id", "text")


@query("match_all", "select doc_id, text from documents")
def _(spark, sf_dir):
    from loglake.operators.records import match_all
    return _texts(spark, sf_dir).where(match_all()).select("doc_id", "text")


@query("bool_query", f"""
    with {ALOG}, {DOCS} select * from docs where _index = 'logs' and _type = 'err'
    and regexp_matches(logtext, '\\b(17|23)\\b') and not regexp_matches(logtext, '\\b42\\b')""")
def _(spark, sf_dir):
    return search.bool_query(_docs(spark, sf_dir), "logs", "err", "17 23", "42")


@query("hit_total", f"""
    with {TOKENISED} select count(*) as total from t
    where {MATCHES} and not list_contains(words, 'and')""")
def _(spark, sf_dir):
    return search.hit_total(
        search.bool_query(_texts(spark, sf_dir), contains=QUERY, not_contains="and", column="text"))


SCORED = f"""{TOKENISED},
    corpus as (select cast(count(*) as double) as n, avg(len(words)) as mean from t),
    tf as (select doc_id, w, cast(count(*) as double) as tf from (select doc_id, unnest(words) as w from t)
        where w in {TERMS} group by all),
    df as (select w, cast(count(*) as double) as df from tf group by w),
    scored as (select doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
        / (tf + 1.2 * (1 - 0.75 + 0.75 * len(words) / mean))) as score
        from tf join df using (w) join t using (doc_id) cross join corpus group by doc_id)"""


@query("bm25_scores", f"with {SCORED} select doc_id, round(score, 6) as score from scored")
def _(spark, sf_dir):
    return search.bm25_scores(_texts(spark, sf_dir), QUERY, "text").select(
        "doc_id", F.round("score", 6).alias("score"))


@query("search_topk", f"""
    with {SCORED} select doc_id, round(score, 6) as score from scored join documents using (doc_id)
    where lang = 'en' order by scored.score desc, doc_id limit 30""")
def _(spark, sf_dir):
    return search.search_topk(
        _texts(spark, sf_dir), QUERY, column="text", tie="doc_id", lang="en"
    ).select("doc_id", F.round("score", 6).alias("score"))


def _indexed(spark, sf_dir):
    """The texts in two segments, the second of which brings most of the first again."""
    lang = T.StructField("lang", T.StringType())

    def write(path):
        index, docs = TextIndex(spark, path, T.LongType(), [lang]), _texts(spark, sf_dir)
        index.add(docs.where(F.col("lang") == "en"), "doc_id", "text")
        index.add(docs, "doc_id", "text")

    return TextIndex(spark, written_once(spark, sf_dir, "text-index", write), T.LongType(), [lang])


@query("search_topk_indexed", f"""
    with {SCORED} select doc_id, round(score, 6) as score from scored join documents using (doc_id)
    where lang = 'en' order by scored.score desc, doc_id limit 30""")
def _(spark, sf_dir):
    return _indexed(spark, sf_dir).top(QUERY, lang="en").select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query("bool_query_indexed", f"""
    with {TOKENISED} select doc_id, lang from t where {MATCHES} and not list_contains(words, 'and')""")
def _(spark, sf_dir):
    return _indexed(spark, sf_dir).matches(QUERY, "and").withColumnRenamed("id", "doc_id")


# All hits page by page, each page told only the last hit of the one before.
@query("scroll", f"with {SCORED} select doc_id, round(score, 6) as score from scored join documents using (doc_id) where lang = 'de'")
def _(spark, sf_dir):
    path = new_path(spark, "scored")
    search.bm25_scores(_texts(spark, sf_dir), QUERY, "text").where("lang = 'de'").select("doc_id", "score").write.parquet(path)
    scored, held = spark.read.parquet(path), new_path(spark, "pages")
    size, after = -(-scored.count() // 4), None
    for _ in range(4):
        page = search.hit_page(scored, size, after, "doc_id")
        page.write.mode("append").parquet(held)
        last = page.orderBy("score", F.col("doc_id").desc()).first()
        after = after if last is None else (last["score"], last["doc_id"])
    return spark.read.schema(scored.schema).parquet(held).select("doc_id", F.round("score", 6).alias("score"))
