"""Full-text search over documents: match, exclude, count, ranked top hits."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loglake.functions.text import split_tokens, tokens

# The parameters of Okapi BM25 as published, and the size of a hit list.
K1, B = 1.2, 0.75
TOP_HITS = 30


def match_text(c: Column, query: str) -> Column:
    """The text holds any token of the query."""
    return F.coalesce(F.arrays_overlap(split_tokens(c), tokens(F.lit(query))), F.lit(False))


def must_not_term(c: Column, term: str) -> Column:
    """The text does not hold this token. The term is taken as it stands, not lower-cased."""
    if term == "":
        return F.lit(True)
    return ~F.coalesce(F.array_contains(split_tokens(c), term), F.lit(False))


def term_filter(column: str, value: object) -> Column:
    return F.col(column) == F.lit(value)


def bool_query(
    docs: DataFrame, index: str | None = None, doc_type: str | None = None,
    contains: str | None = None, not_contains: str | None = None, column: str = "logtext",
) -> DataFrame:
    """Documents of an index and type whose text matches and does not hold a term."""
    if index is not None:
        docs = docs.where(term_filter("_index", index))
    if doc_type is not None:
        docs = docs.where(term_filter("_type", doc_type))
    if contains is not None:
        docs = docs.where(match_text(F.col(column), contains))
    if not_contains is not None:
        docs = docs.where(must_not_term(F.col(column), not_contains))
    return docs


def hit_total(docs: DataFrame) -> DataFrame:
    """How many documents a search met."""
    return docs.agg(F.count(F.lit(1)).alias("total"))


def _query_terms(docs: DataFrame, query: str) -> list[str]:
    """Distinct tokens of the query, split by the same expression as the texts."""
    one = docs.sparkSession.sql("select 1")
    return one.select(F.array_distinct(tokens(F.lit(query)))).first()[0]


def bm25_scores(docs: DataFrame, query: str, column: str = "logtext") -> DataFrame:
    """Documents that match, with ``score`` by Okapi BM25 over all given documents.

    Corpus size, mean length and the document frequency of each query term come from one
    aggregation that returns a single row, used as a scalar subquery.
    """
    terms = _query_terms(docs, query)
    if not terms:
        return docs.where(F.lit(False)).withColumn("score", F.lit(0.0))

    words = split_tokens(F.coalesce(F.col(column), F.lit("")))
    corpus = docs.select(words.alias("w")).agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg(_length(F.col("w"))).alias("mean"),
            F.array(*[F.count_if(F.array_contains("w", t)).cast("double") for t in terms]).alias("df"),
        ).alias("corpus")
    )
    # The tokens are generated rather than projected, so that the filter does not split again.
    split = docs.select("*", F.inline(F.array(F.struct(words.alias("_words")))))
    matched = split.where(F.arrays_overlap("_words", F.array(*map(F.lit, terms)))).withColumn(
        "_corpus", corpus.scalar()
    )
    n, mean = F.col("_corpus.n"), F.col("_corpus.mean")
    size = F.size("_words")
    norm = K1 * (1 - B + B * _length(F.col("_words")) / mean)
    score = F.lit(0.0)
    for i, term in enumerate(terms):
        tf = (size - F.size(F.array_remove("_words", term))).cast("double")
        df = F.get(F.col("_corpus.df"), F.lit(i))
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + norm)
    return matched.withColumn("score", score).drop("_corpus", "_words")


def _length(words: Column) -> Column:
    """Number of tokens in a split text, which can have an empty string at either end."""
    first = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.size(words) > 1) & (F.get(words, F.size(words) - 1) == ""), 1).otherwise(0)
    return F.size(words) - first - last


def search_topk(
    docs: DataFrame, query: str, k: int = TOP_HITS, column: str = "logtext", tie: str = "_id",
    **filters: object,
) -> DataFrame:
    """The ``k`` best hits. ``filters`` are exact field values and do not change the scores."""
    scored = bm25_scores(docs, query, column)
    for name, value in filters.items():
        scored = scored.where(term_filter(name, value))
    return scored.orderBy(F.col("score").desc(), F.col(tie)).limit(k)


def scroll(docs: DataFrame) -> Iterator[Row]:
    """Hits one by one for display, a partition at a time; never the whole result at once."""
    return docs.toLocalIterator()


def hit_page(scored: DataFrame, n: int = TOP_HITS, after: tuple[float, object] | None = None, tie: str = "_id") -> DataFrame:
    """The next ``n`` hits in order of score, then ``tie``, behind the hit ``after`` (its score and tie).

    The last row of a page is all that is needed to go on, also from another session; pages share no
    hit and leave none out, as long as the documents stay the same.
    """
    if after is not None:
        score, last = after
        scored = scored.where((F.col("score") < F.lit(score)) | ((F.col("score") == F.lit(score)) & (F.col(tie) > F.lit(last))))
    return scored.orderBy(F.col("score").desc(), F.col(tie)).limit(n)
