from __future__ import annotations

import math

from loglake.operators import search
from pyspark.sql import functions as F

TEXTS = ["the red fox", "The red red door", "a blue fox jumps over the door", "", None, "RED"]


def docs(spark):
    return spark.createDataFrame(
        [(f"d{i}", "logs", "log", t) for i, t in enumerate(TEXTS)],
        "_id string, _index string, _type string, logtext string")


def ids(df):
    return sorted(r["_id"] for r in df.select("_id").collect())


def test_match_and_exclude(spark):
    d = docs(spark)
    assert ids(d.where(search.match_text(F.col("logtext"), "RED, jumps?"))) == ["d0", "d1", "d2", "d5"]
    assert ids(d.where(search.match_text(F.col("logtext"), "..."))) == []
    assert ids(search.bool_query(d, "logs", "log", "red", "door")) == ["d0", "d5"]
    # A term is not analysed: upper case meets no token.
    assert ids(search.bool_query(d, contains="red", not_contains="RED")) == ["d0", "d1", "d5"]
    assert search.hit_total(search.bool_query(d, "other")).first()["total"] == 0


def bm25(query):
    split = [(t or "").lower().split() for t in TEXTS]
    mean = sum(map(len, split)) / len(split)
    scores = {}
    for i, words in enumerate(split):
        score = 0.0
        for term in query:
            df = sum(term in w for w in split)
            tf = words.count(term)
            idf = math.log(1 + (len(split) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        if any(term in words for term in query):
            scores[f"d{i}"] = round(score, 9)
    return scores


def test_scores_by_hand(spark):
    # A null text counts as an empty one.
    d = docs(spark).na.fill("")
    scored = search.bm25_scores(d, "Red door red").collect()
    assert {r["_id"]: round(r["score"], 9) for r in scored} == bm25(["red", "door"])
    top = search.search_topk(d, "red door", 2).collect()
    want = sorted(bm25(["red", "door"]).items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [(r["_id"], round(r["score"], 9)) for r in top] == want
    assert search.bm25_scores(d, "...").count() == 0
    assert [r["_id"] for r in search.scroll(d.orderBy("_id"))] == [f"d{i}" for i in range(6)]
