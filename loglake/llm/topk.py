"""Exact top-k search by inner product, block at a time.

Each shard lays its vectors out in blocks of near neighbours and keeps every dimension's largest
and smallest value of a block. The sum over dimensions of the larger product bounds what any row
of a block can score for a query. A query visits blocks from the highest bound down, scores all rows
of a block by its forward index (the block's own matrix), and stops where the bound falls below its
k-th score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.common import stored

EXACT = 2.0 ** 53  # integers up to here are exact as doubles


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, vector array<bigint>``: each component ``floor(scale * x)``.

    Rows with a null id or vector, or a null or non-finite component, take no part. Rows with equal
    ids all stay, equal vectors too. Products beyond 64 bits are held to their bounds.
    """
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
        .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", plain))
        .select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("vector"))
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    lists = column.combine_chunks()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < counts[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def widest(column: pa.ChunkedArray) -> int:
    return pc.max(pc.list_value_length(column)).as_py() or 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b``."""
    most = np.abs(a.astype(float)).max(initial=0) * np.abs(b.astype(float)).max(initial=0) * max(a.shape[1], 1)
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


def layout(rows: np.ndarray, ids: np.ndarray, block: int) -> list[np.ndarray]:
    """Blocks of row numbers: rows nearest the same of a few spread rows, then by id."""
    n = len(rows)
    if n <= block:
        return [np.argsort(ids, kind="stable")]
    x = rows.astype(np.float64)
    wanted = max(2, n // (2 * block))
    centres = x[np.argsort(ids, kind="stable")[:: n // wanted]][:wanted]
    for _ in range(3):
        near = np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    order = np.lexsort((ids, near))
    ends = np.cumsum(np.bincount(near, minlength=len(centres)))
    return [part[i:i + block] for part in np.split(order, ends[:-1]) for i in range(0, len(part), block)]


def search_shard(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
                 block: int, copy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query number, row number, score`` of each query's k best rows, without its own row.

    ``copy`` numbers equal rows from 0; of those that are equal to a query the first is the query's own.
    """
    first = np.ones(len(ids), bool) if copy is None else copy == 0
    blocks = layout(rows, ids, block)
    high = np.stack([rows[b].max(0) for b in blocks]).astype(np.float64)
    low = np.stack([rows[b].min(0) for b in blocks]).astype(np.float64)
    q = queries.astype(np.float64)
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    bound += np.abs(bound) * 1e-9 + 1  # above any rounding
    visit = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, visit, 1)
    n = len(queries)
    none = np.iinfo(np.int64).min
    best = np.full((n, k), none)
    best_row = np.full((n, k), -1)
    ids_or = np.append(ids, np.iinfo(np.int64).max)
    active = np.arange(n)
    for turn in range(len(blocks)):
        active = active[(best_row[active, -1] < 0) | (bound[active, turn] >= best[active, -1])]
        if not len(active):
            break
        which = visit[active, turn]
        order = np.argsort(which, kind="stable")
        for group in np.split(active[order], np.flatnonzero(np.diff(which[order])) + 1):
            own = blocks[visit[group[0], turn]]
            score = products(queries[group], rows[own])
            itself = (query_ids[group][:, None] == ids[own][None, :]) & first[own][None, :]
            for i, j in np.argwhere(itself):
                itself[i, j] = (queries[group[i]] == rows[own[j]]).all()
            open_ = ~itself & ((best_row[group, -1] < 0)[:, None] | (score >= best[group, -1][:, None]))
            some = open_.any(1)
            if not some.any():
                continue
            g = group[some]
            all_scores = np.concatenate([best[g], np.where(open_[some], score[some], none)], 1)
            all_rows = np.concatenate([best_row[g], np.where(open_[some], own[None, :], -1)], 1)
            top = _ranked(all_scores, all_rows, ids_or)[:, :k]
            best[g] = np.take_along_axis(all_scores, top, 1)
            best_row[g] = np.take_along_axis(all_rows, top, 1)
    found = best_row >= 0
    return np.nonzero(found)[0], best_row[found], best[found]


def _ranked(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Columns by row present, then score from the highest, then id from the smallest."""
    return np.lexsort((ids[rows], ~scores, rows < 0), axis=1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 256, shard_rows: int = 32_768,
          query_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows of highest inner product.

    ``vectors`` and ``queries`` hold ``vec_id, vector`` as :func:`integer_vectors` gives them. Equal
    scores go to the smaller id. Every row is a candidate but the query's own, that is one row of the
    same id and vector; other rows of that id are. Each row of ``queries`` is a query, so equal ones
    bring equal results. A query gets all rows if there are fewer than ``k``. Vectors of unequal
    length compare as if filled up with zeros. Empty tables give no rows.

    Equal rows travel as one with their number, and stand for ``k + 1`` at most, as no query can get
    more. Rows go to shards by the hash of id and vector, queries to groups likewise; each pair of shard
    and group is one task, so both sides may grow without any task growing.
    """
    fold = lambda rows: rows.groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))
    vectors = stored(fold(vectors), "vectors")
    queries = stored(fold(queries).withColumn("query", F.monotonically_increasing_id()), "queries")
    vectors = vectors.select("vec_id", "vector", F.explode(F.sequence(F.lit(0), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))).alias("copy"))
    shards = max(1, -(-vectors.count() // shard_rows))
    groups = max(1, -(-queries.count() // query_rows))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    held = vectors.withColumn("shard", own(shards)).withColumn("part", spread(groups))
    asked = queries.withColumn("part", own(groups)).withColumn("shard", spread(shards))
    names = ("query", "query_id", "copies", "vec_id", "score")

    def run(ask: pa.Table, hold: pa.Table) -> pa.Table:
        if not ask.num_rows or not hold.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in names})
        width = max(widest(ask.column("vector")), widest(hold.column("vector")))
        query_ids, ids = (t.column("vec_id").to_numpy().astype(np.int64) for t in (ask, hold))
        query, row, score = search_shard(
            query_ids, matrix(ask.column("vector"), width), ids, matrix(hold.column("vector"), width), k, block,
            hold.column("copy").to_numpy())
        asked_as = [ask.column(name).to_numpy()[query] for name in ("query", "vec_id", "copies")]
        return pa.table(dict(zip(names, [*asked_as, ids[row], score])))

    found = asked.groupBy("shard", "part").cogroup(held.groupBy("shard", "part")).applyInArrow(
        run, ", ".join(f"{name} bigint" for name in names))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("query_id", "rank", "vec_id", "score")
