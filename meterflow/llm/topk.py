"""Exact top-k inner products by block-at-a-time pruning over ranges of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, stored

ship(__name__)

#: Documents per block, blocks that one task holds at most on average, and queries that it scores at a time.
BLOCK_ROWS = 256
GROUP_BLOCKS = 32
QUERY_ROWS = 1024
#: Sums of products of whole numbers up to this size are exact in 8-byte floats.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    """True for vectors that hold finite components only; a null vector gives null."""
    infinite = float("inf")
    return F.forall(vector, lambda x: F.coalesce(
        x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(infinite)), F.lit(False)
    ))


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for n, row in enumerate(rows):
        out[n, : len(row)] = row
    return out


def _products(queries: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Exact inner products: in floats where they cannot round, otherwise in Python's integers, cut to a long."""
    reach = (np.abs(queries).max(initial=0.0) * np.abs(documents).max(initial=0.0)) * max(queries.shape[1], 1)
    if reach < EXACT:
        return (queries @ documents.T).astype(np.int64)
    whole = np.array([[int(x) for x in q] for q in queries], dtype=object).reshape(queries.shape) @ np.array(
        [[int(x) for x in d] for d in documents], dtype=object).reshape(documents.shape).T
    return np.clip(whole, -LONG, LONG).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by score, ties to smaller ids."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search_group(queries: pd.DataFrame, documents: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best documents of this group for each query, found block by block.

    The bound of a block is the sum over the dimensions of the query's component times the block's maximum, or its
    minimum where the component is negative. A query visits blocks by falling bound and stops at the first that lies
    below its k-th score; a bound that equals it is still scored, as ties go to the smaller id.
    """
    width = max(max(map(len, queries["q"]), default=0), max(map(len, documents["q"]), default=0))
    asked, given = _matrix(queries["q"].tolist(), width), _matrix(documents["q"].tolist(), width)
    ask_id, ids = queries["id"].to_numpy(), documents["id"].to_numpy()
    ask_row, rows = queries["uid"].to_numpy(), documents["uid"].to_numpy()
    starts = np.arange(0, len(ids), BLOCK_ROWS)
    high = np.maximum.reduceat(given, starts, axis=0)
    low = np.minimum.reduceat(given, starts, axis=0)
    bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    visit = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((len(ask_id), k), -LONG, dtype=np.int64)
    best_id = np.full((len(ask_id), k), LONG, dtype=np.int64)
    full = np.zeros(len(ask_id), dtype=np.int64)
    active = np.arange(len(ask_id))
    for turn in range(len(starts)):
        blocks = visit[active, turn]
        # A float bound may be off by rounding once components are huge: it is then raised a little.
        reach = bounds[active, blocks] * (1 + 1e-12 * np.sign(bounds[active, blocks])) + 1e-6
        keep = (full[active] < k) | (reach >= best[active, k - 1].astype(float))
        active, blocks = active[keep], blocks[keep]
        if not len(active):
            break
        order = np.argsort(blocks, kind="stable")
        edges = np.flatnonzero(np.diff(blocks[order])) + 1
        for part in np.split(order, edges):
            who, block = active[part], blocks[part[0]]
            span = slice(starts[block], starts[block] + BLOCK_ROWS)
            scores = _products(asked[who], given[span])
            own = ask_row[who][:, None] == rows[span][None, :]
            candidate = np.broadcast_to(ids[span], scores.shape).copy()
            scores[own], candidate[own] = -LONG, LONG
            full[who] += (~own).sum(axis=1)
            best[who], best_id[who] = _best(
                np.hstack([best[who], scores]), np.hstack([best_id[who], candidate]), k
            )
    there = np.arange(k)[None, :] < np.minimum(full, k)[:, None]
    who, _ = np.nonzero(there)
    return pd.DataFrame({
        "query_uid": ask_row[who], "query_id": ask_id[who], "vec_id": best_id[there], "score": best[there],
    })


def top_k(frame: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row that ``is_query`` selects.

    Scores are inner products of ``floor(256 * x)``; ties go to the smaller id. Null ids take no part, nor do vectors
    that are null or hold null or non-finite components. Shorter vectors count as padded with zeros, an empty one scores 0.
    Rows that repeat an id are rows of their own: each is a candidate of the other. An empty table, or no query, gives no rows.

    Documents are ranged by their dominant term, so that a block's maxima are tight, and cut into groups of blocks; ids
    break the order, so that many equal vectors spread over groups. Queries are cut into batches and sent to every
    group: a task holds one batch and one group, both of bounded size. A query brings at most k rows per group to the
    final ranking.
    """
    spark = frame.sparkSession
    vector = F.col(f"`{vector_col}`")
    rows = stored(
        frame.filter(F.col(f"`{id_col}`").isNotNull() & finite(vector)).select(
            F.col(f"`{id_col}`").cast("long").alias("id"), quantised(vector).alias("q"),
            F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("uid"),
        ),
        "quantised",
    )
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.expr("if(asks, 1, null)")).alias("asked")).first()
    groups = max(1, -(-counts["rows"] // (BLOCK_ROWS * GROUP_BLOCKS)))
    batches = max(1, -(-counts["asked"] // QUERY_ROWS))
    peak = F.array_max(F.transform("q", lambda x: F.abs(x)))
    term = F.array_position(F.transform("q", lambda x: F.abs(x)), peak)
    sign = F.when(F.get("q", (term - 1).cast("int")) < 0, -1).otherwise(1)
    ranged = rows.select("id", "uid", "q", F.coalesce(F.expr("if(size(q) = 0, 0, 1)") * sign * term, F.lit(0)).alias("lead"))
    ranged = stored(
        ranged.repartitionByRange(groups, "lead", "id", "uid").sortWithinPartitions("lead", "id", "uid")
        .select("id", "uid", "q", F.spark_partition_id().alias("group")),
        "ranged",
    )
    documents = ranged.select("*", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"))
    queries = rows.filter("asks").select(
        "id", "uid", "q", F.pmod(F.xxhash64("uid"), F.lit(batches)).cast("int").alias("batch"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_uid": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return search_group(left, right.sort_index(), k)

    found = queries.groupBy("group", "batch").cogroup(documents.groupBy("group", "batch")).applyInPandas(
        search, "query_uid long, query_id long, vec_id long, score long"
    )
    ranked = found.withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY query_uid ORDER BY score DESC, vec_id)")
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
