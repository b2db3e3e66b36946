"""Exact search of the k highest inner products by branch and bound over dimension blocks.

Vectors lie vertically: a block of rows is stored dimension by dimension.  Queries are
packed in blocks too, and every query meets every row block.  Its inner products with the
rows are accumulated one block of dimensions after another, its largest components first.
After each block, the mass that remains in the other dimensions bounds what a row can
still gain (Cauchy-Schwarz).  The exact scores of the rows that lead so far give the
query's threshold: rows that can't reach it any more are dropped, and the survivors are
compacted.  Each query has survivors of its own, and a threshold that goes on from one row
block to the next.  What is left at the end has exact scores.

The query set is stated, and its blocks meet all row blocks through a join on the lanes
that row blocks are dealt to.  A task works on one block of each kind at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import col
from hearthline.session import settle

ROWS = 8192
QUERIES = 512
STEP = 8  # dimensions at a time
PROBES = 64  # leading rows whose exact scores give a threshold
LANE_BLOCKS = 128  # row blocks that share a copy of the queries, once there are enough for all cores
MOST = 2**62
BLOCK = "dim int, number long, ids binary, rows binary, planes binary"


def whole_numbers(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The usable vectors' positions, lengths, and all their components as floor(scale * x)."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # What a long can't hold isn't a number here, like an infinite component.
    bad = np.bincount(owner[~(np.abs(values) < 2.0**63)], minlength=len(sizes)) > 0
    keep = (sizes > 0) & ~bad
    return np.flatnonzero(keep), sizes[keep], values[keep[owner]].astype(np.int64)


def vector_blocks(df: DataFrame, id_col: str, vector_col: str, scale: float, chosen: Column | None = None, n: int = ROWS) -> DataFrame:
    """Blocks of at most n vectors of equal length, vertical: dim, number, ids, rows (numbers of rows), planes."""
    own = df.select(col(id_col).cast("long").alias("id"), "_row", col(vector_col).alias("v")).where(F.col("id").isNotNull())
    own = own.where(chosen) if chosen is not None else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, n):
                part = batch.slice(at, n)
                which, sizes, values = whole_numbers(part.column("v"), scale)
                ids, rows = part.column("id").to_numpy()[which], part.column("_row").to_numpy()[which]
                stops = np.cumsum(sizes)
                for dim in np.unique(sizes):
                    own = np.flatnonzero(sizes == dim)
                    planes = values[(stops[own] - dim)[:, None] + np.arange(dim)].T
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([dim], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([ids[own].tobytes()]),
                            pa.array([rows[own].tobytes()]), pa.array([np.ascontiguousarray(planes).tobytes()]),
                        ],
                        ["dim", "number", "ids", "rows", "planes"],
                    )

    return own.mapInArrow(run, BLOCK)


class Rows:
    """A block of rows, vertical, in the type that its sums with some queries are exact in."""

    def __init__(self, planes: np.ndarray, kind: type) -> None:
        self.planes = planes.astype(kind)
        self.squares = np.square(planes.astype(np.float64))
        self.mass = self.squares.sum(axis=0)


def best(query: np.ndarray, rows: Rows, k: int, own: int | None = None, limit: float = -np.inf) -> tuple[np.ndarray, np.ndarray, float]:
    """Rows that may be among the k best others of a query, their exact scores, and the query's new threshold.

    ``own`` is the place of the query's own row, which is left out; ``limit`` is a score
    that k other rows of earlier blocks have reached.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    weights = query.astype(rows.planes.dtype)
    alive = np.arange(rows.planes.shape[1])
    if own is not None:
        alive = np.delete(alive, own)
    score = np.zeros(len(alive), rows.planes.dtype)
    mass = rows.mass[alive]
    rest = float(np.square(query.astype(np.float64)).sum())
    for at in range(0, len(order), STEP):
        dims = order[at : at + STEP]
        part = np.ix_(dims, alive)
        score += weights[dims] @ rows.planes[part]
        if at + STEP >= len(order) or len(alive) <= k:
            continue
        mass -= rows.squares[part].sum(axis=0)
        rest -= float(np.square(query[dims].astype(np.float64)).sum())
        if len(alive) > PROBES:
            lead = alive[np.argpartition(score, len(alive) - PROBES)[-PROBES:]]
        else:
            lead = alive
        exact = weights @ rows.planes[:, lead]
        if len(lead) >= k:
            limit = max(limit, float(np.partition(exact, len(lead) - k)[len(lead) - k]))
        # Rounded up: what is left of the masses, and the scores where they are beyond 2^53.
        slack = np.sqrt(np.maximum(mass, 0) + rows.mass[alive] * 1e-9) * np.sqrt(max(rest, 0.0) + 1e-9 * float(np.square(query.astype(np.float64)).sum()))
        keep = score + slack * (1 + 1e-9) + 1 + np.abs(score) * 1e-12 >= limit
        if not keep.all():
            alive, score, mass = alive[keep], score[keep], mass[keep]
    if len(score) >= k:
        limit = max(limit, float(np.partition(score, len(score) - k)[len(score) - k]))
    return alive, score.astype(np.int64), limit


def dense(query: np.ndarray, planes: np.ndarray, own: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All other rows and their scores, for numbers whose sums a long may not hold; those beyond it are the nearest long."""
    alive = np.arange(planes.shape[1])
    alive = alive if own is None else np.delete(alive, own)
    exact = query.astype(object) @ planes[:, alive].astype(object) if len(alive) else np.zeros(0, object)
    return alive, np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def search(df: DataFrame, queries: Column, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """Per query its k highest scores among all other rows: query_id, rank from 1, vec_id, score.

    ``queries`` is a condition on column ``id``.  Components become floor(scale * x).  Rows
    with a null id, a null or empty vector, or a component that is null, not finite or
    beyond a long take no part, and vectors meet only vectors of their length; a score
    beyond a long is the nearest long.  Ties go to the smaller vec_id.  Of repeated rows
    each is a candidate and each a query; only the query's own row is left out, and equal
    results of repeated queries are told apart by nothing but their order.
    """
    numbered = settle(df.select(col(id_col), col(vector_col)).withColumn("_row", F.monotonically_increasing_id()), "vectors")
    rows = settle(vector_blocks(numbered, id_col, vector_col, scale).withColumn("block", F.monotonically_increasing_id()), "row_blocks")
    asked = settle(vector_blocks(numbered, id_col, vector_col, scale, queries, QUERIES), "query_blocks")
    # Row blocks are dealt to lanes, and query blocks to every lane.
    blocks, cores = rows.count(), 4 * df.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, min(blocks, cores), -(-blocks // LANE_BLOCKS))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))
    sent = asked.select("dim", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("planes").alias("q_planes"))
    sent = sent.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    pairs = sent.join(rows, ["dim", "lane"]).select("dim", "q_ids", "q_rows", "q_planes", "ids", "rows", "planes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits: dict[int, float] = {}
        for batch in batches:
            for k_row in range(batch.num_rows):
                yield found(limits, *(batch.column(c)[k_row].as_py() for c in ("dim", "q_ids", "q_rows", "q_planes", "ids", "rows", "planes")))

    def found(limits: dict[int, float], dim: int, q_ids, q_rows, q_planes, ids, rows, planes) -> pa.RecordBatch:
        q_id, q_row, r_id, r_row = (np.frombuffer(x, np.int64) for x in (q_ids, q_rows, ids, rows))
        q, r = (np.frombuffer(x, np.int64).reshape(dim, -1) for x in (q_planes, planes))
        # Sums of whole numbers below 2^53 are exact in doubles, which multiply fastest.
        bound = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * dim
        block = Rows(r, np.float64 if bound < 2**53 else np.int64) if bound < MOST else None
        places = {row: n for n, row in enumerate(r_row.tolist())}
        out: list[list[np.ndarray]] = [[], [], [], []]
        for j, row in enumerate(q_row.tolist()):
            if block is None:
                alive, score = dense(q[:, j], r, places.get(row))
            else:
                alive, score, limits[row] = best(q[:, j], block, k, places.get(row), limits.get(row, -np.inf))
            if len(score) > k:
                over = score >= np.partition(score, len(score) - k)[len(score) - k]
                alive, score = alive[over], score[over]
            first = np.lexsort((r_id[alive], -score))[:k]
            for column, values in zip(out, (np.full(len(first), q_id[j]), np.full(len(first), row), r_id[alive][first], score[first]), strict=True):
                column.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "_row", "vec_id", "score"])

    near = pairs.mapInArrow(run, "query_id long, _row long, vec_id long, score long")
    order = Window.partitionBy("query_id", "_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
