"""Centroid clustering with scalar lookup tables.

Vectors have integer components, so the squared difference of a component to a
centroid's depends on few numbers: in every round and block of vectors, it is tabulated
for each dimension, each value that occurs in it, and each centroid.  The distances of
the block's vectors are then sums of table entries, gathered by the number of each
component's value; no vector is subtracted from a centroid.

Vectors are written once, in blocks of ``BLOCK`` rows stored by dimension: the values
that occur, and for each vector the number of its value.  A table has at most ``BLOCK``
values a dimension, whatever the data.  A round reads the blocks, sums up in each task
(one row per centroid and dimension leaves it) and hands the driver k x dims sums.  A
lost task is worked out again from the written blocks.

All arithmetic is exact: in 64-bit integers where components and centroids are below
2^27 in size, in Python integers otherwise.  A component beyond a 64-bit integer is the
nearest one, as is a distance or inertia.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import Batches, col, mapped
from hearthline.session import settle

BLOCK = 4096
SMALL = 1 << 27
LONGEST = (1 << 63) - 1


class Block(NamedTuple):
    """Vectors by dimension: ``values[d][codes[d, i]]`` is component d of vector i."""

    values: list[np.ndarray]
    codes: np.ndarray


def usable(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have exactly ``dims`` components, none null or non-finite, and these as an array of doubles."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum())) if len(lists) else lists.values
    # A null component becomes NaN; a null list may still span values.
    numbers = flat.to_numpy(zero_copy_only=False)
    right = np.flatnonzero((sizes == dims) & lists.is_valid().to_numpy(zero_copy_only=False))
    begin = (lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py())[right] if len(right) else np.zeros(0, np.int64)
    taken = numbers[begin[:, None] + np.arange(dims)]
    finite = np.isfinite(taken).all(axis=1)
    return right[finite], taken[finite]


def scaled(numbers: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); beyond a 64-bit integer, the nearest one."""
    with np.errstate(over="ignore"):
        floors = np.floor(numbers * float(scale))
    out = np.clip(floors, -(2.0**63), 2.0**62).astype(np.int64)
    high = floors > 2.0**62
    out[high] = [min(int(x), LONGEST) if np.isfinite(x) else LONGEST for x in floors[high].tolist()]
    return out


def coded(vectors: np.ndarray) -> Block:
    pairs = [np.unique(vectors[:, d], return_inverse=True) for d in range(vectors.shape[1])]
    return Block([v for v, _ in pairs], np.array([c for _, c in pairs], np.uint16).reshape(vectors.shape[1], len(vectors)))


def write_blocks(df: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """The usable vectors in blocks: ids, values by dimension, and codes (uint16, little-endian, by dimension)."""
    own = df.select(col(id_col).alias("id"), col(vector_col).cast("array<double>").alias("vector"))

    def run(batches: Batches) -> Batches:
        waiting: list[tuple[pa.Array, np.ndarray]] = []
        for batch in batches:
            for rows in (batch.slice(at, BLOCK) for at in range(0, batch.num_rows, BLOCK)):
                which, numbers = usable(rows.column("vector"), dims)
                waiting.append((rows.column("id").take(pa.array(which)), scaled(numbers, scale)))
                if sum(len(v) for _, v in waiting) >= BLOCK:
                    joined = pa.chunked_array([i for i, _ in waiting]).combine_chunks(), np.concatenate([v for _, v in waiting])
                    yield stored(joined[0][:BLOCK], joined[1][:BLOCK])
                    waiting = [(joined[0][BLOCK:], joined[1][BLOCK:])]
        if sum(len(v) for _, v in waiting):
            yield stored(pa.chunked_array([i for i, _ in waiting]).combine_chunks(), np.concatenate([v for _, v in waiting]))

    kind = own.schema["id"].dataType.simpleString()
    return settle(mapped(own, run, [], f"ids array<{kind}>, vals array<array<bigint>>, codes binary"), "blocks")


def stored(ids: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
    block = coded(vectors)
    columns = [
        pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([[v.tolist() for v in block.values]], pa.list_(pa.list_(pa.int64()))),
        pa.array([block.codes.astype("<u2").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["ids", "vals", "codes"])


def blocks_of(batch: pa.RecordBatch) -> Iterator[Block]:
    for vals, codes in zip(batch.column("vals"), batch.column("codes"), strict=True):
        values = [np.array(v, np.int64) for v in vals.as_py()]
        yield Block(values, np.frombuffer(codes.as_py(), "<u2").reshape(len(values), -1))


def exact_type(block: Block, centroids: list[list[int]]) -> type:
    most = max((abs(int(x)) for v in block.values for x in (v[0], v[-1])), default=0)
    return np.int64 if max([most, *(abs(x) for c in centroids for x in c)]) < SMALL else object


def tables(block: Block, centroids: list[list[int]]) -> list[np.ndarray]:
    """Per dimension the squared difference of each occurring value (rows) to each centroid's component (columns)."""
    kind = exact_type(block, centroids)
    middles = np.array(centroids, object).astype(kind)
    return [(v.astype(kind)[:, None] - middles[None, :, d]) ** 2 for d, v in enumerate(block.values)]


def nearest(block: Block, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number among equally near ones, and the squared distance."""
    sums = 0
    for table, codes in zip(tables(block, centroids), block.codes, strict=True):
        sums = sums + table[codes]
    best = sums.argmin(axis=1)
    return best, sums[np.arange(len(best)), best]


def first_centroids(blocks: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hash of their id, by hash; of equal hashes, by components.

    Each task offers its k smallest.
    """

    def run(batches: Batches) -> Batches:
        least: list[tuple[str, list[int]]] = []
        for batch in batches:
            for ids, block in zip(batch.column("ids").to_pylist(), blocks_of(batch), strict=True):
                keys = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i in ids]
                edge = heapq.nsmallest(k, keys)[-1]
                near = [n for n, key in enumerate(keys) if key <= edge]
                offers = [(keys[n], [int(v[c]) for v, c in zip(block.values, block.codes[:, n], strict=True)]) for n in near]
                least = heapq.nsmallest(k, least + offers)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in least], pa.string()), pa.array([v for _, v in least], pa.list_(pa.int64()))], ["key", "vector"])

    offered = mapped(blocks, run, [], "key string, vector array<bigint>")
    return [list(r.vector) for r in offered.orderBy("key", "vector").limit(k).collect()]


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: componentwise floors of the exact means of their vectors; empty ones stay."""
    dims = len(centroids[0])

    def run(batches: Batches) -> Batches:
        count = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), dims), object)
        for batch in batches:
            for block in blocks_of(batch):
                kind = exact_type(block, [])
                best, _ = nearest(block, centroids)
                order = np.argsort(best, kind="stable")
                found, begin = np.unique(best[order], return_index=True)
                count += np.bincount(best, minlength=len(centroids))
                for d in range(dims):
                    sums[found, d] += np.add.reduceat(block.values[d][block.codes[d]][order].astype(kind), begin).astype(object)
        filled = np.flatnonzero(count)
        totals = [Decimal(int(x)) for x in sums[filled].ravel()]
        columns = [
            pa.array(np.repeat(filled, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(filled))),
            pa.array(np.repeat(count[filled], dims)), pa.array(totals, pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "dim", "n", "total"])

    parts = mapped(blocks, run, [], "cluster int, dim int, n bigint, total decimal(38,0)")
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.cluster][r.dim] = int(r.total) // r.n
    return out


def written(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    df: DataFrame, k: int = 16, rounds: int = 3, *, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per usable vector its id, cluster, squared distance, the inertia of its cluster and of all, and its centroid's hash.

    Vectors that are null, have another length, or hold null or non-finite components take
    no part.  With fewer than k vectors there are as many centroids as vectors; without any,
    no rows.  Repeated rows are clustered alike and each counts; a null id is hashed as
    an empty one.  The input's other columns aren't passed on.
    """
    kind = df.schema[id_col].dataType
    blocks = write_blocks(df, dims, scale, id_col, vector_col)
    centroids = first_centroids(blocks, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(blocks, centroids)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for ids, block in zip(batch.column("ids"), blocks_of(batch), strict=True):
                best, distance = nearest(block, centroids)
                held = pa.array([min(int(x), LONGEST) for x in distance], pa.int64()) if distance.dtype == object else pa.array(distance)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(best.astype(np.int32)), held], ["id", "cluster", "distance"])

    shape = f"id {kind.simpleString()}, cluster int, distance bigint"
    spark = df.sparkSession
    assigned = settle(mapped(blocks, run, [], shape), "assigned") if centroids else spark.createDataFrame([], shape)
    # A row per centroid: k rows at most.
    most = F.lit(LONGEST).cast("decimal(38,0)")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = min(sum(int(r.total) for r in inertia), LONGEST)
    found = [(r.cluster, min(int(r.total), LONGEST), whole, written(centroids[r.cluster])) for r in inertia]
    sums = spark.createDataFrame(found, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = assigned.join(F.broadcast(sums), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
