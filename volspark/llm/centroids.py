"""Centroid clustering (Lloyd's rounds) over dictionary-encoded vectors, exact in integers.

A vector component x becomes the integer floor(``scale`` * x). The vectors are
ordered so that equal ones lie together (a range shuffle by their hash and id:
copies of one vector that are too many for one task go to several), cut into
chunks, and every chunk is stored once, encoded without loss: its dimensions in
blocks of ``block``, for each block the chunk's distinct subvectors (the
dictionary) and one code per vector.

A round reads the stored chunks. It computes the squared distance of every
distinct subvector to the centroids' part of its block once, adds a vector's
partial distances up by its codes, and takes the nearest centroid. The new sums
come from the dictionary too: how often a cluster holds each code, times the
subvector. Tasks send ``k`` x (dimensions + 1) sums each; the driver holds ``k``
centroids and nothing that grows with the data. A lost executor costs the tasks
it ran: chunks are on shared storage and the rounds only read them.

All arithmetic is in 64-bit integers (components up to 2 ** 26 in size; a larger
one raises), floors go down, ties go to the smaller centroid number.

Defined results: vectors that are null, of another size, or hold null or
non-finite components have no row; fewer vectors than ``k`` start as many
clusters; repeated rows count and are returned once each; rows without an id
start no cluster but belong to one; no vectors give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.session import keep

BLOCK = 8                   # dimensions of a subvector
CHUNK = 4096                # vectors that share dictionaries
LARGEST = 1 << 26           # size of an integer component: 64 squared differences fit a long


def integer_vectors(table: DataFrame, dims: int = 64, scale: int = 1024, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """(id, v): the whole vectors as arrays of integers floor(scale * x)."""
    x = table.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = x.where((F.size("x") == dims) & finite)
    fits = F.forall("x", lambda e: F.abs(e * scale) <= LARGEST)
    floors = F.transform("x", lambda e: F.floor(e * scale))
    return whole.select("id", F.when(fits, floors).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest sha256 of ``salt`` + id, in that order."""
    code = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = vectors.where("id is not null").orderBy(code, "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def encode(vectors: DataFrame, dims: int, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Chunks (ids, n, codes, dictionaries) of dictionary-encoded vectors.

    ``codes`` holds one 16-bit number per block and vector (block by block) and
    ``dictionaries`` the distinct subvectors of each block as 32-bit integers.
    """
    starts = range(0, dims, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, chunk):
                rows = batch.slice(first, chunk)
                v = rows.column(1).flatten().to_numpy().reshape(rows.num_rows, dims).astype("<i4")
                codes, dictionaries = [], []
                for at in starts:
                    part = np.ascontiguousarray(v[:, at:at + block])
                    _, one, code = np.unique(part.view(f"V{part.shape[1] * 4}").ravel(),
                                             return_index=True, return_inverse=True)
                    codes.append(code.astype("<u2").tobytes())
                    dictionaries.append(part[one].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([rows.num_rows], pa.int32()), pa.array([b"".join(codes)], pa.binary()),
                     pa.array([dictionaries], pa.list_(pa.binary()))],
                    names=["ids", "n", "codes", "dictionaries"])

    if chunk > 1 << 16:
        raise ValueError("a chunk has at most 65,536 vectors: codes are 16-bit numbers")
    together = vectors.repartitionByRange(F.xxhash64("v"), "id").sortWithinPartitions(F.xxhash64("v"), "id")
    return together.mapInArrow(run, "ids array<long>, n int, codes binary, dictionaries array<binary>")


def _decode(row: dict, dims: int, block: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (block, vector) and the dictionary of each block."""
    codes = np.frombuffer(row["codes"], "<u2").reshape(-1, row["n"])
    return codes, [np.frombuffer(d, "<i4").reshape(-1, min(block, dims - at)).astype(np.int64)
                   for at, d in zip(range(0, dims, block), row["dictionaries"])]


def _distances(codes: np.ndarray, dictionaries: list[np.ndarray], centroids: np.ndarray,
               block: int) -> np.ndarray:
    """Squared distances (vector, centroid): partial ones of the distinct subvectors, added by code."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for b, (code, entries) in enumerate(zip(codes, dictionaries)):
        part = centroids[:, b * block:b * block + entries.shape[1]]
        total += ((entries[:, None, :] - part) ** 2).sum(2)[code]
    return total


def _round(chunks: DataFrame, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the vectors nearest to each centroid, summed exactly."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                codes, dictionaries = _decode(row, dims, block)
                nearest = _distances(codes, dictionaries, centroids, block).argmin(1)
                counts += np.bincount(nearest, minlength=k)
                for b, (code, entries) in enumerate(zip(codes, dictionaries)):
                    held = np.bincount(nearest * len(entries) + code, minlength=k * len(entries))
                    sums[:, b * block:b * block + entries.shape[1]] += held.reshape(k, -1) @ entries
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dims + 1), pa.int32()),
             pa.array(np.tile(np.arange(dims + 1), k), pa.int32()),
             pa.array(np.c_[sums, counts].ravel(), pa.int64())], names=["cluster", "at", "total"])

    sent = chunks.select("n", "codes", "dictionaries").mapInArrow(run, "cluster int, at int, total long")
    table = np.zeros((k, dims + 1), np.int64)
    for r in sent.groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect():
        table[r.cluster, r.at] = r.total
    return table[:, :dims], table[:, dims]


def _assign(chunks: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                distances = _distances(*_decode(row, dims, block), centroids, block)
                nearest = distances.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(nearest, pa.int32()),
                     pa.array(distances[np.arange(len(nearest)), nearest], pa.int64())],
                    names=["id", "cluster", "distance"])

    return chunks.mapInArrow(run, "id long, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    """Lowercase hex SHA-256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, *, dims: int = 64, scale: int = 1024,
            salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding",
            block: int = BLOCK, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance, cluster_inertia, inertia), centroids) after ``rounds`` rounds.

    Every round replaces each centroid that has vectors by the floored mean of
    its vectors, component by component; then vectors are assigned once more.
    """
    spark = table.sparkSession
    vectors = integer_vectors(table, dims, scale, id_col, vector_col)
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame(
            [], "id long, cluster int, distance long, cluster_inertia long, inertia long"), centroids
    chunks = keep(encode(vectors, dims, block, chunk), "vector-chunks")
    for _ in range(rounds):
        sums, counts = _round(chunks, centroids, block)
        filled = counts > 0
        centroids[filled] = sums[filled] // counts[filled, None]
    found = keep(_assign(chunks, centroids, block), "cluster-members")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per_cluster = found.groupBy("cluster").agg(exact.alias("c"))
    whole = found.agg(exact.alias("i")).select("i").scalar()
    # at most k rows
    inertias = F.broadcast(per_cluster.select("cluster", F.col("c").cast("long").alias("cluster_inertia"),
                                              whole.cast("long").alias("inertia")))
    return found.join(inertias, "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia"), centroids
