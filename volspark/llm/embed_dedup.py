"""Embedding near-duplicates with an inverted multi-index.

Vectors are compared within a label (and a dimension) by cosine, in double
precision. Identical vectors of a label are one class; all work is on classes.

Index: two codebooks, one per half of the unit vector, trained independently by
k-means on a bounded sample (``sample`` classes); a class is filed in the cell
of its nearest centroids, so the two codebooks span a product grid. The
size of the codebooks is the one of least estimated work, from the sample's
visits and the number of classes that a class is compared with: it grows with
the table. Query: a class visits cells in the order of the multi-sequence
traversal, nearest first by the sum of its squared distances to the two cells'
regions. Those are lower bounds of the distance to anything filed there, so at
target recall 1 (the default) the traversal ends, without loss, where the sum
passes the squared link radius ``2 * (1 - threshold)``; a lower target shortens
the radius. Every candidate is verified exactly. Both ends of a link see each
other's cell, so only the end in the lower cell visits.

A cell's members and its visitors from lower cells are dealt to blocks of about
``block`` rows; every pair of blocks (one triangle of them among members) meets
in one task, so no task holds a cell. A task returns, per class, a link count
and a spanning link to the smallest class of its group, never the pairs
themselves.

Defined results: vectors that are null, zero, without a label, or with null or
non-finite components link with nothing (n_links 0, kept); copies of a linkable
vector link with each other; an id that repeats gets one row per occurrence,
each with the links of its own vector; a row without an id is compared and
counted like any other, and its component is the smallest id it reaches (null,
and then kept, if it reaches none); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from math import sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.components import components
from volspark.session import keep

SAMPLE = 8192
TARGET_RECALL = 1.0
BLOCK = 1000
CENTROIDS = 8           # of each codebook, at least
BORDERS = 16            # nearest centroids whose borders bound the distance to a region
COPY_WORK = 1000        # work of sending a class to one more block, in verified pairs (measured)
SLACK = 1e-6            # of a squared radius, for rounding in the bounds


def _encoded(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector): binary little-endian doubles, null where the row cannot link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, label in zip(batch.column(2), batch.column(1)):
                row = value.values if value.is_valid and label.is_valid else None
                if row is None or row.null_count or not len(row):
                    out.append(None)
                    continue
                x = row.to_numpy(zero_copy_only=False).astype("<f8") + 0.0     # no negative zeros
                with np.errstate(over="ignore"):
                    out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["id", "label", "vector"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "id long, label string, vector binary")


def _unit(vectors) -> np.ndarray:
    """Unit rows of binary vectors of one dimension."""
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)              # norms stay in range
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _halves(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (unit.shape[1] + 1) // 2
    return unit[:, :cut], unit[:, cut:]


def kmeans(points: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """Centroids of ``points`` (fewer than k when there are fewer distinct points)."""
    distinct = np.unique(points, axis=0)
    random = np.random.default_rng(seed)
    centroids = distinct[random.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = _squares(points, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def _squares(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((points ** 2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(axis=1)[None])


class Grid:
    """The product grid of two codebooks for one dimension."""

    def __init__(self, unit: np.ndarray, k: int, threshold: float, target_recall: float):
        self.codebooks = [kmeans(half, k) for half in _halves(unit)]
        self.apart = [np.sqrt(np.maximum(_squares(c, c), 0)) for c in self.codebooks]
        self.radius = link_radius(threshold, target_recall, unit.shape[1])

    def _margins(self, half: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid, and a lower bound of the distance from each point to each centroid's region."""
        codebook = self.codebooks[side]
        if not codebook.shape[1]:
            return np.zeros(len(half), np.int64), np.zeros((len(half), 1))
        squares = _squares(half, codebook)
        home = squares.argmin(axis=1)
        margin = np.zeros_like(squares)
        nearest = np.argsort(squares, axis=1, kind="stable")[:, :BORDERS]
        for c in nearest.T:                                   # the plane between c and the region's centroid
            apart = self.apart[side][c]
            to_plane = (squares - np.take_along_axis(squares, c[:, None], axis=1)) / np.maximum(2 * apart, SLACK)
            np.maximum(margin, np.where(apart < SLACK, 0, to_plane), out=margin)
        return home, margin

    def visits(self, unit: np.ndarray, rows: int = 1024) -> tuple[np.ndarray, list[list[int]]]:
        """Home cell of each row, and the cells it visits (nearest first)."""
        homes, visited = [], []
        for at in range(0, len(unit), rows):
            (home1, m1), (home2, m2) = (self._margins(h, side)
                                        for side, h in enumerate(_halves(unit[at:at + rows])))
            homes.append(home1 * m2.shape[1] + home2)
            visited += [_traverse(a, b, self.radius) for a, b in zip(m1, m2)]
        return np.concatenate(homes), visited

    def homes(self, unit: np.ndarray) -> np.ndarray:
        """Home cell of each row."""
        first, second = (_squares(h, c).argmin(axis=1) if c.shape[1] else np.zeros(len(h), np.int64)
                         for h, c in zip(_halves(unit), self.codebooks))
        return first * len(self.codebooks[1]) + second


def fitting_grid(unit: np.ndarray, compared: float, threshold: float, target_recall: float, block: int) -> Grid:
    """The grid of least estimated work; ``compared``: classes of its label that a class of the table has, on average.

    Codebooks double from CENTROIDS while that pays, and leave eight sampled points a centroid.
    """
    best, least, k = None, np.inf, CENTROIDS
    while best is None or k <= len(unit) // 8:
        grid = Grid(unit, k, threshold, target_recall)
        share = np.bincount(grid.homes(unit), minlength=len(grid.codebooks[0]) * len(grid.codebooks[1])) / len(unit)
        _, visits = grid.visits(unit[:512])
        pairs = compared * np.mean([share[v].sum() for v in visits]) / 2
        copies = np.mean([len(v) for v in visits]) / 2 + 2 * pairs / block
        work = pairs + COPY_WORK * copies
        if work >= least:
            break
        best, least, k = grid, work, 2 * k
    return best


def link_radius(threshold: float, target_recall: float, dimension: int) -> float:
    """Distance within which cells are visited.

    At target recall 1 that of two unit vectors at the threshold; below, how far
    a neighbour at that distance in a random direction gets towards any one
    border with that probability.
    """
    radius = sqrt(max(2 * (1 - threshold), 0))
    if target_recall >= 1:
        return radius
    return min(radius, radius / sqrt(dimension) * max(NormalDist().inv_cdf(target_recall), 0))


def _traverse(m1: np.ndarray, m2: np.ndarray, radius: float) -> list[int]:
    """Cells by ascending sum of squared margins, up to the squared radius.

    The classic multi-sequence traversal: both halves' cells in order, a front
    of pairs (i, j), each popped pair pushing its two successors.
    """
    limit = radius * radius + SLACK
    o1, o2 = (np.flatnonzero(m * m <= limit) for m in (m1, m2))
    o1, o2 = o1[np.argsort(m1[o1], kind="stable")], o2[np.argsort(m2[o2], kind="stable")]
    s1, s2 = (m1[o1] ** 2).tolist(), (m2[o2] ** 2).tolist()
    front, cells = [(s1[0] + s2[0], 0, 0)], []
    while front:
        total, i, j = heappop(front)
        if total > limit:
            break
        cells.append(int(o1[i]) * len(m2) + int(o2[j]))
        if j + 1 < len(s2):
            heappush(front, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(s1):                        # each pair is pushed once
            heappush(front, (s1[i + 1] + s2[0], i + 1, 0))
    return cells


def _linked(index: pd.DataFrame, visitors: pd.DataFrame | None, threshold: float) -> pd.DataFrame:
    """(id, n, other) of the links between two blocks, or within one when ``visitors`` is None.

    Every pair of classes meets in one place only, so a link counts at both
    ends. ``other`` is the smallest id reachable over links found here.
    """
    within = visitors is None
    both = index if within else pd.concat([index, visitors], ignore_index=True)
    if not len(index) or len(both) == len(index) and not within:
        return pd.DataFrame({name: pd.Series(dtype="int64") for name in ("id", "n", "other")})
    both = both.sort_values("id", kind="stable") if within else both
    units, ids, copies = _unit(both["vector"].tolist()), both["id"].to_numpy(), both["copies"].to_numpy()
    split = 0 if within else len(index)
    members = units if within else units[:split]
    counts, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(split, len(units), 256):
        a, b = np.nonzero(units[at:at + 256] @ members.T >= threshold)
        a += at
        if within:
            a, b = a[a < b], b[a < b]
        counts += np.bincount(a, copies[b], len(ids)).astype(np.int64)
        counts += np.bincount(b, copies[a], len(ids)).astype(np.int64)
        edges.append((a, b))
    a, b = (np.concatenate(ends) for ends in zip(*edges))
    # roots by place, the smallest id being that of the lowest rank
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    a, b = rank[a], rank[b]
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    touched, ordered = np.unique(np.concatenate([a, b])), np.argsort(rank)
    return pd.DataFrame({"id": ids[ordered[touched]], "n": counts[ordered[touched]],
                         "other": ids[ordered[root[touched]]]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.98, centroids: int | None = None,
                    sample: int = SAMPLE, target_recall: float = TARGET_RECALL,
                    block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    ``centroids``: size of each codebook, chosen by estimated work when None.
    """
    spark = vectors.sparkSession
    rows = keep(_encoded(vectors, id_col, vector_col, label_col)
                .withColumn("key", F.when(F.col("vector").isNotNull(), F.sha2("vector", 256))), "vectors")
    # copies meet here, combined before the shuffle; the number is stored, so it stays
    classes = keep(rows.where("vector is not null").groupBy("label", "vector").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("key", F.sha2("vector", 256)).withColumn("id", F.monotonically_increasing_id()), "vector-classes")

    # codebooks per dimension, from a bounded sample
    picked = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).collect()
    by_size: dict[int, list[bytes]] = {}
    for row in picked:
        by_size.setdefault(len(row.vector), []).append(bytes(row.vector))
    per_label = classes.groupBy("label", F.length("vector").alias("size")).count()
    compared = {r.size: r.n for r in per_label.groupBy("size").agg(
        (F.sum(F.col("count").cast("double") * F.col("count")) / F.sum("count")).alias("n")).where(
        F.col("size").isin(list(by_size))).collect()}
    grids = {size: vars(Grid(_unit(found), centroids, threshold, target_recall) if centroids else
                        fitting_grid(_unit(found), compared[size], threshold, target_recall, block))
             for size, found in by_size.items()}
    # for each sampled dimension 2 x k x (dimension / 2 + k) numbers, k at most an eighth of its sample
    shared = spark.sparkContext.broadcast(grids)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {}
        for size, state in shared.value.items():
            own[size] = Grid.__new__(Grid)
            vars(own[size]).update(state)
        for batch in batches:
            batch["size"] = batch["vector"].map(len)
            for size, part in batch.groupby("size"):
                if size in own:
                    home, visits = own[size].visits(_unit(part["vector"].tolist()))
                else:                                     # a dimension outside of the sample: one cell
                    home, visits = np.zeros(len(part), np.int64), [[0]] * len(part)
                higher = [[c for c in cells if c > at] for at, cells in zip(home.tolist(), visits)]
                yield part.assign(home=home, visits=higher)[
                    ["id", "label", "copies", "vector", "size", "home", "visits"]]

    filed = keep(classes.select("id", "label", "copies", "vector").mapInPandas(
        file, "id long, label string, copies long, vector binary, size int, home long, visits array<long>"),
        "vector-cells")
    cell = ["label", "size", "cell"]
    members = filed.withColumn("cell", F.col("home"))
    visitors = filed.withColumn("cell", F.explode("visits"))
    # blocks of each cell's members (ib) and visitors (vb); block pair (i, v): v < ib is a block of members
    sizes = keep(members.groupBy(cell).agg(F.count("*").alias("n"))
                 .join(visitors.groupBy(cell).agg(F.count("*").alias("m")), cell, "left").na.fill(0, ["m"])
                 .where("n > 1 or m > 0")
                 .select(*cell, F.ceil(F.col("n") / block).alias("ib"), F.ceil(F.col("m") / block).alias("vb")),
                 "cell-sizes")
    spread = F.xxhash64("id")
    no_pairs = F.array().cast("array<struct<i:bigint,v:bigint,member:boolean>>")

    def pair(i, v, member: bool):
        return F.struct(i.cast("long").alias("i"), v.cast("long").alias("v"), F.lit(member).alias("member"))

    payload = ["id", "copies", "vector"]
    own, ib, vb = F.pmod(spread, "ib"), F.col("ib"), F.col("vb")
    places = F.concat(
        F.transform(F.sequence(own, ib + vb - 1), lambda v: pair(own, v, True)),
        F.when(own > 0, F.transform(F.sequence(F.lit(0).cast("long"), own - 1), lambda i: pair(i, own, False)))
        .otherwise(no_pairs))
    members = members.join(sizes, cell).select(*cell, *payload, F.explode(places).alias("p"))
    visitors = visitors.join(sizes, cell).select(*cell, *payload, F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), ib - 1), lambda i: pair(i, ib + F.pmod(spread, "vb"), False))).alias("p"))

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        *_, i, v = key
        return _linked(rows[rows["member"]], None if i == v else rows[~rows["member"]], threshold)

    # dealt by block: a partitioning by cell, left over from the joins, would keep a crowded cell together
    blocks = members.union(visitors).select(*cell, *payload, "p.*").repartition(*cell, "i", "v")
    found = keep(blocks.groupBy(*cell, "i", "v").applyInPandas(
        meet, "id long, n long, other long"), "vector-links")

    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = keep(components(found, "id", "other"), "vector-components")
    least = groups.join(classes.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("least"))
    per_class = keep(classes.select("id", "label", "key", "copies", "rep").join(links, "id", "left")
                     .join(groups.join(least, "component"), "id", "left")
                     .select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                             F.coalesce("least", "rep").alias("least")), "vector-groups")
    return (rows.select("id", "label", "key").join(per_class, ["label", "key"], "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("least", "id").alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))
