"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64-bit SimHash of word shingles (XXH64, seed 42, UTF-8); a bit is
1 when more than half of the shingle hashes have it set.

Linking, over distinct fingerprints:

1. bits that vary together are grouped into ``parts`` partitions (greedy, on
   the absolute correlations over all fingerprints), so that a value shared by
   chance in one partition says little about the others;
2. thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 are allocated by
   dynamic programming on the estimated candidate counts of each partition:
   fingerprints within max_bits differ in at most t_i bits of some partition,
   a partition with t_i = -1 is not probed at all;
3. every fingerprint probes its partition values within t_i bits and each
   candidate is verified on the whole 64 bits inside the join.

A partition value shared by more than ``block`` fingerprints is dealt to
several join keys (the probe visits each of them), so no task holds one bucket.
Components are found over the fingerprints themselves.

Defined results: null or wordless text has fingerprint zero and links like any
other; identical texts share a fingerprint; rows without an id are compared and
link others, and their component is the smallest id they reach (null if none);
repeated ids give repeated rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.llm.components import components
from volspark.session import keep

BITS = 64
SEED = 42


def _counts(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """Per-bit counts of set bits over the shingle hashes, and the number of hashes."""
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64,
                         max(1, len(words) - shingle + 1))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):     # bounded working memory for very long texts
        part = hashes[start:start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return ones, len(hashes)


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer (zero when it has no word)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII only
    if not words:
        return 0
    ones, n = _counts(words, shingle)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, fp): one row per document with its signed 64-bit fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [text_fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def bit_groups(together: np.ndarray, ones: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits grouped into ``parts`` partitions, correlated bits together.

    ``together[i, j]``: fingerprints with both bits set; ``ones[i]``: with bit i set.
    """
    p = ones / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        sub = corr[np.ix_(left, left)]
        group = [left[int(np.argmax(sub.max(axis=1)))]]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], max_bits: int) -> list[int]:
    """Thresholds t_i in -1..max_bits with sum(t_i + 1) = max_bits + 1 of least total cost.

    ``costs[i][t + 1]``: estimated candidates of partition i at threshold t.
    """
    best = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (total, picks) in best.items():
            for extra in range(min(max_bits + 1 - used, len(cost) - 1) + 1):
                option = (total + cost[extra], [*picks, extra - 1])
                if used + extra not in new or option < new[used + extra]:
                    new[used + extra] = option
        best = new
    return best[max_bits + 1][1]


def _value(fp: Column, bits: list[int]) -> Column:
    """The partition's bits of ``fp`` (in place, the others cleared)."""
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _bit_statistics(fps: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts of set bits and of jointly set bit pairs over all fingerprints (64 x 64 numbers)."""
    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(fp)
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.ravel().tolist()], pa.list_(pa.int64())), pa.array([n], pa.int64())],
            names=["together", "n"])

    got = (fps.mapInArrow(run, "together array<long>, n long")
           .select(F.posexplode("together").alias("k", "c"), "n")
           .groupBy("k").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect())
    together, n = np.zeros(BITS * BITS), 0
    for row in got:
        together[row.k], n = row.c, row.n
    together = together.reshape(BITS, BITS)
    return together, np.diag(together).copy(), n


def plan(fps: DataFrame, max_bits: int, parts: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed partition, from statistics of all fingerprints."""
    together, ones, n = _bit_statistics(fps)
    groups = bit_groups(together, ones, n, parts)
    values = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), _value(F.col("fp"), g).alias("v"))
        for i, g in enumerate(groups)])).alias("e")).select("e.*")
    pairs = {r.part: float(r.s) for r in values.groupBy("part", "v").count()
             .groupBy("part").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("s"))
             .collect()}
    # probing t bits meets about as many candidates per probed value as the exact value does
    costs = [[0.0] + [sum(comb(len(g), k) for k in range(t + 1)) * (n + pairs.get(i, 0.0))
                      for t in range(max_bits + 1)] for i, g in enumerate(groups)]
    return [(g, t) for g, t in zip(groups, allocate(costs, max_bits)) if t >= 0]


def links(fps: DataFrame, max_bits: int = 3, parts: int = 4, block: int = 2000) -> DataFrame:
    """(a, b): pairs of distinct fingerprints a < b within ``max_bits``.

    ``fps``: distinct fingerprints in column ``fp`` (read several times). A pair
    may appear once per partition that finds it.
    """
    index, probes = [], []
    for i, (bits, t) in enumerate(plan(fps, max_bits, parts)):
        flips = [_signed(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(bits, k)]
        value = _value(F.col("fp"), bits)
        index.append(F.struct(F.lit(i).alias("part"), value.alias("v")))
        probes += [F.struct(F.lit(i).alias("part"), value.bitwiseXOR(F.lit(f)).alias("v")) for f in flips]
    index = fps.select(F.col("fp").alias("b"), F.explode(F.array(*index)).alias("e")).select("b", "e.*")
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.array(*probes)).alias("e")).select("a", "e.*")
    # a value of many fingerprints is split over ceil(count / block) keys
    crowded = (index.groupBy("part", "v").count().where(F.col("count") > block)
               .select("part", "v", F.ceil(F.col("count") / block).alias("keys")))
    index = (index.join(crowded, ["part", "v"], "left")
             .withColumn("key", F.pmod(F.xxhash64("b"), F.coalesce("keys", F.lit(1)))).drop("keys"))
    probe = (probe.join(crowded, ["part", "v"], "left")
             .withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.coalesce("keys", F.lit(1)) - 1))).drop("keys"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (probe.join(index, (probe.part == index.part) & (probe.v == index.v)
                       & (probe.key == index.key) & (F.col("a") < F.col("b")) & near)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3, parts: int = 4) -> DataFrame:
    """(id, fp, component_id): each document's fingerprint and its group.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included.
    """
    return grouped(keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints"), max_bits, parts)


def grouped(fps: DataFrame, max_bits: int = 3, parts: int = 4) -> DataFrame:
    """(id, fp, component_id) of stored fingerprints (id, fp)."""
    # copies meet here: one row per distinct fingerprint, combined before the shuffle
    classes = keep(fps.groupBy("fp").agg(F.min("id").alias("rep")), "fingerprint-classes")
    pairs = keep(links(classes.select("fp"), max_bits, parts), "fingerprint-links")
    groups = keep(components(pairs).withColumnRenamed("id", "fp"), "fingerprint-components")
    least = groups.join(classes, "fp").groupBy("component").agg(F.min("rep").alias("least"))
    found = keep(classes.join(groups.join(least, "component"), "fp", "left").select(
        "fp", F.coalesce("least", "rep").alias("component_id")), "fingerprint-groups")
    # plain scans on both sides: Spark splits the rows of a fingerprint that very many share
    return fps.join(found, "fp").select("id", "fp", "component_id")
