"""Target-distribution importance resampling over hashed n-grams.

Words are runs of bytes that are not ASCII punctuation, white space or controls,
A-Z in lower case. A text is normalised first: separators collapse to single
spaces. The n-grams of a length are then the overlapped matches of one pattern,
``n`` words held by single spaces between two boundary lookarounds; each match's
span goes straight to CRC-32 and a bucket.

A text's buckets are stored once, as its distinct buckets with counts (at most
``buckets`` of them, however long the text). The buckets of both tables are
counted by Spark; a bucket's gain is the scaled, floored log ratio of its
smoothed shares in the target and in the corpus, a text's weight the floored
mean of its gains. Scores add a Gumbel draw made from the id, so the highest
scores are a sample without replacement, the same in every run.

Ranks need no task that sees all rows: scores are integers, and there are at most
some 120,000 different ones (both terms are logarithms), so their counts are a
small table that gives each score its first rank. Only rows of one score, a
share of at most 0.04 % by the draw, are numbered together; rows alike in all
columns are numbered as one.

Defined results: a null or empty text has no words, weight 0 and is not drawn;
a null id draws like the empty text and comes last among ties; repeated rows are
ranked one by one; an empty target gives every bucket its smoothed share; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volspark.session import keep

BUCKETS = 10_000
SCALE = 1000
COPIES = 4096                   # ranks of like rows that are made at a time
# bytes of a word stay (A-Z in lower case), all others are separators
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7a
                   else b + 32 if 0x41 <= b <= 0x5a else 0x20 for b in range(256))


def gram_pattern(n: int) -> bytes:
    """A pattern whose overlapped matches are the ``n``-grams of a normalised text."""
    return rb"(?<![^ ])[^ ]+" + rb"(?: [^ ]+){%d}" % (n - 1) * (n > 1) + rb"(?![^ ])"


def grams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shortest: int = 1,
          longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, at, n): each text's distinct n-gram buckets ``at``, ``n`` times each."""
    if not 1 <= shortest <= longest:
        raise ValueError("n-grams have at least one word, and the longest no fewer than the shortest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        separators = regex.compile(rb" {2,}")
        patterns = [regex.compile(gram_pattern(n)) for n in range(shortest, longest + 1)]
        for batch in batches:
            words, features, at, counts = [], [], [], []
            for text in batch.column(1):
                raw = separators.sub(b" ", (text.as_py() or "").encode().translate(WORD_BYTES)).strip(b" ")
                hashes = np.fromiter((crc32(raw[start:end]) % buckets for pattern in patterns for start, end in (
                    m.span() for m in pattern.finditer(raw, overlapped=True))), np.int32)
                bucket, n = np.unique(hashes, return_counts=True)
                words.append(raw.count(b" ") + 1 if raw else 0)
                features.append(len(hashes))
                at.append(bucket)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                 pa.array(at, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["id", "n_words", "n_features", "at", "n"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(run, "id long, n_words long, n_features long, at array<int>, n array<long>"))


def _shares(features: DataFrame, name: str) -> DataFrame:
    """(at, <name>): how many features a bucket holds."""
    return (features.select(F.explode(F.arrays_zip("at", "n")).alias("e"))
            .groupBy(F.col("e.at").alias("at")).agg(F.sum("e.n").alias(name)))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> Column:
    """The gain of every bucket, as one array in a scalar subquery (``buckets`` numbers)."""
    spark = corpus.sparkSession
    table = (spark.range(buckets).select(F.col("id").cast("int").alias("at"))
             .join(_shares(corpus, "s"), "at", "left").join(_shares(target, "t"), "at", "left")
             .select("at", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")]))
    listed = table.agg(F.array_sort(F.collect_list(F.struct("at", "s", "t"))).alias("e"),
                       F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = lambda e: ((e.t + 1) * (F.col("all_s") + buckets)) / ((e.s + 1) * (F.col("all_t") + buckets))
    return listed.select(F.transform("e", lambda e: F.floor(F.log(ratio(e)) * SCALE)).alias("g")).scalar()


def gumbel(id_: Column, seed: str) -> Column:
    """The scaled, floored Gumbel draw of an id: 32 bits of sha256 of ``seed`` + id."""
    code = F.sha2(F.concat(F.lit(seed), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(code, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -SCALE)


def weigh(features: DataFrame, gain: Column, seed: str = "2024:") -> DataFrame:
    """(id, n_words, n_features, weight, score) of every text."""
    total = F.aggregate(F.arrays_zip("at", "n"), F.lit(0).cast("long"),
                        lambda sum_, e: sum_ + F.get(F.col("gain"), e["at"]) * e["n"])
    n = F.nullif(F.col("n_features"), F.lit(0))
    return (features.withColumn("gain", gain).withColumn("total", total).withColumn("some", n)
            .withColumn("weight", F.coalesce(F.expr("(total - pmod(total, some)) div some"), F.lit(0)).cast("long"))
            .select("id", "n_words", "n_features", "weight",
                    (F.col("weight") + gumbel(F.col("id"), seed)).alias("score")))


def draw(weighed: DataFrame, percent: int, min_words: int) -> DataFrame:
    """All rows with ``rank``: 1, 2, ... for the drawn ones by score and id, else null.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) are
    drawn. ``weighed`` is read several times.
    """
    able = weighed.where(F.col("n_words") >= min_words)
    k = able.agg(F.count(F.lit(1)).alias("n")).select(F.expr(f"n * {percent} div 100").alias("k")).scalar()
    by_score = able.groupBy("score").agg(F.count(F.lit(1)).alias("same"))
    # one row per different score
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    first = F.broadcast(by_score.select("score", F.coalesce(F.sum("same").over(higher), F.lit(0)).alias("before")))
    placed = (weighed.join(first, "score", "left")
              .withColumn("near", F.coalesce((F.col("n_words") >= min_words) & (F.col("before") < k), F.lit(False))))
    columns = ["id", "n_words", "n_features", "weight", "score"]
    alike = placed.where("near").groupBy(*columns, "before").agg(F.count(F.lit(1)).alias("copies"))
    earlier = (Window.partitionBy("score").orderBy(F.asc_nulls_last("id"), "weight", "n_words")
               .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)) + 1
    blocks = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    within = F.sequence(F.col("block"), F.least(F.col("block") + COPIES, F.col("copies")) - 1)
    ranked = (alike.select(*columns, "copies", start.alias("start"))
              .select("*", F.explode(blocks).alias("block"))
              .select(*columns, "start", F.explode(within).alias("copy"))
              .select(*columns, (F.col("start") + F.col("copy")).alias("rank"))
              .withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))))
    return placed.where("not near").select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(ranked)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, *,
             shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, seed: str = "2024:",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; ``rank`` of the drawn ones.

    ``target`` needs ``text_col`` only.
    """
    sizes = dict(shortest=shortest, longest=longest, buckets=buckets)
    corpus = keep(grams(docs, id_col, text_col, **sizes), "corpus-grams")
    wanted = keep(grams(target.select(F.lit(0).alias("id"), text_col), "id", text_col, **sizes), "target-grams")
    return draw(keep(weigh(corpus, gains(corpus, wanted, buckets), seed), "weighed"), percent, min_words)
