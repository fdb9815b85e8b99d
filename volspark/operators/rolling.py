"""Rolling time-frame aggregates that scale past one task per series.

A RANGE frame ``[t - F, t]`` over an unpartitioned (or hot-keyed) series puts
the whole series into one task, and Spark's sliding RANGE frame recomputes the
aggregate for every row (O(rows x frame rows)). This module computes the same
values with only linear, bounded-size work per task:

* time is cut into buckets of ``w`` seconds (``w`` divides every frame length);
  all big work is partitioned by (series, bucket), so a hot series spreads
  over its buckets;
* the frame of a row at ``t`` in bucket ``s`` is split into three parts:

  - prefix: rows of bucket ``s`` with time <= t (running aggregate, ascending
    order, growing frame -> O(n)), taken where ``lag`` has sorted the rows;
  - middle: whole buckets ``s - F/w + 1 .. s - 1``. Up to ``DIRECT_SPAN`` buckets a
    frame, each bucket sends its totals, in the exchange of the rows, to the
    non-empty buckets whose middle it belongs to. Beyond that totals are summed
    in a dyadic tree (node i of level l holds the buckets i * 2**l up to the next
    node's), and a bucket asks for the at most 2 * log2(F/w) nodes that its middle
    consists of: narrow buckets, which split bursts, cost a logarithm of rows;
  - suffix: rows of bucket ``s - F/w`` with time >= t - F. The totals of each second
    are copied once per frame into bucket ``s + F/w`` with their time shifted by ``F``;
    a running aggregate in descending order gives the suffix (O(n)). A bucket gets at
    most ``w`` copies a frame, however many rows its seconds hold.

All parts are sums, maxima and minima of disjoint row sets, so the result is
the frame aggregate with no subtraction of large partial sums. Peers (equal
times) are inside the frame at both ends, as with SQL RANGE frames.

The previous value in (time, seq) order across bucket borders (``lag``) uses
a carry table: the last value of each non-empty bucket, lagged over buckets.

A burst inside one bucket is cut into blocks of consecutive (time, seq) ranks
(``add_blocks``). ``lag`` then works block by block with a carry per block, and
``rolling_by_second`` scans totals: rows give totals of each second of a block,
these the totals of a second, and only the seconds (at most ``w`` a bucket) go
through the frames. No step holds a bucket's rows together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volspark.session import keep

SK = "_sk"   # series key: struct of the key columns (null fields group together)
BK = "_b"    # bucket index
TG = "_targets"  # non-empty buckets ahead whose frames reach back to this one
FIRST = "_first"  # first row of its bucket in (time, seq) order
FIRST_BK = "_first_b"  # bucket index, between two exchanges
BLK = "_block"   # block of consecutive ranks within a bucket


@dataclass(frozen=True)
class FrameAgg:
    """One rolling aggregate: ``kind`` of ``column`` over ``[t - seconds, t]``.

    kind is one of count, sum, sumsq, max, min. sum/sumsq are NULL when the
    frame holds no non-null value (SQL semantics).
    """
    name: str
    kind: str
    column: str
    seconds: int


DIRECT_SPAN = 32         # buckets of the longest frame up to which totals are sent one by one
TASKS_PER_CORE = 8       # at least, of the shuffles of rows
MIN_BUCKET = 60          # seconds; narrower buckets would mean more totals than rows
UNTIMED = 1 << 40        # first bucket of rows without a time, after every real one
UNTIMED_BUCKETS = 1024
BLOCK_SAMPLES = 32       # sampled rows a block, for its borders
BLOCK_SALTS = 64         # parts of a bucket while its rows look up their block
MAX_BLOCK_BITS = 24      # blocks of a bucket, as a power of two
FAR_TIME = 1 << 61       # seconds; times beyond either end count as this one in ``order_number``


def bucket_width(seconds: list[int]) -> int:
    """The widest bucket that divides every frame; at least ``MIN_BUCKET`` seconds."""
    width = reduce(math.gcd, seconds)
    if width < MIN_BUCKET:
        raise ValueError(f"frames {sorted(set(seconds))} share no bucket of {MIN_BUCKET} s or more; "
                         "choose frames with a larger common divisor or pass bucket_seconds")
    return width


def add_series_bucket(df: DataFrame, keys, time_col: str, width: int, spread: Column,
                      lookahead: int) -> DataFrame:
    """Add the bucket index and, for keyed series, the series key column.

    Rows without a time get buckets of their own, by a hash of ``spread`` and
    too far apart to be in each other's frames, so they never meet in one task.
    """
    new = [F.struct(*[F.col(k) for k in keys]).alias(SK)] if keys else []
    apart = F.pmod(F.xxhash64(spread), F.lit(UNTIMED_BUCKETS)) * (lookahead + 2)
    new.append(F.coalesce(F.floor(F.col(time_col) / F.lit(width)).cast("long"),
                          F.lit(UNTIMED) + apart).alias(BK))
    return df.select("*", *new)


def _series(df: DataFrame) -> list[str]:
    # Unkeyed series get no key column at all: a constant key would be folded
    # away by the optimizer and break partitioning reuse between operators.
    return [SK] if SK in df.columns else []


def add_blocks(df: DataFrame, time_col: str, seq_col: str, block_rows: int) -> DataFrame:
    """Add ``_block``: about ``block_rows`` rows of one bucket with consecutive (time, seq).

    The borders are order statistics of a sample taken by a hash of (time, seq), so
    they are the same in every recomputation. Rows of equal (time, seq) share a block.
    Rows find their block in a table of the borders of the crowded buckets alone, by a
    join on (series, bucket, salt): Spark broadcasts that table if it is small, else a
    crowded bucket is spread over ``BLOCK_SALTS`` tasks.
    """
    if block_rows < 1:
        raise ValueError("block_rows must be positive")
    part = _series(df) + [BK]
    every = max(1, block_rows // BLOCK_SAMPLES)
    step = max(1, block_rows // every)
    order = F.struct(F.col(time_col).alias("t"), F.col(seq_col).alias("s"))
    mixed = F.xxhash64(F.col(time_col), F.col(seq_col))
    sample = df.where(F.pmod(mixed, F.lit(every)) == 0).select(*part, order.alias("_o"))
    borders = sample.groupBy(*part).agg(F.sort_array(F.collect_list("_o")).alias("_o")).select(
        *part, F.filter("_o", lambda o, k: (k > 0) & (k % step == 0)).alias("_borders"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(BLOCK_SALTS - 1)).cast("array<long>"))
    crowded = borders.where(F.size("_borders") > 0).select("*", salts.alias("_salt"))
    # other bits of the hash than the sample's
    salt = F.pmod(F.shiftrightunsigned(mixed, 40), F.lit(BLOCK_SALTS)).cast("long")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MAX_BLOCK_BITS))])
    # binary search: the number of borders at or before the row
    block = F.aggregate(steps, F.lit(0), lambda at, n: F.when(
        F.get(F.col("_borders"), at + n - 1) <= order, at + n).otherwise(at))
    return (df.select("*", salt.alias("_salt")).join(crowded, part + ["_salt"], "left")
            .select(*df.columns, F.when(F.col("_borders").isNull(), 0).otherwise(block).alias(BLK)))


def _dealt(df: DataFrame, part: list[str], spread: bool, from_files: bool = False) -> DataFrame:
    """Exchange by ``part``. With ``spread`` its number of tasks is fixed: left to itself,
    adaptive execution merges tasks by compressed bytes, and rows that compress well
    (repeated prices and times) then meet in a few tasks of any number of rows.

    Rows ``from_files`` come in tasks that may be of any size (a row group is never split).
    Up to ``spark.shuffle.sort.bypassMergeThreshold`` parts Spark writes an exchange without
    holding rows, beyond that it gathers all rows of a task. So they are dealt twice when there
    are more parts: first into that many, which are then small enough to be gathered.
    """
    if not spread:
        return df.repartition(*part)
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    unheld = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    if from_files and tasks > unheld > 1:
        # renamed and back: Spark would merge two exchanges with nothing in between
        first = df.withColumnRenamed(BK, FIRST_BK).repartition(unheld, *[FIRST_BK if c == BK else c for c in part])
        df = first.withColumnRenamed(FIRST_BK, BK)
    return df.repartition(tasks, *part)


def order_number(df: DataFrame, time_col: str, seq_col: str) -> Column:
    """The order (time, seq) as one number, for ``max_by`` and the like: nulls come first.

    Spark aggregates by hash only if the buffer has fixed-size fields. A struct has not:
    a task then sorts all rows of its part of the input before it reduces them. Pairs
    that are not integers stay a struct.
    """
    integers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if not all(isinstance(df.schema[c].dataType, integers) for c in (time_col, seq_col)):
        return F.struct(F.col(time_col), F.col(seq_col))
    whole = lambda c: c.cast("decimal(20,0)")
    # 65 bits for seq: 0 if it is null, else 1 and up
    seq = F.coalesce(whole(F.col(seq_col)) + F.lit(Decimal((1 << 63) + 1)), F.lit(Decimal(0)))
    # least and greatest skip nulls
    time = F.when(F.col(time_col).isNotNull(), F.greatest(F.least(F.col(time_col), F.lit(FAR_TIME)), F.lit(-FAR_TIME)))
    time = F.coalesce(time, F.lit(-FAR_TIME - 1))
    return (whole(time) * F.lit(Decimal(1 << 65)) + seq).cast("decimal(38,0)")


def with_previous(df: DataFrame, time_col: str, seq_col: str, value_col: str,
                  out_col: str, lookahead: int = 0, spread: bool = True) -> DataFrame:
    """Previous ``value_col`` in (time, seq) order within the series.

    ``df`` must carry the series key and bucket columns. Output is
    hash-partitioned by (series, bucket), and by block if ``df`` has them. With a ``lookahead`` of 1 up to
    ``DIRECT_SPAN`` buckets each row also gets ``_targets``: the non-empty buckets in
    (b, b + lookahead], taken from the same small per-bucket table; ``rolling``
    then sends totals to them, else it builds the dyadic tree.
    """
    sk = _series(df)
    place = [BK, BLK] if BLK in df.columns else [BK]
    part = sk + place
    if lookahead >= DIRECT_SPAN:
        lookahead = 0
    # one row per non-empty bucket (or block): its last value, then the previous one's;
    # aggregated by hash, so a scan task holds its buckets, not its rows
    last = (df.groupBy(*part)
              .agg(F.max_by(F.col(value_col), order_number(df, time_col, seq_col)).alias("_last")))
    wb = Window.partitionBy(*sk).orderBy(*place)
    extra = []
    if lookahead > 0:
        ahead = F.collect_list(BK).over(wb.rangeBetween(1, lookahead))
        extra = [ahead.alias(TG)]
    carry = last.select(*part, F.lag("_last").over(wb).alias("_carry"), *extra)
    # explicit repartition: join and window then share one exchange
    rows = _dealt(df, part, spread, True).join(carry, part, "inner")
    w = Window.partitionBy(*part).orderBy(F.col(time_col), F.col(seq_col))
    out = rows.select("*", F.lag(F.col(value_col), 1).over(w).alias("_lag"),
                      (F.row_number().over(w) == 1).alias(FIRST))
    kept = [c for c in out.columns if c not in ("_carry", "_lag")
            and not (c == FIRST and lookahead <= 0)]
    return out.select(*kept, F.when(F.col(FIRST), F.col("_carry"))
                      .otherwise(F.col("_lag")).alias(out_col))


def _part_expr(kind: str, col: Column) -> Column:
    if kind == "count":
        return F.count(col)
    if kind == "sum":
        return F.sum(col)
    if kind == "sumsq":
        return F.sum(col * col)
    if kind == "max":
        return F.max(col)
    if kind == "min":
        return F.min(col)
    raise ValueError(f"unknown aggregate kind {kind!r}")


def _combine_expr(kind: str, col: Column) -> Column:
    """Aggregate of per-part partials (count -> sum of counts, ...)."""
    if kind in ("count", "sum", "sumsq"):
        return F.sum(col)
    if kind == "max":
        return F.max(col)
    return F.min(col)


def _merge(kind: str, parts: list[Column]) -> Column:
    if kind in ("count", "sum", "sumsq"):
        return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    if kind == "max":
        return F.greatest(*parts) if len(parts) > 1 else parts[0]
    return F.least(*parts) if len(parts) > 1 else parts[0]


def dyadic_nodes(bucket: Column, span: int) -> Column:
    """The nodes (level, node) that make up the buckets ``bucket - span + 1 .. bucket - 1``.

    Bottom-up over [lo, hi): a level gives its first node when that is a right
    child and its last one when that is a left child; the rest is whole nodes above.
    """
    nodes = []
    for level in range(max(span - 1, 1).bit_length()):
        width = 1 << level
        lo = F.ceil((bucket - (span - 1)) / F.lit(width)).cast("long")
        hi = F.floor(bucket / F.lit(width)).cast("long")
        some = lo < hi
        for odd, node in ((lo, lo), (hi, hi - 1)):
            nodes.append(F.when(some & (F.pmod(odd, F.lit(2)) == 1), F.struct(F.lit(level).alias("level"), node.alias("node"))))
    return F.filter(F.array(*nodes), lambda n: n.isNotNull())


def _dyadic_middle(df: DataFrame, mid_parts: dict, spans: dict, tname: dict) -> DataFrame:
    """Per (series, bucket): the middle of every frame, from the nodes of the dyadic tree."""
    sk = _series(df)
    by_node = [*sk, "level", "node"]
    totals = df.groupBy(*sk, BK).agg(*[_part_expr(kind, F.col(column)).alias(name) for (kind, column), name in {
        (k[0], k[1]): tname[k] for k in mid_parts}.items()])
    names = sorted(set(tname.values()))
    kinds = {tname[k]: k[0] for k in mid_parts}
    levels = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col(BK) / F.lit(1 << level)).cast("long").alias("node"))
                       for level in range((max(spans.values()) - 1).bit_length())])
    nodes = (totals.select(*sk, *names, F.explode(levels).alias("n")).select(*sk, "n.*", *names)
             .groupBy(*by_node).agg(*[_combine_expr(kinds[n], F.col(n)).alias(n) for n in names]))

    def nodes_of(span: int) -> Column:
        return F.transform(dyadic_nodes(F.col(BK), span), lambda n: F.struct(
            n["level"].alias("level"), n["node"].alias("node"), F.lit(span).alias("span")))

    wanted = F.concat(*[nodes_of(span) for span in sorted(set(spans.values()))])
    asked = totals.select(*sk, BK, F.explode(wanted).alias("n")).select(*sk, BK, "n.*")
    found = asked.join(nodes, by_node)
    return found.groupBy(*sk, BK).agg(*[
        _combine_expr(key[0], F.when(F.col("span") == spans[key], F.col(tname[key]))).alias(f"{p}_m")
        for key, p in mid_parts.items()])


def rolling(df: DataFrame, time_col: str, aggs: list[FrameAgg],
            width: int, order_cols=None, spread: bool = True) -> DataFrame:
    """Add one column per ``FrameAgg``; ``df`` carries series key and bucket.

    ``time_col`` must be integral seconds (a long); rows without a time stand
    in buckets of their own and their values mean nothing.
    ``order_cols`` is the order ``df`` is already partitioned and sorted in within a
    bucket (from ``with_previous``): prefixes and totals of buckets and seconds reuse it
    and add no sort. Without it ``df`` is dealt by bucket first. ``spread``: see ``_dealt``.
    """
    if order_cols is None:
        df = _dealt(df, _series(df) + [BK], spread, True)
    order_cols = list(order_cols or [time_col])
    frames = sorted({a.seconds for a in aggs})
    for f in frames:
        if f <= 0 or f % width:
            raise ValueError(f"frame {f}s is not a positive multiple of bucket {width}s")
    # every sum/sumsq needs the matching count for its SQL NULL rule
    parts: dict[tuple[str, str, int], str] = {}

    def part(kind, column, seconds):
        key = (kind, column, seconds)
        if key not in parts:
            parts[key] = f"_p{len(parts)}"
        return parts[key]

    for a in aggs:
        part(a.kind, a.column, a.seconds)
        if a.kind in ("sum", "sumsq"):
            part("count", a.column, a.seconds)

    roles = {f: i + 1 for i, f in enumerate(frames)}
    mid_role = len(frames) + 1
    sk = _series(df)
    part_cols = sk + [BK]
    spans = {key: key[2] // width for key in parts}
    mid_parts = {key: p for key, p in parts.items() if spans[key] > 1}
    # one column per (kind, column): the total that a row of the exchange stands for,
    # whatever the frame length
    tname = {key: f"_t_{key[0]}_{key[1]}" for key in parts}
    totals = {tname[key]: (key[0], key[1]) for key in parts}
    summaries = TG in df.columns
    payload = [c for c in df.columns if c not in (SK, BK, TG, FIRST)]

    middle = None
    if mid_parts and not summaries:
        middle = _dyadic_middle(df, mid_parts, {k: spans[k] for k in mid_parts}, {k: tname[k] for k in mid_parts})

    # -- prefix (ascending running aggregate) and totals of each bucket, then totals of
    #    each second: all on rows that are already partitioned and sorted by bucket and
    #    time, so no exchange and no sort
    asc = Window.partitionBy(*part_cols).orderBy(F.col(time_col))
    prefix = asc.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = asc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [_part_expr(kind, F.col(c)).over(prefix).alias(f"{t}_a") for t, (kind, c) in totals.items()]
    if summaries:
        cols += [_part_expr(totals[t][0], F.col(totals[t][1])).over(whole).alias(f"{t}_m") for t in sorted({tname[k] for k in mid_parts})]
        if FIRST not in df.columns:
            cols.append((F.row_number().over(Window.partitionBy(*part_cols).orderBy(*order_cols)) == 1).alias(FIRST))
    df = df.select("*", *cols)
    # rows of one second enter and leave a frame together: one of them carries them all
    in_order = order_cols[1:] or [time_col]
    second = Window.partitionBy(*part_cols, time_col).orderBy(*in_order)
    peers = second.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.select("*", *[_part_expr(kind, F.col(c)).over(peers).alias(f"{t}_d") for t, (kind, c) in totals.items()],
                   (F.row_number().over(second) == 1).alias("_leads"))

    # -- expansion: own row (role 0), for each second one shifted copy per frame length,
    #    and for each bucket its totals to the non-empty buckets whose middle it belongs
    #    to (at most span - 1 of them)
    def gen_struct(role, tb, okey, k):
        return F.struct(F.lit(role).alias("_role"), tb.alias("_tb"), okey.alias("_okey"),
                        F.lit(k).cast("long").alias("_k") if isinstance(k, int) else k.alias("_k"))

    own = F.array(gen_struct(0, F.col(BK), F.col(time_col), 0))
    copies = F.array(*[gen_struct(roles[f], F.col(BK) + F.lit(f // width), F.col(time_col) + F.lit(f), 0)
                       for f in frames])
    leads = F.col("_leads")
    gen_arr = F.when(leads, F.concat(own, copies)).otherwise(own)
    if summaries:
        summ = F.transform(F.col(TG), lambda t: gen_struct(
            mid_role, t, F.col(time_col), t - F.col(BK)))
        gen_arr = (F.when(F.col(FIRST) & leads, F.concat(own, copies, summ))
                   .when(F.col(FIRST), F.concat(own, summ)).otherwise(gen_arr))
    exploded = df.select("*", F.explode(gen_arr).alias("_g"))
    role = F.col("_g._role")
    cols = [F.col(c) for c in sk] + [
        F.col("_g._tb").alias(BK), role.alias("_role"), F.col("_g._okey").alias("_okey"),
        F.col("_g._k").alias("_k")]
    cols += [F.when(role == 0, F.col(c)).alias(c) for c in payload]
    for t in totals:
        carried = F.when(role == 0, F.col(f"{t}_a"))
        if f"{t}_m" in df.columns:
            carried = carried.when(role == mid_role, F.col(f"{t}_m"))
        cols.append(carried.when(role != mid_role, F.col(f"{t}_d")).alias(t))
    ex = _dealt(exploded.select(*cols), part_cols, spread)

    # -- suffix: descending running aggregate of the shifted copies; the middle, over the
    #    whole bucket, is on the same spec: same window operator, one sort
    back = Window.partitionBy(*part_cols).orderBy(F.col("_okey").desc())
    desc = back.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    every = back.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    win_cols = []
    for key, pname in parts.items():
        kind, _, seconds = key
        t = F.col(tname[key])
        win_cols.append(_combine_expr(kind, F.when(F.col("_role") == roles[seconds], t)).over(desc).alias(f"{pname}_d"))
        if summaries and key in mid_parts:
            inside = (F.col("_role") == mid_role) & (F.col("_k") <= spans[key] - 1)
            win_cols.append(_combine_expr(kind, F.when(inside, t)).over(every).alias(f"{pname}_m"))
    framed = ex.select("*", *win_cols).filter(F.col("_role") == 0)

    if middle is not None:
        framed = framed.join(middle, part_cols, "left")

    out = []
    for key, pname in parts.items():
        ps = [F.col(tname[key]), F.col(f"{pname}_d")]
        if key in mid_parts:
            ps.append(F.col(f"{pname}_m"))
        out.append(_merge(key[0], ps).alias(pname))
    merged = framed.select(*payload, *part_cols, *out)

    final = []
    for a in aggs:
        v = F.col(part(a.kind, a.column, a.seconds))
        if a.kind in ("sum", "sumsq"):
            n = F.col(part("count", a.column, a.seconds))
            v = F.when(n > 0, v)
        final.append(v.alias(a.name))
    return merged.select(*payload, *part_cols, *final)


def rolling_by_second(df: DataFrame, time_col: str, aggs: list[FrameAgg], width: int,
                      spread: bool = True) -> DataFrame:
    """``rolling`` for rows with blocks: all rows of a second share their frames.

    Totals per second of each block, combined to totals per second, go through
    ``rolling``; the results return to the rows by (bucket, block, second), so neither
    a crowded bucket nor a crowded second meets in one task. Rows without a time get
    NULL. The rows and the totals are each read more than once, so they are stored first.
    """
    sk = _series(df)
    df = keep(df, "block-rows")
    second = sk + [BK, time_col]
    totals = {key: f"_s{i}" for i, key in enumerate(dict.fromkeys((a.kind, a.column) for a in aggs))}
    pieces = keep(df.where(F.col(time_col).isNotNull()).groupBy(*second, BLK).agg(
        *[_part_expr(kind, F.col(column)).alias(name) for (kind, column), name in totals.items()]), "block-seconds")
    seconds = pieces.groupBy(*second).agg(
        *[_combine_expr(kind, F.col(name)).alias(name) for (kind, _), name in totals.items()])
    framed = rolling(seconds, time_col, [
        FrameAgg(a.name, a.kind if a.kind in ("max", "min") else "sum", totals[a.kind, a.column], a.seconds)
        for a in aggs], width, spread=spread)
    found = pieces.select(*second, BLK).join(framed.select(*second, *[a.name for a in aggs]), second)
    return df.join(found, [*second, BLK], "left").drop(BLK)
