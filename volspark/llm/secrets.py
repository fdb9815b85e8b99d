"""Secret scan: fixed patterns, plus Markov models of random and ordinary strings.

Base spans come from three patterns (kinds ``assign``, ``access``, ``hex``).
Outside of them, runs of token characters of at least ``MIN_TOKEN`` are compared
under two first-order character Markov models: one of random strings, trained
on what the base patterns capture, one of ordinary identifiers, trained on the
other runs of at least ``MIN_ORDINARY`` characters that look like ``IDENTIFIER``. Runs whose mean
log-likelihood ratio per transition reaches ``MIN_RATIO`` are spans of kind
``markov``.

Everything is DataFrame functions. Both models are counted over the whole
corpus; together they are one array of 128 x 128 log ratios, a scalar subquery
of the scoring pass, which is a projection: no join, no shuffle.

Matches are bracketed by a control character and the text is split at it, so
positions are running sums of lengths in code points, added up block by block so
that a text's cost is linear in its matches. (That character itself
is first replaced by another one; no pattern has either.)

Defined results: null text is an empty one (no spans); texts are scanned whole;
without base matches or without other tokens there are no models and the
method adds no span; repeated rows give repeated results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.llm.expressions import let
from volspark.session import keep

# fixed values: the base patterns
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")       # in the order of equal starts

# what an ordinary identifier looks like: words, maybe joined, maybe with a short number
IDENTIFIER = r"^[A-Za-z]+(?:[_-][A-Za-z]+)*[_-]?[0-9]{0,4}$"
# leftmost runs of the shortest accepted length match exactly the accepted runs
ACCESS_LONG = r"AKIA[A-Z0-9]{14,}"
HEX_LONG = r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
MIN_TOKEN = 16
MIN_ORDINARY = 12
MIN_RATIO = 0.5
SMOOTHING = 0.5
CODES = 128
BLOCK = 64              # values scanned, or gaps cut, together
LEVELS = 2              # of blocks: one block of the highest level covers BLOCK ** LEVELS values
MARK, OTHER = "\x01", "\x02"
REDACTED = "[secret]"


def _clean(text: Column) -> Column:
    return (F.when(text.contains(MARK), F.translate(text, MARK, OTHER))
            .otherwise(F.coalesce(text, F.lit(""))))


def _parts(text: Column, pattern: str) -> Column:
    """[outside, match, outside, match, ..., outside] of a cleaned text."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


def _assigned(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= MIN_ASSIGNED


def _accepted(kind: str, match: Column) -> Column:
    return _assigned(match) if kind == "assign" else F.lit(True)


def _blocks(values: Column, size: int) -> Column:
    """``values``, not empty, as arrays of ``size`` consecutive ones."""
    last = F.floor((F.size(values) - 1) / F.lit(size)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * size + 1, F.lit(size)))


def _before(values: Column, combine, zero: Column, levels: int = LEVELS) -> Column:
    """array<int>: ``combine`` over all earlier values, from ``zero``; linear in the number of values.

    Within a block the results grow one by one; the blocks' totals are scanned in
    the same way, so no array beyond a block's is copied for every value.
    """
    def grown(all_: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(all_, state, lambda s, v: F.struct(
            combine(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def by_block(all_: Column) -> Column:
        return let(_blocks(all_, BLOCK), lambda blocks: F.flatten(F.zip_with(
            blocks, _before(F.transform(blocks, lambda b: F.aggregate(b, zero, combine)), combine, zero, levels - 1),
            grown)))

    if levels == 0:
        return grown(values, zero)
    return let(values, lambda v: F.when(F.size(v) <= BLOCK, grown(v, zero)).otherwise(by_block(v)))


def _spans(parts: Column, kind: str, accepted) -> Column:
    """array<struct(start, rank, end)> of the accepted matches among ``parts``."""
    def found(p: Column, starts: Column) -> Column:
        spans = F.transform(p, lambda part, k: F.when((k % 2 == 1) & accepted(part), F.struct(
            F.get(starts, k).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            (F.get(starts, k) + F.length(part)).alias("end"))))
        return F.filter(spans, lambda s: s.isNotNull())

    return let(parts, lambda p: F.when(F.size(p) > 1, let(
        _before(F.transform(p, F.length), lambda at, n: at + n, F.lit(0)), lambda starts: found(p, starts)))
        .otherwise(F.array().cast("array<struct<start:int,rank:int,end:int>>")))


def _masked(text: Column, pattern: str, kind: str) -> Column:
    """``text`` with each accepted match replaced by as many spaces."""
    def blanked(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p, k: F.when(
            (k % 2 == 1) & _accepted(kind, p), F.repeat(F.lit(" "), F.length(p))).otherwise(p)), "")

    return let(text, lambda t: let(_parts(t, pattern), lambda parts: F.when(
        F.size(parts) > 1, blanked(parts)).otherwise(t)))


def _outside(text: Column) -> Column:
    """A cleaned text with all base matches blanked."""
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS_LONG), ("hex", HEX_LONG)):
        text = _masked(text, pattern, kind)
    return text


def _tokens(text: Column, length: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([A-Za-z0-9+/_=-]{{{length},}})"), 1)


def _transitions(token: Column, value) -> Column:
    """array of value(code of a character * 128 + code of the next)."""
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return let(codes, lambda all_: F.zip_with(
        F.slice(all_, 1, F.greatest(F.size(all_) - 1, F.lit(0))),
        F.slice(all_, 2, F.greatest(F.size(all_) - 1, F.lit(0))),
        lambda a, b: value(a * CODES + b)))


def train(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row (ratios): log ratios of all transitions, random over ordinary; null without samples.

    Counted over all documents; transitions are combined within each task, so
    at most 128 x 128 x 2 counts per task are shuffled.
    """
    text = _clean(F.col(text_col))
    values = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), 2), lambda v: F.length(v) >= MIN_ASSIGNED),
        F.regexp_extract_all(text, F.lit(f"({ACCESS_LONG})"), 1),
        F.regexp_extract_all(text, F.lit(f"({HEX_LONG})"), 1))
    samples = docs.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), values.alias("tokens")),
        F.struct(F.lit(0).alias("random"), F.filter(
            _tokens(_outside(text), MIN_ORDINARY), lambda t: t.rlike(IDENTIFIER)).alias("tokens")))
    ).alias("s")).select("s.random", F.explode("s.tokens").alias("token"))
    counts = (samples.select("random", F.explode(_transitions(F.col("token"), lambda c: c)).alias("code"))
              .groupBy("random", "code").count().groupBy("code").pivot("random", [0, 1])
              .agg(F.sum("count")).toDF("code", "ordinary", "random"))
    # every transition, with the sum of its first character, in one ordered array
    codes = docs.sparkSession.range(CODES * CODES).select(F.col("id").cast("int").alias("code"))
    full = codes.join(counts, "code", "left").na.fill(0, ["ordinary", "random"])
    first = F.floor(F.col("code") / CODES)
    sums = full.groupBy(first.alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("code", "ordinary", "random"))).alias("cells"),
        F.sum("ordinary").alias("n0"), F.sum("random").alias("n1"))
    smooth = lambda n, total: F.log((n + SMOOTHING) / (total + SMOOTHING * CODES))      # noqa: E731
    rows = sums.select("first", "n0", "n1", F.transform(
        "cells", lambda c: smooth(c["random"], F.col("n1")) - smooth(c["ordinary"], F.col("n0"))).alias("row"))
    return rows.agg(F.sort_array(F.collect_list(F.struct("first", "row"))).alias("rows"),
                    F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).select(
        F.when((F.col("n0") > 0) & (F.col("n1") > 0), F.flatten(F.transform("rows", lambda r: r["row"])))
        .alias("ratios"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, base, added) of every document: arrays of struct(start, rank, end), by position.

    ``rank`` is the kind's place in ``KINDS``; positions are code points, end
    exclusive. ``added`` has the spans of the Markov models.
    """
    ratios = keep(train(docs, text_col), "secret-ratios").scalar()      # 16,384 numbers
    rows = docs.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"carry_{c}") for c in carry],
                       _clean(F.col(text_col)).alias("t"), ratios.alias("ratios"))
    base = F.array_sort(F.concat(*[
        _spans(_parts(F.col("t"), pattern), kind, lambda m, kind=kind: _accepted(kind, m))
        for kind, pattern in (("assign", ASSIGN), ("access", ACCESS_LONG), ("hex", HEX_LONG))]))

    def unlikely(token: Column) -> Column:
        total = F.aggregate(_transitions(token, lambda code: F.get(F.col("ratios"), code)),
                            F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(total / (F.length(token) - 1) >= MIN_RATIO, F.lit(False))

    token = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    added = F.when(F.col("t").rlike(token), _spans(_parts(_outside(F.col("t")), token), "markov", unlikely))
    return rows.select("id", *[F.col(f"carry_{c}").alias(c) for c in carry], base.alias("base"),
                       F.coalesce(added, none).alias("added"))


def count(spans: Column, kind: str) -> Column:
    """Number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the given order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _cut(text: Column, first: Column, gaps: Column, levels: int = LEVELS) -> Column:
    """The pieces of ``text``, which starts at ``first``, at ``gaps``: ascending, disjoint struct(at, start).

    A block of gaps is cut from a stretch of the text that ends with it, so finding
    a position does not pass the whole text for every gap.
    """
    if levels == 0:
        return F.transform(gaps, lambda g: F.substring(text, g["at"] - first + 1, g["start"] - g["at"]))

    def inside(block: Column) -> Column:
        begin = F.get(block, F.lit(0))["at"]
        stretch = F.substring(text, begin - first + 1, F.get(block, F.size(block) - 1)["start"] - begin)
        return let(stretch, lambda t: _cut(t, begin, block, levels - 1))

    return F.flatten(F.transform(_blocks(gaps, BLOCK ** levels), inside))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span (sorted by start, overlaps merge) replaced by a marker."""
    def replaced(all_: Column, before: Column) -> Column:
        gaps = F.filter(F.transform(all_, lambda s, k: F.struct(F.get(before, k).alias("at"), s["start"].alias("start"))),
                        lambda g: g["start"] >= g["at"])
        outside = let(gaps, lambda g: _cut(text, F.lit(0), g))
        end = F.array_max(F.transform(all_, lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(outside, lambda piece: F.concat(piece, F.lit(REDACTED))), ""),
                        F.substring(text, end + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(spans, lambda all_: let(
        _before(F.transform(all_, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0)),
        lambda before: replaced(all_, before)))).otherwise(text)
