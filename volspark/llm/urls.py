"""URL filter: rules first, then a character language-model ratio.

A rule (host and path prefix) fits its host and all subdomains; the longest
rule wins. URLs without a rule are judged by two variable-order Markov models
over the characters of host and path, one of URLs that the rules accept, one of
those they reject:

* a character is predicted from the longest of its up to ``ORDER`` preceding
  characters that training saw at least ``MIN_CONTEXT`` times in that place;
  probabilities are smoothed order by order towards the next shorter context
  (Dirichlet prior of weight ``PRIOR``, a uniform distribution at the end);
* a URL's score is the log-likelihood difference over its length;
* the threshold is the point of least balanced error on URLs that were kept out
  of training (every fifth distinct one, by hash), among steps of ``1 / BINS``.

Everything is DataFrame functions. Counts cover every distinct rule-labelled
URL but the fifth that calibrates the threshold. The trained table is keyed by the n-grams themselves and grows with them;
it is met by shuffled joins: what a position adds to a score depends on its
last ``ORDER + 1`` characters alone, so the distinct ones of the URLs to be
judged look up their n-grams, and each URL then adds up its positions.

Defined results: a null url, or one without ``://``, has an empty host and path
and score 0, like any URL without characters; repeated rows give repeated
results; without URLs of both labels every score is 0 and the threshold is 0
(so allow); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volspark.llm.expressions import let
from volspark.session import keep

# fixed values: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

ORDER = 4               # longest context
MIN_CONTEXT = 4
PRIOR = 4.0
SYMBOLS = 128.0         # the uniform distribution below the shortest context
HELD_OUT = 5
BINS, MOST = 100, 20    # threshold steps per unit, largest threshold
START = "\x02"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for own, prefix, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def _characters(text: Column) -> Column:
    """The start mark and the characters of a text."""
    return F.concat(F.array(F.lit(START)), F.filter(F.split(text, ""), lambda c: c != ""))


def _gram(chars: Column, end: Column, length: Column) -> Column:
    """``length`` characters up to position ``end`` (from 1)."""
    return F.array_join(F.slice(chars, end - length + 1, length), "")


def grams(texts: DataFrame) -> DataFrame:
    """(gram, accepted, rejected): counts over ``texts`` (text, allowed), all lengths 1..ORDER + 1."""
    def all_grams(chars: Column) -> Column:
        ends = F.sequence(F.lit(2), F.size(chars))
        return F.flatten(F.transform(ends, lambda end: F.transform(
            F.sequence(F.lit(1), F.least(end, F.lit(ORDER + 1))), lambda n: _gram(chars, end, n))))

    made = let(_characters(F.col("text")), all_grams)
    return (texts.where("text <> ''").select("allowed", F.explode(made).alias("gram"))
            .groupBy("gram").agg(F.count_if("allowed").alias("accepted"),
                                 F.count_if(~F.col("allowed")).alias("rejected")))


def train(texts: DataFrame) -> DataFrame:
    """(kind, key, d): log ratios by n-gram, stored; a key occurs at most once in each kind.

    ``gram``: log P(last character | the others), accepted over rejected, absent
    where training has no such gram (or its context is too rare); ``context``:
    the ratio of the weights that a context leaves to shorter ones.
    """
    counted = keep(grams(texts).withColumn("n", F.length("gram")), "url-grams")
    around = Window.partitionBy("n", "context")
    counted = counted.withColumn("context", F.expr("substring(gram, 1, n - 1)")).select(
        "gram", "n", "context", "accepted", "rejected",
        F.sum("accepted").over(around).alias("a"), F.sum("rejected").over(around).alias("r"))
    known = counted.where((F.col("n") == 1) | (F.col("a") + F.col("r") >= MIN_CONTEXT))
    known = keep(known, "url-known")

    def smooth(hits: str, total: str, lower: Column) -> Column:
        return (F.col(hits) + PRIOR * lower) / (F.col(total) + PRIOR)

    levels = []
    for n in range(1, ORDER + 2):
        own = known.where(F.col("n") == n)
        if n == 1:
            level = own.withColumn("la", F.lit(1 / SYMBOLS)).withColumn("lr", F.lit(1 / SYMBOLS))
        else:
            below = levels[-1].select(F.col("gram").alias("shorter"), F.col("pa").alias("la"), F.col("pr").alias("lr"))
            level = own.withColumn("shorter", F.expr("substring(gram, 2)")).join(below, "shorter")
        levels.append(level.select("gram", "context", "accepted", "rejected", "a", "r",
                                   smooth("accepted", "a", F.col("la")).alias("pa"),
                                   smooth("rejected", "r", F.col("lr")).alias("pr")))
    found = reduce(DataFrame.union, levels)
    by_gram = found.select(F.lit("gram").alias("kind"), F.col("gram").alias("key"),
                           F.log(F.col("pa") / F.col("pr")).alias("d"))
    by_context = known.where("n > 1").groupBy("context").agg(F.max("a").alias("a"), F.max("r").alias("r")).select(
        F.lit("context").alias("kind"), F.col("context").alias("key"),
        F.log((F.col("r") + PRIOR) / (F.col("a") + PRIOR)).alias("d"))
    return keep(by_gram.union(by_context), "url-model")


def windows(texts: DataFrame) -> DataFrame:
    """(t, window) per position of ``texts`` (t, text): its up to ORDER + 1 last characters."""
    def all_windows(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.size(chars)),
                           lambda end: _gram(chars, end, F.least(end, F.lit(ORDER + 1))))

    return texts.select("t", F.explode(let(_characters(F.col("text")), all_windows)).alias("window"))


def window_values(found: DataFrame, model: DataFrame) -> DataFrame:
    """(window, value): what a position adds to the score, absent where the model knows nothing of it.

    From the longest gram down: the first known one counts, and the known
    contexts of the longer ones are paid for. ``found``: distinct windows.
    """
    size = F.length("window")

    def key(kind: str, n: Column, length: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), n.alias("n"),
                        F.substring("window", size - n + 1, length).alias("key"))

    lengths = F.sequence(F.lit(1), size)
    keys = F.concat(F.transform(lengths, lambda n: key("gram", n, n)),
                    F.transform(F.filter(lengths, lambda n: n > 1), lambda n: key("context", n, n - 1)))
    met = found.select("window", F.explode(keys).alias("e")).select("window", "e.*").join(model, ["kind", "key"])
    gram = F.col("kind") == "gram"
    each = met.groupBy("window").agg(
        F.max(F.when(gram, F.struct("n", "d"))).alias("own"),
        F.collect_list(F.when(~gram, F.struct("n", "d"))).alias("left"))                      # at most ORDER
    paid = F.filter("left", lambda x: x["n"] > F.coalesce(F.col("own.n"), F.lit(0)))
    return each.select("window", F.aggregate(F.array_sort(paid), F.coalesce("own.d", F.lit(0.0)),
                                             lambda a, x: a + x["d"]).alias("value"))


def with_score(texts: DataFrame, model: DataFrame) -> DataFrame:
    """``texts`` with the ``score`` of column ``text`` under a trained ``model``.

    Length-normalised log-likelihood difference; 0 when the text is empty.
    """
    # stored, so that the numbers stay and Spark can split the joins on frequent windows
    own = keep(texts.select("text").where("text <> ''").distinct()
               .withColumn("t", F.monotonically_increasing_id()), "url-texts")
    cells = keep(windows(own), "url-windows")
    values = keep(window_values(keep(cells.select("window").distinct(), "url-window-keys"), model), "url-window-values")
    # decimal sums do not depend on the order of their terms
    sums = cells.join(values, "window", "left").groupBy("t").agg(
        (F.sum(F.coalesce("value", F.lit(0.0)).cast("decimal(24,15)")).cast("double") / F.count("*")).alias("score"))
    scores = keep(own.join(sums, "t").select("text", "score"), "url-scores")
    return texts.join(scores, "text", "left").select(*texts.columns, F.coalesce("score", F.lit(0.0)).alias("score"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score): ``rule`` null and the method's verdict without a rule."""
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("text", F.concat("host", "path"))
    labelled = keep(rows.where("found is not null").select(
        "text", (F.col("found.verdict") == "allow").alias("allowed")).distinct(), "url-labels")
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    both = labelled.where(~held).agg(F.count_distinct("allowed")).first()[0] == 2
    if both:
        model = train(labelled.where(~held))
        threshold = calibrate(with_score(labelled.where(held), model))
        rows = with_score(rows, model)
    else:
        threshold, rows = 0.0, rows.withColumn("score", F.lit(0.0))
    return rows.select("id", "host", "path", "found.rule", F.coalesce("found.verdict", F.when(
        F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score")


def calibrate(scored: DataFrame) -> float:
    """The threshold of least balanced error over (allowed, score); 0 without both labels."""
    step = F.least(F.greatest(F.floor(F.col("score") * BINS), F.lit(-MOST * BINS)), F.lit(MOST * BINS))
    bins = scored.groupBy(step.alias("bin")).agg(
        F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("r"))     # 2 * MOST * BINS rows
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # threshold at a bin's lower edge: accepted ones below it and rejected ones from it on are errors
    errors = bins.select(
        "bin", (F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(whole)
                + 1 - F.coalesce(F.sum("r").over(below), F.lit(0)) / F.sum("r").over(whole)).alias("error"))
    best = errors.where("error is not null").orderBy("error", F.abs("bin"), "bin").first()
    return best.bin / BINS if best else 0.0
