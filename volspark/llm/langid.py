"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its
labelled text. A text is parsed greedily into the longest phrases that occur in
that sample; few phrases mean that the text is well described by the language.
The estimate ``phrases * log2(sample length) / letters`` is comparable between
languages, the lowest wins.

Normal form of a text: letters in lower case, every run of other characters as
one space. Texts are parsed in blocks of ``BLOCK`` characters (a phrase never
crosses a block end), so memory per text is bounded and all blocks of a batch
advance together; every character of every text is parsed.

Training sample (documented bound): per language the documents with the
smallest hashes of their id until ``sample_chars`` characters; only documents
that :func:`trainable` accepts are read. Every character of the samples has a
symbol of its own. Automata are at most ``2 * sample_chars`` states by
``ALPHABET`` columns, whatever the corpus size: the language's most frequent
characters have a column each, edges of its other ones are a sorted list.

Defined results: null text or text without a letter gives ``und`` with score 0;
documents without a label train nothing; without any labelled text every
document is ``und``; ties go to the alphabetically first language; repeated
rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLE_CHARS = 30_000
ALPHABET = 64            # columns of a language's table: 0 = any character without a column
BLOCK = 1024
LANES = 4096             # blocks that advance together
SALTS, MOST_OF_A_SALT = 1024, 4      # candidates for the sample, per language
UNDETERMINED = "und"
NON_LETTERS = regex.compile(r"\P{L}+")


def trainable(id_col: str = "doc_id") -> Column:
    """Documents that may train: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def normal_form(text: str | None) -> str:
    """Lower-case letters with single spaces between words."""
    return NON_LETTERS.sub(" ", text or "").strip().lower()


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    goto: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(goto)
        goto.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in goto[p]:
            goto[p][c] = new
            p = link[p]
        if p >= 0:
            q = goto[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(goto)
                goto.append(dict(goto[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and goto[p].get(c) == q:
                    goto[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return goto


def _sorted(found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their values."""
    keys = np.array(sorted(found), np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], np.int32)


class Model:
    """The languages' automata as one table: next state * 2 + (a new phrase starts here).

    Symbols are numbered over all samples, 0 is any character in none of them.
    Each language's ``ALPHABET - 1`` most frequent ones have a column in its
    table. Its others are ``far``: their edges are sorted keys state * symbols +
    symbol, searched only where such a symbol occurs.

    The last state of each language stands before a phrase: whatever follows
    starts one. A character that the language never saw is a phrase of its own.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(k for k, v in samples.items() if v)
        texts = [samples[k] for k in self.languages]
        letters = sorted(set().union(*texts))
        self.points = np.array([ord(c) for c in letters], np.uint32)        # of symbols 1, 2, ...
        symbols = {c: k + 1 for k, c in enumerate(letters)}
        self.size = len(letters) + 1
        tables, starts, base = [], [], 0
        self.columns, self.far = [], []
        for text in texts:
            goto = suffix_automaton(text)
            often = Counter(text)
            shown = sorted(often, key=lambda c: (-often[c], c))[:ALPHABET - 1]
            column = {c: k + 1 for k, c in enumerate(shown)}
            columns = np.zeros(self.size, np.uint8)
            for c, k in column.items():
                columns[symbols[c]] = k
            table = np.empty((len(goto) + 1, ALPHABET), np.int32)
            before = base + len(goto)
            # no continuation: the symbol starts the next phrase
            restart = np.full(ALPHABET, before * 2 + 1, np.int32)
            for c, q in goto[0].items():
                if c in column:
                    restart[column[c]] = (base + q) * 2 + 1
            edges_of_far, restarts_of_far = {}, {}
            for state, edges in enumerate(goto):
                table[state] = restart
                for c, q in edges.items():
                    if c in column:
                        table[state, column[c]] = (base + q) * 2
                    else:
                        edges_of_far[(base + state) * self.size + symbols[c]] = (base + q) * 2
                        if state == 0:
                            restarts_of_far[symbols[c]] = (base + q) * 2 + 1
            table[-1] = restart
            tables.append(table)
            starts.append(before)
            base += len(table)
            self.columns.append(columns)
            self.far.append((*_sorted(edges_of_far), *_sorted(restarts_of_far)))
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        self.starts = np.array(starts, np.int64)
        self.bits = np.log2([max(2, len(t)) for t in texts]) if texts else np.empty(0)
        self.code = np.zeros(0x250, np.int32)              # symbol of each frequent code point
        for c, k in symbols.items():
            if ord(c) < 0x250:
                self.code[ord(c)] = k

    def encode(self, text: str) -> np.ndarray:
        """Symbols of a text in normal form."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.code[np.minimum(points, 0x24f)]
        far = np.flatnonzero(points >= 0x250)
        if len(far):
            out[far] = 0
            if len(self.points):
                at = np.minimum(np.searchsorted(self.points, points[far]), len(self.points) - 1)
                out[far] = np.where(self.points[at] == points[far], at + 1, 0)
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        owners, blocks = [], []
        for k, text in enumerate(texts):
            symbols = self.encode(text)
            for at in range(0, len(symbols), BLOCK):
                owners.append(k)
                blocks.append(symbols[at:at + BLOCK])
        order = sorted(range(len(blocks)), key=lambda b: -len(blocks[b]))
        for at in range(0, len(order), LANES):
            picked = order[at:at + LANES]
            sizes = np.array([len(blocks[b]) for b in picked])
            grid = np.zeros((int(sizes[0]), len(picked)), np.int32)
            for lane, b in enumerate(picked):
                grid[:sizes[lane], lane] = blocks[b]
            # lanes are sorted by length: at step t the first alive[t] of them go on
            alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
            for j, start in enumerate(self.starts):
                state = np.full(len(picked), start, np.int64)
                begun = np.zeros(len(picked), np.int64)
                columns = self.columns[j][grid]
                keys, nexts, firsts, restarts = self.far[j]
                is_far = np.zeros(self.size, np.bool_)
                is_far[firsts] = True
                rare = is_far[grid] if len(firsts) else None
                some = rare.any(axis=1) if len(firsts) else np.zeros(len(grid), np.bool_)
                for t, n in enumerate(alive):
                    step = self.table[state[:n] * ALPHABET + columns[t, :n]]
                    if some[t]:
                        lanes = np.flatnonzero(rare[t, :n])
                        symbols = grid[t, lanes]
                        wanted = state[lanes] * self.size + symbols
                        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                        step[lanes] = np.where(keys[at] == wanted, nexts[at],
                                               restarts[np.searchsorted(firsts, symbols)])
                    begun[:n] += step & 1
                    state[:n] = step >> 1
                np.add.at(counts[:, j], np.array(owners)[picked], begun)
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and confidence (0 to 1) of each text."""
        normal = [normal_form(t) for t in texts]
        languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [k for k, t in enumerate(normal) if t]
        if not self.languages or not known:
            return languages, scores
        counts = self.phrases([normal[k] for k in known])
        sizes = np.array([len(normal[k]) for k in known])
        entropy = counts * self.bits / sizes[:, None]
        best = entropy.argmin(axis=1)
        # share of the winner when each bit per letter halves a language's weight
        weight = np.exp2(entropy.min(axis=1)[:, None] - entropy)
        share = weight.max(axis=1) / weight.sum(axis=1)
        for k, b, s in zip(known, best, share):
            languages[k], scores[k] = self.languages[b], float(s)
        return languages, scores


def training_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Per language at most ``sample_chars`` characters of labelled text, in normal form."""
    share = sample_chars // 10          # of one document, so that a long text is not the whole sample
    rows = (docs.where(trainable(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                    F.least(F.length(text_col), F.lit(share)).alias("n"))
            .withColumn("h", F.xxhash64("id")))
    # ids first: per language and salt (ranked within each task before the shuffle), then per language
    rows = (rows.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)))
            .withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy("h", "id")))
            .where(F.col("k") <= MOST_OF_A_SALT)
            .withColumn("before", F.sum("n").over(Window.partitionBy("lang").orderBy("h", "id", "k")
                                                  .rowsBetween(Window.unboundedPreceding, -1)))
            .where(F.coalesce("before", F.lit(0)) < sample_chars))
    chosen = rows.select("id", "lang", "h").distinct()                  # at most 4,096 rows per language
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                        F.substring(text_col, 1, share).alias("text"))
    found = (texts.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "h", "id")
             .agg(F.min("text").alias("text")).select("lang", "h", "id", "text").collect())
    samples: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r.lang, r.h, r.id)):
        samples.setdefault(row.lang, []).append(normal_form(row.text))
    return {k: " ".join(v)[:sample_chars] for k, v in samples.items()}


def language_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """struct(lang_pred, score) of a text column; narrow, so that rows need no join to be judged."""
    shared = spark.sparkContext.broadcast(vars(model))       # bounded, see the module docstring

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model({})
        vars(own).update(shared.value)
        for texts in batches:
            found = [own.predict(texts.iloc[at:at + 2000].tolist()) for at in range(0, len(texts), 2000)]
            yield pd.DataFrame({"lang_pred": [x for names, _ in found for x in names],
                                "score": [x for _, scores in found for x in scores]})

    return judge(text)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every document."""
    found = language_of(F.col(text_col), model, docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), found.alias("found")).select("id", "found.*")
