"""Benchmark decontamination with an FM-index per training shard.

Words: A-Z in lower case, then runs of characters that are not ASCII
punctuation, white space or controls. Phrases: every ``window`` consecutive
words of a benchmark item, the whole item when it has fewer.

A task cuts its documents into shards of about ``SHARD_CHARS`` characters (a
longer document is a shard of its own) and builds for each an FM-index over
its words: suffix array by prefix doubling, Burrows-Wheeler transform in a
wavelet matrix with packed bits and block counts, and sampled suffix
positions. Words that no phrase has cannot be part of an occurrence, so a
stretch of them is one separator; separators are distinct and end the sorting
depth. All phrases are searched backwards at once, occurrences are located by
walking to the next sample, and overlapping ones merge to removal spans.

The phrases are broadcast in blocks of at most ``block_words`` benchmark words;
with more blocks the documents pass through one index search per block, in the
same narrow stage. Documents are never shuffled.

Defined results: null text has no words; an item without words has no phrase;
items may repeat or share phrases (each is reported); items without an id are
searched like any other and reported together as one null; no benchmark leaves every
document clean; repeated documents give repeated results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = 10
SHARD_CHARS = 4_000_000
SAMPLE_EVERY = 16
BLOCK_WORDS = 2_000_000
NO_ID = -(1 << 63)                  # stands for a missing item id in a scan
# bytes of a word stay (A-Z in lower case), all others become spaces
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7a
                   else b + 32 if 0x41 <= b <= 0x5a else 0x20 for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Phrases:
    """Distinct phrases of a block of items over a vocabulary 1..V."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[int]] = {}
        for item, text in items:
            words = split_words(text)
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[at:at + window]), set()).add(item)
        phrases = sorted(owners)
        vocabulary = sorted({w for p in phrases for w in p})
        self.vocabulary = {w: k + 1 for k, w in enumerate(vocabulary)}
        self.size = len(vocabulary)
        self.lengths = np.array([len(p) for p in phrases], np.int64)
        self.words = np.zeros((len(phrases), window), np.int64)      # last word in the last column
        for k, p in enumerate(phrases):
            self.words[k, window - len(p):] = [self.vocabulary[w] for w in p]
        lists = [sorted(owners[p]) for p in phrases]
        self.owners = np.array([i for own in lists for i in own], np.int64)
        self.owner_from = np.cumsum([0] + [len(own) for own in lists])


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order of ``symbols``: zeros are distinct separators in text order, the last is one."""
    n = len(symbols)
    zero = symbols == 0
    first = symbols + (n + 1)
    first[zero] = np.arange(int(zero.sum()))
    order = np.argsort(first, kind="stable")
    ordered = first[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[start, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, sizes)
    active = order[np.repeat(sizes, sizes) > 1]        # suffixes that share their rank, by rank
    depth = 1
    while len(active):
        key = rank[active] * (n + 1) + rank[active + depth]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old = key // (n + 1)
        index = np.arange(len(active))
        head = np.r_[True, old[1:] != old[:-1]]
        group = index[head][np.cumsum(head) - 1]       # where the old group starts
        split = np.r_[True, key[1:] != key[:-1]]
        part = index[split][np.cumsum(split) - 1]      # where the new group starts
        rank[active] = old + (part - group)
        sizes = np.diff(np.r_[index[split], len(active)])
        active = active[np.repeat(sizes, sizes) > 1]
        depth *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class WaveletMatrix:
    """Rank and access over integers below 2 ** levels: one packed bit row per level."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.rows, self.blocks, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level & 1).astype(np.bool_)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            self.rows.append(packed)
            self.blocks.append(np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.zeros.append(len(values) - int(bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        self.origin = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before position ``at`` of a level."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        low = (np.uint64(1) << rest) - np.uint64(1)
        return self.blocks[level][word] + np.bitwise_count(self.rows[level][word] & low)

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones = self._ones(level, at)
            bit = symbols >> (self.levels - 1 - level) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position ``at``."""
        return self._walk(symbols, at) - self.origin[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        symbols = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            ones = self._ones(level, at)
            bit = (self.rows[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            symbols = symbols << 1 | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return symbols, at - self.origin[symbols]


class FMIndex:
    """Backward search and location over one shard's symbols (0: separator)."""

    def __init__(self, symbols: np.ndarray, top: int, every: int = SAMPLE_EVERY):
        order = suffix_array(symbols)
        last = symbols[order - 1]                     # symbol before each suffix
        last[order == 0] = 0
        self.before = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        self.tree = WaveletMatrix(last, top)
        # samples: every few positions, and suffixes that follow a separator
        sampled = (order % every == 0) | (last == 0)
        self.sampled = WaveletMatrix(sampled.astype(np.int64), 1)
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases whose last word is in the last column."""
        last = phrases[:, -1]
        low, high = self.before[last].copy(), self.before[last + 1].copy()
        for back in range(2, phrases.shape[1] + 1):
            going = np.flatnonzero((high > low) & (lengths >= back))
            if not len(going):
                break
            symbol = phrases[going, -back]
            low[going] = self.before[symbol] + self.tree.rank(symbol, low[going])
            high[going] = self.before[symbol] + self.tree.rank(symbol, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to the next sample."""
        found = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows, 0
        while len(left):
            sampled, rank = self.sampled.access(at)
            done = sampled == 1
            found[left[done]] = self.positions[rank[done]] + steps
            left, at = left[~done], at[~done]
            symbol, rank = self.tree.access(at)
            at = self.before[symbol] + rank
            steps += 1
        return found


def scan_shard(texts: list[str | None], phrases: Phrases) -> list[tuple[int, list[int], list[int]]]:
    """(words, merged spans as start, end, start, end ..., item ids) of each text."""
    get = phrases.vocabulary.get
    pieces, counts = [], []
    for text in texts:
        words = split_words(text)
        counts.append(len(words))
        pieces.append(np.array([get(w, 0) for w in words] + [0], np.int64))
    starts = np.cumsum([0] + [c + 1 for c in counts])
    out: list[tuple[int, list[int], list[int]]] = [(c, [], []) for c in counts]
    full = np.concatenate(pieces) if pieces else np.empty(0, np.int64)
    known = full > 0
    if not known.any():
        return out
    # a stretch of unknown words is one separator; the last symbol of a shard is one
    kept = known | np.r_[False, known[:-1]]
    place = np.flatnonzero(kept)
    index = FMIndex(full[kept], phrases.size)
    low, high = index.search(phrases.words, phrases.lengths)
    which = np.flatnonzero(high > low)
    if not len(which):
        return out
    times = (high - low)[which]
    rows = np.repeat(low[which] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
    which = np.repeat(which, times)
    at = place[index.locate(rows)]
    # removal spans: overlapping or adjacent occurrences merge; they never cross a document's end
    edge = np.zeros(len(full) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + phrases.lengths[which], -1)
    hit = np.r_[False, np.cumsum(edge[:-1]) > 0, False]
    change = np.flatnonzero(hit[1:] != hit[:-1])
    for start, end in zip(change[::2].tolist(), change[1::2].tolist()):
        doc = int(np.searchsorted(starts, start, side="right")) - 1
        out[doc][1].extend([start - int(starts[doc]), end - int(starts[doc])])
    # items of each document, by the phrases' owners
    owners = phrases.owner_from[which + 1] - phrases.owner_from[which]
    doc = np.repeat(np.searchsorted(starts, at, side="right") - 1, owners)
    first = np.repeat(phrases.owner_from[which] - np.r_[0, np.cumsum(owners)[:-1]], owners)
    item = phrases.owners[first + np.arange(owners.sum())]
    for d, i in np.unique(np.stack([doc, item], axis=1), axis=0).tolist():
        out[d][2].append(i)
    return out


def _merge(old: list[int], new: list[int]) -> list[int]:
    """Union of two flat span lists."""
    spans = sorted(zip(old[::2] + new[::2], old[1::2] + new[1::2]))
    out: list[int] = []
    for start, end in spans:
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def phrase_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark's phrases, in blocks of at most about ``block_words`` words."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(NO_ID)).alias("item"),
                             F.col(text_col).alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // (6 * block_words)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield Phrases([(r.item, r.text) for r in part.collect()], window)


def found_in(text: Column, blocks: Iterator[Phrases], spark: SparkSession,
             shard_chars: int = SHARD_CHARS) -> Column:
    """struct(n_words, spans, items) of a text column; narrow, so that rows need no join to be judged.

    ``spans``: word positions start, end (exclusive), start, end, ...;
    ``items``: ascending ids of the items with an occurring phrase, ``NO_ID`` for those without one.
    """
    none = F.array().cast("array<long>")
    found = F.struct(F.lit(0).cast("long").alias("n_words"), none.alias("spans"), none.alias("items"))
    for phrases in blocks:
        found = _scanner(spark, phrases, shard_chars)(text, found["spans"], found["items"])
    return found


def _scanner(spark: SparkSession, phrases: Phrases, shard_chars: int):
    shared = spark.sparkContext.broadcast(vars(phrases))        # at most a block of phrases

    @F.pandas_udf("n_words long, spans array<long>, items array<long>")
    def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = Phrases([])
        vars(own).update(shared.value)
        for texts, spans, items in batches:
            results = [r for shard in _shards(texts.tolist(), shard_chars) for r in scan_shard(shard, own)]
            yield pd.DataFrame({
                "n_words": [r[0] for r in results],
                "spans": [_merge(a.tolist(), r[1]) for a, r in zip(spans, results)],
                "items": [sorted({*a.tolist(), *r[2]}) for a, r in zip(items, results)]})

    return scan


def _shards(texts: list[str | None], shard_chars: int) -> Iterator[list[str | None]]:
    shard, total = [], 0
    for text in texts:
        if shard and total + len(text or "") > shard_chars:
            yield shard
            shard, total = [], 0
        shard.append(text)
        total += len(text or "")
    if shard:
        yield shard


def hit_words(spans: Column) -> Column:
    """Number of words inside the removal spans."""
    return F.aggregate(F.transform(spans, lambda x, k: F.when(k % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_hit, spans, items) of every document."""
    found = found_in(F.col(text_col), phrase_blocks(benchmark, window=window), docs.sparkSession)
    return (docs.select(F.col(id_col).alias("id"), found.alias("found")).select("id", "found.*")
            .select("id", "n_words", hit_words(F.col("spans")).alias("n_hit"), "spans",
                    F.transform("items", lambda i: F.when(i != NO_ID, i)).alias("items")))
