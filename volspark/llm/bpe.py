"""Byte-level BPE encoding and decoding with a rank file.

A text is cut by the vocabulary's split pattern. Pieces that are tokens stand
for themselves. All other new pieces of a step are merged together: they are
bucketed by length, each bucket is a padded matrix of token numbers, and every
row merges its leftmost minimum-rank pair each round. The rank of a pair comes
from a hashed table of all pairs whose joined bytes are a token; only the two
pairs beside a merge are looked up again, and the row closes up by one column
(every unfinished row loses exactly one token a round, so the matrix narrows).

Pieces of more than ``LONG`` bytes are rows of their own. A round there makes
all merges that the leftmost rule would make one after another before a lower
rank appears: the pairs of the least rank from left to right, up to the first
one that forms a pair of lower rank. Rounds then follow the ranks in use, not
the length of the row.

Tasks keep the ids of short pieces in a bounded cache. Texts are cut in
stretches of ``STRETCH`` characters that end where a piece ends, so memory
beyond the text and its ids does not follow the length of a text.

Defined results: a null or empty text has no ids, and no ids decode to no bytes;
null ids decode to null; an unknown id is an error. Both operators are column
functions: repeated rows, further columns and empty tables pass as they are.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LONG = 64                       # bytes of the longest piece in a matrix
CELLS = 1 << 20                 # of a matrix
STRETCH = 1 << 20               # characters cut into pieces at a time
CACHE_ENTRIES = 200_000
ROWS = 512                      # texts or id lists that are Python objects at a time
NONE = np.int32(2 ** 31 - 1)    # no token: after every rank
MIX = np.uint64(0x9E3779B97F4A7C15)


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public rank file (installed alike on the driver and the executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    """The pattern that cuts texts before the merges of the public rank files."""
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, which is the token's id. Every single byte has to be a token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: not every byte is a token")
    return ranks


class PairTable:
    """(left id, right id) -> id of the joined token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(8, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            slots, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slots], self.values[slots] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, at = keys[rest], values[rest], self._next(at[rest])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return at + 1 & (1 << self.bits) - 1

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` if its bytes are no token (or one side is ``NONE``)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], NONE)
        missed = np.flatnonzero((seen != keys) & (seen >= 0))
        at = at[missed]
        while len(missed):
            at = self._next(at)
            seen = self.keys[at]
            hit = seen == keys[missed]
            out[missed[hit]] = self.values[at[hit]]
            more = ~hit & (seen >= 0)
            missed, at = missed[more], at[more]
        return out


def merge_rows(pieces: list[bytes], byte_ids: np.ndarray, table: PairTable) -> list[bytes]:
    """Ids of each piece (little-endian unsigned 32-bit), all rows merged side by side."""
    width, n = max(map(len, pieces)), len(pieces)
    sizes = np.array([len(p) for p in pieces])
    tokens = byte_ids[np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8)].reshape(n, width)
    tokens[np.arange(width) >= sizes[:, None]] = NONE
    ranks = table.ranks(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(n, width - 1)
    out: list[bytes] = [b""] * n
    rows = np.arange(n)
    while len(rows):
        if tokens.shape[1] > 1:
            at = ranks.argmin(1)                    # the first of equal ranks: the leftmost
            best = ranks[np.arange(len(rows)), at]
        else:
            at, best = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
        done = best == NONE
        if done.any():
            ready = tokens[done]
            used = ready != NONE
            flat = ready[used].astype("<u4").tobytes()
            ends = 4 * np.cumsum(used.sum(1))
            start = 0
            for row, end in zip(rows[done].tolist(), ends.tolist()):
                out[row], start = flat[start:end], end
            going = ~done
            rows, tokens, ranks, at, best = rows[going], tokens[going], ranks[going], at[going], best[going]
            if not len(rows):
                break
        index = np.arange(len(rows))
        tokens[index, at] = best
        columns = np.arange(tokens.shape[1] - 1)
        shift = columns + (columns > at[:, None])
        tokens = np.take_along_axis(tokens, shift, 1)
        ranks = np.take_along_axis(ranks, shift[:, :-1], 1)
        left, right = at > 0, at < tokens.shape[1] - 1
        ranks[index[left], at[left] - 1] = table.ranks(tokens[index[left], at[left] - 1], best[left])
        ranks[index[right], at[right]] = table.ranks(best[right], tokens[index[right], at[right] + 1])
    return out


def merge_long(piece: bytes, byte_ids: np.ndarray, table: PairTable) -> bytes:
    """Ids of one long piece; a round makes every merge of its rank that the leftmost rule would."""
    tokens = byte_ids[np.frombuffer(piece, np.uint8)]
    ranks = table.ranks(tokens[:-1], tokens[1:])
    while len(ranks):
        best = ranks.min()
        if best == NONE:
            break
        hits = np.flatnonzero(ranks == best)
        # in a run of overlapping pairs (one repeated token) every second one merges
        head = np.r_[True, np.diff(hits) > 1]
        since = np.arange(len(hits)) - np.flatnonzero(head)[np.cumsum(head) - 1]
        hits = hits[since % 2 == 0]
        # as the merge at hits[k] leaves its neighbours: all on its left merged, none on its right
        before = np.where(hits > 0, tokens[hits - 1], NONE)
        before[1:][np.diff(hits) == 2] = best
        after = np.where(hits + 2 < len(tokens), tokens[np.minimum(hits + 2, len(tokens) - 1)], NONE)
        formed = np.minimum(table.ranks(before, np.full(len(hits), best)), table.ranks(np.full(len(hits), best), after))
        lower = np.flatnonzero(formed < best)
        if len(lower):
            hits = hits[:lower[0] + 1]
        tokens[hits] = best
        tokens = np.delete(tokens, hits + 1)
        ranks = np.delete(ranks, hits)
        merged = hits - np.arange(len(hits))
        for near in (merged - 1, merged):
            near = near[(near >= 0) & (near < len(tokens) - 1)]
            ranks[near] = table.ranks(tokens[near], tokens[near + 1])
    return tokens.astype("<u4").tobytes()


class Encoder:
    """Texts to ids as the rank file's own library gives them, without special tokens."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.split = regex.compile(pattern)
        self.ranks = read_ranks(path)
        self.table = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.cache: dict[str, bytes] = {}

    def stretches(self, text: str) -> Iterator[tuple[list[str], int]]:
        """The pieces of a text and their characters, about ``STRETCH`` of them at a time."""
        at, size = 0, STRETCH
        while at < len(text):
            end = min(at + size, len(text))
            pieces = self.split.findall(text, at, end)
            if end < len(text):
                if len(pieces) < 2:             # one piece fills the stretch: look further
                    size *= 2
                    continue
                end -= len(pieces.pop())        # the end may have cut the last piece short
            yield pieces, end - at
            at, size = end, STRETCH

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Merge ``pieces``: short ones enter the cache, the ids of long ones are returned."""
        long: dict[str, bytes] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            rank = self.ranks.get(raw)
            if rank is not None:
                self.cache[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONG:
                long[piece] = merge_long(raw, self.byte_ids, self.table)
            else:
                buckets.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for exponent, rows in buckets.items():
            step = CELLS >> exponent
            for first in range(0, len(rows), step):
                part = rows[first:first + step]
                ids = merge_rows([raw for _, raw in part], self.byte_ids, self.table)
                self.cache.update(zip([piece for piece, _ in part], ids))
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; the new pieces of about ``STRETCH`` characters are merged together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, int, list[str]]] = []       # text, part, pieces
        chars = 0

        def flush() -> None:
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            long = self.learn({p for _, _, pieces in waiting for p in pieces} - self.cache.keys())
            self.cache.update(long)
            for doc, part, pieces in waiting:
                out[doc][part] = b"".join(map(known, pieces))
            for piece in long:
                del self.cache[piece]
            waiting.clear()

        known = self.cache.__getitem__
        for doc, text in enumerate(texts):
            for pieces, size in self.stretches(text or ""):
                try:
                    out[doc].append(b"".join(map(known, pieces)))
                except KeyError:
                    waiting.append((doc, len(out[doc]), pieces))
                    out[doc].append(b"")
                    chars += size
                    if chars >= STRETCH:
                        flush()
                        chars = 0
        flush()
        return [b"".join(parts) for parts in out]


class Decoder:
    """Ids back to bytes, gathered from the tokens' joined bytes."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        tokens = sorted(ranks.items(), key=lambda t: t[1])
        self.size = tokens[-1][1] + 1
        self.lengths = np.zeros(self.size, np.int64)
        for token, rank in tokens:
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(token for token, _ in tokens), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        out = []
        for at in range(0, len(ids), 4 * STRETCH):
            part = np.frombuffer(ids[at:at + 4 * STRETCH], "<u4").astype(np.int64)
            if len(part) and (part.max() >= self.size or not self.lengths[part].all()):
                raise ValueError("an id is not in the rank file")
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
            out.append(self.bytes[np.repeat(self.starts[part], lengths) + within].tobytes())
        return b"".join(out)


def _by_rows(values: pa.Array, make: Callable[[list], list]) -> pa.Array:
    """``make`` over ``ROWS`` values at a time, as one binary array."""
    parts = [pa.array(make(values.slice(at, ROWS).to_pylist()), pa.binary()) for at in range(0, len(values), ROWS)]
    return pa.chunked_array(parts, pa.binary()).combine_chunks()


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of ``text`` as binary: little-endian unsigned 32-bit numbers.

    ``path``: a rank file that every executor can read; ``pattern``: how texts are cut.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(path, pattern)
        for texts in batches:
            yield _by_rows(texts, encoder.encode)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(text)


def decoded(ids: Column, path: str) -> Column:
    """The bytes that binary ``ids`` stand for."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(path)
        for rows in batches:
            yield _by_rows(rows, lambda ids: [None if v is None else decoder.decode(v) for v in ids])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(ids)


def n_tokens(ids: Column) -> Column:
    """How many ids a binary column holds."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
