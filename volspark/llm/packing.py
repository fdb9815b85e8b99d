"""Best-fit packing of token pieces into fixed-length sequences.

The linear grouping scheme, run on the histogram of piece lengths (at most
``capacity`` numbers, whatever the corpus size):

1. large lengths (above ``capacity * small``) are sorted, split into ``groups``
   groups of equal cardinality and rounded up to the longest of their group
   (the whole scheme is run for a few values of ``small``, the shortest plan wins);
2. the few rounded sizes are packed by optimised configurations: a linear
   program over configurations, solved by column generation with a knapsack
   as pricing step, rounded down;
3. actual lengths take the slots of their group;
4. the rest of the large pieces, then the small ones, are placed best-fit, in
   decreasing length, into the room that is left, opening sequences as needed.

The plan is a short list of segments: ranks [r, r + n) of length L go to
consecutive sequences at a given offset. Pieces get their rank within their
length from windows over (length, salt); a length shared by many pieces has as
many salts as its count asks for, so no window holds a whole length. Tokens
are made once; only (id, piece, start, length) and caller columns are shuffled.

Defined results: a null text is an empty one (a single end-of-text id);
repeated rows are packed once per row; rows with a null id are packed like any
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.session import keep

CAPACITY = 2048
SMALL = (0.125, 0.25, 0.5)              # shares of the capacity that bound small lengths
END_OF_TEXT = 0
PUNCTUATION = ".,;:!?%*$#&|()\""       # split off by the vocabulary's word pattern
CACHE_ENTRIES = 400_000                 # of each of the two word caches of a task
CACHED_CHARS = 64


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file (installed alike on the driver and the executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of whole texts, word by word through bounded caches.

    The vocabulary (lower case, white space dropped) never merges across white
    space, so a text's ids are those of its space-separated chunks in order.
    Chunks of letters with trailing punctuation are split here; anything else
    goes through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        # byte-level alphabet of the vocabulary: printable bytes stand for themselves
        shown = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            shown = word if word.isascii() else "".join([self.letter[b] for b in word.encode()])
            found = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.words) >= CACHE_ENTRIES:
                self.words.clear()
            self.words[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is not None:
            return found
        if len(chunk) > CACHED_CHARS:
            return self._whole(chunk)
        core = chunk.rstrip(PUNCTUATION)
        word = core.lower()
        if core.isalpha() and word.isalpha() and max(core) <= "ɏ":
            found = self._word(word)
            if len(core) < len(chunk):
                found += self._word(chunk[len(core):])
        else:
            found = self._whole(chunk)
        if len(self.chunks) >= CACHE_ENTRIES:
            self.chunks.clear()
            self.chunks[""] = b""
        self.chunks[chunk] = found
        return found

    def _whole(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        parts = text.replace("\n", " ").split(" ")
        try:
            return b"".join([self.chunks[p] for p in parts])
        except KeyError:
            return b"".join([self._chunk(p) for p in parts])


def tokenize_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids): the documents' ids, cut into pieces of ``capacity``.

    ``ids`` is binary (little-endian unsigned 32-bit); id 0 ends each document.
    ``tokenizer``: path of a tokenizer file that every executor can read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        end = array("I", [END_OF_TEXT]).tobytes()
        step = 4 * capacity
        for batch in batches:
            for first in range(0, batch.num_rows, 256):      # ids of a few documents at a time
                rows = batch.slice(first, 256)
                out = [[], [], [], [], []]
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                    ids = encoder.encode(text.as_py() or "") + end
                    for piece, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, part)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                     pa.array(out[4], pa.binary())],
                    names=["id", "piece", "start", "length", "ids"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(run, "id long, piece int, start long, length long, ids binary"))


def _price(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration of ``sizes`` (ascending) within ``capacity``."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(sizes[0]), capacity + 1):
        fit = np.searchsorted(sizes, c, side="right")
        options = best[c - sizes[:fit]] + value[:fit]
        k = int(np.argmax(options))
        best[c], pick[c] = (options[k], k) if options[k] > best[c - 1] else (best[c - 1], -1)
    config, c = np.zeros(len(sizes), np.int64), capacity
    while c >= sizes[0]:
        if pick[c] < 0:
            c -= 1
        else:
            config[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   gap: float = 1e-4, rounds: int = 1000) -> list[tuple[np.ndarray, int]]:
    """(configuration, times) covering at most ``demand`` of each size, near the LP optimum.

    ``sizes`` ascending and distinct. Column generation from single-size
    configurations; stops when no configuration improves or Farley's bound
    proves the linear program within ``gap``.
    """
    columns = np.diag(capacity // sizes).astype(float)
    amounts = demand / np.diag(columns)
    for _ in range(rounds):
        duals = np.linalg.solve(columns.T, np.ones(len(sizes)))
        price, config = _price(sizes, duals, capacity)
        if price <= 1 + gap:
            break
        direction = np.linalg.solve(columns, config.astype(float))
        ratios = np.full(len(sizes), np.inf)
        rising = direction > 1e-9
        ratios[rising] = amounts[rising] / direction[rising]
        leaves = int(np.argmin(ratios))
        columns[:, leaves] = config
        amounts = np.linalg.solve(columns, demand.astype(float))
    times = np.floor(np.maximum(amounts, 0) + 1e-9).astype(np.int64)
    return [(columns[:, j].round().astype(np.int64), int(t)) for j, t in enumerate(times) if t > 0]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 32,
                   small: tuple[float, ...] = SMALL) -> tuple[np.ndarray, int]:
    """Segments that place ``histogram`` (length -> count), and the number of sequences.

    The scheme runs once for each share in ``small``; the shortest plan is returned.

    A segment (length, rank, count, sequence, offset, each) puts the pieces of
    ``length`` with ranks rank .. rank + count - 1, ``each`` of them per
    sequence, into consecutive sequences from ``sequence`` on, side by side
    from ``offset`` on.
    """
    return min((_plan(histogram, capacity, groups, share) for share in small), key=lambda p: p[1])


def _plan(histogram: dict[int, int], capacity: int, groups: int,
          small: float) -> tuple[np.ndarray, int]:
    """The plan of :func:`plan_sequences` for one share that separates small from large lengths."""
    used = dict.fromkeys(histogram, 0)                # ranks given away, by length
    segments: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}       # free tokens -> (first sequence, sequences)
    state = {"next": 0}

    def put(length: int, count: int, sequence: int, offset: int, each: int = 1) -> None:
        segments.append((length, used[length], count, sequence, offset, each))
        used[length] += count

    def leave(free: int, sequence: int, bins: int) -> None:
        if free > 0 and bins > 0:
            room.setdefault(free, []).append((sequence, bins))

    # 1: equal-cardinality groups of the large lengths, longest first
    large = sorted((n for n in histogram if capacity * small < n <= capacity), reverse=True)
    total = sum(histogram[n] for n in large)
    queues: list[list[list[int]]] = []                # per group: runs [length, count]
    if total:
        share, filled = -(-total // groups), 0
        for length in large:
            count = histogram[length]
            while count:
                if filled % share == 0:
                    queues.append([])
                take = min(count, share - filled % share)
                queues[-1].append([length, take])
                filled, count = filled + take, count - take
        # groups whose longest length is equal are one size
        merged: list[list[list[int]]] = []
        for queue in queues:
            if merged and merged[-1][0][0] == queue[0][0]:
                merged[-1] += queue
            else:
                merged.append(queue)
        queues = merged[::-1]                         # ascending size
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(c for _, c in q) for q in queues])
        # 2 and 3: configurations, then actual lengths in their slots
        for config, times in configurations(sizes, demand, capacity):
            slots = [k for k in np.flatnonzero(config)[::-1] for _ in range(config[k])]
            while times:
                # the longest stretch over which every slot takes one length
                need = {k: slots.count(k) for k in set(slots)}
                stretch = min([times] + [max(1, queues[k][0][1] // need[k]) for k in need])
                offset, first = 0, state["next"]
                if any(queues[k][0][1] < need[k] for k in need):
                    stretch = 1
                for k in slots:
                    run = queues[k][0]
                    put(run[0], stretch, first, offset)
                    offset += run[0]
                    run[1] -= stretch
                    if not run[1]:
                        queues[k].pop(0)
                leave(capacity - offset, first, stretch)
                state["next"] += stretch
                times -= stretch
    # 4: best fit, in decreasing length
    for length in sorted(histogram, reverse=True):
        count = histogram[length] - used[length]
        fits = sorted(r for r in room if r >= length)
        for free in fits:
            while count and room[free]:
                sequence, bins = room[free].pop()
                each = min(free // length, count)
                whole = min(bins, count // each)
                offset = capacity - free
                put(length, whole * each, sequence, offset, each)
                leave(free - each * length, sequence, whole)
                leave(free, sequence + whole, bins - whole)
                count -= whole * each
            if not room[free]:
                del room[free]
            if not count:
                break
        while count:
            each = min(capacity // length, count)
            whole = count // each
            put(length, whole * each, state["next"], 0, each)
            leave(capacity - each * length, state["next"], whole)
            state["next"] += whole
            count -= whole * each
    table = np.array(segments, np.int64).reshape(-1, 6)
    return table[np.lexsort((table[:, 1], table[:, 0]))], state["next"]


def place(pieces: DataFrame, length_col: str = "length", order: tuple[str, ...] = ("id", "piece"),
          capacity: int = CAPACITY, groups: int = 32, window_rows: int = 1000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (both long, gapless offsets from 0).

    ``pieces`` is read twice and should be stored. Lengths lie in 1..capacity.
    ``order``: columns that spread pieces of a length over windows of about
    ``window_rows`` rows; they affect which piece goes where, not the packing.
    """
    names = list(pieces.columns)
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}   # <= capacity rows
    segments, _ = plan_sequences(counts, capacity, groups)
    keys = segments[:, 0] << 44 | segments[:, 1]

    salts = pieces.sparkSession.createDataFrame(
        [(n, -(-c // window_rows)) for n, c in counts.items()], f"{length_col} long, salts long")
    salted = (pieces.join(F.broadcast(salts), length_col)          # at most `capacity` rows
              .withColumn("salt", F.pmod(F.xxhash64(*order), "salts")).drop("salts"))
    sizes = (salted.groupBy(length_col, "salt").agg(F.count("*").alias("n"))
             .select(length_col, "salt", (F.sum("n").over(
                 Window.partitionBy(length_col).orderBy("salt")) - F.col("n")).alias("before")))
    ranked = (salted.withColumn("rank", F.row_number().over(
                  Window.partitionBy(length_col, "salt").orderBy(*order)))
              .join(sizes, [length_col, "salt"])
              .withColumn("rank", F.col("rank") - 1 + F.col("before"))
              .select(*names, "rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_col).to_numpy()
            rank = batch.column("rank").to_numpy()
            at = segments[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            within = rank - at[:, 1]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(at[:, 3] + within // at[:, 5]),
                 pa.array(at[:, 4] + within % at[:, 5] * length)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, groups: int = 32) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all documents."""
    pieces = (tokenize_pieces(docs, tokenizer, id_col, text_col, capacity)
              .withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return place(keep(pieces, "pieces"), capacity=capacity, groups=groups)
