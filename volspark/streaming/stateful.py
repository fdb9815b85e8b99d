"""Tick metrics from keyed state: ``transformWithState`` and event-time timers (ST3, ST6).

``RollingMetricsSink`` reads stored ticks back for every batch, so that late ticks
and replays can change any hour. For a feed that is ordered within each series
(up to a fixed ``lateness``) this module needs no such reads: the state of a
series holds what its next ticks can still need, and every tick's row is emitted
once, when it is final.

A call of the processor costs milliseconds and a request to the state store a
fraction of one, so the series are worked on together: the grouping key is one of
``GROUPS`` slots, a slot holds the series whose keys have its hash, and the ticks of
all its series go through the same numpy operations. State of a slot (RocksDB, one
partition per shuffle partition):

* ``ticks``: ``PAGES`` pages by another part of the hash. A page has the time of the
  last emitted tick and its price (the next return), the timers, the times, returns
  and prices of the last buckets of each of its series, and the rows that are not
  final yet. More than ``SEALED`` ticks of a page go to an entry of their own, which
  is not written again: removed as soon as most of it is too old. A batch reads the
  pages of its ticks and writes what changes of them;
* ``due``: the earliest timer and the size of each page.

Times are cut into buckets (an hour for the 1 h / 24 h frames). A frame
``[t - F, t]`` is the head of the tick's bucket, whole buckets and the tail of the
bucket ``F`` back: sums of disjoint rows, nothing is subtracted. Buckets older than
the longest frame are removed with every emission, so the state of a series is
bounded by that frame, however long its history.

Ticks of one second are peers and their rows need all of them. Rows older than the
newest tick of their series by more than ``lateness`` seconds are emitted in the
batch that brings it; for the others a timer at the newest pending second of the
series fires as the watermark (over all series) passes it. A tick that is not newer than the last
emitted one of its series is too late for a row: it is returned with the reason
``late_tick``, like the ticks that fail the quality check with theirs, for the
quarantine. Nothing is dropped and nothing is emitted twice, also after a restart
or a replayed batch (the state is versioned by batch).

A slot is the work of one task per batch: its rows of one micro-batch are held
together, so a source's batch limit (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``) bounds the memory. Ticks without keys are one series.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from volspark.functions import event_time
from volspark.operators.clean import enrich_ticks, quality_check
from volspark.operators.metrics import HOUR
from volspark.operators.rolling import bucket_width
from volspark.schemas import DASHBOARD_COLUMNS
from volspark.sources.files import CORRUPT
from volspark.streaming.stream import start

# the processor runs in Python workers: pickled by value, executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ADAPTIVE = "spark.sql.adaptive.enabled"
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
KEY_TIME = JSON_TIME | {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# the row's own text of a bad line is a field like any other here
ROW_TEXT = JSON_TIME | {"columnNameOfCorruptRecord": "_no_field"}
LATE = "late_tick"
AHEAD = "timestamp_in_future"
COLUMNS = ("log_return", "price")
NOTHING = (np.empty(0, np.int64), np.empty(0), np.empty(0))

GROUPS = 1024               # slots of a stream and pages of a slot: other numbers need
PAGES = 16                  # a new checkpoint
PIECE = 10_000              # rows handed over at once
SEALED = 1 << 14            # ticks of a page that make an entry of their own
AT_ONCE = 1 << 26           # bytes of a slot's pages that may be read by one request
NEVER = np.iinfo(np.int64).max                          # a page without a timer
STORED = pa.schema([("series", pa.string()), ("closed", pa.int64()), ("price", pa.float64()),
                    ("timers", pa.list_(pa.int64())), ("t", pa.list_(pa.int64())),
                    ("r", pa.list_(pa.float64())), ("p", pa.list_(pa.float64()))])

Rows = tuple[np.ndarray, np.ndarray, np.ndarray]        # times, returns, prices


# --- frames over buckets (numpy, no Spark) --------------------------------------

def _running(kind: str, values: np.ndarray, heads: np.ndarray, back: bool = False) -> np.ndarray:
    """Running value within the segments that begin at ``heads``; ``back``: from their ends."""
    values = np.ones(len(values)) if kind == "count" else values * values if kind == "sumsq" else values
    add = {"max": np.maximum, "min": np.minimum}.get(kind, np.add)
    sizes = np.diff(np.append(heads, len(values)))
    first, step = (heads + sizes - 1, -1) if back else (heads, 1)
    out = values.astype(float)
    lengths = np.frexp(sizes)[1]
    for length in np.unique(lengths[sizes > 1]):        # side by side: segments of about the same length
        own = np.flatnonzero(lengths == length)
        inside = np.arange(sizes[own].max()) < sizes[own, None]
        at = np.where(inside, first[own, None] + step * np.arange(inside.shape[1]), 0)
        out[at[inside]] = add.accumulate(values[at], axis=1)[inside]
    return out


def _join(kind: str, a, b):
    return np.maximum(a, b) if kind == "max" else np.minimum(a, b) if kind == "min" else a + b


def _none(kind: str) -> float:
    return {"max": -np.inf, "min": np.inf}.get(kind, 0.0)


def frames(rows: Rows, at: np.ndarray, width: int, parts: tuple[tuple[str, str], ...],
           seconds: tuple[int, ...]) -> np.ndarray:
    """Values (row, frame, part) over ``[t - s, t]`` of the rows at positions ``at``.

    ``rows`` are in time order and hold every row of the frames. A part is (kind,
    column). Series may share the time axis where it sets them apart by more than
    the longest frame.
    """
    times, columns = rows[0], dict(zip(COLUMNS, rows[1:]))
    out = np.empty((len(at), len(seconds), len(parts)))
    if not len(at):
        return out
    buckets = times // width
    heads = np.flatnonzero(np.r_[True, np.diff(buckets) > 0])
    marks, ends = buckets[heads], np.append(heads[1:], len(times)) - 1
    used, own = np.unique(np.searchsorted(heads, at, "right") - 1, return_inverse=True)
    last = np.searchsorted(times, times[at], "right") - 1
    before = [np.searchsorted(times, times[at] - s, "left") for s in seconds]
    for k, (kind, column) in enumerate(parts):
        head = _running(kind, columns[column], heads)
        tail = _running(kind, columns[column], heads, back=True)
        for f, s in enumerate(seconds):
            partly = buckets[before[f]] == buckets[at] - s // width
            whole = used - np.searchsorted(marks, marks[used] - s // width, "right")
            middle = np.full(len(used), _none(kind))
            for back in range(int(whole.max()), 0, -1):
                some = np.flatnonzero(whole >= back)
                middle[some] = _join(kind, middle[some], head[ends[used[some] - back]])
            out[:, f, k] = _join(kind, _join(kind, head[last], np.where(partly, tail[before[f]], _none(kind))),
                                 middle[own])
    return out


def frame_values(load: Callable[[int], Rows], totals: dict[int, np.ndarray], new: Rows, width: int,
                 parts: tuple[tuple[str, str], ...], seconds: tuple[int, ...]
                 ) -> tuple[np.ndarray, dict[int, Rows]]:
    """``frames`` of one series that is kept bucket by bucket, and the buckets that new rows changed.

    ``new`` is in time order and not older than what ``load`` gives for a bucket;
    rows of one time are all there. ``totals`` (bucket -> value of each part) is
    brought up to date.
    """
    rows = tuple(np.concatenate(a) for a in zip(*[load(b) for b in sorted(totals)], new))
    values = frames(rows, np.arange(len(rows[0]) - len(new[0]), len(rows[0])), width, parts, seconds)
    changed: dict[int, Rows] = {}
    for b in np.unique(new[0] // width).tolist():
        lo, hi = np.searchsorted(rows[0], [b * width, (b + 1) * width])
        changed[b] = own = tuple(a[lo:hi] for a in rows)
        columns = dict(zip(COLUMNS, own[1:]))
        totals[b] = np.array([_running(kind, columns[column], np.zeros(1, int))[-1] for kind, column in parts])
    return values, changed


# --- the processor -------------------------------------------------------------

@dataclass(frozen=True)
class Plan:
    """What a processor computes: its order columns, frames and outputs."""
    order: tuple[str, ...]
    hours: tuple[int, ...]
    extra: tuple[tuple[str, tuple[str, str, int]], ...]
    lateness: int

    @property
    def seconds(self) -> tuple[int, ...]:
        return tuple(sorted({h * HOUR for h in self.hours} | {s for _, (_, _, s) in self.extra}))

    @property
    def parts(self) -> tuple[tuple[str, str], ...]:
        own = {("count", "log_return"), ("sum", "log_return"), ("sumsq", "log_return"), ("sum", "price")}
        return tuple(sorted(own | {(kind, column) for _, (kind, column, _) in self.extra}))

    @property
    def metrics(self) -> list[str]:
        names = ["log_return", "price_change_pct"]
        names += [f"{m}_{h}h" for h in self.hours for m in ("volatility", "price_ma")]
        return names + [name for name, _ in self.extra]


@dataclass
class Series:
    """The series of some pages: an entry each, and what belongs to it by the entry's number."""
    names: np.ndarray
    page: np.ndarray
    closed: np.ndarray                          # time and price of the last emitted tick
    price: np.ndarray
    timers: tuple[np.ndarray, ...]              # entry, second
    ticks: tuple[np.ndarray, ...]               # entry, time, return, price, part: by entry and time
    parts: dict[tuple[int, int], int]           # sealed (page, part) -> ticks
    rows: pd.DataFrame                          # not final yet

    def entries(self, names: pd.Series, pages: pd.Series) -> np.ndarray:
        """The entry of each row; series that are not known yet get one."""
        codes, found = pd.factorize(names)
        at = pd.Index(self.names, dtype=object).get_indexer(found)
        new = at < 0
        at[new] = len(self.names) + np.arange(new.sum())
        self.names = np.append(self.names, np.asarray(found, dtype=object)[new])
        self.page = np.append(self.page, pages.to_numpy(np.int64)[np.unique(codes, return_index=True)[1][new]])
        self.closed = np.append(self.closed, np.full(new.sum(), np.iinfo(np.int64).min))
        self.price = np.append(self.price, np.full(new.sum(), np.nan))
        return at[codes]


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _lists(entry: np.ndarray, n: int, *values: np.ndarray) -> list[pa.Array]:
    order = np.argsort(entry, kind="stable")
    offsets = np.r_[0, np.cumsum(np.bincount(entry, minlength=n))].astype(np.int32)
    return [pa.ListArray.from_arrays(offsets, v[order]) for v in values]


class SeriesMetrics(StatefulProcessor):
    """Final metric rows of the series of one slot, in time order; see the module's docstring."""

    def __init__(self, plan: Plan, width: int):
        self.plan, self.width = plan, width

    def init(self, handle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "pages binary")
        self.ticks = handle.getMapState("ticks", "page long, part long", "series binary, rows binary, parts binary")
        self.fired: set = set()                 # slots whose timers of this batch are done

    # rows come with the slot and the columns below (Spark renames names that start with "_")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        refused = batch["tick_reason"].notna()
        if refused.any():
            yield from self._refused(batch[refused], batch["tick_reason"][refused])
            batch = batch[~refused]
        if not len(batch):
            return
        due = self._due()
        series = self._load(due, np.unique(batch["tick_page"].to_numpy(np.int64)))
        batch = batch.assign(tick_entry=series.entries(batch["tick_series"], batch["tick_page"]))
        late = batch["tick_t"].to_numpy(np.int64) <= series.closed[batch["tick_entry"]]
        if late.any():
            yield from self._refused(batch[late], LATE)
            batch = batch[~late]
        if not len(batch):
            return
        entries = np.unique(batch["tick_entry"])
        series.rows = pd.concat([r for r in (series.rows, batch[self._own]) if len(r)], ignore_index=True)
        newest = np.full(len(series.names), -1)
        np.maximum.at(newest, series.rows["tick_entry"].to_numpy(), series.rows["tick_t"].to_numpy(np.int64))
        series.timers = tuple(np.append(a, b) for a, b in zip(series.timers, (entries, newest[entries])))
        upto = np.full(len(newest), -1)
        upto[entries] = newest[entries] - self.plan.lateness - 1
        out = self._emit(series, upto)
        self._save(due, series)
        self.handle.registerTimer(int(newest[entries].min()) * 1000)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if key in self.fired:
            return
        self.fired.add(key)
        now = timerValues.getCurrentWatermarkInMs() // 1000
        due = self._due()
        pages = np.flatnonzero((due[1] > 0) & (due[0] <= now))
        if len(pages):
            series = self._load(due, pages)
            entry, second = series.timers
            upto = np.full(len(series.names), -1)
            upto[entry[second <= now]] = now
            series.timers = entry[second > now], second[second > now]
            out = self._emit(series, upto)
            self._save(due, series)
            yield from out
        if due[0].min() < NEVER:
            self.handle.registerTimer(int(due[0].min()) * 1000)

    def close(self) -> None:
        pass

    @property
    def _own(self) -> list[str]:
        return ["tick_entry", "tick_t", *self.plan.order, "tick_p", "tick_row"]

    def _due(self) -> np.ndarray:
        """The earliest timer and the bytes of each page."""
        if self.due.exists():
            return np.frombuffer(self.due.get()[0], np.int64).reshape(2, PAGES).copy()
        return np.array([[NEVER] * PAGES, [0] * PAGES])

    def _load(self, due: np.ndarray, pages: np.ndarray) -> Series:
        """The stored series of ``pages``."""
        pages = pages[due[1, pages] > 0].tolist()
        if 2 * len(pages) > (due[1] > 0).sum() and due[1].sum() < AT_ONCE:
            stored = {tuple(k): v for k, v in self.ticks.iterator()}
            value = stored.__getitem__
        else:
            value = self.ticks.getValue
        tables, rows, page, parts, sealed, base = [STORED.empty_table()], [], [], {}, [], 0
        for at in pages:
            entries, waiting, own = value((at, 0))
            tables.append(_unpacked(entries))
            if waiting:
                table = _unpacked(waiting)
                rows.append(table.set_column(0, "tick_entry", pa.array(table["tick_entry"].to_numpy() + base)))
            for part in np.frombuffer(own, np.int64).tolist():
                table = _unpacked(value((at, part))[0])
                parts[at, part] = table.num_rows
                entry, *values = (c.to_numpy() for c in table.columns)
                sealed.append((entry + base, *values, np.full(len(entry), part)))
            page += [at] * tables[-1].num_rows
            base += tables[-1].num_rows
        found = {c: column.combine_chunks() for c, column in zip(STORED.names, pa.concat_tables(tables).columns)}
        owner = {c: np.repeat(np.arange(base), found[c].value_lengths().to_numpy()) for c in ("timers", "t")}
        ticks = (owner["t"], *[found[c].flatten().to_numpy() for c in ("t", "r", "p")], np.zeros(len(owner["t"]), int))
        if sealed:
            ticks = tuple(np.concatenate(a) for a in zip(ticks, *sealed))
            order = np.lexsort((ticks[1], ticks[0]))
            ticks = tuple(a[order] for a in ticks)
        return Series(
            found["series"].to_numpy(zero_copy_only=False), np.array(page, np.int64),
            found["closed"].to_numpy().copy(), found["price"].to_numpy().copy(),
            (owner["timers"], found["timers"].flatten().to_numpy()), ticks, parts,
            pa.concat_tables(rows, promote_options="permissive").to_pandas() if rows else pd.DataFrame(columns=self._own))

    def _save(self, due: np.ndarray, series: Series) -> None:
        n = len(series.names)
        order = np.argsort(series.page, kind="stable")      # a series keeps its place in its page
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        pages, heads = np.unique(series.page[order], return_index=True)
        open_ = self._seal(series, place - heads[np.searchsorted(pages, series.page)])
        timers = _lists(place[series.timers[0]], n, series.timers[1])
        ticks = _lists(place[series.ticks[0][open_]], n, *[a[open_] for a in series.ticks[1:4]])
        table = pa.Table.from_arrays([pa.array(series.names[order], pa.string()), pa.array(series.closed[order]),
                                      pa.array(series.price[order]), *timers, *ticks], schema=STORED)
        at = place[series.rows["tick_entry"].to_numpy(np.int64)]
        held = np.argsort(at, kind="stable")
        at = at[held]
        rows = pa.Table.from_pandas(series.rows.iloc[held], preserve_index=False).replace_schema_metadata()
        earliest = np.full(n, NEVER)
        np.minimum.at(earliest, place[series.timers[0]], series.timers[1])
        for page, lo, hi in zip(pages.tolist(), heads.tolist(), [*heads[1:].tolist(), n]):
            first, last = np.searchsorted(at, [lo, hi]).tolist()
            waiting = b""
            if last > first:
                waiting = _packed(rows.slice(first, last - first).set_column(
                    0, "tick_entry", pa.array(at[first:last] - lo)))
            sealed = {part: size for (p, part), size in series.parts.items() if p == page}
            value = _packed(table.slice(lo, hi - lo)), waiting, np.array([*sealed], np.int64).tobytes()
            self.ticks.updateValue((page, 0), value)
            due[:, page] = earliest[lo:hi].min(), sum(map(len, value)) + 32 * sum(sealed.values())
        self.due.update((due.tobytes(),))

    def _seal(self, series: Series, place: np.ndarray) -> np.ndarray:
        """Store full parts and remove old ones; which ticks stay in their page. ``place``: of a series in its page."""
        entry, *values, part = series.ticks
        page = series.page[entry]
        taken = dict(series.parts)
        for (p, k), size in taken.items():
            own = (page == p) & (part == k)
            if 2 * own.sum() < size:
                part[own] = 0
                self.ticks.removeKey((p, k))
                del series.parts[p, k]
        for p in np.flatnonzero(np.bincount(page[part == 0], minlength=PAGES) > SEALED).tolist():
            own = (page == p) & (part == 0)
            k = max((k for q, k in taken if q == p), default=0) + 1
            part[own] = k
            table = pa.table([place[entry[own]], *[a[own] for a in values]], names=["entry", "t", "r", "p"])
            self.ticks.updateValue((p, k), (_packed(table), b"", b""))
            series.parts[p, k] = int(own.sum())
        return part == 0

    def _emit(self, series: Series, upto: np.ndarray) -> Iterator[pd.DataFrame]:
        """The final rows up to second ``upto`` of their series; the others wait."""
        final = series.rows["tick_t"].to_numpy(np.int64) <= upto[series.rows["tick_entry"].to_numpy(np.int64)]
        rows, series.rows = series.rows[final], series.rows[~final]
        return self._pieces(self._closed(series, self._sorted(rows))) if len(rows) else iter(())

    def _sorted(self, rows: pd.DataFrame) -> pd.DataFrame:
        by_time = lambda df: df.iloc[np.lexsort((df["tick_t"].to_numpy(), df["tick_entry"].to_numpy()))]
        rows = by_time(rows)
        same = (np.diff(rows["tick_t"].to_numpy()) == 0) & (np.diff(rows["tick_entry"].to_numpy()) == 0)
        if same.any():
            order = ["tick_entry", "tick_t", *self.plan.order, "tick_p"]
            peers = np.r_[False, same] | np.r_[same, False]
            # ticks that agree in time and order are one tick
            tied = rows[peers].drop_duplicates(order).sort_values(order, kind="stable", na_position="first")
            rows = by_time(pd.concat([rows[~peers], tied]))
        return rows

    def _closed(self, series: Series, rows: pd.DataFrame) -> pd.DataFrame:
        plan, width = self.plan, self.width
        entry, t = (rows[c].to_numpy(np.int64) for c in ("tick_entry", "tick_t"))
        p = rows["tick_p"].to_numpy(float)
        ends = np.flatnonzero(np.diff(entry, append=-1))
        before = np.r_[np.nan, p[:-1]]
        firsts = np.r_[0, ends[:-1] + 1]
        before[firsts] = series.price[entry[firsts]]
        known = before > 0
        safe = np.where(known, before, 1.0)
        r = np.where(known, np.log(p / safe), 0.0)
        change = np.where(known, (p - safe) / safe * 100.0, 0.0)

        # one axis for all series, farther apart than the longest frame
        emitting = np.zeros(len(series.names), bool)
        emitting[entry] = True
        old = emitting[series.ticks[0]]
        both = [np.append(a[old], b) for a, b in zip(series.ticks, (entry, t, r, p, np.zeros(len(t), int)))]
        least = both[1].min() // width * width
        apart = ((both[1].max() - least + plan.seconds[-1]) // width + 2) * width
        axis = both[0] * apart + (both[1] - least)
        order = np.argsort(axis, kind="stable")
        both = [a[order] for a in both]
        values = frames((axis[order], *both[2:4]), np.flatnonzero(order >= old.sum()), width, plan.parts, plan.seconds)
        series.closed[entry[ends]], series.price[entry[ends]] = t[ends], p[ends]
        oldest = series.closed // width - plan.seconds[-1] // width
        kept = both[1] // width >= oldest[both[0]]
        series.ticks = tuple(np.append(a[~old], b[kept]) for a, b in zip(series.ticks, both))

        def value(kind: str, column: str, seconds: int) -> np.ndarray:
            return values[:, plan.seconds.index(seconds), plan.parts.index((kind, column))]

        out = self._rows(rows, None)
        out["log_return"], out["price_change_pct"] = r, change
        for h in plan.hours:
            n, s, q = (value(kind, "log_return", h * HOUR) for kind in ("count", "sum", "sumsq"))
            spread = np.maximum((q - s * s / n) / np.maximum(n - 1, 1), 0.0)
            out[f"volatility_{h}h"] = np.where(n >= 2, np.sqrt(spread), 0.0)
            out[f"price_ma_{h}h"] = value("sum", "price", h * HOUR) / n
        for name, (kind, column, seconds) in plan.extra:
            out[name] = value(kind, column, seconds)
        return out

    def _rows(self, rows: pd.DataFrame, reason) -> pd.DataFrame:
        return pd.DataFrame({"tick_row": rows["tick_row"].to_numpy(), "tick_reason": reason})

    def _refused(self, rows: pd.DataFrame, reason) -> Iterator[pd.DataFrame]:
        out = self._rows(rows, reason if isinstance(reason, str) else reason.to_numpy())
        for name in self.plan.metrics:
            out[name] = np.nan
        return self._pieces(out)

    def _pieces(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for lo in range(0, len(rows), PIECE):
            yield rows.iloc[lo:lo + PIECE]


# --- the stream ------------------------------------------------------------------

def stateful_metrics(ticks: DataFrame, keys=(), *, seq_col: str = "seq", hours=(1, 24),
                     extra: dict | None = None, lateness: int = 0, max_ahead: int = 86400) -> DataFrame:
    """Every tick of a stream once: with its final metrics, or with its ``reject_reason``.

    Output: the input's columns, ``event_time``, ``date``, the metrics of
    ``tick_metrics`` and ``reject_reason`` (null for metric rows). ``lateness``:
    how many seconds a tick may be behind the newest of its series. Ticks more than
    ``max_ahead`` seconds after the batch's own time are rejected: one of them
    would move the watermark, and with it the end of every series, there.
    """
    extra = extra or {}
    order = [c for c in (seq_col, "datetime") if c in ticks.columns]
    plan = Plan(tuple(f"order_{c}" for c in order), tuple(hours), tuple(extra.items()), lateness)
    width = bucket_width(list(plan.seconds))
    ticks = ticks.drop(*[m for m in plan.metrics if m in ticks.columns], "event_time", "date")
    payload = ticks.schema
    checked = quality_check(ticks)
    ahead = F.col("timestamp") > F.unix_timestamp(F.current_timestamp()) + max_ahead
    reason = F.coalesce("reject_reason", F.when(ahead, F.lit(AHEAD)))
    # one text per series: a null is a key like any other, 0.0 and -0.0 are the same
    types = {f.name: f.dataType for f in checked.schema}
    own = [F.col(k) + 0 if isinstance(types.get(k), (T.FloatType, T.DoubleType)) else F.col(k) for k in keys] or [F.lit(0)]
    series = F.to_json(F.struct(*[k.alias(f"key{i}") for i, k in enumerate(own)]), KEY_TIME)
    rows = checked.select(
        F.pmod(F.xxhash64(series), F.lit(GROUPS)).alias("tick_slot"),
        F.pmod(F.shiftrightunsigned(F.xxhash64(series), 24), F.lit(PAGES)).alias("tick_page"),
        series.alias("tick_series"), F.coalesce("timestamp", F.lit(-1)).alias("tick_t"),
        *[F.col(c).alias(o) for c, o in zip(order, plan.order)],
        F.col("price").cast("double").alias("tick_p"), reason.alias("tick_reason"),
        F.to_json(F.struct(*payload.fieldNames()), JSON_TIME).alias("tick_row"),
        F.when(reason.isNull(), event_time("timestamp")).alias("_at"))
    # the event time serves the watermark alone: Spark would drop late rows by itself
    # where it sees the column, and they belong to the quarantine
    marked = rows.withWatermark("_at", f"{lateness} seconds").drop("_at")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("tick_row", "tick_reason")]
                          + [T.StructField(m, T.DoubleType()) for m in plan.metrics])
    found = marked.groupBy("tick_slot").transformWithStateInPandas(
        SeriesMetrics(plan, width), schema, "Append", "EventTime")
    back = found.select(F.from_json("tick_row", payload, ROW_TEXT).alias("_in"), *plan.metrics,
                        F.col("tick_reason").alias("reject_reason"))
    return enrich_ticks(back.select("_in.*", *plan.metrics, "reject_reason"))


@dataclass
class StatefulMetricsSink:
    """foreachBatch handler: final rows to ``metrics/`` and ``dashboard/``, the others to ``quarantine/``.

    Partitions are (date, ingest_batch), the quarantine's (ingest_batch), with
    dynamic overwrite: a replayed batch replaces its own rows. No stored row is read.
    A date is written by one task, or by several when large: the number of files
    follows the rows, not shuffle partitions x dates.
    """
    base: str
    dashboard: bool = True
    counts: dict = field(default_factory=dict)          # batch id -> (final, refused) rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            n = batch.agg(F.count_if(F.col("reject_reason").isNull()).alias("final"),
                          F.count_if(F.col("reject_reason").isNotNull()).alias("refused")).first()
            self.counts[batch_id] = (n.final, n.refused)
            rows = batch.withColumn("ingest_batch", F.lit(batch_id))
            with _adaptive(batch.sparkSession):
                if n.refused:
                    _write(rows.where(F.col("reject_reason").isNotNull()), "ingest_batch").parquet(
                        os.path.join(self.base, "quarantine"))
                if n.final:
                    final = rows.where(F.col("reject_reason").isNull()).drop("reject_reason", CORRUPT)
                    _write(final, "date", "ingest_batch").parquet(os.path.join(self.base, "metrics"))
                    if self.dashboard:
                        shown = [c for c in DASHBOARD_COLUMNS if c in final.columns]
                        _write(final.select(*shown, "date", "ingest_batch"), "date", "ingest_batch").json(
                            os.path.join(self.base, "dashboard"))
        finally:
            batch.unpersist()


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution, which Spark turns off in the session of a stateful stream, for writes of rows that are stored."""
    own = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, own)


def _write(df: DataFrame, *partition_by: str):
    return (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by))


def start_stateful(metrics: DataFrame, handler, checkpoint: str, **kw):
    """Start a query over ``stateful_metrics`` rows; see ``stream.start``.

    The operator needs the RocksDB state store; the session's own choice is put
    back once the query has started.
    """
    spark = metrics.sparkSession
    own = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start(metrics, handler, checkpoint, **kw)
    finally:
        spark.conf.set(PROVIDER, own)
