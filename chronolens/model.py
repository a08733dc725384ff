"""Data model: the long ``samples`` table, time windows and step grids.

``samples`` has one row per point::

    metric      STRING                 metric name (the ``__name__`` label)
    labels      MAP<STRING, STRING>    every other label
    series_key  STRING                 JSON of the label map with sorted keys
    ts          TIMESTAMP              sample time (UTC)
    value       DOUBLE                 NaN and ±Inf are legal

Operators work in integer epoch microseconds internally (``ts_us``) so that
window edges are exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES_DDL = ("metric STRING, labels MAP<STRING,STRING>, series_key STRING, "
               "ts TIMESTAMP, value DOUBLE")

# Column of bucketed samples tables: the number of the time chunk that a sample lies in.
CHUNK_COL = "ts_chunk"

# Default query parameters of the reference.
DEFAULT_STEP_S = 60            # range queries of the registry run at a 1m step
DEFAULT_LOOKBACK_S = 300       # instant-selector lookback (5m)
DEFAULT_RANGE_S = 300          # the [5m] of every registry range function
DEFAULT_LIST_LIMIT = 200       # metric list cap when the caller passes <= 0
DEFAULT_MAX_SERIES = 2000      # series cap (read but never applied upstream)

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def series_key(labels: Column) -> Column:
    """Deterministic text key of a label map: keys sorted, compact JSON."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


_RFC3339 = re.compile(r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})(?:[.,]([0-9]+))?(Z|[+-][0-9]{2}:[0-9]{2})")


def parse_time(t) -> datetime | None:
    """RFC 3339 text / datetime / epoch seconds → aware UTC datetime; other text is an error.

    ``functions.exprs.parse_rfc3339`` is the same for a column."""
    if t is None or t == "":
        return None
    if isinstance(t, datetime):
        return t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    if isinstance(t, (int, float)):
        return datetime.fromtimestamp(t, tz=timezone.utc)
    m = _RFC3339.fullmatch(str(t))
    if not m or m[1][11:13] == "24" or (m[3] != "Z" and (m[3][1:3] > "23" or m[3][4:] > "59")):
        raise ValueError(f"not an RFC 3339 time: {t!r}")
    d = datetime.fromisoformat(m[1] + ("+00:00" if m[3] == "Z" else m[3]))
    return (d + timedelta(microseconds=int((m[2] or "0")[:6].ljust(6, "0")))).astimezone(timezone.utc)


def to_micros(t: datetime) -> int:
    return (t - _EPOCH) // timedelta(microseconds=1)


def fmt_rfc3339(t: datetime) -> str:
    return t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass(frozen=True)
class TimeWindow:
    """The configured investigation window; every query is clamped to it."""

    start: datetime
    end: datetime

    @staticmethod
    def of(start, end) -> "TimeWindow":
        s, e = parse_time(start), parse_time(end)
        if s is None or e is None or not e > s:
            raise ValueError("window end must be after window start")
        return TimeWindow(s, e)

    def clamp(self, start=None, end=None) -> tuple[datetime, datetime]:
        """Range clamp: each bound is clamped on its own side only.

        An unset or early start becomes the window start; an unset or late end
        becomes the window end. The result may be inverted (start > end) when
        the request lies wholly outside the window; callers treat that as an
        empty range.
        """
        s, e = parse_time(start), parse_time(end)
        if s is None or s < self.start:
            s = self.start
        if e is None or e > self.end:
            e = self.end
        return s, e

    def clamp_instant(self, t=None) -> datetime:
        """Instant clamp into [start, end]; unset → window end."""
        t = parse_time(t)
        if t is None:
            return self.end
        return min(max(t, self.start), self.end)

    def info(self) -> dict:
        return {"start": fmt_rfc3339(self.start), "end": fmt_rfc3339(self.end)}


def clamp_range(start: Column, end: Column, ws: Column, we: Column) -> tuple[Column, Column]:
    """Column form of ``TimeWindow.clamp`` for a table of requests (any
    orderable type: timestamps or epoch micros). Each bound is clamped on its
    own side; the result may be inverted."""
    s = F.when(start.isNull() | (start < ws), ws).otherwise(start)
    e = F.when(end.isNull() | (end > we), we).otherwise(end)
    return s, e


def clamp_instant_value(t: Column, ws: Column, we: Column) -> Column:
    """Instant clamp into [ws, we]; unset → window end."""
    return F.when(t.isNull(), we).otherwise(F.least(F.greatest(t, ws), we))


def clamp_columns(start: Column, end: Column, window: TimeWindow) -> tuple[Column, Column]:
    ws = F.timestamp_micros(F.lit(to_micros(window.start)))
    we = F.timestamp_micros(F.lit(to_micros(window.end)))
    return clamp_range(start, end, ws, we)


@dataclass(frozen=True)
class Grid:
    """Evaluation steps ``start + k*step`` for ``k = 0..K`` with the last ≤ end."""

    start_us: int
    end_us: int
    step_us: int

    @staticmethod
    def of(start, end, step_s: float) -> "Grid":
        s, e = to_micros(parse_time(start)), to_micros(parse_time(end))
        step = int(round(step_s * 1_000_000))
        if step <= 0:
            raise ValueError("step must be positive")
        return Grid(s, e, step)

    @property
    def empty(self) -> bool:
        return self.start_us > self.end_us

    @property
    def k_max(self) -> int:
        """Index of the last step (−1 when the range is inverted)."""
        return -1 if self.empty else (self.end_us - self.start_us) // self.step_us

    def step_ts_us(self, k: Column) -> Column:
        return F.lit(self.start_us) + k.cast("long") * F.lit(self.step_us)

