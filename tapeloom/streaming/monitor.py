"""Stateful streams: an intraday poll with rejection, cooldown and silence, and sums over days held in panes.

Both give the same rows however the input is cut into micro-batches, because a
row counts only once the watermark has passed it, in the order of event time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keyed state with timers lives in RocksDB; the other store has neither.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Why a snapshot's own time is not usable.
MISSING, FUTURE, STALE = "missing_or_unparseable_timestamp", "future_timestamp", "stale_timestamp"


def timestamp_issue(snapshot_at: Column, observed_at: Column, future_seconds: int = 60, stale_seconds: int = 900) -> Column:
    """Why a snapshot's time is not usable at the moment it is observed; null where it is."""
    ahead = (F.unix_micros(snapshot_at) - F.unix_micros(observed_at)) / F.lit(1_000_000.0)
    return F.when(snapshot_at.isNull(), MISSING).when(ahead > future_seconds, FUTURE).when(ahead < -stale_seconds, STALE)


_POLLS = "symbol long, observed_us long, event_id long, kind string, issue string, status string, queued boolean, price double, last_snapshot_us long"


class _Poll(StatefulProcessor):
    """Per symbol: polls that the watermark has not passed, and four numbers.

    ``waiting`` holds what lies within the watermark's delay; ``past`` the last
    good snapshot's time, the last refresh, the last poll and whether its
    silence was told. Nothing grows with a symbol's history.
    """

    def __init__(self, cooldown_us: int, silence_us: int):
        self.cooldown, self.silence = cooldown_us, silence_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "event_id long, observed_us long, snapshot_us long, issue string, price double")
        self.past = handle.getValueState("past", "snapshot_us long, refresh_us long, poll_us long, told boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        # a column with nulls comes as floats, and state takes no float for a whole number
        kinds = {"event_id": int, "observed_us": int, "snapshot_us": int, "issue": str, "price": float}
        columns = [[None if pd.isna(v) else kind(v) for v in new[c].tolist()] for c, kind in kinds.items()]
        self.waiting.appendList(list(zip(*columns, strict=True)))
        self._wake(int(new["observed_us"].min()) // 1000)
        yield from ()

    def _wake(self, at: int) -> None:
        """One timer a symbol is enough: for the earliest thing that may happen."""
        for known in list(self.handle.listTimers()):
            if known <= at:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(set(self.waiting.get()), key=lambda r: (r[1], r[0]))
        ready = [r for r in waiting if r[1] // 1000 <= mark]
        rest = [r for r in waiting if r[1] // 1000 > mark]
        snapshot, refresh, poll, told = self.past.get() if self.past.exists() else (None, None, None, True)
        out: list[tuple] = []

        def due(now: int) -> bool:
            return refresh is None or refresh <= now - self.cooldown

        def silent_before(now_us: float) -> None:
            nonlocal refresh, told
            at = None if poll is None or told else poll + self.silence
            if at is not None and at < now_us and at // 1000 <= mark:
                queued = due(at)
                out.append((key[0], at, None, "snapshot_missing", None, "failed", queued, None, snapshot))
                refresh, told = at if queued else refresh, True

        for event_id, observed, taken, issue, price in ready:
            silent_before(observed)
            queued = due(observed)
            snapshot = snapshot if issue else taken
            status = "failed" if issue else "refresh_queued" if queued else "observed"
            out.append((key[0], observed, event_id, "snapshot_timestamp_invalid" if issue else "snapshot_observed", issue, status, queued, price, snapshot))
            refresh, poll, told = observed if queued else refresh, observed, False
        silent_before(float("inf"))
        if ready:
            self.waiting.put(rest) if rest else self.waiting.clear()
        if poll is not None:
            self.past.update((snapshot, refresh, poll, told))
        wake = [rest[0][1] // 1000] if rest else []
        wake += [] if poll is None or told else [(poll + self.silence) // 1000]
        for known in list(self.handle.listTimers()):
            self.handle.deleteTimer(known)
        if wake:
            self.handle.registerTimer(max(min(wake), mark + 1))
        if out:
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _POLLS.split(", ")])
            yield frame.astype({c: "Int64" for c in ("symbol", "observed_us", "event_id", "last_snapshot_us")} | {"price": "Float64"})

    def close(self) -> None:
        pass


def poll_statuses(snapshots: DataFrame, delay: str = "1 hour", cooldown_seconds: int = 3600, silence_seconds: int = 86400, future_seconds: int = 60, stale_seconds: int = 900) -> DataFrame:
    """A stream of what an intraday poll says, from a stream ``event_id, symbol, observed_at, snapshot_at, price``.

    Every poll gives one row: ``snapshot_observed``, or
    ``snapshot_timestamp_invalid`` with the issue where the snapshot's own time
    is missing, ahead or stale. A symbol that is silent for ``silence_seconds``
    gives one ``snapshot_missing`` row by a timer, though no event came. A
    refresh is queued when none was for ``cooldown_seconds``.

    Rows wait until the watermark (``delay`` behind the newest poll) has passed
    them, so polls out of order within it are put right, the same poll again is
    one, and later ones are dropped by Spark. Polls without a symbol, an id or a
    moment are left out. State per symbol: the polls within ``delay``, and four
    numbers. Needs the state store ``STORE``.
    """
    issue = timestamp_issue(F.col("snapshot_at"), F.col("observed_at"), future_seconds, stale_seconds)
    rows = snapshots.where("symbol is not null and observed_at is not null and event_id is not null").withWatermark("observed_at", delay).select(
        "observed_at", "event_id", F.col("symbol").cast("long").alias("symbol"), F.unix_micros("observed_at").alias("observed_us"),
        F.unix_micros("snapshot_at").alias("snapshot_us"), issue.alias("issue"), F.col("price").cast("double").alias("price"),
    )
    told = rows.groupBy("symbol").transformWithStateInPandas(_Poll(cooldown_seconds * 1_000_000, silence_seconds * 1_000_000), _POLLS, "Append", "EventTime")
    return told.select(
        "symbol", F.timestamp_micros("observed_us").alias("observed_at"), "event_id", "kind", "issue", "status", "queued", "price",
        F.timestamp_micros("last_snapshot_us").alias("last_snapshot_at"),
    )


class _Panes(StatefulProcessor):
    """Per symbol: one total a day for the longest window; older days leave as newer ones come."""

    def __init__(self, columns: list[str], windows: tuple[int, ...]):
        self.columns, self.windows = columns, windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.panes = handle.getMapState("panes", "day int", ", ".join(f"`{c}` double" for c in self.columns))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {int(day[0]): tuple(v) for day, v in self.panes.iterator()}
        known = set(held)
        out = []
        for row in pd.concat(list(rows)).sort_values("day")[["day", *self.columns]].itertuples(index=False, name=None):
            day = int(row[0])
            held[day] = tuple(0.0 if pd.isna(v) else float(v) for v in row[1:])
            oldest = day - max(self.windows)
            held = {d: v for d, v in held.items() if d > oldest}
            sums = [sum(v[i] for d, v in held.items() if day - n < d <= day) for n in self.windows for i in range(len(self.columns))]
            out.append((key[0], day, *held[day], *sums))
        for day in known - set(held):
            self.panes.removeKey((day,))
        for day in set(held) - known:
            self.panes.updateValue((day,), held[day])
        yield pd.DataFrame(out, columns=["symbol", "day", *self.columns, *[f"{c}_{n}d" for n in self.windows for c in self.columns]])

    def close(self) -> None:
        pass


def rolling_day_sums(rows: DataFrame, time: str, columns: list[str], windows: tuple[int, ...] = (30, 90), delay: str = "2 days") -> DataFrame:
    """A stream of ``symbol, as_of_date``, each day's totals of ``columns`` and their sums over the last days of every window.

    Two steps: Spark sums each symbol's day (map-side first) and gives it out
    once the watermark has passed the day, so later rows are dropped; then a
    symbol's day meets the days before it, which are one pane each. A day
    without rows gives none. State per symbol: the open days, and at most as
    many panes as the longest window has days, whatever came before. Rows
    without a symbol or a time are left out; null values count 0. Needs the
    state store ``STORE``.
    """
    marked = rows.where(F.col("symbol").isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    days = marked.groupBy(F.window(time, "1 day").alias("w"), "symbol").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in columns])
    days = days.select("symbol", F.datediff(F.to_date("w.start"), F.lit("1970-01-01").cast("date")).alias("day"), *columns)
    names = [*columns, *[f"{c}_{n}d" for n in windows for c in columns]]
    key = rows.schema["symbol"].dataType.simpleString()
    summed = days.groupBy("symbol").transformWithStateInPandas(_Panes(columns, windows), f"symbol {key}, day int, " + ", ".join(f"`{n}` double" for n in names), "Append", "None")
    return summed.select("symbol", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("as_of_date"), *names)


def run_through(spark: SparkSession, stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append what is there to the sink and stop; a run again goes on behind the last one."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        q = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
