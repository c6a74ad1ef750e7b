"""Stateful streaming: alert cooldown and first-seen songs."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

NEVER = -(1 << 62)


def cooldown_events(alerts: DataFrame, seconds: float = 300.0, delay: int = 0, idle_seconds: int | None = None) -> DataFrame:
    """``(code, ts, late)``: alerts at least ``seconds`` after the last emitted one of their code, and the rows that came too late.

    ``alerts`` is a stream of ``(code, ts)`` with epoch seconds, in any order.
    An alert waits until a time ``delay`` later has been seen for its code; so
    rows that are at most ``delay`` behind their code's newest take part in
    order, as in the batch rule.  A row further behind could change what was emitted already: it is
    given out with ``late`` true and decides nothing.  Equal times count once.
    Null codes and times are left out.

    The state of a code is its last emitted time, its frontier and the times
    that wait, all within ``delay``.  With ``idle_seconds`` a code without a row
    for so long in processing time emits what waits and is forgotten; it must
    not be less than ``seconds``.  Such a stream keeps running batches to look
    for idle codes, so it is not for a run that ends when its input does.
    """
    if idle_seconds is not None and idle_seconds < seconds:
        raise ValueError("a code must be remembered for as long as its cooldown lasts")

    def emit(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, frontier, waiting = state.get if state.exists else (NEVER, NEVER, [])
        times = np.array(waiting, np.int64)
        late = np.zeros(0, np.int64)
        if state.hasTimedOut:
            frontier = np.iinfo(np.int64).max
        else:
            newest = frontier
            for frame in frames:
                seen = frame["ts"].to_numpy(np.int64)
                newest = max(newest, int(seen.max()) - delay)
                late = np.concatenate([late, seen[seen < frontier]])
                times = np.union1d(times, seen[seen >= frontier])
            frontier = newest
        ready = np.searchsorted(times, frontier, "right")
        at, kept = 0, []
        while at < ready:
            if last != NEVER:
                at = max(at, int(np.searchsorted(times, last + seconds)), int(np.searchsorted(times, last, "right")))
                if at >= ready:
                    break
            last = int(times[at])
            kept.append(last)
            at += 1
        if state.hasTimedOut:
            state.remove()
        else:
            state.update((last, int(frontier), times[ready:].tolist()))
            if idle_seconds is not None:
                state.setTimeoutDuration(idle_seconds * 1000)
        yield pd.DataFrame({"code": [key[0]] * (len(kept) + len(late)), "ts": np.array([*kept, *late], np.int64), "late": [False] * len(kept) + [True] * len(late)})

    given = alerts.where("code IS NOT NULL AND ts IS NOT NULL").select("code", F.col("ts").cast("bigint").alias("ts"))
    return given.groupBy("code").applyInPandasWithState(
        emit, "code string, ts bigint, late boolean", "last bigint, frontier bigint, waiting array<bigint>", "append",
        GroupStateTimeout.NoTimeout if idle_seconds is None else GroupStateTimeout.ProcessingTimeTimeout)


def cooldown_stream(alerts: DataFrame, seconds: float = 300.0, delay: int = 0, idle_seconds: int | None = None) -> DataFrame:
    """The alerts of ``cooldown_events`` without the late rows."""
    return cooldown_events(alerts, seconds, delay, idle_seconds).where("NOT late").drop("late")


def start_cooldown(alerts: DataFrame, root: str, checkpoint: str, seconds: float = 300.0, delay: int = 0, idle_seconds: int = 86_400, once: bool = True) -> StreamingQuery:
    """Run the cooldown into two tables under ``root``: ``alerts`` and, beside it, ``late_alerts``; a replayed batch replaces its own rows.

    ``once`` drains what is there and stops; otherwise idle codes are forgotten after ``idle_seconds``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        for name, wanted in (("alerts", "NOT late"), ("late_alerts", "late")):
            (rows.where(wanted).select("code", "ts", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/{name}"))
        rows.unpersist()

    writer = cooldown_events(alerts, seconds, delay, None if once else idle_seconds).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def first_seen_stream(songs: DataFrame, watermark: str | None = None, ts: str = "seen_at") -> DataFrame:
    """One row per song id.  With an event time and a watermark the state is bounded."""
    if watermark is None:
        return songs.dropDuplicates(["song_id"])
    return songs.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["song_id"])
