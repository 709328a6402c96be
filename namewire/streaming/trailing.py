"""Counts that rise and fall: mentions of the last hour, kept by state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from namewire.operators.windows import HOUR, MINUTE
from namewire.session import use_rocksdb_state

_MS = 1000


class TrailingCounter(StatefulProcessor):
    """The count of one name over the last ``size`` seconds, told at every tick at which it changes.

    State of a name: its mentions by slot (of ``slide`` seconds) as far as those can still count, the last
    tick that was dealt with, the count told there, and the tick of the one timer that is set: the
    next at which the count can change, be it a slot that ends or one that leaves the window. When it
    expires, all ticks up to the watermark are told and the next timer is set. A name whose last slot
    has left is told as 0 and has no state any more.
    """

    def __init__(self, size: int = HOUR, slide: int = MINUTE):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        longs, long = ArrayType(LongType()), LongType()
        self.state = handle.getValueState("slots", StructType([
            StructField("slots", longs), StructField("counts", longs), StructField("dealt_with", long),
            StructField("told", long), StructField("timer", long)]))

    def _ticks(self, slots: list[int], after: int) -> list[int]:
        """Ticks past ``after`` at which some slot enters or leaves the window, in order."""
        steps = (self.slide, self.size + self.slide)
        return sorted({slot + step for slot in slots for step in steps if slot + step > after})

    def _hold(self, slots: dict[int, int], dealt_with: int, told: int, timer: int) -> None:
        """Keeps the state and sees that the timer of the next tick is set."""
        due = self._ticks(list(slots), dealt_with)[0]
        if due != timer:
            if timer > dealt_with:
                self.handle.deleteTimer(timer * _MS)
            self.handle.registerTimer(due * _MS)
        self.state.update((list(slots), list(slots.values()), dealt_with, told, due))

    def _held(self) -> tuple[dict[int, int], int, int, int]:
        if not self.state.exists():
            return {}, 0, 0, 0
        slots, counts, dealt_with, told, timer = self.state.get()
        return dict(zip(slots, counts)), dealt_with, told, timer

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        slots, dealt_with, told, timer = self._held()
        for row in rows:
            slots[row.slot] = slots.get(row.slot, 0) + row.cnt
        self._hold(slots, dealt_with, told, timer)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) // _MS
        slots, dealt_with, told, timer = self._held()
        order = sorted(slots)
        entering = leaving = cnt = 0
        for tick in self._ticks(order, dealt_with):
            if tick > now:
                break
            while entering < len(order) and order[entering] < tick:
                cnt += slots[order[entering]]
                entering += 1
            while leaving < entering and order[leaving] < tick - self.size:
                cnt -= slots[order[leaving]]
                leaving += 1
            if cnt != told:
                yield Row(name=key[0], tick=tick, cnt=cnt)
            dealt_with, told = tick, cnt
        left = {slot: slots[slot] for slot in order[leaving:]}
        if left:
            self._hold(left, dealt_with, told, timer)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def live_trailing_counts(mentions: DataFrame, size: int = HOUR, slide: int = MINUTE, late: str = "10 minutes") -> DataFrame:
    """Changelog (name, tick, cnt): mentions of a name in ``[tick - size, tick)``, wherever that changes.

    Ticks are multiples of ``slide``; one is told once the watermark, ``late`` behind the newest mention,
    has passed it. A name that nobody mentions falls, and is told as 0 once its last mention is
    ``size`` old. Mentions (ts, name) are counted by slot first, partly in the map tasks, and a slot is handed
    on when the watermark has passed it, which is when its tick is due: a hot name is one row a slot for the
    processor, whose state is bounded by the slots of ``size``. Later mentions, and rows without a name or
    time, drop out. Two stateful operators: run it in append mode.
    """
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    use_rocksdb_state(mentions.sparkSession)
    counts = (
        mentions.where("ts is not null and name is not null").withWatermark("ts", late)
        .groupBy(F.window("ts", f"{slide} seconds").alias("_slot"), "name").agg(F.count("*").alias("cnt"))
    )
    slots = counts.select("name", F.window_time("_slot").alias("ts"), F.unix_seconds("_slot.start").alias("slot"), "cnt")
    return slots.groupBy("name").transformWithState(
        TrailingCounter(size, slide), "name string, tick bigint, cnt bigint", "append", "EventTime",
    ).withColumn("tick", F.timestamp_seconds("tick"))
