"""The stock guard: changes of stock taken in event-time order, each refused if it would leave a level below zero.

Products and warehouses are dealt to a fixed number of slots. A slot's state is the level of each of its pairs and the changes
that wait for the watermark. Once the watermark has passed a change nothing earlier can come, so waiting changes are
settled in order of time and id, however they were delivered or split over files. Refused ones leave the level as it is
and come out beside the accepted ones. A task holds the waiting changes of one slot: what comes in within the lateness
allowed. Slots, not pairs, have timers, and rows are packed in the state, so that a change costs a share of a call to it, not several.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stockyard.operators.commands import STOCK_KEY
from stockyard.streaming.rules import ALL_NOW, state_in_files

OUTCOMES = (
    "product_id bigint, warehouse_id bigint, change_id bigint, changed_at timestamp_ltz, delta bigint, "
    "accepted boolean, quantity_after bigint, reason string"
)
SLOTS = 256
#: Parts of a slot's levels, and rows in one value of waiting changes or one frame of outcomes.
BINS, PACKED_ROWS = 32, 50_000
BELOW_ZERO, NO_ROW = "stock would go negative", "no stock row"
_COLUMNS = [part.split()[0] for part in OUTCOMES.split(", ")]


def _unpacked(packed: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(packed, dtype="int64").reshape(-1, columns)


def _by_bin(rows: np.ndarray, products: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by the bin of their product, in the order they have."""
    bins = products % BINS
    order = np.argsort(bins, kind="stable")
    numbers, starts = np.unique(bins[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(rows[order], starts[1:]))


def _told(outcomes: list[tuple]) -> pd.DataFrame:
    told = pd.DataFrame(outcomes, columns=_COLUMNS).astype({"quantity_after": "Int64", "reason": object})
    return told.assign(changed_at=told["changed_at"].to_numpy().astype("datetime64[us]"))


class StockGuard(StatefulProcessor):
    """Levels and waiting changes of one slot; a single timer stands at the earliest of them.

    Both are kept as packed rows, since every call to the state is a message to the JVM: levels in ``BINS`` by product, of
    which a batch opens those of its changes, waiting changes as they came in.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "bin bigint", "packed binary")
        self.waiting = handle.getListState("waiting", "packed binary")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = initialState[[*STOCK_KEY, "quantity_on_hand"]].astype("int64").to_numpy()
        for number, part in _by_bin(rows, rows[:, 0]):
            self.levels.updateValue((number,), (self._packed_levels(number) + part.tobytes(),))  # a slot comes in several frames

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = self.timer.get()[0] if self.timer.exists() else None
        first = earliest
        for frame in rows:
            frame = frame.dropna(subset=["change_id", "delta", *STOCK_KEY])
            if frame.empty:
                continue  # ticks
            at = frame["changed_at"].astype("datetime64[us]").astype("int64")
            rest = frame[["change_id", *STOCK_KEY, "delta"]].astype("int64")
            self.waiting.appendValue((np.column_stack([at, rest]).tobytes(),))
            first = int(at.min()) if first is None else min(first, int(at.min()))
        if first is not None and first != earliest:
            self._wake(earliest, first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = 1000 * timerValues.getCurrentWatermarkInMs()
        changes = np.concatenate([_unpacked(packed, 5) for (packed,) in self.waiting.get()])
        due = changes[changes[:, 0] <= passed]
        rest = changes[changes[:, 0] > passed]
        self.waiting.clear()
        self.timer.clear()
        if len(rest):
            for start in range(0, len(rest), PACKED_ROWS):
                self.waiting.appendValue((rest[start : start + PACKED_ROWS].tobytes(),))
            self._wake(None, int(rest[:, 0].min()))
        due = due[np.lexsort(due.T[[4, 3, 2, 1, 0]])]  # time, id, and what else tells rows apart
        out: list[tuple] = []
        for number, part in _by_bin(due, due[:, 2]):
            out += self._settled(number, part)
            if len(out) >= PACKED_ROWS:
                yield _told(out)
                out = []
        if out:
            yield _told(out)

    def _packed_levels(self, number: int) -> bytes:
        found = self.levels.getValue((number,))
        return bytes(found[0]) if found else b""

    def _settled(self, number: int, changes: np.ndarray) -> list[tuple]:
        """Outcomes of one bin's changes in their order; keeps the levels they leave."""
        levels = {(product, warehouse): quantity for product, warehouse, quantity in _unpacked(self._packed_levels(number), 3).tolist()}
        out, moved = [], False
        for at, change_id, product, warehouse, delta in changes.tolist():
            pair = (product, warehouse)
            level = levels.get(pair)
            reason = NO_ROW if level is None else BELOW_ZERO if level + delta < 0 else None
            if reason is None:
                levels[pair] = level = level + delta
                moved = True
            out.append((*pair, change_id, at, delta, reason is None, level, reason))
        if moved:
            packed = np.array([(*pair, level) for pair, level in levels.items()], dtype="int64")
            self.levels.updateValue((number,), (packed.tobytes(),))
        return out

    def _wake(self, before: int | None, at: int) -> None:
        """Timers count whole milliseconds; the one before goes."""
        if before is not None:
            self.handle.deleteTimer(-(-before // 1000))
        self.handle.registerTimer(-(-at // 1000))
        self.timer.update((at,))

    def close(self) -> None:
        pass


def guarded_stock(changes: DataFrame, inventory: DataFrame, lateness: str = "1 day", slots: int = SLOTS) -> DataFrame:
    """Every change with its outcome, once the watermark has passed it (append mode).

    ``changes``: a stream of change_id, changed_at, product_id, warehouse_id, delta. ``inventory`` gives the opening levels when
    the stream first starts and is not read again. A change that comes later than ``lateness`` behind the latest one
    is dropped, see ``rules.dropped_lines``. One of a product and warehouse without a stock row is refused. A row that has only a
    time is a tick: it moves the watermark and changes nothing. Times lie between the years 1678 and 2261.
    """
    pair = [F.col(c).cast("bigint").alias(c) for c in STOCK_KEY]
    slot = F.pmod(F.xxhash64(*pair), F.lit(slots)).alias("slot")
    timed = changes.select(
        slot, *pair, "change_id", F.col("changed_at").cast("timestamp_ltz").alias("changed_at"), F.col("delta").cast("bigint").alias("delta")
    ).withWatermark("changed_at", lateness)
    opening = inventory.select(slot, *pair, F.col("quantity_on_hand").cast("bigint"))
    return timed.groupBy("slot").transformWithStateInPandas(StockGuard(), OUTCOMES, "Append", "EventTime", initialState=opening.groupBy("slot"))


def guard_stream(
    changes: DataFrame, inventory: DataFrame, folder: str, checkpoint: str, lateness: str = "1 day", trigger: dict = ALL_NOW,
    slots: int = SLOTS,
) -> StreamingQuery:
    """Write the outcomes to ``folder``, accepted and refused ones apart, each once whatever fails in between."""
    spark = changes.sparkSession
    with state_in_files(spark):
        return (
            guarded_stock(changes, inventory, lateness, slots)
            .writeStream.queryName("guard")
            .option("checkpointLocation", checkpoint)
            .partitionBy("accepted")
            .format("parquet")
            .outputMode("append")
            .trigger(**trigger)
            .start(folder)
        )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(OUTCOMES).parquet(folder)
