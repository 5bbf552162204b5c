"""Groups of n items or of t seconds, whichever comes first (T02, T03): stateful, with timers.

Items are dealt to ``shards`` by a hash of the item, so equal items meet and no shard is hot by one key's
repeats: a group keeps each item once.  A shard's open group is its state: at most ``most`` items and one
timer, which closes the group ``seconds`` after its first item.  State is bounded by shards x most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SHARDS = 64
GROUP = "shard int, number long, n int, items array<string>, full boolean"


class CountOrTime(StatefulProcessor):
    def __init__(self, most: int, seconds: float):
        self.most, self.wait = most, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("items", "item string")
        self.number = handle.getValueState("number", "number long")

    def _close(self, shard: int, items: list[str], full: bool) -> tuple:
        number = self.number.get()[0] if self.number.exists() else 0
        self.number.update((number + 1,))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        return shard, number, len(items), items, full

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        items = [r[0] for r in self.open.get()] if self.open.exists() else []
        held, began, closed = set(items), bool(items), []
        for batch in rows:
            for item in batch["item"]:
                if item in held:
                    continue
                items.append(item)
                held.add(item)
                if len(items) == self.most:
                    closed.append(self._close(key[0], items, True))
                    items, held, began = [], set(), False
        if items:
            self.open.put([(i,) for i in items])
            if not began:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        else:
            self.open.clear()
        yield pd.DataFrame(closed, columns=["shard", "number", "n", "items", "full"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        items = [r[0] for r in self.open.get()] if self.open.exists() else []
        self.open.clear()
        closed = [self._close(key[0], items, False)] if items else []
        yield pd.DataFrame(closed, columns=["shard", "number", "n", "items", "full"])

    def close(self) -> None:
        pass


def grouped(items: DataFrame, item: str, most: int, seconds: float, shards: int = SHARDS) -> DataFrame:
    """Groups of a stream of items: shard, number (of the group in its shard, from 0), n, items in the order of
    their arrival, full (closed by count, not by time).  Needs the RocksDB state store provider."""
    dealt = items.select(F.pmod(F.xxhash64(item), F.lit(shards)).cast("int").alias("shard"), F.col(item).cast("string").alias("item"))
    return dealt.where("item IS NOT NULL").groupBy("shard").transformWithStateInPandas(
        CountOrTime(most, seconds), outputStructType=GROUP, outputMode="append", timeMode="processingTime")
