"""Problem 9: filling containers of fixed capacity with items of varying length.

Bounded-space online best-fit: a fixed number of bins is open; a bitset keyed by free space finds the open bin that an
item fits most tightly; if none fits, a bin is opened and, where all are in use, the fullest closes first. Items above the
capacity are cut into full containers and a rest; others are never split.

Items are spread by a hash over tasks of ``containers_per_task`` containers each, which pack independently, in an order
drawn by hash; unused space is lost only in the bins that are open when a task ends. Sizes of 0 (null and empty texts) fit
anywhere. Repeated rows are packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import stage

OPEN_BINS = 64


class OpenBins:
    """Open bins by free space. ``put`` gives the container an item goes to."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free: dict[int, list[int]] = {}  # free space: numbers of open bins
        self.bits = 0  # bit f is set where a bin with f free exists
        self.open = 0
        self.opened = 0

    def _add(self, free: int, number: int) -> None:
        self.free.setdefault(free, []).append(number)
        self.bits |= 1 << free

    def _take(self, free: int) -> int:
        numbers = self.free[free]
        number = numbers.pop()
        if not numbers:
            del self.free[free]
            self.bits &= ~(1 << free)
        return number

    def put(self, size: int) -> int:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            number, free = self.opened, self.capacity
            self.opened += 1
            self.open += 1
        self._add(free - size, number)
        return number


    def place(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(part, tokens of the part, container): parts of the full capacity, each closed at once, then the rest."""
        part = 0
        while size > self.capacity:
            yield part, self.capacity, self.opened
            self.opened += 1
            size -= self.capacity
            part += 1
        yield part, size, self.put(size)


def pack(sizes: DataFrame, key: str, size: str, capacity: int, open_bins: int = OPEN_BINS, containers_per_task: int = 4000) -> DataFrame:
    """(``key``, part, tokens, container) of every item; null sizes count as 0. ``container`` is unique over all tasks."""
    kept = stage(sizes.select(F.col(key).alias("key"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size")), "sizes")
    total = kept.agg(F.sum("size")).first()[0] or 0
    tasks = max(1, math.ceil(total / capacity / containers_per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins_of: dict[int, OpenBins] = {}
        for batch in batches:
            source, parts, tokens, containers = [], [], [], []
            for i, (item, task) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for part, taken, number in bins_of.setdefault(task, OpenBins(capacity, open_bins)).place(item):
                    source.append(i)
                    parts.append(part)
                    tokens.append(taken)
                    containers.append(task << 32 | number)
            out = [batch.column(0).take(pa.array(source, pa.int32())), pa.array(parts, pa.int32()), pa.array(tokens, pa.int64()), pa.array(containers, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=["key", "part", "tokens", "container"])

    kind = kept.schema["key"].dataType.simpleString()
    spread = kept.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))
    spread = spread.repartition(tasks, "task").sortWithinPartitions("task", F.xxhash64("key", F.lit(7)), "key", "size")
    return spread.mapInArrow(run, f"key {kind}, part int, tokens bigint, container bigint").withColumnRenamed("key", key)
