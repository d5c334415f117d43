"""Filling fixed-capacity containers with items: bounded-space online best-fit.

Each task packs the items of its scan partition in one pass, without a shuffle.
It keeps a bounded number of open containers per capacity; the free spaces that
occur are the set bits of one integer, so the best fit for an item of size s is
the lowest set bit at or above s. When no open container fits and none may be
added, the fullest is closed (lowest set bit of all). Items larger than the
capacity are cut into full containers and one rest, which is packed like any
item; no other item is split.

The containers that are still open when a task ends are themselves items for a
second, far smaller pass: at most ``open_bins`` per task and capacity, grouped by
a bounded number of tasks and packed best-fit decreasing. A task writes an item's
row when its container closes, so only the rows of containers that stayed open
are joined with their new containers; all others are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietfare.llm import tokens as T
from quietfare.session import cut


#: States of a packed row: its container is closed, was open when the row was written, or the row is a container still open at the end.
CLOSED, OPEN, STILL = 0, 1, 2
#: Rows of one open container that a task holds back at most.
HELD_ROWS = 10_000


class BestFit:
    """Open containers of one capacity, at most ``open_bins`` at a time."""

    def __init__(self, capacity: int, open_bins: int, first: int = 0, step: int = 1):
        if capacity < 1 or open_bins < 1:
            raise ValueError("capacity and open_bins must be positive")
        self.capacity, self.open_bins = capacity, open_bins
        self.next, self.step = first, step
        self.bits = 0
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.count = 0
        self.closed: list[int] = []  # containers closed since the caller last emptied this list

    def _take(self, free: int) -> int:
        ids = self.by_free[free]
        found = ids.pop()
        if not ids:
            self.bits ^= 1 << free
        self.count -= 1
        return found

    def _new(self) -> int:
        found = self.next
        self.next += self.step
        return found

    def place(self, size: int) -> int:
        """The container that gets an item of ``size`` <= capacity."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            container = self._take(free)
        else:
            if self.count >= self.open_bins:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, container = self.capacity, self._new()
        left = free - size
        if left:
            self.by_free[left].append(container)
            self.bits |= 1 << left
            self.count += 1
        else:
            self.closed.append(container)
        return container

    def add(self, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(piece, container, start, length) of an item of any size."""
        piece = start = 0
        while size - start > self.capacity:
            full = self._new()
            self.closed.append(full)
            yield piece, full, start, self.capacity
            piece, start = piece + 1, start + self.capacity
        yield piece, self.place(size - start), start, size - start

    def still_open(self) -> Iterator[tuple[int, int]]:
        """(container, used) of the open ones."""
        for free, ids in self.by_free.items():
            for i in ids:
                yield i, self.capacity - free


def pack(
    df: DataFrame,
    capacities: Mapping[int, int],
    item: str = "doc_id",
    text: str | None = "text",
    size: str | None = None,
    open_bins: int = 512,
    tasks_per_group: int = 64,
    folder: str = T.TOKENIZERS,
    vocabulary: str = T.VOCABULARY,
) -> DataFrame:
    """``capacity_id``, ``container_id``, item, ``piece``, ``start``, ``size``: every item in containers of every capacity.

    The size is the token count of the whole ``text``, counted once for all
    capacities, or the column ``size`` (null and negative count as 0). Items of
    size 0 (null and empty texts) get a container too. Repeated item ids are
    separate items. ``container_id`` is unique within its capacity; ``start`` is
    the piece's first token. ``capacities`` maps ids to sizes. An empty input
    gives no row. Only the item and its size or text are read.
    """
    kind = df.schema[item].dataType.simpleString()
    path = f"{folder}/{vocabulary}"
    caps = {int(k): int(v) for k, v in capacities.items()}
    source = df.select(F.col(item).alias("item"), F.col(size or text).alias("what"))
    counted = size is not None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = None if counted else T.counter(path)
        task = TaskContext.get().partitionId()
        packers = {c: BestFit(v, open_bins, task << 40) for c, v in caps.items()}
        held: dict[int, dict[int, list[tuple]]] = {c: defaultdict(list) for c in caps}
        for batch in batches:
            sizes = batch.what.fillna(0).clip(lower=0).astype("int64") if counted else [tokens(t) for t in batch.what]
            rows: list[tuple] = []
            for i, s in zip(batch.item.astype(object), sizes, strict=True):
                for c, packer in packers.items():
                    mine = held[c]
                    for piece, container, start, length in packer.add(int(s)):
                        mine[container].append((c, container, i, piece, start, length, task, CLOSED))
                        if len(mine[container]) > HELD_ROWS:  # many empty items: let them go, marked as open
                            rows += [(*r[:-1], OPEN) for r in mine.pop(container)]
                    for container in packer.closed:
                        rows += mine.pop(container, [])
                    packer.closed.clear()
            yield pd.DataFrame(rows, columns=columns)
        rows = [(c, container, None, None, None, used, task, STILL) for c, packer in packers.items() for container, used in packer.still_open()]
        rows += [(*r[:-1], OPEN) for mine in held.values() for of in mine.values() for r in of]
        yield pd.DataFrame(rows, columns=columns).astype({"item": object, "piece": object, "start": object})

    columns = ["capacity_id", "container_id", "item", "piece", "start", "size", "task", "state"]
    placed = cut(source.mapInPandas(run, f"capacity_id int, container_id bigint, item {kind}, piece bigint, start bigint, size bigint, task int, state int"))

    def again(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        capacity = caps[int(key[0])]
        packer = BestFit(capacity, len(group) + 1)
        first: dict[int, int] = {}
        out = []
        for container, used in group.sort_values(["size", "container_id"], ascending=[False, True])[["container_id", "size"]].itertuples(index=False):
            slot = packer.place(int(used))
            out.append((int(key[0]), container, first.setdefault(slot, container)))
        return pd.DataFrame(out, columns=["capacity_id", "container_id", "merged_id"])

    rest = placed.where(F.col("state") == STILL).withColumn("part", F.floor(F.col("task") / tasks_per_group))
    merged = rest.groupBy("capacity_id", "part").applyInPandas(again, "capacity_id int, container_id bigint, merged_id bigint")
    moved = placed.where(F.col("state") == OPEN).join(merged, ["capacity_id", "container_id"], "left").withColumn("container_id", F.coalesce("merged_id", "container_id"))
    out = placed.where(F.col("state") == CLOSED).unionByName(moved.select(placed.columns))
    return out.select("capacity_id", "container_id", F.col("item").alias(item), F.col("piece").cast("int"), "start", "size")


def fill_report(packed: DataFrame, capacities: Mapping[int, int]) -> DataFrame:
    """Per capacity: containers, total size, mean fill, pieces of split items, largest content."""
    caps = F.create_map(*[F.lit(x) for pair in capacities.items() for x in pair])
    used = packed.groupBy("capacity_id", "container_id").agg(F.sum("size").alias("used"), F.count_if(F.col("piece") > 0).alias("cuts"))
    return used.groupBy("capacity_id").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("used").alias("size"), F.max("used").alias("largest"), F.sum("cuts").alias("cuts"),
    ).withColumn("capacity", caps[F.col("capacity_id")]).withColumn("fill", F.col("size") / (F.col("containers") * F.col("capacity")))
