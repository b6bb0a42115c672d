"""Comparing the rows of a group with each other when a group may hold any share of all rows.

A group of more than ``limit`` rows is dealt by a hash of the row's id into blocks of about
that size. Each pair of blocks is a task of its own, and so is each block with itself; a row
takes part in one task for each block of its group, and no pair of rows is ever written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wxengine.llm.memory import give_back


def comparison_tasks(
    rows: DataFrame,
    group: list[str],
    id_col: str,
    limit: int,
    weight: Column | None = None,
    mixed: str | None = None,
) -> DataFrame:
    """Rows of groups with at least two, with the columns ``_task`` and ``_side``.

    A task on a single block has side 0; in one on two blocks each row has its block's side,
    1 or 2. ``weight`` lets heavy rows make for more blocks. With ``mixed`` groups that have
    only one value in that column are left out.
    """
    measure = F.sum(weight) if weight is not None else F.count("*")
    measures = [F.count("*").alias("_n"), measure.alias("_weight")]
    if mixed is not None:
        measures.append((F.min(mixed) < F.max(mixed)).alias("_mixed"))
    sizes = rows.groupBy(*group).agg(*measures)
    if mixed is not None:
        sizes = sizes.where("_mixed")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_weight") / F.lit(float(limit)))).cast("int")
    sizes = sizes.where("_n > 1").select(*group, blocks.alias("_blocks"))
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(id_col)), F.col("_blocks")).cast("int")
    placed = rows.join(sizes, group).withColumn("_own", own)
    dealt = placed.withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - F.lit(1)))
    )
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return dealt.select(
        *rows.columns,
        F.xxhash64(*group, low, high).alias("_task"),
        F.when(low == high, 0).when(F.col("_own") == low, 1).otherwise(2).alias("_side"),
    )


def run_tasks(
    tasks: DataFrame,
    function: Callable[[pd.DataFrame, list[tuple[int, int]]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Hand each task's rows to ``function``, many small tasks in one call.

    Rows are dealt and sorted by task and stream through; ``function`` gets a frame of whole
    tasks and where each begins and ends. Only a task that is cut by the end of a batch waits
    for the next, so memory holds a batch and a task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def whole(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            task = frame["_task"].to_numpy()
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            return function(frame, list(pairwise(cuts)))

        for frame in frames:
            if not len(frame):
                continue
            task = frame["_task"].to_numpy()
            if waiting and waiting[0]["_task"].iloc[0] == task[-1]:
                waiting.append(frame)
                continue
            last = int(np.argmax(task == task[-1]))
            head = pd.concat([*waiting, frame.iloc[:last]], ignore_index=True)
            waiting = [frame.iloc[last:]]
            if len(head):
                yield from whole(head)
        if waiting:
            yield from whole(pd.concat(waiting, ignore_index=True))
        give_back()

    dealt = tasks.repartition("_task").sortWithinPartitions("_task")
    return dealt.mapInPandas(run, schema)


def sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to compare with each other; both are the same array in a task on one block."""
    if not side.any():
        own = np.arange(len(side))
        return own, own
    return np.flatnonzero(side == 1), np.flatnonzero(side == 2)


class Links:
    """Classes among the rows of one task; what it found goes on as a star per class."""

    def __init__(self, ids: list[int]) -> None:
        self.ids = np.asarray(ids)
        self.label = np.arange(len(self.ids))

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            if self.ids[b] < self.ids[a]:
                a, b = b, a
            self.label[self.label == b] = a

    def join_all(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join pairs, leaving out those that are in one class by the time they come up."""
        while len(i):
            apart = self.label[i] != self.label[j]
            i, j = i[apart], j[apart]
            for a, b in zip(i[:32].tolist(), j[:32].tolist(), strict=True):
                self.join(a, b)
            i, j = i[32:], j[32:]

    def star(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the smallest ids of their classes, of rows that are not the smallest."""
        other = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.ids[other], self.ids[self.label[other]]
