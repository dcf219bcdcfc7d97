"""The best rows per query: running state inside a task, and the cut across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1   # stands for a null id while ranking


class Best:
    """The ``top`` best rows of each query so far: higher scores first, ties by smaller id.

    ``least`` holds the score that a row needs to count for its query: the
    given floor, later the score of the query's last row.
    """

    def __init__(self, floor: np.ndarray, top: int):
        self.top, self.least = top, floor.copy()
        self.query, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        ok = score >= self.least[query]
        if not ok.any():
            return
        query, score, ids = (np.concatenate(x) for x in ((self.query, query[ok]), (self.score, score[ok]), (self.id, ids[ok])))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.nonzero(np.r_[True, query[1:] != query[:-1]])[0]
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        keep = place < self.top
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        last = place == self.top - 1
        self.least[query[last]] = np.maximum(self.least[query[last]], score[last])


def best_rows(found: DataFrame, by: list[str], top: int, groups: int = 64) -> DataFrame:
    """(``by``, score, id, rank): the best rows of all tasks, cut in ``groups`` of tasks first."""

    def cut(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    first = cut(found.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(groups))), *by, "__group")
    return cut(first.drop("rank", "__group"), *by)
