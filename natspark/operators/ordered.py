"""Folds of rows in order, key by key, in a stream of sorted rows: no key's rows are held together."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame


def fold_in_order(rows: DataFrame, keys: list[str], order: list[str], start: Callable[[], object], fold: Callable[[tuple, object, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fold(key, state, frame)`` of the rows of each key in ascending ``order``, some rows at a time. ``state`` comes
    from ``start`` where a key begins, and ``fold`` changes it in place. Rows are dealt by key and sorted, so a task's
    memory doesn't grow with a key; a null key is a key like others."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for frame in frames:
            of_row = list(zip(*(frame[k].astype(object).where(frame[k].notna(), None) for k in keys)))
            begin = 0
            for key, same in groupby(of_row):
                n = sum(1 for _ in same)
                if state is None or key != now:
                    now, state = key, start()
                yield fold(key, state, frame.iloc[begin : begin + n])
                begin += n

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
