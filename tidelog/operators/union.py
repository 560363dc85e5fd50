"""The logical view as a UNION ALL of physical legs.

``view_steady``   read ∪ active write (normal operation);
``view_extended`` read ∪ active write ∪ standby write (while a compaction
                  moves the old write leg into the read leg).

Both project every leg onto the same column list first (data columns in
declared order, then the exposed partitions), then union by name without
de-duplication. Filters on the view are pushed into every leg by the
optimizer, and filters on ``dt``/``appid`` prune directories in each leg.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidelog.operators.write import quoted


def union_view(legs: list[DataFrame], columns: list[str]) -> DataFrame:
    if not legs:
        raise ValueError("a view needs at least one leg")
    return reduce(lambda a, b: a.unionByName(b), [leg.select(*map(quoted, columns)) for leg in legs])


def view_steady(read: DataFrame, write: DataFrame, columns: list[str]) -> DataFrame:
    return union_view([read, write], columns)


def view_extended(read: DataFrame, write_active: DataFrame, write_standby: DataFrame,
                  columns: list[str]) -> DataFrame:
    return union_view([read, write_active, write_standby], columns)
