"""A limit on what a query may scan, checked before it runs.

The bytes are those of the files that are left after partition pruning, from the file listing of the planned scans:
no data file is opened.  A query above the limit is refused and never starts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

#: Fixed value: the default limit of a query, in bytes.
DEFAULT_LIMIT = 1 << 30


class ScanLimitError(RuntimeError):
    """``planned`` bytes are above ``limit``."""

    def __init__(self, planned: int, limit: int):
        super().__init__(f"the query would scan {planned} bytes; the limit is {limit}")
        self.planned, self.limit = planned, limit


def _file_scans(plan) -> list:
    """File scan nodes of a physical plan, also inside adaptive plans and subqueries."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return _file_scans(plan.inputPlan())
    found = [plan] if plan.getClass().getSimpleName() == "FileSourceScanExec" else []
    for group in (plan.children(), plan.subqueries()):
        for i in range(group.size()):
            found += _file_scans(group.apply(i))
    return found


def planned_bytes(df: DataFrame) -> int:
    """Bytes of the files the query's scans would open.

    Files that several scans of a query open count each time.  Pruning that waits for another side of a join
    (dynamic pruning) is not known before the query runs; what it would save is counted.
    """
    plan = df._jdf.queryExecution().executedPlan()
    return sum(scan.selectedPartitions().totalFileSize() for scan in _file_scans(plan))


def guarded(df: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """``df`` itself, or :class:`ScanLimitError` when its scans would open more than ``limit`` bytes."""
    planned = planned_bytes(df)
    if planned > limit:
        raise ScanLimitError(planned, limit)
    return df
