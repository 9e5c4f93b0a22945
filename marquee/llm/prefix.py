"""Distributed prefix sums: running totals before each row of an ordered group.

Rows are dealt to ranges of (group, order), so a group that holds a third of
all rows spans a third of the ranges. Each task sums its own range row by row;
one total per (range, group) is summed over the earlier ranges of the group,
and is added back. No group meets in one task, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import partitions, written


def _running(batches: Iterator[pa.RecordBatch], group: str, value: str) -> Iterator[pa.RecordBatch]:
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        names = batch.schema.names
        keys = batch.column(names.index(group))
        codes = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        values = batch.column(names.index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(values) - values
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        base = np.repeat(before[first], np.diff(np.append(first, n)))
        before -= base
        if keys[0].as_py() == last:
            before[: first[1] if len(first) > 1 else n] += carried
        last, carried = keys[n - 1].as_py(), int(before[-1] + values[-1])
        columns = [*batch.columns, pa.array(before), pa.array(np.full(n, part, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "in_part", "part"])


def ranged(df: DataFrame, group: str, order: tuple[str, ...], value: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, totals): the rows with ``part`` (their range) and ``in_part`` (the
    sum of ``value`` over the earlier rows of the group in that range), and one
    row per (part, group) with ``offset``, the sum over the group's earlier ranges.

    ``group`` is a string column without nulls; ``value`` is not null. Rows that
    are equal in group and order are taken in any one order.
    """
    keys = [F.col(group), *map(F.col, order)]
    sorted_rows = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, in_part long, part int"
    rows = written(sorted_rows.mapInArrow(lambda it: _running(it, group, value), schema), name)
    totals = rows.groupBy("part", group).agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("offset", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    return rows, totals.drop("total")
