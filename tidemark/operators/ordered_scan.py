"""Newest offered row so far, over rows sorted by key and time across all tasks.

Rows are dealt out by ranges of (key, time), so a key that owns most of them lies in as many tasks
as it needs. Each task scans its range once and in order, a batch at a time and by whole columns,
and remembers one offered row per kind. What it cannot know is the newest offered row of the key
that is open where its range begins. So a task also says what it ended with: a *border* row for
the key its range begins with and one for the key it ends with. They are a handful for each task,
and carry the missing values over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import cut_lineage

ASKED, BORDER, OPENS, TASK = "__asked", "__border", "__opens", "__task"


def newest_so_far(marks: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """For every asked row the newest non-null value at or before it, of each column in ``values``.

    ``marks`` has ``keys`` (null equals null), the time ``at``, a boolean ``__asked`` and the value
    columns, which are null in asked rows. An asked ``(keys, at)`` stands once. The job fails on a
    second value of one column at the same key and time. Rows without any value are left out.
    """
    dealt = marks.repartitionByRange(*keys, at).sortWithinPartitions(*keys, at, ASKED)
    columns = [*keys, at, *values]
    fields = [marks.schema[c] for c in columns]
    fields += [T.StructField(c, T.BooleanType()) for c in (BORDER, OPENS)]
    schema = T.StructType([*fields, T.StructField(TASK, T.IntegerType())])
    scan = partial(_scan, len(keys), len(values))
    found = cut_lineage(dealt.select(*columns, ASKED).mapInArrow(scan, schema), "newest")
    earlier = Window.partitionBy(*keys).orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(v, ignorenulls=True).over(earlier).alias(f"{v}__carried") for v in values]
    carry = found.where(BORDER).select(F.col(TASK).alias("__of"), OPENS, *carried).where(OPENS).drop(OPENS)
    # One row per task at most, so its size is bounded by the number of shuffle partitions.
    rows = found.where(~F.col(BORDER)).join(F.broadcast(carry), F.when(F.col(OPENS), F.col(TASK)) == F.col("__of"), "left")
    out = rows.select(*keys, at, *[F.coalesce(v, f"{v}__carried").alias(v) for v in values])
    return out.where(reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values]))


def _scan(n_keys: int, n_values: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan one range. Columns come in order: keys, time, values, whether the row asks."""
    task = TaskContext.get().partitionId()
    held: pa.Table | None = None  # newest offered rows of the open key, and the last row
    opening = True  # whether the key of the range's first row is still open
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        columns, asked = rows.columns[:-1], rows.column(rows.num_columns - 1).to_numpy()
        run = _numbered(columns[:n_keys])
        instant = _numbered(columns[: n_keys + 1])
        here = np.arange(len(run))
        newest = []
        for value in columns[n_keys + 1 :]:
            offered = np.flatnonzero(value.is_valid().to_numpy())
            if np.any(instant[offered[1:]] == instant[offered[:-1]]):
                raise ValueError("duplicate feature key: two rows of one key and time")
            latest = np.full(len(run), -1)
            latest[offered] = offered
            latest = np.maximum.accumulate(latest)
            newest.append(np.where((latest >= 0) & (run[latest] == run), latest, -1))
        opens = (run == 0) & opening
        known = np.any(np.array(newest) >= 0, axis=0) | opens
        yield _answers(columns, n_keys, newest, here[asked & known], opens, False, task)
        if opening and run[-1] > 0:
            yield _answers(columns, n_keys, newest, np.flatnonzero(run == 0)[-1:], opens, True, task)
            opening = False
        keep = np.unique([len(run) - 1, *(n[-1] for n in newest if n[-1] >= 0)])
        last = rows.num_columns - 1
        held = rows.take(pa.array(keep)).set_column(last, rows.schema.field(last), pa.array(np.zeros(len(keep), bool)))
    if held is not None:
        columns = held.combine_chunks().columns[:-1]
        newest = []
        for value in columns[n_keys + 1 :]:
            offered = np.flatnonzero(value.is_valid().to_numpy())
            newest.append(np.full(len(held), offered[-1] if len(offered) else -1))
        end = np.array([len(held) - 1])
        yield _answers(columns, n_keys, newest, end, np.full(len(held), opening), True, task)


def _numbered(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """Sorted rows numbered by distinct values of the columns; nulls are equal."""
    changes = np.zeros(len(columns[0]), bool)
    for column in columns:
        differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), False).to_numpy()
        missing = column.is_null().to_numpy()
        changes[1:] |= differs | (missing[1:] != missing[:-1])
    return np.cumsum(changes)


def _answers(
    columns: list[pa.ChunkedArray], n_keys: int, newest: list[np.ndarray], rows: np.ndarray, opens: np.ndarray, border: bool, task: int
) -> pa.RecordBatch:
    """The named rows with the newest values, or the border row of a key."""
    out = [c.take(pa.array(rows)) for c in columns[: n_keys + 1]]
    for value, at in zip(columns[n_keys + 1 :], newest, strict=True):
        out.append(value.take(pa.array(at[rows], mask=at[rows] < 0)))
    out = [c.combine_chunks() for c in out]
    out = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out]
    out += [pa.array(np.full(len(rows), border)), pa.array(opens[rows]), pa.array(np.full(len(rows), task, np.int32))]
    names = [f"c{i}" for i in range(len(out))]
    return pa.RecordBatch.from_arrays(out, names)
