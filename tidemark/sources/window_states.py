"""Stored partial states of windowed aggregates, by batch of input.

A batch adds one line per key and pane to the day folders of its panes, under its own number. A
batch that comes again replaces its lines, so nothing counts twice. Windows are made of all lines
of their panes: rows that come late for an old window change it without another look at the rows
that came before.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.windows import Measure, pane_states, windows_of_panes
from tidemark.sources.tables import overwrite_path, stored_rows

DAY, BATCH = "on_day", "batch"
DAY_MINUTES = 24 * 60


def on_day(at: Column) -> Column:
    """The UTC day of a time, as a folder name."""
    return F.date_format(at, "yyyy-MM-dd").alias(DAY)


class WindowStates:
    """States of ``measures`` per ``keys`` and pane under ``path``; windows of ``size`` minutes every ``slide``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        measures: Sequence[Measure],
        size: int,
        slide: int | None = None,
    ):
        self.spark, self.path, self.keys, self.measures = spark, path, list(keys), list(measures)
        self.size, self.slide = size, slide or size
        if size % self.slide:
            raise ValueError("the window size must be a multiple of the slide")

    def add(self, rows: DataFrame, ts: str, batch: int) -> list[str]:
        """Store the states of a batch of rows; returns the days on which a window it touched ends.

        The days are as many as the batch's times have. Rows without a time count nowhere.
        """
        states = pane_states(rows.where(F.col(ts).isNotNull()), self.keys, ts, self.measures, self.slide)
        dated = states.withColumns({DAY: on_day(F.col("pane.start")), BATCH: F.lit(batch)})
        overwrite_path(dated, self.path, (DAY, BATCH), only_touched=True)
        stored = stored_rows(self.spark, self.path)
        if stored is None:
            return []
        mine = stored.where(F.col(BATCH).cast("long") == batch).select(F.col(DAY).cast("string")).distinct()
        later = self._reach()
        return sorted({str(date.fromisoformat(r[0]) + timedelta(n)) for r in mine.collect() for n in range(later + 1)})

    def windows(self, end_days: Sequence[str] | None = None) -> DataFrame:
        """Keys, ``window`` and measures of the windows that end on these days, or of all.

        Only the day folders that hold their panes are read.
        """
        states = stored_rows(self.spark, self.path)
        if states is None:
            raise ValueError(f"nothing is stored at {self.path}")
        if end_days is not None:
            days = {str(date.fromisoformat(d) - timedelta(n)) for d in end_days for n in range(self._reach() + 1)}
            states = states.where(F.col(DAY).cast("string").isin(sorted(days)))
        found = windows_of_panes(states.drop(DAY, BATCH), self.keys, self.measures, self.size, self.slide, one_state=False)
        return found if end_days is None else found.where(on_day(F.col("window.end")).isin(list(end_days)))

    def _reach(self) -> int:
        """How many days after its pane's day a window can end."""
        return -(-self.size // DAY_MINUTES)
