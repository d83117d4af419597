"""Aggregates per entity and time window.

A sliding window puts every row into ``size / slide`` windows. Expanding the raw rows that
often is the dominant cost on dense data, so rows are first combined into panes one slide
wide, and only the panes are expanded. Both steps are ordinary partial + final aggregates:
a hot entity collapses before the shuffle in each map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One output column of a windowed aggregate: ``kind`` of ``column``, called ``name``.

    The kind ``newest`` takes the value of the row with the largest ``by``.
    """

    name: str
    kind: str
    column: str = "*"
    by: str = ""

    def direct(self) -> Column:
        """The aggregate over raw rows."""
        if self.kind == "newest":
            return F.max_by(self.column, self.by).alias(self.name)
        return _DIRECT[self.kind](self.column).alias(self.name)

    def partials(self) -> list[Column]:
        """What a pane must keep so that panes can be combined later."""
        c, n = self.column, self.name
        if self.kind == "count":
            return [_DIRECT["count"](c).alias(f"{n}__n")]
        if self.kind == "mean":
            return [F.sum(c).alias(f"{n}__sum"), F.count(c).alias(f"{n}__n")]
        if self.kind == "std":
            moments = (F.count(c).cast("double"), F.avg(c), F.var_pop(c) * F.count(c))
            return [m.alias(f"{n}__{part}") for m, part in zip(moments, _MOMENTS, strict=True)]
        if self.kind == "newest":
            return [F.max_by(c, self.by).alias(n), F.max(self.by).alias(f"{n}__by")]
        if self.kind == "sketch":
            return [self.direct().alias(f"{n}__sketch")]
        return [self.direct()]

    def merged(self, panes: int = 0) -> Column:
        """The aggregate over panes; equals ``direct`` over their rows.

        ``panes`` is how many different ones a group can hold, numbered by ``__pane``; 0 if a pane
        may have several states.
        """
        n = self.name
        if self.kind == "count":
            out = F.sum(f"{n}__n")
        elif self.kind == "mean":
            out = F.try_divide(F.sum(f"{n}__sum"), F.sum(f"{n}__n"))
        elif self.kind == "std":
            out = _deviation([f"{n}__{part}" for part in _MOMENTS], panes)
        elif self.kind == "newest":
            out = F.max_by(n, f"{n}__by")
        elif self.kind == "sketch":
            out = F.kll_merge_agg_double(f"{n}__sketch", SKETCH_K)
        else:
            out = _DIRECT[self.kind](n)
        return out.alias(n)


# Size of a quantile sketch: ranks are off by about one in a thousand, by nothing up to so many rows.
SKETCH_K = 4096


def _sketch(column: str) -> Column:
    """A mergeable sketch of the values, without nulls and NaN."""
    value = F.col(column).cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), SKETCH_K)


_MOMENTS = ("n", "mean", "spread")
_NUMBERED = 8
_DIRECT = {
    "count": lambda c: F.count(F.lit(1) if c == "*" else c),
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "sketch": _sketch,
}


def _deviation(moments: Sequence[str], panes: int) -> Column:
    """Sample deviation from the moments of the panes of a group, of which there are a few.

    Spreads about different means add up with a term for the distance of the means, so that
    nothing is lost by taking the difference of large sums. Up to ``_NUMBERED`` panes have columns
    of their own in the aggregate; a list of them costs several times as much.
    """
    if 0 < panes <= _NUMBERED:
        of_pane = [F.struct(*[F.max(F.when(F.col("__pane") == i, F.col(m))).alias(k) for m, k in zip(moments, _MOMENTS, strict=True)]) for i in range(panes)]
        states = F.array(*of_pane)
    else:
        states = F.collect_list(F.struct(*[F.col(m).alias(k) for m, k in zip(moments, _MOMENTS, strict=True)]))
    none = F.struct(*[F.lit(0.0).alias(k) for k in _MOMENTS])

    def joined(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = b["n"] / n
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["spread"] + b["spread"] + apart * apart * a["n"] * share).alias("spread"),
        )

    def ended(all_rows: Column) -> Column:
        return F.when(all_rows["n"] > 1, F.sqrt(all_rows["spread"] / (all_rows["n"] - 1)))

    return F.aggregate(F.filter(states, lambda m: m["n"] > 0), none, joined, ended)


def time_window(ts: str | Column, size: int, slide: int | None = None) -> Column:
    """Half-open window of ``size`` minutes every ``slide`` minutes on the epoch grid."""
    return F.window(ts, f"{size} minutes", f"{slide or size} minutes")


def windowed_agg(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    measures: Sequence[Measure],
    size: int,
    slide: int | None = None,
    panes: bool = True,
) -> DataFrame:
    """Group by ``keys`` and time window; gives keys, a ``window`` struct and the measures.

    Empty windows give no row and rows without a timestamp count nowhere.

    Panes are used when the windows overlap. With about one row per pane they cost an extra
    shuffle, which ``panes=False`` saves. Streams need it too (one stateful step).
    """
    slide = slide or size
    if not (panes and slide < size and size % slide == 0):
        return df.groupBy(*keys, time_window(ts, size, slide)).agg(*[m.direct() for m in measures])
    return windows_of_panes(pane_states(df, keys, ts, measures, slide), keys, measures, size, slide)


def pane_states(df: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[Measure], slide: int) -> DataFrame:
    """What every measure needs of each ``slide`` minutes: keys, ``pane`` and the partial states.

    Rows of one key and pane may come from several calls; their windows come out right all the same.
    """
    return df.groupBy(*keys, time_window(ts, slide).alias("pane")).agg(*[p for m in measures for p in m.partials()])


def windows_of_panes(
    panes: DataFrame, keys: Sequence[str], measures: Sequence[Measure], size: int, slide: int, one_state: bool = True
) -> DataFrame:
    """The measures of each window from the states of its panes; say if a pane may have several."""
    placed = panes.withColumn("window", time_window(F.col("pane.start"), size, slide))
    number = F.timestamp_diff("MINUTE", F.col("window.start"), F.col("pane.start")) / slide
    count = size // slide if one_state else 0
    return placed.withColumn("__pane", number.cast("int")).groupBy(*keys, "window").agg(*[m.merged(count) for m in measures])
