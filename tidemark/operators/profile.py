"""Error profiles per time window and model, the retraining check, and feature drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.metrics import EPSILON
from tidemark.operators.windows import SKETCH_K, Measure

WHOLE_TABLE = ":table"
ALL_MODELS = "*"
INPUT_LOG = "INPUT"


def error_profile(
    df: DataFrame,
    ts: str = "timestamp",
    model: str = "model_id",
    prediction: str = "prediction",
    label: str = "fare_amount",
    granularity: str = "1 day",
) -> DataFrame:
    """Metric rows per window and model, plus one per window over all models, marked ``"*"``.

    The raw rows are aggregated once, per window and model; the all-model rows come from those
    few partial results by grouping sets, so the input is not expanded.
    """
    per_model = (
        judged_rows(df, ts, model, prediction, label)
        .groupBy(F.window("at", granularity), "model_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(c).alias(f"{c}_sum") for c in ERRORS],
            F.avg("label").alias("label_mean"),
            (F.var_pop("label") * F.count(F.lit(1))).alias("own_spread"),
        )
    )
    return _metrics_of(per_model)


ERRORS = ("abs", "sq", "pct")
#: What a window and model needs for its metrics, in a form that can be stored and added up.
PROFILE_MEASURES = (
    Measure("n", "count"),
    *(Measure(f"{c}_sum", "sum", c) for c in ERRORS),
    Measure("label_mean", "mean", "label"),
    Measure("label_std", "std", "label"),
)


def judged_rows(
    df: DataFrame, ts: str = "timestamp", model: str = "model_id", prediction: str = "prediction", label: str = "fare_amount"
) -> DataFrame:
    """``at, model_id, label`` and the errors of the predictions that have a label."""
    p, t = F.col(prediction), F.col(label)
    error = p - t
    return df.filter(p.isNotNull() & t.isNotNull()).select(
        F.col(ts).alias("at"),
        F.col(model).cast("string").alias("model_id"),
        t.alias("label"),
        F.abs(error).alias("abs"),
        (error * error).alias("sq"),
        (F.abs(error) / F.greatest(F.abs(t), F.lit(EPSILON))).alias("pct"),
    )


def profile_of_states(windows: DataFrame) -> DataFrame:
    """The metric rows of :func:`error_profile` from windows of ``PROFILE_MEASURES`` per model."""
    spread = F.coalesce(F.col("label_std") * F.col("label_std") * (F.col("n") - 1), F.lit(0.0))
    return _metrics_of(windows.withColumn("own_spread", spread))


def _metrics_of(per_model: DataFrame) -> DataFrame:
    """Metric rows from sums per window and model."""
    # Spread of the labels around the mean of the whole window, from the per-model moments.
    same_window = Window.partitionBy("window")
    window_mean = F.sum(F.col("n") * F.col("label_mean")).over(same_window) / F.sum("n").over(same_window)
    off = F.col("label_mean") - window_mean
    per_model = per_model.withColumn("shared_spread", F.col("own_spread") + F.col("n") * off * off)
    window, model_id = F.col("window"), F.col("model_id")
    sums = per_model.groupingSets([[window, model_id], [window]], window, model_id).agg(
        F.grouping("model_id").alias("all_models"),
        *[F.sum(c).alias(c) for c in ("n", "abs_sum", "sq_sum", "pct_sum", "own_spread", "shared_spread")],
    )
    everything = F.col("all_models") == 1
    spread = F.when(everything, F.col("shared_spread")).otherwise(F.col("own_spread"))
    mse = F.col("sq_sum") / F.col("n")
    return sums.select(
        "window",
        F.lit(WHOLE_TABLE).alias("column_name"),
        F.lit(None).cast("string").alias("slice_key"),
        F.when(everything, F.lit(ALL_MODELS)).otherwise(model_id).alias("model_id"),
        F.lit(INPUT_LOG).alias("log_type"),
        F.col("n").alias("count"),
        (F.col("abs_sum") / F.col("n")).alias("mean_average_error"),
        mse.alias("mean_squared_error"),
        F.sqrt(mse).alias("root_mean_squared_error"),
        (F.col("pct_sum") / F.col("n")).alias("mean_absolute_percentage_error"),
        (F.lit(1.0) - F.try_divide(F.col("sq_sum"), spread)).alias("r2_score"),
    )


def monitored_rows(profile: DataFrame) -> DataFrame:
    """Metric rows of single models over the whole primary table."""
    return profile.filter(
        (F.col("column_name") == WHOLE_TABLE)
        & F.col("slice_key").isNull()
        & (F.col("model_id") != ALL_MODELS)
        & (F.col("log_type") == INPUT_LOG)
    )


def recent_windows(profile: DataFrame, metric: str = "root_mean_squared_error", windows: int = 5) -> DataFrame:
    """The newest ``windows`` metric rows; equal windows order by model id."""
    return (
        monitored_rows(profile)
        .select("window", "model_id", metric)
        .orderBy(F.col("window").desc(), F.col("model_id"))
        .limit(windows)
    )


def _verdict(metric: str, threshold: float, violations: int, newest: Column) -> Column:
    above = F.count_if(F.col(metric) > threshold) >= violations
    return F.when(above & (newest > threshold), 1).otherwise(0).cast("int")


def violation_check(
    profile: DataFrame,
    metric: str = "root_mean_squared_error",
    threshold: float = 100.0,
    windows: int = 5,
    violations: int = 2,
) -> DataFrame:
    """One row, ``query_result`` 1 when the newest metric row and enough recent ones exceed
    the threshold, else 0."""
    ranked = recent_windows(profile, metric, windows).withColumn(
        # Newest first; on equal windows the smaller model id counts as newer.
        "__rank", F.row_number().over(Window.orderBy(F.col("window").desc(), F.col("model_id")))
    )
    newest = F.max(F.when(F.col("__rank") == 1, F.col(metric)))
    return ranked.agg(_verdict(metric, threshold, violations, newest).alias("query_result"))


def violation_by_model(
    profile: DataFrame,
    metric: str = "root_mean_squared_error",
    threshold: float = 100.0,
    windows: int = 5,
    violations: int = 2,
) -> DataFrame:
    """The same check for each model on its own newest windows."""
    newest_first = Window.partitionBy("model_id").orderBy(F.col("window").desc())
    ranked = (
        monitored_rows(profile)
        .select("window", "model_id", metric)
        .withColumn("__rank", F.row_number().over(newest_first))
        .filter(F.col("__rank") <= windows)
    )
    newest = F.max(F.when(F.col("__rank") == 1, F.col(metric)))
    return ranked.groupBy("model_id").agg(_verdict(metric, threshold, violations, newest).alias("query_result"))


def is_violated(check: DataFrame) -> bool:
    """Read the one-row result of :func:`violation_check`."""
    return bool(check.first()["query_result"])


def _bucket(column: str, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value: 0 under the first, ``len(edges)`` from the last on."""
    cases = " ".join(f"WHEN `{column}` < {float(edge)!r}D THEN {i}" for i, edge in enumerate(edges))
    return F.expr(f"CASE WHEN `{column}` IS NULL THEN NULL {cases} ELSE {len(edges)} END")


def drift(
    df: DataFrame,
    ts: str,
    column: str,
    edges: Sequence[float],
    baseline_end: str,
    granularity: str = "1 day",
    fraction: float = 0.5,
) -> DataFrame:
    """:func:`drift_of_columns` for one column, without its name."""
    return drift_of_columns(df, ts, {column: edges}, baseline_end, granularity, fraction).drop("column_name")


def drift_of_columns(
    df: DataFrame,
    ts: str,
    edges: Mapping[str, Sequence[float]],
    baseline_end: str,
    granularity: str = "1 day",
    fraction: float = 0.5,
    accuracy: int = 10_000,
) -> DataFrame:
    """Per window and column: rows, nulls, mean, a percentile and the population stability index.

    The index compares the window's shares of the column's fixed buckets with those of all rows
    before ``baseline_end``: sum of (share - base) * ln(share / base), where each share is
    smoothed by half a row per bucket. The percentile is a value of the column, found with a
    rank error of one in ``accuracy`` (exact in windows with fewer rows). All columns come from
    one aggregate of the rows; the baseline is a second one, over the earlier rows only.
    """
    placed = df.select(
        ts, *edges, *[_bucket(c, e).alias(f"__cell{n}") for n, (c, e) in enumerate(edges.items())]
    )

    def counts(n: int, cells: int) -> Column:
        return F.array(*[F.count_if(F.col(f"__cell{n}") == i) for i in range(cells)])

    base = placed.where(F.col(ts) < F.lit(str(baseline_end))).agg(
        F.struct(*[counts(n, len(e) + 1).alias(f"b{n}") for n, e in enumerate(edges.values())]).alias("base")
    )
    wide = placed.groupBy(F.window(ts, granularity)).agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.avg(c).alias("mean"),
                F.percentile_approx(c, fraction, accuracy).cast("double").alias("percentile"),
                counts(n, len(e) + 1).alias("cells"),
            ).alias(f"c{n}")
            for n, (c, e) in enumerate(edges.items())
        ]
    )
    one_base = base.scalar()
    each = [F.struct(f"c{n}.*", one_base.getField(f"b{n}").alias("base")) for n in range(len(edges))]
    lines = wide.select("window", F.inline(F.array(*each)))

    def shares(cells: str) -> Column:
        total = F.aggregate(cells, F.lit(0).cast("long"), lambda a, n: a + n)
        return F.transform(cells, lambda n: (n + 0.5) / (total + 0.5 * F.size(cells)))

    terms = F.zip_with("p", "q", lambda p, q: (p - q) * F.log(p / q))
    return lines.withColumns({"p": shares("cells"), "q": shares("base")}).select(
        "window",
        "column_name",
        "rows",
        "nulls",
        "mean",
        "percentile",
        F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("stability_index"),
    )


RANK_STEPS = 1024  # ranks told apart when two sketches are compared; a power of two, so that ranks are exact


def sketch_measures(columns: Sequence[str]) -> list[Measure]:
    """What :func:`drift_of_sketches` needs of a window: rows, and of each column the mean and a quantile sketch."""
    each = [(Measure(f"mean_{c}", "mean", c), Measure(f"sketch_{c}", "sketch", c)) for c in columns]
    return [Measure("rows", "count"), *(m for pair in each for m in pair)]


def _told(windows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A line per window and column, with the number of values and their sketch."""
    lines = [
        F.struct(F.lit(c).alias("column_name"), "rows", F.col(f"mean_{c}").alias("mean"), F.col(f"sketch_{c}").alias("sketch"))
        for c in columns
    ]
    told = windows.select("window", F.inline(F.array(*lines)))
    return told.withColumn("values", F.kll_sketch_get_n_double("sketch"))


def _baseline(told: DataFrame, end: str) -> DataFrame:
    """A line per column: the sketches of the windows that end by then, as one."""
    early = told.where((F.col("window.end") <= F.lit(str(end))) & (F.col("values") > 0))
    return early.groupBy(F.col("column_name").alias("base_of")).agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("base"))


def _fractions(parts: int) -> Column:
    return F.array(*[F.lit(i / parts) for i in range(1, parts)])


def drift_of_sketches(
    windows: DataFrame, columns: Sequence[str], baseline_end: str, fraction: float = 0.5, points: int = 64
) -> DataFrame:
    """Per window and column: rows, nulls, mean, smallest, largest, a percentile, distance to the baseline.

    ``windows`` hold :func:`sketch_measures`; no row is read again. ``distance`` is the largest
    difference between the shares of values up to a point, in steps of 1/1024, in the window and in all
    windows that end by ``baseline_end``, over the points that cut either into ``points`` equal parts.
    Ranks are off by about one in a thousand, by nothing where a sketch holds no more values than its
    size. Columns
    without values, and windows without a baseline, have nulls there; a NaN counts as a null.
    """
    told = _told(windows, columns)
    base = _baseline(told, baseline_end)  # as many lines as columns
    lines = told.join(F.broadcast(base), F.col("column_name") == F.col("base_of"), "left")
    known = F.col("values") > 0
    steps = F.array(*[F.lit(i / RANK_STEPS) for i in range(1, RANK_STEPS + 1)])
    lines = lines.withColumns({c: F.when(known, F.kll_sketch_get_quantile_double(s, steps)) for c, s in (("__own", "sketch"), ("__base", "base"))})
    every = RANK_STEPS // points
    at = F.array_union(*[F.filter(c, lambda _, n: (n + 1) % every == 0) for c in ("__own", "__base")])

    def share(cuts: str, value: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut <= value)) / F.lit(float(RANK_STEPS))

    apart = F.array_max(F.transform(at, lambda value: F.abs(share("__own", value) - share("__base", value))))
    quantile = lambda share: F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))
    return lines.select(
        "window",
        "column_name",
        "rows",
        (F.col("rows") - F.col("values")).alias("nulls"),
        "mean",
        quantile(0.0).alias("smallest"),
        quantile(1.0).alias("largest"),
        quantile(fraction).alias("percentile"),
        F.when(known & F.col("base").isNotNull(), apart).alias("distance"),
    )


def baseline_edges(windows: DataFrame, columns: Sequence[str], baseline_end: str, buckets: int = 10) -> dict[str, list[float]]:
    """By column, edges that cut the baseline's values into about equal buckets, for :func:`drift_of_columns`."""
    base = _baseline(_told(windows, columns), baseline_end)
    cut = base.select("base_of", F.array_distinct(F.kll_sketch_get_quantile_double("base", _fractions(buckets))).alias("edges"))
    return {r.base_of: list(r.edges) for r in cut.collect()}  # as many lines as columns
