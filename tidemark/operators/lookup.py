"""Point-in-time lookup: the newest feature row at or before each row's own time.

Base rows are many and wide, and one key may own a large share of them, so they are neither
sorted nor gathered by key. The lookups are resolved on *instants* instead:

1. the distinct ``(key, time)`` pairs asked for, of all lookups in one read of the base rows and
   collapsed before the shuffle. Lookups with the same key and time columns share theirs;
2. for each of them the newest feature row so far, by one ordered scan of the instants and the
   feature rows of all lookups together (see ``ordered_scan``): a key lies in as many tasks as
   its rows need;
3. one equality join of the base rows on ``(key, time)`` for each pair of key and time columns.
   A hot pair on the base side is split by adaptive skew-join handling, and Spark broadcasts
   the answers when their size is under its broadcast limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keys import unique_rows
from tidemark.operators.ordered_scan import ASKED, newest_so_far

_AT, _PAIR = "__at", "__pair"


@dataclass(frozen=True)
class FeatureLookup:
    """Which columns to fetch from a feature table, and how to match it to the base rows.

    ``lookup_key`` and ``timestamp_lookup_key`` are base columns; they pair, in order, with
    the table's ``primary_keys`` and ``timestamp_key``. ``rename`` maps fetched names.
    """

    features: DataFrame
    feature_names: Sequence[str]
    lookup_key: Sequence[str]
    timestamp_lookup_key: str
    primary_keys: Sequence[str]
    timestamp_key: str
    rename: dict[str, str] = field(default_factory=dict)

    @property
    def output_names(self) -> list[str]:
        return [self.rename.get(n, n) for n in self.feature_names]

    @property
    def asked_by(self) -> tuple[str, ...]:
        """The base columns that are asked with."""
        return (*self.lookup_key, self.timestamp_lookup_key)


def _common_type(columns: Sequence[tuple[DataFrame, str]]) -> T.DataType:
    """The type in which values of all columns can be compared; text where there is none, and for
    floating numbers, of which a NaN would not equal itself."""
    try:
        kind = reduce(DataFrame.union, [df.select(F.col(c)) for df, c in columns]).schema[0].dataType
    except AnalysisException:
        return T.StringType()
    return T.StringType() if isinstance(kind, (T.FloatType, T.DoubleType)) else kind


class _Asked:
    """How lookups ask: their pairs of key and time columns, and the types to compare them in."""

    def __init__(self, base: DataFrame, lookups: Sequence[FeatureLookup]):
        self.base, self.lookups = base, lookups
        self.pairs = list(dict.fromkeys(lookup.asked_by for lookup in lookups))
        self.width = max(len(lookup.lookup_key) for lookup in lookups)
        self.keys = [f"__k{i}" for i in range(self.width)]
        self.types = []
        for i in range(self.width):
            of = [lookup for lookup in lookups if i < len(lookup.lookup_key)]
            self.types.append(_common_type([c for u in of for c in ((base, u.lookup_key[i]), (u.features, u.primary_keys[i]))]))
        self.time = _common_type(
            [c for u in lookups for c in ((base, u.timestamp_lookup_key), (u.features, u.timestamp_key))]
        )

    def key(self, i: int, names: Sequence[str]) -> Column:
        return (F.col(names[i]) if i < len(names) else F.lit(None)).cast(self.types[i])

    def named(self, pair: int, names: Sequence[str], at: str) -> list[Column]:
        keys = [self.key(i, names).alias(k) for i, k in enumerate(self.keys)]
        return [F.lit(pair).alias(_PAIR), *keys, F.col(at).cast(self.time).alias(_AT)]

    def complete(self, names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])

    def instants(self) -> DataFrame:
        """The distinct instants of all pairs, by one read of the base rows. Rows without a key or time ask nothing."""
        each = [
            F.when(self.complete(pair), F.struct(*self.named(n, pair[:-1], pair[-1]))) for n, pair in enumerate(self.pairs)
        ]
        asked = self.base.select(F.explode(F.array_compact(F.array(*each))).alias("a")).select("a.*")
        return asked.distinct().withColumn(ASKED, F.lit(True))

    def offered(self, n: int) -> DataFrame:
        """The feature rows of a lookup, its values as one struct. Rows without a key or time are never met."""
        lookup = self.lookups[n]
        values = F.struct(*[F.col(c).alias(o) for c, o in zip(lookup.feature_names, lookup.output_names, strict=True)])
        rows = lookup.features.where(self.complete((*lookup.primary_keys, lookup.timestamp_key)))
        named = self.named(self.pairs.index(lookup.asked_by), lookup.primary_keys, lookup.timestamp_key)
        return rows.select(*named, F.lit(False).alias(ASKED), values.alias(f"__f{n}"))

    def answers(self) -> DataFrame:
        marks = self.instants()
        for n in range(len(self.lookups)):
            marks = marks.unionByName(self.offered(n), allowMissingColumns=True)
        return newest_so_far(marks, [_PAIR, *self.keys], _AT, [f"__f{n}" for n in range(len(self.lookups))])


def lookup_features(base: DataFrame, lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Attach the features of every lookup to the base rows; no match leaves nulls.

    The lookups are resolved when this is called, the base rows joined when the result is used:
    store ``base`` first when it is costly to compute. The job fails on two feature rows of one
    key and time.
    """
    fetched = [name for lookup in lookups for name in lookup.output_names]
    clashing = sorted({c for c in [*base.columns, *fetched] if [*base.columns, *fetched].count(c) > 1})
    if clashing:
        raise ValueError(f"ambiguous columns {clashing}: rename what is fetched")
    if not lookups:
        return base
    asked = _Asked(base, lookups)
    found = asked.answers()
    out = base
    for n, pair in enumerate(asked.pairs):
        of = [i for i, lookup in enumerate(lookups) if lookup.asked_by == pair]
        answers = found.where(F.col(_PAIR) == n).select(*asked.keys, _AT, *[f"__f{i}" for i in of])
        same = [asked.key(i, pair[:-1]) == F.col(asked.keys[i]) for i in range(len(pair) - 1)]
        same.append(F.col(pair[-1]).cast(asked.time) == F.col(_AT))
        out = out.join(answers, same, "left").drop(*asked.keys, _AT)
    values = [F.col(f"__f{i}.{name}").alias(name) for i, lookup in enumerate(lookups) for name in lookup.output_names]
    return out.select(*base.columns, *values)


def training_set(
    base: DataFrame, lookups: Sequence[FeatureLookup], label: str, exclude_columns: Sequence[str] = ()
) -> DataFrame:
    """Base rows with looked-up features and the label, without the excluded columns."""
    if label not in base.columns:
        raise ValueError(f"label column {label!r} is not in the base rows")
    return lookup_features(base, lookups).drop(*exclude_columns)


def join_labels(predictions: DataFrame, labels: DataFrame, on: Sequence[str], label: str) -> DataFrame:
    """Attach ground truth to predictions; a prediction without a label keeps a null.

    The job fails on a second label of the same key, or on a label without one.
    """
    return predictions.drop(label).join(unique_rows(labels.select(*on, label), on), list(on), "left")
