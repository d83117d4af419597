"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Candidates of a text get votes (yes, no, none) from a pattern, a check of their shape, lists of
known values, the words before them and the characters around them. No labels are given: per kind
of data, expectation-maximisation estimates how often each labeler votes how on true and on false
spans, and with that the probability of every combination of votes. These soft labels train a
logistic classifier of votes and further traits of the span. Spans of the fixed patterns stay
whatever the classifier says; it adds others from a probability of ``ACCEPT`` on.

Votes and traits have few values, so the whole corpus is a table of counted combinations
(``MAX_PATTERNS``, which the numbers of values imply; a few hundred in practice): each task counts
its own, and the driver estimates from the sums. Texts are not shuffled.

A null or empty text has no spans. Repeated rows are judged alike and all stay; their spans count
as often as they stand. An empty table has an empty result and a model that accepts nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pii_spans import KINDS, LABELERS, Candidate, Span, candidates

ACCEPT = 0.5
MAX_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 3 * 3 * 5 * 4
EM_ROUNDS = 100
# What is believed before any text is seen, worth this many spans: the shares of (no, none, yes) that
# each labeler votes on false and on true spans. Estimation starts here, so that its two classes
# are false and true and not some other division of the spans.
BELIEF_SPANS = 20.0
BELIEFS = {
    "regex": ((0.30, 0.68, 0.02), (0.02, 0.38, 0.60)),
    "shape": ((0.50, 0.20, 0.30), (0.05, 0.15, 0.80)),
    "gazetteer": ((0.30, 0.55, 0.15), (0.10, 0.50, 0.40)),
    "context": ((0.40, 0.55, 0.05), (0.03, 0.47, 0.50)),
    "border": ((0.40, 0.20, 0.40), (0.03, 0.17, 0.80)),
}
RIDGE = 1.0

Pattern = tuple[int, tuple[int, ...], str]  # kind, votes, traits


@dataclass
class Model:
    """Per kind: how likely a span is true, and per labeler the shares of no, none and yes on false and true spans."""

    prior: np.ndarray  # (kinds,)
    votes: np.ndarray  # (kinds, labelers, 2, 3)
    weights: dict[tuple, float] = field(default_factory=dict)

    def truth(self, kind: int, votes: tuple[int, ...]) -> float:
        """Probability that a span with these votes is true."""
        return float(_posterior(self, np.array([kind]), np.array([votes]))[0])

    def score(self, pattern: Pattern) -> float:
        """The classifier's probability that the span is personal data of its kind."""
        level = sum(self.weights.get(f, 0.0) for f in features(pattern)) if self.weights else -30.0
        return 1 / (1 + float(np.exp(-np.clip(level, -30, 30))))


def pattern_of(found: Candidate) -> Pattern:
    return found.span.kind, found.votes, found.traits


def features(pattern: Pattern) -> list[tuple]:
    """Names of the classifier's inputs that hold for a span."""
    kind, votes, traits = pattern
    return [(kind,), *((kind, "vote", n, v) for n, v in enumerate(votes)), *((kind, "trait", n, t) for n, t in enumerate(traits))]


def patterns(docs: DataFrame) -> dict[Pattern, int]:
    """How often each combination of kind, votes and traits stands in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(_coded(pattern_of(c)) for c in candidates(text.as_py() or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pattern", "n"]
        )

    counts = docs.select("text").mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return {_decoded(r.pattern): r.n for r in sorted(counts.collect())}  # at most MAX_PATTERNS rows


def _coded(pattern: Pattern) -> str:
    kind, votes, traits = pattern
    return f"{kind}{''.join('n.y'[v + 1] for v in votes)}{traits}"


def _decoded(code: str) -> Pattern:
    ends = 1 + len(LABELERS)
    return int(code[0]), tuple("n.y".index(c) - 1 for c in code[1:ends]), code[ends:]


def reliabilities(counts: dict[Pattern, int]) -> tuple[Model, np.ndarray]:
    """Labelers' reliabilities by expectation-maximisation, and the truth of each pattern in turn."""
    kinds = np.array([k for k, _, _ in counts], int)
    votes = np.array([v for _, v, _ in counts], int).reshape(len(counts), len(LABELERS))
    n = np.array(list(counts.values()), float)
    shares = np.array([BELIEFS[labeler] for labeler in LABELERS])
    belief = np.tile(shares * BELIEF_SPANS, (len(KINDS), 1, 1, 1))
    model = Model(np.full(len(KINDS), 0.5), np.tile(shares, (len(KINDS), 1, 1, 1)))
    truth = _posterior(model, kinds, votes)
    for _ in range(EM_ROUNDS):
        sums, true = belief.copy(), np.ones((len(KINDS), 2))
        for y, share in enumerate((1 - truth, truth)):
            np.add.at(true[:, y], kinds, n * share)
            for labeler in range(len(LABELERS)):
                np.add.at(sums[:, labeler, y], (kinds, votes[:, labeler] + 1), n * share)
        model = Model(true[:, 1] / true.sum(axis=1), sums / sums.sum(axis=3, keepdims=True))
        before, truth = truth, _posterior(model, kinds, votes)
        if len(truth) == 0 or np.abs(before - truth).max() < 1e-9:
            break
    return model, truth


def _posterior(model: Model, kinds: np.ndarray, votes: np.ndarray) -> np.ndarray:
    level = np.log(model.prior[kinds]) - np.log1p(-model.prior[kinds])
    for labeler in range(len(LABELERS)):
        seen = np.log(model.votes[kinds, labeler, :, votes[:, labeler] + 1])
        level = level + seen[:, 1] - seen[:, 0]
    return 1 / (1 + np.exp(-np.clip(level, -30, 30)))


def train(counts: dict[Pattern, int]) -> Model:
    """Reliabilities and the classifier, from counted patterns."""
    model, truth = reliabilities(counts)
    names = sorted({f for p in counts for f in features(p)}, key=repr)
    place = {name: i for i, name in enumerate(names)}
    rows = np.repeat(np.arange(len(counts)), [len(features(p)) for p in counts])
    columns = np.array([place[f] for p in counts for f in features(p)], int)
    design = np.zeros((len(counts), len(names)))
    design[rows, columns] = 1.0
    n, w = np.array(list(counts.values()), float), np.zeros(len(names))
    for _ in range(60 if names else 0):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(len(names))
        step = np.linalg.solve(curvature, design.T @ (n * (truth - p)) - RIDGE * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.weights = dict(zip(names, w.tolist(), strict=True))
    return model


def fit(docs: DataFrame) -> Model:
    """The model of all texts of ``docs``."""
    return train(patterns(docs))


def spans_of(text: str, model: Model) -> list[tuple[Span, bool, float]]:
    """Exact spans and accepted others, by start and kind; of added ones that overlap the likelier stays."""
    exact, wider = [], []
    for found in candidates(text):
        score = model.score(pattern_of(found))
        if found.exact:
            exact.append((found.span, True, score))
        elif score >= ACCEPT:
            wider.append((found.span, False, score))
    added: list[tuple[Span, bool, float]] = []
    for group in _overlapping(wider):
        taken: list[tuple[Span, bool, float]] = []
        for one in sorted(group, key=lambda s: (-s[2], s[0])):
            if all(one[0].end <= t[0].start or t[0].end <= one[0].start for t in taken):
                taken.append(one)
        added += taken
    return sorted(exact + added)


def _overlapping(spans: list[tuple[Span, bool, float]]) -> Iterator[list[tuple[Span, bool, float]]]:
    """Runs of spans, sorted by start, in which each overlaps one before it."""
    group: list[tuple[Span, bool, float]] = []
    reach = 0
    for one in sorted(spans):
        if group and one[0].start >= reach:
            yield group
            group = []
        group.append(one)
        reach = max(reach, one[0].end)
    if group:
        yield group


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with ``found``: its spans as (kind, start, end, exact, score), by start and kind.

    Offsets count code points. A column named found is replaced; all others stay.
    """
    rows = docs.drop("found")
    at = rows.columns.index("text")
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("exact", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [(KINDS[s.kind], s.start, s.end, exact, score) for s, exact, score in spans_of(text.as_py() or "", model)]
                for text in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(item))], [*batch.schema.names, "found"]
            )

    schema = rows.withColumn(
        "found", F.lit(None).cast("array<struct<kind:string,start:int,end:int,exact:boolean,score:double>>")
    ).schema
    return rows.mapInArrow(run, schema)
