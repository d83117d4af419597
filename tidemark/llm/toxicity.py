"""Toxicity from two Kneser-Ney models, one of toxic documents and one of ordinary ones.

A word's probability in a class is its continuation count there (after how many different words
it was seen), discounted, and backs off to the continuation count shared by both classes: an
expression that is rare in a class is about as likely in either. The discount of a class comes
from its numbers of words seen after one and after two words; of some multiples of it the one is
taken under which the labels of the last fold are likeliest. Every word has its evidence. Shares
of single word pairs are not used above that: on labels like these they carry the chance pairs of
the smaller class (see the README for figures). A document is scored by the difference of its two
log-likelihoods per word, together with the part of it that comes from words which tell the
classes apart by more than a margin; a logistic curve turns both into a probability.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, kept
from tidemark.llm.lookup_table import KeyTable

MAX_LABELS = 400_000
BROADCAST_VALUES = 1 << 21
MAX_CURVE_ROWS = 50_000
CURVE_FOLD = 4
MULTIPLES = (1, 2, 3, 4, 6, 8)
MARGIN = 1.0
START = np.uint64(0)  # before the first word
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACED = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words: A-Z lower-cased, ASCII punctuation and white space between them."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_SPACED).split()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


@dataclass
class Words:
    """Evidence of the words, small enough to be sent to the tasks."""

    table: KeyTable
    evidence: np.ndarray  # by word and discount; a last row of zeros for all other words

    def differences(self, text: str | None) -> np.ndarray:
        """By discount, per word: the difference of the log-likelihoods, and what exceeds the margin; 0 without words."""
        hashes = word_hashes(text)
        if not len(hashes):
            return np.zeros((self.evidence.shape[1], 2))
        each = self.evidence[self.table.find(hashes)]
        return np.stack([each.mean(axis=0), np.maximum(each - MARGIN, 0).mean(axis=0)], axis=1)


@dataclass
class Model:
    """Evidence (log-likelihood of a word in the toxic less that in the ordinary model) and the curve."""

    table: DataFrame  # (word, e0, ...), a column per discount, null where both classes back off
    words: Words | None  # the same in memory, unless it has too many values
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def differences(self, text: str | None) -> tuple[float, float]:
        if self.words is None:
            raise ValueError("the words are in a table; use score()")
        mean, excess = self.words.differences(text)[0]
        return float(mean), float(excess)

    def with_differences(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``_x``: mean and excess of each discount in turn."""
        names = self.table.columns[1:]
        return _looked_up(docs, self.words, len(names)) if self.words else _joined(docs, self.table, names)

    def only(self, at: int, broadcast_values: int) -> Model:
        """The model of one discount. Words on which both classes back off need no row."""
        table = self.table.select("word", f"e{at}").dropna()
        return Model(table, _in_memory(table, broadcast_values))

    def score(self, differences: np.ndarray) -> np.ndarray:
        x = differences @ np.array(self.curve[:2]) + self.curve[2]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def labelled_rows(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``(doc_id, text, toxic, fold)`` of documents that may be learned from.

    Of more than ``max_labels`` labels, the share that keeps about as many is taken by a hash of
    the id. So the label table has a fixed bound and is sent to the tasks; texts are not
    shuffled. A doc_id with several labels has the larger one; null labels and ids are left out.
    """
    usable = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(fold(F.col("doc_id")) != 0)
    total = usable.count()
    if total > max_labels:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(max_labels / total * (1 << 30)))
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(F.broadcast(one), "doc_id").withColumn("fold", fold(F.col("doc_id")))


def fit(
    docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, broadcast_values: int = BROADCAST_VALUES
) -> Model | None:
    """Models from folds 1 to 3 of the labelled rows, the curve and the multiple of the discount
    from fold 4; None without both labels.

    All words of these rows are counted, in a table that grows with them. A word seen no more
    often than the discount in either class is left to the shared back-off and is, like one never
    seen, as likely in both. Evidence of up to ``broadcast_values`` words times discounts is sent
    to the tasks, more is joined to the words of the documents; the results are the same. Where
    the last fold lacks a label, the curve uses all rows.
    """
    rows = labelled_rows(docs, labels, max_labels)
    model = _count(rows.where(F.col("fold") != CURVE_FOLD), broadcast_values)
    model = model or _count(rows, broadcast_values)
    if model is None:
        return None
    for part in (rows.where(F.col("fold") == CURVE_FOLD), rows):
        n = part.count()
        if n > MAX_CURVE_ROWS:
            part = part.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(MAX_CURVE_ROWS / n * (1 << 30)))
        found = model.with_differences(part.select("toxic", "text")).select("toxic", "_x").toArrow()
        y = found["toxic"].to_numpy()
        if 0 < y.sum() < len(y):
            x = np.array(found["_x"].to_pylist()).reshape(len(y), len(MULTIPLES), 2)
            curves = [logistic_curve(x[:, i], y) for i in range(len(MULTIPLES))]
            losses = [_loss(x[:, i], y, c) for i, c in enumerate(curves)]
            best = int(np.argmin(losses))
            model = model.only(best, broadcast_values)
            model.curve = curves[best]
            return model
    return None


def _loss(x: np.ndarray, y: np.ndarray, curve: tuple[float, float, float]) -> float:
    level = x @ np.array(curve[:2]) + curve[2]
    return float(np.logaddexp(0, np.where(y > 0, -level, level)).mean())


def _contexts(rows: DataFrame) -> DataFrame:
    """``(word, ordinary, toxic, either)``: after how many different words each word was seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {1: [], 2: []}
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            hashes = [word_hashes(t) for t in batch.column(1).to_pylist()]
            for label, parts in found.items():
                some = [h for h, t in zip(hashes, toxic.tolist(), strict=True) if (2 if t else 1) == label]
                for lo in range(0, len(some), 500):
                    parts.append(_distinct_pairs([np.stack([np.append(START, h[:-1]), h]) for h in some[lo : lo + 500] if len(h)]))
                if len(parts) > 16:
                    found[label] = [_distinct_pairs(parts)]
        for label, parts in found.items():
            before, word = _distinct_pairs(parts).view(np.int64)
            for lo in range(0, len(word), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                seen = np.full(len(word[some]), label, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before[some]), pa.array(word[some]), pa.array(seen)], names=["before", "word", "seen"]
                )

    pairs = rows.select("toxic", "text").mapInArrow(run, "before long, word long, seen int")
    pairs = pairs.groupBy("before", "word").agg(F.bit_or("seen").alias("seen"))
    return pairs.groupBy("word").agg(
        F.sum(F.expr("seen & 1")).alias("ordinary"), F.sum(F.expr("seen >> 1")).alias("toxic"), F.count(F.lit(1)).alias("either")
    )


def _distinct_pairs(parts: list[np.ndarray]) -> np.ndarray:
    """The different columns of two-rowed arrays of hashes."""
    if not parts:
        return np.zeros((2, 0), np.uint64)
    pairs = np.concatenate(parts, axis=1)
    _, first = np.unique(pairs[0] * _ODD + pairs[1], return_index=True)
    return np.ascontiguousarray(pairs[:, first])


def _count(rows: DataFrame, broadcast_values: int) -> Model | None:
    contexts = kept(_contexts(rows))
    kinds = ("ordinary", "toxic")
    sums = contexts.agg(
        F.count(F.lit(1)).alias("words"),
        F.sum("either").alias("either"),
        *(F.sum(c).alias(c) for c in kinds),
        *(F.sum((F.col(c) == n).cast("long")).alias(f"{c}{n}") for c in kinds for n in (1, 2)),
    ).first()
    if not sums["ordinary"] or not sums["toxic"]:
        return None
    base = {c: (sums[f"{c}1"] + 1) / (sums[f"{c}1"] + 2 * sums[f"{c}2"] + 2) for c in kinds}
    taken = {(c, i): F.least(F.col(c).cast("double"), F.lit(base[c] * m)) for c in kinds for i, m in enumerate(MULTIPLES)}
    spare = contexts.agg(*(F.sum(t).alias(f"{c}{i}") for (c, i), t in taken.items())).first()
    share = (F.col("either") + 1) / F.lit(float(sums["either"] + sums["words"] + 1))  # one more for what was never seen

    def log_share(c: str, i: int) -> Column:
        return F.log((F.col(c) - taken[c, i] + F.lit(spare[f"{c}{i}"]) * share) / F.lit(float(sums[c])))

    def evidence(i: int) -> Column:
        above = (F.col("toxic") > base["toxic"] * MULTIPLES[i]) | (F.col("ordinary") > base["ordinary"] * MULTIPLES[i])
        return F.when(above, log_share("toxic", i) - log_share("ordinary", i)).alias(f"e{i}")

    table = contexts.select("word", *(evidence(i) for i in range(len(MULTIPLES)))).where(
        F.coalesce(*(F.col(f"e{i}") for i in range(len(MULTIPLES)))).isNotNull()
    )
    return Model(table, _in_memory(table, broadcast_values))


def _in_memory(table: DataFrame, broadcast_values: int) -> Words | None:
    names = table.columns[1:]
    if table.count() * len(names) > broadcast_values:
        return None
    found = table.toArrow()
    each = np.stack([np.nan_to_num(found[c].to_numpy()) for c in names], axis=1)
    each = np.concatenate([each, np.zeros((1, each.shape[1]))])
    return Words(KeyTable(found["word"].to_numpy().view(np.uint64)), each)


def _looked_up(docs: DataFrame, words: Words, n: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(words)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.differences(t.as_py()).ravel() for t in batch.column(at)]
            each = pa.array(np.array(x).ravel())
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * (2 * n))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, each)], names=[*batch.schema.names, "_x"]
            )

    return docs.mapInArrow(run, docs.withColumn("_x", F.array(F.lit(0.0))).schema)


def _joined(docs: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
    """Words meet their evidence in a join. Two hashes stand for a text; a repeated text only
    counts its words more often, which leaves the means as they are."""
    keyed = docs.withColumns({"_a": F.xxhash64("text"), "_b": F.xxhash64(F.lit(1), "text")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, text in enumerate(batch.column(2)):
                word, n = np.unique(word_hashes(text.as_py()), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(word), a[i])), pa.array(np.full(len(word), b[i])), pa.array(word.view(np.int64)), pa.array(n)],
                    names=["_a", "_b", "word", "n"],
                )

    words = keyed.select("_a", "_b", "text").mapInArrow(run, "_a long, _b long, word long, n long")
    sums = []
    for c in names:
        each = F.coalesce(F.col(c), F.lit(0.0))
        sums += [F.sum(F.col("n") * each), F.sum(F.col("n") * F.greatest(each - MARGIN, F.lit(0.0)))]
    found = words.join(table, "word", "left").groupBy("_a", "_b").agg(F.array(*(s / F.sum("n") for s in sums)).alias("_x"))
    none = F.array(*[F.lit(0.0)] * len(sums))
    return keyed.join(found, ["_a", "_b"], "left").select(*docs.columns, F.coalesce("_x", none).alias("_x"))


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float, float]:
    """Two slopes (the second not negative) and the level of the likeliest logistic curve."""
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    design = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w, ridge = np.zeros(3), np.diag([1e-3] * 3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curvature = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curvature, design.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:2] / scale
    slopes[1] = max(0.0, slopes[1])
    return float(slopes[0]), float(slopes[1]), float(w[2] - slopes @ centre)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row of ``docs`` with ``score``, the probability of toxicity from its whole text.

    A null, empty or wordless text has differences 0. Without a model every score is 0. A column
    named score is replaced and one named _x left out; all others stay, repeated rows too.
    """
    rows = docs.drop("score")
    if model is None:
        return rows.withColumn("score", F.lit(0.0))
    level = sum((F.col("_x")[i] * float(w) for i, w in enumerate(model.curve[:2])), F.lit(float(model.curve[2])))
    level = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), level))
    return model.with_differences(rows.drop("_x")).select(*rows.drop("_x").columns, (1 / (1 + F.exp(-level))).alias("score"))
