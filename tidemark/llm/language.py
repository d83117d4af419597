"""Language identification by prediction by partial matching over bytes.

Per language, a tree of byte contexts of up to three bytes holds what followed them in all
documents that may be learned from. With the counts frozen, the code length of a byte is exact:
its share of the longest context that knows it, after the escapes of the longer ones that do not
(escape method C: as many parts as the context has different followers; last comes one even
share of 256). Shorter contexts are the sums of longer ones, so only four-byte strings are
counted. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept
from tidemark.llm.lookup_table import KeyTable

ORDER = 3
MAX_CELLS = 1 << 22
MAX_LANGUAGES = 500
UNDETERMINED = "und"
_BLOCK = 1 << 19


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in UTF-8, each after ``ORDER`` zero bytes; and where the texts start."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64) + ORDER
    ends = np.cumsum(sizes)
    joined = b"".join(b"\0" * ORDER + r for r in raw)
    return np.frombuffer(joined, np.uint8), np.stack([ends - sizes + ORDER, ends])


def _grams(data: np.ndarray) -> np.ndarray:
    """At every place from ``ORDER`` on: the byte there and the ``ORDER`` before it, as one number."""
    wide = data.astype(np.uint32)
    return reduce(lambda a, b: (a << np.uint32(8)) | b, (wide[i : len(wide) - ORDER + i] for i in range(ORDER + 1)))


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grams of some texts at a time: numbers of the texts, their grams, where each text starts."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < _BLOCK):
            size += len(texts[hi])
            hi += 1
        data, (starts, ends) = _bytes(texts[lo:hi])
        grams = _grams(data)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, starts, 1)
        np.add.at(inside, ends, -1)
        mask = np.cumsum(inside[:-1], dtype=np.int8)[ORDER:] > 0
        lengths = ends - starts
        yield np.arange(lo, hi), grams[mask], np.cumsum(lengths) - lengths
        lo = hi


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` from ``labelled(lang, text)``: four-byte strings, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                for _, grams, _ in _blocks([t for la, t in zip(langs, texts, strict=True) if la == lang]):
                    parts = found.setdefault(lang, [])
                    parts.append(np.unique(grams, return_counts=True))
                    if len(parts) > 16:
                        found[lang] = [_merged(parts)]
        for lang, parts in found.items():
            keys, n = _merged(parts)
            for lo in range(0, len(keys), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(keys[some]), pa.string()),
                        pa.array(keys[some].astype(np.int64)),
                        pa.array(n[some].astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


class Model:
    """Code lengths in bits for all languages at once, after the context bytes of ``mine``."""

    def __init__(self, languages: list[str], orders: list[tuple[np.ndarray, np.ndarray]], mine: np.ndarray):
        """``orders``: by context length, the byte strings and their counts by language."""
        self.languages, self.mine = languages, mine
        self.tables, self.bits, self.context_tables, self.escapes = [], [], [], []
        shorter, shorter_table = np.full((1, len(languages)), 8.0), None
        for order, (grams, counts) in enumerate(orders):
            contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
            total = np.stack([np.bincount(of, c, len(contexts)) for c in counts.T], axis=1)
            kinds = np.stack([np.bincount(of, c > 0, len(contexts)) for c in counts.T], axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                known = np.log2((total + kinds)[of] / counts)
            last = np.zeros(len(grams), np.int64)
            if shorter_table is not None:
                last = shorter_table.find(grams & np.uint64((1 << 8 * order) - 1))
            bits = np.where(counts > 0, known, escape[of] + shorter[last])
            self.tables.append(KeyTable(grams))
            self.context_tables.append(KeyTable(contexts))
            self.bits.append(np.ascontiguousarray(bits, dtype=np.float32))
            self.escapes.append(np.ascontiguousarray(escape, dtype=np.float32))
            shorter, shorter_table = bits, self.tables[-1]

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after the others, by language; 0 for those of other models."""
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        keys = grams.astype(np.uint64)
        left = np.flatnonzero(self.mine[(keys >> np.uint64(8)) & np.uint64(255)])
        keys = keys[left]
        for order in range(len(self.tables) - 1, -1, -1):
            keys = keys & np.uint64((1 << 8 * (order + 1)) - 1)
            at = self.tables[order].find(keys)
            hit = at >= 0
            if hit.all():
                out[left] += self.bits[order][at]
                return out
            out[left[hit]] += self.bits[order][at[hit]]
            left, keys = left[~hit], keys[~hit]
            context = self.context_tables[order].find(keys >> np.uint64(8))
            out[left[context >= 0]] += self.escapes[order][context[context >= 0]]
        out[left] += 8.0
        return out


class Models:
    """Models of disjoint sets of bytes before the coded one; every context lies in one of them."""

    def __init__(self, languages: list[str], parts: list[Broadcast]):
        self.languages, self.parts = languages, parts

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        return reduce(np.add, (part.value.code_lengths(grams) for part in self.parts))


def fit(labelled: DataFrame, max_cells: int = MAX_CELLS) -> Models | None:
    """Count over every row of ``labelled(lang, text)``; None where nothing can be learned.

    Every string keeps its count. A context and the shorter ones it escapes to end in the same
    byte, so strings are dealt by it into models of about ``max_cells`` strings times languages
    (more if one byte has more), which are made and sent to the tasks one after another.
    """
    rows = labelled.where("lang is not null and length(text) > 0")
    counted = kept(gram_counts(rows))
    languages = sorted(r[0] for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages; each has a model in every task")
    if not languages:
        return None
    before = F.shiftright("gram", 8).bitwiseAND(255)
    sizes = counted.select("gram").distinct().groupBy(before.alias("before")).count().collect()  # at most 256 rows
    groups: list[list[int]] = []
    size = 0
    for byte, n in sorted(tuple(r) for r in sizes):
        if not groups or size + n * len(languages) > max_cells:
            groups.append([])
            size = 0
        groups[-1].append(byte)
        size += n * len(languages)
    single = _counts(counted, 0, languages)
    parts = []
    for n, group in enumerate(groups):
        mine = np.zeros(256, bool)
        mine[group] = True
        if n == 0:  # bytes that were never seen before another
            mine |= ~np.isin(np.arange(256), [b for g in groups for b in g])
        some = counted if len(groups) == 1 else counted.where(before.isin(group))
        orders = [single, *(_counts(some, order, languages) for order in range(1, ORDER + 1))]
        parts.append(labelled.sparkSession.sparkContext.broadcast(Model(languages, orders, mine)))
    return Models(languages, parts)


def _counts(counted: DataFrame, order: int, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The strings of a context length and the byte after it, and their counts by language."""
    by = counted.withColumn("gram", F.col("gram").bitwiseAND((1 << 8 * (order + 1)) - 1))
    found = (by.groupBy("lang", "gram").agg(F.sum("n").alias("n")) if order < ORDER else by).select("lang", "gram", "n").toArrow()
    grams, row = np.unique(found["gram"].to_numpy(), return_inverse=True)
    number = {la: i for i, la in enumerate(languages)}
    column = np.array([number[la] for la in found["lang"].to_pylist()], dtype=np.int64)
    counts = np.zeros((len(grams), len(languages)))
    counts[row, column] = found["n"].to_numpy()
    return grams.astype(np.uint64), counts


def _text_bits(model: Model, texts: list[str]) -> np.ndarray:
    """Code length of each text, by language."""
    out = np.zeros((len(texts), len(model.languages)))
    for numbers, grams, starts in _blocks(texts):
        ends = np.append(starts[1:], len(grams))
        bits = np.zeros((len(starts), len(model.languages)))
        for lo in range(0, len(grams), _BLOCK):
            part = model.code_lengths(grams[lo : lo + _BLOCK])
            first = np.clip(starts - lo, 0, len(part))
            some = np.flatnonzero(np.clip(ends - lo, 0, len(part)) > first)
            bits[some] += np.add.reduceat(part, first[some], axis=0, dtype=np.float64)
        out[numbers] = bits
    return out


def predict(docs: DataFrame, model: Models | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row, from the whole text alone.

    ``score`` is the probability of the language if all are equally likely beforehand. A text
    that is null or has no letter is ``und`` with score 0, and so is any text without a model.
    Ties go to the first language by name. With several models the texts are read once for each
    and their code lengths summed; two hashes stand for a text then.
    """
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", letter.alias("letter"))
    languages, parts = (model.languages, model.parts) if model else ([], [])

    def judged(keys: pa.Array, at: list[int], bits: np.ndarray) -> pa.RecordBatch:
        names, scores = [UNDETERMINED] * len(keys), np.zeros(len(keys))
        if at:
            best = bits.argmin(axis=1)
            odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            for i, b, s in zip(at, best.tolist(), (1 / odds).tolist(), strict=True):
                names[i], scores[i] = languages[b], s
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, letters = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = [i for i, ok in enumerate(letters) if ok and parts]
            yield judged(batch.column(0), at, _text_bits(parts[0].value, [texts[i] for i in at]) if at else np.zeros(0))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(1).to_pylist()
            at = [i for i, b in enumerate(bits) if b is not None]
            yield judged(batch.column(0), at, np.array([bits[i] for i in at]))

    result = "doc_id long, lang_pred string, score double"
    if len(parts) <= 1:
        return rows.mapInArrow(run, result)
    keyed = rows.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})
    read = keyed.where("letter").select("a", "b", "text")
    lengths = reduce(DataFrame.union, (read.mapInArrow(_measured(part), "a long, b long, bits array<double>") for part in parts))
    copies = F.count(F.lit(1)) / len(parts)
    sums = F.array(*(F.sum(F.col("bits")[i]) / copies for i in range(len(languages))))
    found = lengths.groupBy("a", "b").agg(sums.alias("bits"))
    return keyed.select("doc_id", "a", "b").join(found, ["a", "b"], "left").select("doc_id", "bits").mapInArrow(judge, result)


def _measured(part: Broadcast):
    """A task that gives the code lengths of texts under one model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _text_bits(part.value, batch.column(2).to_pylist())
            made = pa.array(bits.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["a", "b", "bits"])

    return run
