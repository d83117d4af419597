"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs between ASCII punctuation and white space. Grams of test items are three
words, either in a row or with one word left out after the second, so that a copy of which every
third word was changed, added or dropped still shares some. One pass over the documents finds the
grams that a fixed-size bit table of the items' grams knows, and keeps the stretches of text around
them, as far as the items behind the gram reach.

Every gram of an item is a seed, however often it was met, and one shared seed makes a pair. Only what
many items share says nothing of a single one: grams of a heading of the benchmark are no seeds of an
item that has a part of its own. Alignment of their words scores each pair: by the share of the item
that is aligned, or by a run of words that are equal throughout. Pairs that a bound shows to stay below
both are not aligned.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

NGRAM = 3
SKIPPING = (0, 1, 3)  # places of the words of the second kind of gram
COMMON_ITEMS = 4  # items that share a gram before it counts as a heading
REACHES = (64, 512, 4096)  # words; longer items have a class of their own
TABLE_BITS = 24
MIN_SCORE = 0.4
MIN_RUN = 13
MATCH, MISMATCH, GAP = 2, -1, -1
_SPACED = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPACED).split()


def gram_hashes(words: list[bytes], n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the grams, and where each starts: the ``n`` words from each place on, and
    those of ``SKIPPING``; of fewer words, one for all of them. The hash tells words and number only."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = min(n, len(words))
    each = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    kinds = [tuple(range(n))] + ([SKIPPING] if n == len(SKIPPING) and len(words) > SKIPPING[-1] else [])
    hashes = []
    for places in kinds:
        size = len(words) - places[-1]
        h = np.full(size, n, np.uint64)
        for i, place in enumerate(places):
            h = (h ^ each[place : place + size]) * np.uint64(_FACTORS[i % len(_FACTORS)])
            h ^= h >> np.uint64(29)
        hashes.append(h)
    return np.concatenate(hashes), np.concatenate([np.arange(len(h)) for h in hashes])


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << TABLE_BITS) - 1)
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64), ((hashes >> np.uint64(8)) & low).astype(np.int64)


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """``(item_id, place, last, gram, words)``: all n-grams of all items, by the places of their first and
    last words, with the item's length.

    Items of the same id stand for one item with several texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                grams, places = gram_hashes(words, n)
                size = min(n, len(words))
                in_a_row = np.arange(len(grams)) <= len(words) - size
                last = places + np.where(in_a_row, size - 1, SKIPPING[-1])
                parts.append((np.full(len(grams), key), places, last, grams, np.full(len(grams), len(words))))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 5
            columns = [c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in columns]
            names = ["item_id", "place", "last", "gram", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    rows = items.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    return rows.mapInArrow(run, "item_id long, place long, last long, gram long, words long")


def bit_tables(grams: DataFrame) -> list[tuple[int, np.ndarray]]:
    """By reach, bits of both probes of the grams of items of up to so many words.

    Each table has 2 ** TABLE_BITS bits, whatever the number of items; there are as many as classes
    of length in use, four at most. Items longer than all of ``REACHES`` reach as far as the longest.
    """
    longest = grams.agg(F.max("words")).first()[0] or 0
    reach = F.lit(int(longest))
    for words in reversed(REACHES):
        reach = F.when(F.col("words") <= words, words).otherwise(reach)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            reaches = batch.column(1).to_numpy(zero_copy_only=False)
            for one in np.unique(reaches):
                at = np.unique(np.concatenate(_probes(hashes[reaches == one])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), one)), pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))],
                    names=["reach", "word", "bits"],
                )

    found = grams.select("gram", reach.cast("long").alias("reach")).mapInArrow(run, "reach long, word long, bits long")
    rows = found.groupBy("reach", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    reaches, places, bits = (rows[c].to_numpy() for c in ("reach", "word", "bits"))
    out = []
    for one in np.unique(reaches).tolist():
        table = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
        mine = reaches == one
        table[places[mine]] = bits[mine].astype(np.uint32)
        out.append((one, table.view(np.uint8)))
    return out


def stretches(docs: DataFrame, tables: list[tuple[int, np.ndarray]], n: int) -> DataFrame:
    """``(doc_id, stretch, words, grams)``: parts of documents around grams that a table has.

    A part goes past a gram twice the length of the items that may hold it; parts that touch are one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(2 * reach, np.unpackbits(bits, bitorder="little").view(bool)) for reach, bits in shared.value]
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                grams, places = gram_hashes(words, n)
                first, second = _probes(grams)
                around = np.full(len(grams), -1)
                for reach, table in known:
                    at = np.flatnonzero(table[first])
                    at = at[table[second[at]]]
                    around[at] = np.maximum(around[at], reach)
                at = np.flatnonzero(around >= 0)
                if not at.size:
                    continue
                lo = np.maximum(0, places[at] - around[at])
                hi = np.minimum(len(words), places[at] + SKIPPING[-1] + 1 + around[at])
                order = np.argsort(lo, kind="stable")
                at, lo, end = at[order], lo[order], np.maximum.accumulate(hi[order])
                for part in np.split(np.arange(len(at)), np.flatnonzero(lo[1:] > end[:-1]) + 1):
                    here, there = int(lo[part[0]]), int(end[part[-1]])
                    rows.append((key, here, b" ".join(words[here:there]), np.unique(grams[at[part]]).view(np.int64)))
            for some in range(0, len(rows), 2000):
                keys, los, texts, found = zip(*rows[some : some + 2000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(los, pa.int64()),
                        pa.array(texts, pa.binary()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "stretch", "words", "grams"],
                )

    schema = "doc_id long, stretch long, words binary, grams array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def seeds_of(grams: DataFrame, n: int = NGRAM, own_share: float = MIN_SCORE) -> DataFrame:
    """``(item_id, gram)``: the grams that join documents to items, all but those of headings.

    A gram of more than ``COMMON_ITEMS`` items is a heading's. It is no seed of an item of whose words
    ``own_share`` or more lie outside of headings: a document that has none of the item's own grams does
    not hold it. An item that is nearly all heading (a filled-in template, a repeated item) keeps them.
    """
    items = grams.groupBy("gram").agg(F.count_distinct("item_id").alias("items"))
    told = grams.join(items, "gram").withColumn("heading", F.col("items") > COMMON_ITEMS)
    in_a_row = told.where(F.col("heading") & (F.col("last") - F.col("place") < n))
    covered = in_a_row.select("item_id", "words", F.explode(F.sequence("place", "last")).alias("at")).distinct()
    covered = covered.groupBy("item_id", "words").agg(F.count(F.lit(1)).alias("covered"))
    told = told.join(covered, ["item_id", "words"], "left")
    own = F.col("words") - F.coalesce("covered", F.lit(0))
    return told.where(~F.col("heading") | (own < own_share * F.col("words"))).select("item_id", "gram").distinct()


def align(document: list[bytes], item: list[bytes]) -> tuple[int, int, int]:
    """Best local alignment of words: its score, and where it starts and ends in the document.

    Row by row over the item; memory is one row. A start is carried along with each score.
    """
    m = len(document)
    number: dict[bytes, int] = {}
    doc = np.array([number.setdefault(w, len(number)) for w in document], dtype=np.int64)
    steps = np.arange(1, m + 1)
    score, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(doc == number.get(word, -1), MATCH, MISMATCH)
        above = score[1:] + GAP
        now = np.maximum(diagonal, above)
        begin = np.where(diagonal >= above, start[:-1], start[1:])
        begin = np.where(now > 0, begin, steps)
        now = np.maximum(now, 0)
        lifted = now - GAP * steps
        peak = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == peak, np.arange(m), 0))
        now, begin = peak + GAP * steps, begin[source]
        begin = np.where(now > 0, begin, steps)
        score = np.concatenate([[0], np.maximum(now, 0)])
        start = np.concatenate([[0], begin])
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(start[top]), top)
    return best


def highest_score(known: np.ndarray) -> int:
    """What no local alignment exceeds, from whether the item has each word of the document.

    Within an alignment a word of the document is either matched, and then the item's, or costs.
    """
    total = np.concatenate([[0], np.cumsum(np.where(known, MATCH, max(MISMATCH, GAP)))])
    return int((total - np.minimum.accumulate(total)).max())


def longest_run(document: list[bytes], item: list[bytes]) -> int:
    """The most words in a row that both have."""
    number: dict[bytes, int] = {}
    doc = np.array([number.setdefault(w, len(number)) for w in document], dtype=np.int64)
    runs, best = np.zeros(len(doc) + 1, np.int64), 0
    for word in item:
        runs[1:] = np.where(doc == number.get(word, -1), runs[:-1] + 1, 0)
        best = max(best, int(runs.max()))
    return best


def matches(
    docs: DataFrame,
    items: DataFrame,
    n: int = NGRAM,
    min_score: float = MIN_SCORE,
    min_run: int = MIN_RUN,
) -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word)``: documents that hold an item or an edit of it.

    Every document that shares a gram with an item is compared with it, but for grams of headings (see
    ``seeds_of``); what the other documents and items are plays no other part. ``score`` is that of the best local alignment over that of the item with itself, 0 to 1; rows
    from ``min_score`` on, or with ``min_run`` words in a row that are the item's, however long it
    is. An item of fewer words than a gram is found in texts that are it and nothing else. The places
    count words of the document. Null or wordless texts, null ids and empty tables give no rows; rows
    that repeat an id count together, the best score stands. Other columns are ignored.
    """
    grams = kept(item_grams(items, n))
    met = kept(stretches(docs, bit_tables(grams), n))
    hits = met.select("doc_id", "stretch", F.explode("grams").alias("gram"))
    pairs = hits.join(seeds_of(grams, n), "gram").select("doc_id", "stretch", "item_id").distinct()
    texts = items.where("item_id is not null").select(F.col("item_id").cast("long"), F.col("text").alias("item"))
    # The stretches, the longer texts, come last: they are not dealt out again with each of their items.
    ready = pairs.join(texts, "item_id").join(met.select("doc_id", "stretch", "words"), ["doc_id", "stretch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_item = lru_cache(1024)(lambda text: (words_of(text), frozenset(words_of(text))))
        of_stretch = lru_cache(4)(bytes.split)
        for batch in batches:
            rows = []
            for doc, item, lo, text, test in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, vocabulary = of_item(test)
                if not words:
                    continue
                found = of_stretch(text)
                known = np.fromiter(map(vocabulary.__contains__, found), bool, len(found))
                if highest_score(known) < min(min_score * MATCH * len(words), MATCH * min_run):
                    continue
                score, first, end = align(found, words)
                share = score / (MATCH * len(words))
                # An equal run of so many words alone scores as much.
                if share >= min_score or score >= MATCH * min_run and longest_run(found, words) >= min_run:
                    rows.append((doc, item, share, lo + first, lo + end))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "score", "first_word", "end_word"],
            )

    scored = ready.select("doc_id", "item_id", "stretch", "words", "item").mapInArrow(
        run, "doc_id long, item_id long, score double, first_word long, end_word long"
    )
    return scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", -F.col("first_word"), "end_word")).alias("b")).select(
        "doc_id", "item_id", "b.score", (-F.col("b.col2")).alias("first_word"), "b.end_word"
    )


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``matches`` did not find; rows with a null doc_id stay."""
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
