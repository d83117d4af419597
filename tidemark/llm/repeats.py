"""Exact removal of repeated byte strings, by enhanced suffix arrays over shared neighbourhoods.

Every string of ``min_length`` bytes has one minimizer: of its shorter strings the one with the
smallest hash. Equal strings have equal minimizers at equal offsets, so text falls apart into
stretches whose strings share a minimizer, and only stretches with equal minimizers can repeat
each other. Stretches equal as a whole are settled by their hash: all but the earliest repeat.
Different stretches with one minimizer go to one suffix array: suffixes sorted, common prefixes
of neighbours, and a stack scan into the tree of common-prefix intervals. An interval that can be
extended to the left with all its occurrences is no maximal repeat and is left to the longer one;
of the others, all occurrences but the earliest are marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, long_id

MIN_LENGTH = 100
SAMPLE_OF_64 = 1
HOT_ROWS = 20_000
MAX_HOT = 1 << 17
_BLOCK = 1 << 20
_PLACE_BITS = np.uint64(22)
_FLUSH = 1_500_000
STRETCHES = "hm long, hs long, doc_id long, s long, e long, role int"


def _window(min_length: int) -> int:
    """How many minimizer candidates a string has: a power of two, about two thirds of its length."""
    if min_length < 16:
        raise ValueError("min_length must be 16 or more")
    return 1 << int(np.log2(min_length * 0.65))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers() -> tuple[np.ndarray, ...]:
    """Two odd bases' powers and inverse powers modulo 2 ** 64, and two values for every byte."""
    out = []
    size = _BLOCK + (1 << 12)
    for base in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95):
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
    seeds = np.arange(512, dtype=np.uint64) + np.uint64(1)
    values = _mix(seeds * np.uint64(0x9E3779B97F4A7C15))
    return *out, values[:256], values[256:]


class _Hashes:
    """Hashes of any part of a block from prefix sums; equal parts hash equal wherever they lie."""

    def __init__(self, data: np.ndarray, second: bool):
        up, down, up2, down2, values, values2 = _powers()
        self.up = up2 if second else up
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((values2 if second else values)[data] * (down2 if second else down)[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.up[start])


def _stretches(data: np.ndarray, limits: np.ndarray, min_length: int) -> tuple[np.ndarray, ...]:
    """Minimizer hash, hash of the whole, start and last string start of each stretch of a block.

    ``limits[i]`` is where the text that byte i belongs to ends.
    """
    window = _window(min_length)
    k = min_length - window + 1
    n = len(data) - min_length + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    first = _Hashes(data, False)
    at = np.arange(len(data) - k + 1)
    hashes = first.of(at, at + k)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    least = (hashes & ~low) | at.astype(np.uint64)
    step = 1
    while step < window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    place = (least[:n] & low).astype(np.int64)
    starts = np.arange(n)
    good = starts + min_length <= limits[:n]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | ~good[:-1] | (limits[1:n] != limits[: n - 1])
    s1 = np.flatnonzero(good & new)
    last = np.ones(n, bool)
    last[:-1] = new[1:] | ~good[1:]
    s2 = np.flatnonzero(good & last)
    whole = _Hashes(data, True).of(s1, s2 + min_length)
    length = (s2 - s1).astype(np.uint64)
    offset = (place[s1] - s1).astype(np.uint64)
    return hashes[place[s1]], _mix(whole ^ _mix((length << np.uint64(32)) | offset)), s1, s2


def _blocks(keys: list[int], texts: list[bytes], min_length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes of some texts at a time, with the number, start and limit of the text of every byte."""
    lo = 0
    while lo < len(texts):
        if len(texts[lo]) > _BLOCK:  # in parts that share all but one byte of a string
            whole = np.frombuffer(texts[lo], np.uint8)
            step = _BLOCK - min_length + 1
            for start in range(0, len(whole) - min_length + 1, step):
                data = whole[start : start + _BLOCK]
                yield data, np.full(len(data), keys[lo]), np.arange(start, start + len(data)), np.full(len(data), len(data))
            lo += 1
            continue
        hi, size = lo, 0
        while hi < len(texts) and size + len(texts[hi]) <= _BLOCK:
            size += len(texts[hi])
            hi += 1
        lengths = np.array([len(t) for t in texts[lo:hi]], dtype=np.int64)
        ends = np.cumsum(lengths)
        of = np.repeat(np.arange(hi - lo), lengths)
        data = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
        yield data, np.array(keys[lo:hi], dtype=np.int64)[of], np.arange(size) - (ends - lengths)[of], ends[of]
        lo = hi


def _find(docs: DataFrame, min_length: int, hot: np.ndarray | None) -> DataFrame:
    """Stretches of all documents; what a task already sees repeated is marked there and merged.

    Stretches with a minimizer of ``hot`` are cut into their single strings: as keys these leave
    no large group of different stretches.
    """

    def flush(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        hm, hs, doc, s, e = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((s, doc, hs, hm))
        hm, hs, doc, s, e = (c[order] for c in (hm, hs, doc, s, e))
        same = np.zeros(len(hm), bool)
        same[1:] = (hm[1:] == hm[:-1]) & (hs[1:] == hs[:-1])
        group = np.maximum.accumulate(np.where(same, 0, np.arange(len(hm))))
        repeats = same & ((doc != doc[group]) | (s != s[group]))
        cd, cs, ce = merged(doc[repeats], s[repeats], e[repeats])
        keep = ~repeats
        own = _mix(cd.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + cs.view(np.uint64))
        columns = [
            np.concatenate([hm[keep], own]).view(np.int64),
            np.concatenate([hs[keep], own]).view(np.int64),
            np.concatenate([doc[keep], cd]),
            np.concatenate([s[keep], cs]),
            np.concatenate([e[keep], ce]),
            np.concatenate([np.zeros(keep.sum(), np.int32), np.ones(len(cd), np.int32)]),
        ]
        names = [c.split()[0] for c in STRETCHES.split(", ")]
        for lo in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 16)]) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            pairs = [(k, t) for k, t in pairs if k is not None and len(t) >= min_length]
            keys, texts = [k for k, _ in pairs], [t for _, t in pairs]
            for data, doc, place, limits in _blocks(keys, texts, min_length):
                hm, hs, s1, s2 = _stretches(data, limits, min_length)
                if hot is not None and len(hot) and len(hm):
                    at = np.minimum(np.searchsorted(hot, hm), len(hot) - 1)
                    is_hot = hot[at] == hm
                    if is_hot.any():
                        n = s2[is_hot] - s1[is_hot] + 1
                        one = np.repeat(s1[is_hot] - np.cumsum(n) + n, n) + np.arange(n.sum())
                        h1, h2 = (_Hashes(data, second).of(one, one + min_length) for second in (False, True))
                        keep = ~is_hot
                        hm, hs = np.concatenate([hm[keep], h1]), np.concatenate([hs[keep], h2])
                        s1, s2 = np.concatenate([s1[keep], one]), np.concatenate([s2[keep], one])
                parts.append((hm, hs, doc[s1], place[s1], place[s2] + min_length))
                size += len(hm)
                if size >= _FLUSH:
                    yield from flush(parts)
                    parts, size = [], 0
        if parts:
            yield from flush(parts)

    return docs.mapInArrow(run, STRETCHES)


def merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the spans of each document; spans that touch are one."""
    if not len(doc):
        return doc, s, e
    order = np.lexsort((s, doc))
    doc, s, e = doc[order], s[order], e[order]
    number = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    lift = number * (int(e.max()) + 1)
    reach = np.maximum.accumulate(e + lift)
    new = np.ones(len(doc), bool)
    new[1:] = (number[1:] != number[:-1]) | (s[1:] + lift[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], s[first], reach[last] - lift[last]


def hot_minimizers(docs: DataFrame, min_length: int) -> np.ndarray:
    """Minimizers with about ``HOT_ROWS`` different stretches or more, judged by a sample of documents.

    Decides on the way only, not on the result. At most ``MAX_HOT``: each has at least that
    share of the sample's stretches.
    """
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(64)) < SAMPLE_OF_64)
    counts = kept(_find(sample, min_length, None).where("role = 0").groupBy("hm").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(HOT_ROWS * SAMPLE_OF_64 // 64, total // MAX_HOT + 1)
    found = counts.where(F.col("count") >= least).select("hm").toArrow()["hm"].to_numpy()
    return np.sort(found.view(np.uint64))


def repeat_groups(rows: list[tuple[int, int, bytes]], min_length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats within some stretches: (length, all occurrences as (doc_id, start)).

    A row is (doc_id, start of its bytes, bytes), the first byte being the one before the stretch
    (start then counts from the stretch), or absent at the beginning of a text: start 0.
    """
    widest = max(len(r[2]) for r in rows)
    leads = np.array([1 if start > 0 else 0 for _, start, _ in rows])
    lengths = np.array([len(r[2]) for r in rows])
    begins = np.cumsum(lengths + widest) - (lengths + widest)
    buffer = np.frombuffer(b"".join(r[2] + b"\0" * widest for r in rows) + b"\0" * widest, np.uint8)
    n = lengths - leads - min_length + 1
    row = np.repeat(np.arange(len(rows)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begins[row] + leads[row] + inner
    left = lengths[row] - leads[row] - inner
    suffixes = np.lib.stride_tricks.sliding_window_view(buffer, widest)[at]
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{widest}").ravel(), kind="stable")
    row, inner, at, left, suffixes = row[order], inner[order], at[order], left[order], suffixes[order]
    differ = suffixes[1:] != suffixes[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), widest)
    common = np.minimum(common, np.minimum(left[1:], left[:-1]))
    doc = np.array([r[0] for r in rows], dtype=np.int64)[row]
    place = np.array([r[1] for r in rows], dtype=np.int64)[row] + inner
    before = np.where(inner > 0, buffer[at - 1].astype(np.int64), -1)  # -1: the stretch begins here
    for lb, rb, length in _intervals(common, min_length):
        chars = before[lb : rb + 1]
        if chars[0] >= 0 and (chars == chars[0]).all():
            continue  # extends to the left with all its occurrences
        yield length, list(zip(doc[lb : rb + 1].tolist(), place[lb : rb + 1].tolist(), strict=True))


def _intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, length) of length ``least`` or more, by a stack scan."""
    high = np.flatnonzero(common >= least)
    if not high.size:
        return
    for part in np.split(high, np.flatnonzero(np.diff(high) > 1) + 1):
        lo, hi = int(part[0]), int(part[-1])
        if lo == hi:
            yield lo, lo + 1, int(common[lo])
            continue
        stack: list[tuple[int, int]] = []
        for i, length in enumerate([*common[lo : hi + 1].tolist(), -1], lo):
            first = i
            while stack and stack[-1][1] > length:
                first, top = stack.pop()
                yield first, i, top
            if length >= 0 and (not stack or stack[-1][1] < length):
                stack.append((first, length))


def _arrays(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    """Spans to remove, from rows (hm, doc_id, s, bytes) sorted by hm: whole groups at a time."""
    held: list[tuple[int, int, int, bytes]] = []

    def settle(rows: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        doc, s, e = [], [], []
        for length, places in repeat_groups([r[1:] for r in rows], min_length):
            earliest = min(places)
            for d, at in places:
                if (d, at) != earliest:
                    doc.append(d)
                    s.append(at)
                    e.append(at + length)
        columns = merged(*(np.array(c, dtype=np.int64) for c in (doc, s, e)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "s", "e"])

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        while len(held) > 3000 and (cut := _last_group(held)):
            # a few thousand rows at a time, groups whole
            stop = cut
            for n in range(3000, cut):
                if held[n][0] != held[n - 1][0]:
                    stop = n
                    break
            yield from settle(held[:stop])
            held = held[stop:]
    if held:
        yield from settle(held)


def _last_group(rows: list[tuple[int, int, int, bytes]]) -> int:
    """Where the last group begins; it may go on in the next batch."""
    n = len(rows) - 1
    while n > 0 and rows[n - 1][0] == rows[-1][0]:
        n -= 1
    return n


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches in ``_asked``, each with the byte before it."""
    names = ["hm", "doc_id", "s", "bytes"]
    for batch in batches:
        rows, size = [], 0
        for doc, text, asked in zip(*(batch.column(c) for c in ("doc_id", "text", "_asked")), strict=True):
            key, data = doc.as_py(), text.as_py() or b""
            data = data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data
            for one in asked.as_py():
                s, e = one["s"], one["e"]
                if e <= len(data):
                    rows.append((one["hm"], key, s, data[max(0, s - 1) : e]))
                    size += e - s + 40
            if size > 8 << 20:
                yield _rows(rows, names)
                rows, size = [], 0
        if rows:
            yield _rows(rows, names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def spans(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``(doc_id, spans)``: byte ranges of repeats, as an array of (s, e), where there are any.

    A byte is in a span if a string of ``min_length`` bytes that covers it starts earlier too: in
    a smaller doc_id, or earlier in the same document. Rows that share a doc_id are judged as one
    document; a row with a null doc_id or text has no spans. Ranges may overlap.
    """
    return _spans(_binary(docs).where("doc_id is not null"), min_length)


def _binary(docs: DataFrame) -> DataFrame:
    return docs.select(long_id(docs), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _spans(rows: DataFrame, min_length: int) -> DataFrame:
    """``spans`` of rows without null ids. All their columns go through the join, unused: so it is
    the same exchange as that of a caller who joins the spans to these rows, and made once."""
    texts = rows.select("doc_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    found = _find(texts, min_length, hot_minimizers(texts, min_length))
    marked = found.selectExpr(
        "*",
        "min(struct(doc_id, s)) over (partition by hm, hs) as earliest",
        "min(hs) over (partition by hm) <> max(hs) over (partition by hm) as many",
    )
    again = "role = 1 or struct(doc_id, s) > earliest"
    some = kept(marked.where(f"{again} or many").selectExpr("hm", "doc_id", "s", "e", f"{again} as again"))
    asked = some.where("not again").groupBy(F.col("doc_id").alias("_of"))
    asked = asked.agg(F.collect_list(F.struct("hm", "s", "e")).alias("_asked"))
    parts = rows.join(asked.hint("shuffle_hash"), F.col("doc_id") == F.col("_of"))
    parts = parts.mapInArrow(_cut_out, "hm long, doc_id long, s long, bytes binary")
    by_group = parts.repartition("hm").sortWithinPartitions("hm")
    partial = by_group.mapInArrow(lambda b: _arrays(b, min_length), "doc_id long, s long, e long")
    both = partial.union(some.where("again").select("doc_id", "s", "e"))
    return both.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _with_spans(rows: DataFrame, min_length: int) -> DataFrame:
    """All rows with ``_cut``, the spans of their document or null."""
    placed = rows.where("doc_id is not null")
    found = _spans(placed, min_length).select(F.col("doc_id").alias("_of"), F.col("spans").alias("_cut"))
    both = placed.join(found.hint("shuffle_hash"), F.col("doc_id") == F.col("_of"), "left").drop("_of")
    lost = rows.where("doc_id is null")
    return both.union(lost.withColumn("_cut", F.lit(None).cast(both.schema["_cut"].dataType)))


def without_repeats(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` as ``(doc_id, n_bytes, n_removed, n_spans, kept)``.

    Texts count as UTF-8 bytes, a null as empty; ``kept`` is what is left of them, joined. It may
    begin or end inside a character. Repeated rows each get a row; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, ranges in zip(*batch.columns, strict=True):
                data = text.as_py()
                left, n = _left(data, ranges.values if ranges.is_valid else None)
                out.append((doc.as_py(), len(data), len(data) - len(left), n, left))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return _with_spans(_binary(docs), min_length).mapInArrow(run, schema)


def shortened(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """The rows of ``docs`` with repeats cut from ``text`` and ``n_chars`` (if there) counted anew.

    Bytes of a character that a cut leaves incomplete go too. A row loses its place only if its
    text was not empty and nothing is left. Other columns stay as they are; a null stays null.
    The doc_id must be a long.
    """
    both = _with_spans(docs, min_length)
    at, of = both.columns.index("text"), both.columns.index("_cut")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, ranges in enumerate(batch.column(of)):
                if ranges.is_valid and texts[i]:
                    data = texts[i].encode("utf-8", "surrogatepass")
                    texts[i] = _left(data, ranges.values)[0].decode("utf-8", "ignore") or None
            columns = [pa.array(texts, pa.string()) if n == at else batch.column(n) for n in range(batch.num_columns) if n != of]
            gone = pa.array([t is None and batch.column(of)[i].is_valid for i, t in enumerate(texts)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns, gone], names=[*names, "_gone"])

    out = both.mapInArrow(run, both.select(*names).withColumn("_gone", F.lit(True)).schema).where("not _gone").drop("_gone")
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in names else out


def _left(data: bytes, ranges: pa.StructArray | None) -> tuple[bytes, int]:
    """What is left of ``data`` without the ranges, and the number of separate ranges."""
    s, e = _union(ranges, len(data))
    edges = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(s)


def _union(ranges: pa.StructArray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    if ranges is None or not len(ranges):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = (ranges.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    inside = s < size
    _, s, e = merged(np.zeros(int(inside.sum()), np.int64), s[inside], np.minimum(e[inside], size))
    return s, e

