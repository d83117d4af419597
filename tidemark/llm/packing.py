"""Packing token sequences: exact complements from length counts, then best fit.

Piece lengths lie between 1 and the capacity, so their counts are a table of fixed size. The
plan is made on these counts alone; pieces then find their place by their rank within their
length, so no piece passes through the driver.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class AddedTokens:
    """Texts and ids of the added tokens of a tokenizers JSON, and its path."""

    tokens: tuple[tuple[str, int], ...]
    tokenizer_file: str


def added_tokens(tokenizer_file: str) -> AddedTokens:
    """The added tokens of a tokenizers JSON, which it finds in any text before it splits.

    Tokens that take spaces with them, or only whole words, are refused.
    """
    found = json.loads(Path(tokenizer_file).read_text(encoding="utf-8")).get("added_tokens") or []
    odd = [t["content"] for t in found if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if odd:
        raise ValueError(f"added tokens that depend on their surroundings: {odd}")
    return AddedTokens(tuple((t["content"], t["id"]) for t in found), tokenizer_file)


@cache
def _encoder(ranks_file: str, pattern: str, added: tuple[tuple[str, int], ...]):
    import tiktoken

    lines = Path(ranks_file).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
    return tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


@cache
def _tokenizer(tokenizer_file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


def encode(text: str, ranks_file: str, pattern: str, added: AddedTokens | None) -> list[int]:
    """The ids of a text. The faster encoder gives up on about a million white-space characters in a
    row; such a text goes to the tokenizer of the JSON, if it is known, whose ids are the same."""
    encoder = _encoder(ranks_file, pattern, added.tokens if added else ())
    try:
        return encoder.encode(text, allowed_special="all") if added else encoder.encode_ordinary(text)
    except ValueError:
        if not added:
            raise
        return _tokenizer(added.tokenizer_file).encode(text, add_special_tokens=False).ids


def token_pieces(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    added: AddedTokens | None = None,
) -> DataFrame:
    """One row per piece of every document: its ids, an end id after them, cut if too long.

    ``ranks_file`` and ``pattern`` name a byte-level vocabulary as merge ranks, read where the
    tasks run. Strings of ``added`` are one id each, others of special tokens are ordinary text. A null or empty text is the end id
    alone. Longer ones are cut into pieces of ``capacity`` ids, of which the first may be shorter.
    ``with_ids`` adds the ids of each piece as an array.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, all_ids = batch.column(0).to_pylist(), [], []
            for key, text in zip(keys, batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or "", ranks_file, pattern, added), END_ID], dtype="<u4")
                at, n = 0, 0
                while at < len(ids):
                    end = at + ((len(ids) - at) % capacity or capacity)
                    part = ids[at:end]
                    rows.append((key, n, at, end - at, zlib.crc32(part.tobytes())))
                    if with_ids:
                        all_ids.append(part.astype(np.int32))
                    at, n = end, n + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            if with_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array(all_ids, type=pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Pattern:
    """A way to fill a sequence, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    times: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every piece once. ``counts``: number of pieces by length.

    Longest first, a length takes one, two or three lengths that fill its gap exactly, as often
    as all of them are left; what has no exact complement is packed by best fit. Many small
    pieces spent on exact fits may be missing later, so plans with complements of up to three,
    two and one lengths are made and the one with the fewest sequences is taken.
    """
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda made: sum(p.times for p in made))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[Pattern]:
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"piece of {length} ids; must lie in 1..{capacity}")
        left[length] += n
    sums = _Sums(left)
    out: list[Pattern] = []

    def use(lengths: tuple[int, ...]) -> None:
        each = Counter(lengths)
        times = min(left[length] // n for length, n in each.items())
        for length, n in each.items():
            left[length] -= times * n
        out.append(Pattern(tuple(sorted(lengths, reverse=True)), times))

    for length in range(capacity, 0, -1):
        while left[length]:
            found = sums.filling(capacity - length, most, (length,))
            if found is None:
                break
            use((length, *found))
    rest = [length for length in range(capacity + 1) if left[length]]
    while rest:
        if not left[rest[-1]]:
            rest.pop()
            continue
        lengths, gap = [rest[-1]], capacity - rest[-1]
        # The longest piece that fits, as often as it fits, then the next shorter one.
        at = bisect_right(rest, gap) - 1
        while gap and at >= 0:
            best = rest[at]
            n = min(left[best] - (best == lengths[0]), gap // best)
            lengths += [best] * n
            gap -= best * n
            at = min(at - 1, bisect_right(rest, gap) - 1)
        use(tuple(lengths))
    return out


class _Sums:
    """Which one, two and three lengths add up to a sum, among those of which pieces are left.

    The pairs of a sum, and the longest lengths of its triples, are listed once, when the sum is
    first asked for, in the order in which they are to be used. As pieces are only ever used up, a
    combination that lacks a piece is struck off its list for good.
    """

    def __init__(self, left: list[int]):
        self.left = left  # pieces by length, shared with the plan
        self.pairs: dict[int, list[int]] = {}  # by sum, the longer lengths, longest last
        self.triples: dict[int, list[int]] = {}  # by sum, the longest lengths, longest last

    def filling(self, gap: int, most: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        """Up to ``most`` (at most three) lengths that add up to ``gap``, the fewest and then the longest first.

        Of each length in ``held`` a piece is taken already.
        """
        if gap == 0:
            return ()
        if self._free(gap, held):
            return (gap,)
        pair = self._pair(gap, held) if most > 1 else None
        return pair if pair or most < 3 else self._triple(gap, held)

    def _free(self, length: int, held: tuple[int, ...]) -> int:
        return self.left[length] - held.count(length)

    def _pair(self, total: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        left = self.left
        if total not in self.pairs:
            self.pairs[total] = [big for big in range((total + 1) // 2, total) if left[big] and left[total - big]]
        listed = self.pairs[total]
        for at in range(len(listed) - 1, -1, -1):
            big, small = listed[at], total - listed[at]
            if not (left[big] and left[small]):
                if at == len(listed) - 1:
                    listed.pop()
            elif self._free(big, held) > (big == small) and self._free(small, held) > 0:
                return big, small
        return None

    def _triple(self, total: int, held: tuple[int, ...]) -> tuple[int, int, int] | None:
        left = self.left
        if total not in self.triples:
            self.triples[total] = [first for first in range(-(-total // 3), total) if left[first]]
        listed = self.triples[total]
        for at in range(len(listed) - 1, -1, -1):
            first = listed[at]
            if not left[first]:
                if at == len(listed) - 1:
                    listed.pop()
            elif self._free(first, held) > 0:
                pair = self._pair(total - first, (*held, first))
                if pair:
                    return first, *pair
        return None


def _slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces per sequence, first sequence, first offset)."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length in dict.fromkeys(p.lengths):
            each = p.lengths.count(length)
            first = used.get(length, 0)
            slots.setdefault(length, []).append((first, each, sequence, offset))
            used[length] = first + each * p.times
            offset += each * length
        sequence += p.times
    return {length: np.array(rows, dtype=np.int64) for length, rows in slots.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` between 1 and ``capacity``.

    Sequences are gapless from offset 0 and hold at most ``capacity`` ids. Ties are broken by
    the stored order. Other columns stay, but for earlier ones with the names of the two new ones
    or ``_part``, ``_rank``, ``_before``; an empty table stays empty.
    """
    pieces = pieces.drop("sequence_id", "offset", "_part", "_rank", "_before")
    stored = kept(pieces.withColumn("length", F.col("length").cast("long")))
    counts = {r[0]: r[1] for r in stored.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = _slots(plan(counts, capacity))
    here = stored.withColumn("_part", F.spark_partition_id())
    by_part = here.groupBy("_part", "length").count()
    before = by_part.selectExpr(
        "_part",
        "length",
        "sum(count) over (partition by length order by _part rows between unbounded preceding and current row)"
        " - count as _before",
    )
    ranked = here.mapInArrow(_rank_in_part, here.withColumn("_rank", F.lit(0).cast("long")).schema)
    placed = ranked.join(before, ["_part", "length"])
    schema = placed.withColumns({c: F.lit(0).cast("long") for c in ("sequence_id", "offset")}).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank, base = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank", "_before")
            )
            rank = rank + base
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length).tolist():
                at = np.flatnonzero(length == one)
                rows = slots[one]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                steps = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + steps // row[:, 1]
                offset[at] = row[:, 3] + steps % row[:, 1] * one
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return placed.mapInArrow(place, schema).select(*stored.columns, "sequence_id", "offset")


def _rank_in_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, int] = {}
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        order = np.argsort(length, kind="stable")
        kinds, first, n = np.unique(length[order], return_index=True, return_counts=True)
        rank = np.empty(len(length), np.int64)
        start = np.array([seen.get(k, 0) for k in kinds.tolist()], dtype=np.int64)
        rank[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(start, n)
        seen.update(zip(kinds.tolist(), (start + n).tolist(), strict=True))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], names=[*batch.schema.names, "_rank"])
