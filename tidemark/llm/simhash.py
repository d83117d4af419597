"""SimHash near-duplicates: Golay-code keys, join, verified bit distance, components.

A 64-bit fingerprint is cut into three segments. Of two fingerprints that differ in at most two
bits, two segments together differ in at most one: one is equal, the other off by at most one
bit. So each ordered pair of segments gives keys (equal segment, codeword index of the other):
one exact index on the left, the indices of all one-bit neighbours on the right.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept
from tidemark.llm.components import components
from tidemark.llm.golay import codeword_index, nearby_indices

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, width)
MAX_BITS = 2
PAIRS_PER_KEY = 4096
ColumnOrName = Column | str
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned SimHash: bit set where over half the shingle hashes have it; no word gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(p), SEED) for p in parts], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of whole texts, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, pairs_per_key: int = PAIRS_PER_KEY) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of ``prints(fp)``.

    Connects exactly what chains of at most ``max_bits`` differing bits connect. Keys with few
    members are joined and every pair verified. A key that would give more than
    ``pairs_per_key`` pairs sends its members to an exact second way without pairs: each goes
    to all words within one bit of it, and members of one word (65 at most) are two bits apart
    or closer and hang on the smallest of them.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must lie in 0..{MAX_BITS}, found {max_bits}")
    keyed = prints.select("fp").mapInArrow(_keys, "key long, side int, fp long")
    sides = keyed.groupBy("key").agg(F.sum(1 - F.col("side")).alias("l"), F.sum("side").alias("r"))
    shared = kept(sides.where("l >= 1 and r >= 2"))
    few, many = (F.col("l") * F.col("r") <= pairs_per_key), (F.col("l") * F.col("r") > pairs_per_key)
    sets = (
        keyed.join(shared.where(few).select("key"), "key")
        .groupBy("key")
        .agg(
            F.collect_list(F.expr("if(side = 0, fp, null)")).alias("left"),
            F.collect_list(F.expr("if(side = 1, fp, null)")).alias("right"),
        )
    )
    near = (
        sets.select(F.explode("left").alias("a"), "right")
        .select("a", F.explode("right").alias("b"))
        .where(f"a < b and bit_count(a ^ b) <= {max_bits}")
        .distinct()
    )
    members = keyed.join(shared.where(many).select("key"), "key").select("fp").distinct()
    words = members.select("fp", F.explode(F.expr(_neighbourhood(min(max_bits, 1)))).alias("word"))
    if max_bits == 1:  # words within one bit would join fingerprints two bits apart
        pairs = words.join(members.select(F.col("fp").alias("word")), "word", "left_semi")
        dense = pairs.where("fp <> word").select(F.col("fp").alias("a"), F.col("word").alias("b"))
    else:
        dense = (
            words.groupBy("word")
            .agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all"))
            .select("a", F.explode("all").alias("b"))
            .where("a <> b")
        )
    return near.union(dense)


def _neighbourhood(radius: int) -> str:
    return "array(fp)" if radius == 0 else "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))"


def near_groups(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` bits. A
    null or wordless text has fingerprint zero and links like any other. Rows that repeat a
    doc_id each get a row. Columns other than doc_id and text are ignored. An empty table
    gives an empty result. Equal fingerprints are one node, so copies never form pairs.
    """
    prints = kept(fingerprints(docs, shingle))
    nodes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(near_links(nodes, max_bits))
    linked = nodes.join(roots, nodes.fp == roots.node).select("fp", "first", "root")
    smallest = linked.groupBy("root").agg(F.min("first").alias("low"))
    low = linked.join(smallest, "root").select("fp", "low")
    # Stored, so that both sides of the last join are plain exchanges: adaptive execution can then
    # split the fingerprint of a large group of copies.
    named = kept(nodes.join(low, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id")))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_print(fp: ColumnOrName) -> Column:
    """Sixteen lower-case hexadecimal digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "side", "fp"]
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for lo in range(0, len(fp), 2048):
            some = fp[lo : lo + 2048]
            parts = [((some >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64) for at, w in SEGMENTS]
            own = [codeword_index(p) for p in parts]
            near = [nearby_indices(p, w) for p, (_, w) in zip(parts, SEGMENTS, strict=True)]
            keys, sides, prints = [], [], []
            for n, (i, j) in enumerate(permutations(range(3), 2)):
                base = (np.int64(n) << 34) | (parts[i] << 12)
                keys.append(base | own[j])
                sides.append(np.zeros(len(some), np.int32))
                prints.append(some)
                spread = np.sort(near[j], axis=1)
                new = np.ones(spread.shape, bool)
                new[:, 1:] = spread[:, 1:] != spread[:, :-1]
                row, col = np.nonzero(new)
                keys.append(base[row] | spread[row, col])
                sides.append(np.ones(len(row), np.int32))
                prints.append(some[row])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys)),
                    pa.array(np.concatenate(sides)),
                    pa.array(np.concatenate(prints).view(np.int64)),
                ],
                names=names,
            )


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; the other columns stay.

    A row without a doc_id cannot be named as the copy of another and stays.
    """
    heads = groups.where("doc_id = component_id").select("doc_id").distinct()
    found = docs.join(heads, "doc_id", "left_semi").select(*docs.columns)
    return found.union(docs.where("doc_id is null"))
