"""Document fingerprints: Merkle trees over sections, paragraphs and short word runs.

All of it is DataFrame expressions. Sections are separated by blank lines, paragraphs by line
ends; a paragraph's hash covers its text, a section's the hashes of its paragraphs, the root
those of its sections. Equal roots mean equal texts; where roots differ, comparing the branches
finds the sections and paragraphs that differ. Below the paragraphs, the three words from every
place on are hashed, whatever white space lies between them, and the smallest of these hashes are a
sketch whose overlap tells how alike texts are: a word put in or taken out changes the runs that hold
it and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, long_id

SKETCH = 64
WORD = r"[^ \t\r\n]+"
SECTION_MARK = "\n\n"


def tree(text: Column, sketch: int = SKETCH) -> dict[str, Column]:
    """Columns ``root``, ``sections``, ``paragraphs`` and ``sketch`` of a text (null: empty).

    Every character belongs to one paragraph and the marks between them are fixed, so texts
    differ exactly if some hash does: splitting keeps empty parts.
    """
    whole = F.coalesce(text, F.lit(""))
    leaves = F.transform(
        F.split(whole, SECTION_MARK, -1), lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.sha2(p, 256))
    )
    sections = F.transform(leaves, lambda p: F.sha2(F.array_join(p, ","), 256))
    return {
        "root": F.sha2(F.array_join(sections, ";"), 256),
        "sections": sections,
        "paragraphs": leaves,
        "sketch": F.slice(F.sort_array(F.array_distinct(_runs(whole))), 1, sketch),
    }


def _runs(text: Column) -> Column:
    """Hashes of the three words from every place on; of fewer words, one for all of them."""

    def of_words(words: Column) -> Column:
        later = [F.slice(words, n, F.greatest(F.size(words), F.lit(1))) for n in (2, 3)]
        placed = F.arrays_zip(words, *later)
        whole = F.slice(placed, 1, F.greatest(F.size(words) - 2, F.lit(1)))
        return F.transform(whole, lambda r: F.xxhash64(r))

    # Within an array of one, the words are found once and then have a name.
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.get(F.transform(F.array(words), of_words), F.lit(0))


def print_string(root: Column, sketch: Column) -> Column:
    """A fingerprint in one string: the root, then the sketch in hexadecimal."""
    return F.concat(root, F.lit("-"), F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def likeness(root: Column, sketch: Column, other_root: Column, other_sketch: Column, size: int = SKETCH) -> Column:
    """Share of word runs in common, 0 to 1: overlap within the smallest hashes of both sketches.

    Equal roots give 1. Exact while both texts have at most ``size`` different runs.
    """
    low = F.slice(F.array_sort(F.array_union(sketch, other_sketch)), 1, size)
    both = F.array_intersect(F.array_intersect(sketch, other_sketch), low)
    share = F.size(both) / F.greatest(F.size(low), F.lit(1))
    return F.when(root == other_root, F.lit(1.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def differing(sections: Column, paragraphs: Column, other_sections: Column, other_paragraphs: Column) -> Column:
    """Places ``(section, paragraph)`` from 0 whose hash has no equal at that place of the other tree.

    Only branches whose section hashes differ are opened.
    """
    n = F.greatest(F.size(sections), F.size(other_sections))
    places = F.sequence(F.lit(0), n - 1)
    apart = F.filter(places, lambda i: ~F.get(sections, i).eqNullSafe(F.get(other_sections, i)))

    def inside(i: Column) -> Column:
        a, b = (F.coalesce(F.get(p, i), F.array().cast("array<string>")) for p in (paragraphs, other_paragraphs))
        spots = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)
        return F.transform(
            F.filter(spots, lambda j: ~F.get(a, j).eqNullSafe(F.get(b, j))),
            lambda j: F.struct(i.alias("section"), j.alias("paragraph")),
        )

    return F.flatten(F.transform(apart, inside))


def fingerprints(docs: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """``(doc_id, root, sections, paragraphs, sketch)`` per row; other columns are ignored."""
    return docs.select("doc_id", *(c.alias(n) for n, c in tree(F.col("text"), sketch).items()))


def next_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` of distinct ids: the next larger one, after the last the first.

    Ids are dealt by ranges; each range finds its neighbours alone and only the first ids of the
    ranges meet in one place.
    """
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    dealt = kept(ids.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()))
    firsts = dealt.groupBy("range").agg(F.min("doc_id").alias("first"))
    after = firsts.selectExpr(
        "range",
        "coalesce(lead(first) over (partition by 0 order by range), min(first) over (partition by 0)) as following",
    )
    inner = dealt.selectExpr("doc_id", "range", "lead(doc_id) over (partition by range order by doc_id) as inner_next")
    return inner.join(after, "range").selectExpr("doc_id", "coalesce(inner_next, following) as next_id")


def edited(docs: DataFrame) -> DataFrame:
    """Every row with its edited text and the fingerprints of itself, the edit and the next document.

    The edit replaces the last quarter of the code points, rounded down, by the first as many
    (or all) of the next document. Of rows that repeat a doc_id, the smallest text stands as
    "the next document". Rows with a null doc_id have no place in the order: nothing replaces
    their last quarter and the next document counts as empty. Only the part of a text that its
    predecessor needs is sent to it.
    """
    rows = docs.select(long_id(docs), F.coalesce("text", F.lit("")).alias("text"))
    own = tree(F.col("text"))
    rows = rows.select("*", own["root"].alias("root"), own["sketch"].alias("sketch"))
    placed = rows.where("doc_id is not null")  # the same rows and columns on both joins: dealt out once
    need = placed.groupBy("doc_id").agg(F.floor(F.max(F.char_length("text")) / 4).alias("need"))
    asked = next_ids(placed).join(need, "doc_id").withColumnRenamed("doc_id", "for_id")
    source = placed.join(asked, placed.doc_id == asked.next_id)
    sent = source.select(
        "for_id",
        F.expr("substring(text, 1, cast(need as int))").alias("head"),
        F.col("root").alias("next_root"),
        F.col("sketch").alias("next_sketch"),
        F.xxhash64("text").alias("tie"),
    )
    sent = sent.groupBy("for_id").agg(F.min_by(F.struct("head", "next_root", "next_sketch"), F.struct("head", "tie")).alias("s"))
    joined = placed.join(sent, placed.doc_id == sent.for_id).select(*rows.columns, "s")
    empty = tree(F.lit(""))
    nothing = F.struct(F.lit("").alias("head"), empty["root"].alias("next_root"), empty["sketch"].alias("next_sketch"))
    lost = rows.where("doc_id is null").select(*rows.columns, nothing.alias("s"))
    n_chars = F.char_length("text").cast("long")
    cut = F.expr("cast(floor(char_length(text) / 4) as int)")
    text = F.concat(F.substring("text", F.lit(1), F.char_length("text") - cut), F.substring("s.head", F.lit(1), cut))
    with_edit = joined.union(lost).select(
        "doc_id",
        "root",
        "sketch",
        n_chars.alias("n_chars"),
        "text",
        text.alias("edited_text"),
        F.col("s.next_root").alias("next_root"),
        F.col("s.next_sketch").alias("next_sketch"),
    )
    a, b = tree(F.col("text")), tree(F.col("edited_text"))
    return with_edit.select(
        "doc_id",
        "n_chars",
        "edited_text",
        "next_root",
        "next_sketch",
        "root",
        "sketch",
        *(a[c].alias(c) for c in ("sections", "paragraphs")),
        *(b[c].alias(f"edited_{c}") for c in ("root", "sections", "paragraphs", "sketch")),
    )
