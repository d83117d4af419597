"""SimHash groups, repeated strings and Merkle fingerprints against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import golay, merkle, queries, repeats, simhash
from tidemark.session import scratch_path
from tidemark.llm.components import components

DOCS = "doc_id long, text string, fp long, spans string"  # two columns with names the operators use


def frame(spark, texts):
    rows = [(i, t, 7, "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def sample_texts(seed=1):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "One", "one", "two words", "two  WORDS", "a b c", "ünï çode wörds"]
    for _ in range(12):
        base = words(rng, 400).split()
        texts.append(" ".join(base))
        texts.append(" ".join(base))
        for _ in range(6):  # near copies
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts.append(words(rng, 60_000))
    return list(enumerate(texts, start=3))


def brute_groups(prints, bits):
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= bits]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_golay_words_one_bit_apart_share_an_index():
    rng = np.random.default_rng(5)
    v = rng.integers(0, 1 << 21, 500)
    assert len(set(golay._tables()[2].tolist())) == 1 << golay.CHECK_BITS
    near = golay.nearby_indices(v, 21)
    for bit in range(21):
        assert (near == golay.codeword_index(v ^ (1 << bit))[:, None]).any(axis=1).all()


@pytest.mark.parametrize("per_key", [4096, 1])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_equal_brute_force_on_dense_fingerprints(spark, bits, per_key):
    rng = random.Random(bits)
    centre = [rng.getrandbits(64) for _ in range(4)]
    prints = {0, *centre}
    for c in centre:
        for _ in range(40):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    prints = dict(enumerate(sorted(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints.values()]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), bits, per_key)
    found = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(links).collect()}
    number = {p: i for i, p in prints.items()}
    expected = brute_groups(prints, bits)
    group = {}
    for i, p in prints.items():
        group.setdefault(expected[i], set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in group.values())
    assert len({next(iter(g)) for g in group.values()}) == len(group)
    assert set(found) <= set(number)


def test_groups_equal_brute_force(spark):
    texts = sample_texts()
    found = simhash.near_groups(frame(spark, texts)).collect()
    prints = {i: simhash.fingerprint(t) for i, t in texts}
    assert prints[3] == prints[4] == prints[5] == 0
    label = brute_groups(prints, 2)
    assert {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in found} == {i: (prints[i], label[i]) for i in prints}
    kept = simhash.one_of_each(frame(spark, texts), simhash.near_groups(frame(spark, texts)))
    assert kept.columns == ["doc_id", "text", "fp", "spans"]
    assert {r.doc_id for r in kept.collect()} == set(label.values())


def test_groups_of_repeated_rows_and_of_nothing(spark):
    twice = simhash.near_groups(frame(spark, [(1, "a b c d"), (1, "a b c d"), (2, "A  b c d")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in twice) == [(1, 1), (1, 1), (2, 1)]
    assert simhash.near_groups(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        simhash.near_links(frame(spark, []), 3)


def test_rows_without_an_id_stay(spark):
    docs = frame(spark, [(1, "a b c d"), (2, "A  b c d"), (None, "a b c d"), (None, "quite another text here"), (None, None)])
    kept = simhash.one_of_each(docs, simhash.near_groups(docs))
    expected = [(1, "a b c d"), (None, "a b c d"), (None, "quite another text here"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert kept.columns == docs.columns


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def brute_repeats(texts, least):
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        data = (t or "").encode()
        mask = bytearray(len(data))
        for at in range(len(data) - least + 1):
            part = hashlib.blake2b(data[at : at + least], digest_size=12).digest()
            if part in seen:
                mask[at : at + least] = b"\1" * least
            seen.add(part)
        left = bytes(b for b, m in zip(data, mask, strict=True) if not m)
        out[i] = (len(data), mask.count(1), sum(1 for r in bytes(mask).split(b"\0") if r), left)
    return out


def repeating_texts():
    rng = random.Random(3)
    passage, other = words(rng, 60), words(rng, 40)
    texts = ["", None, "short", "é" * 400, "ab" * 300, "abc" * 100, "x\0y" * 90, passage, passage]
    texts += [f"{words(rng, 20)} {passage} {words(rng, 20)}" for _ in range(30)]
    texts += [f"{other[k:]} {words(rng, 5)} {passage[: 100 + k]}" for k in range(0, 60, 7)]
    texts += [f"{passage}{passage}", other + "é" + passage, words(rng, 300)]
    return list(enumerate(texts, start=1))


def check_repeats(spark, texts, least):
    found = repeats.without_repeats(frame(spark, texts), least).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == brute_repeats(texts, least)


@pytest.mark.parametrize("least", [20, 100])
def test_repeats_equal_brute_force(spark, least):
    check_repeats(spark, repeating_texts(), least)


def test_hot_minimizers_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_ROWS", 1)
    monkeypatch.setattr(repeats, "SAMPLE_OF_64", 64)
    rows = frame(spark, repeating_texts()).where("text is not null").select("doc_id", F.col("text").cast("binary"))
    assert len(repeats.hot_minimizers(rows, 100)) > 0
    check_repeats(spark, repeating_texts(), 100)


def test_repeats_across_the_parts_of_a_very_long_text(spark):
    rng = random.Random(9)
    passage = words(rng, 50)
    long = words(rng, 190_000, 10**6)
    assert len(long) > repeats._BLOCK
    texts = [(1, passage), (2, long[: repeats._BLOCK - 40] + passage + long[repeats._BLOCK - 40 :] + passage)]
    found = {r.doc_id: r for r in repeats.without_repeats(frame(spark, texts)).collect()}
    expected = brute_repeats(texts, 100)
    assert (found[2].n_removed, found[2].n_spans, bytes(found[2].kept)) == expected[2][1:]


def test_repeat_groups_list_all_occurrences_of_maximal_repeats():
    base = bytes(range(65, 91)) * 2
    rows = [(1, 0, b"1" + base + b"x"), (2, 5, b"2" + base + b"y"), (3, 9, b"2" + base[:30])]
    groups = {(n, tuple(sorted(p))) for n, p in repeats.repeat_groups(rows, 20)}
    assert (52, ((1, 1), (2, 5))) in groups
    assert any(n == 30 and {d for d, _ in p} == {1, 2, 3} for n, p in groups)


def test_shortened_texts_keep_other_columns_and_rows(spark):
    passage = "é".join(f"{n * n}" for n in range(30, 60))
    texts = [(1, passage), (2, "x" + passage + "y"), (3, passage), (4, ""), (5, None), (6, "clean"), (6, "clean")]
    rows = frame(spark, texts).withColumn("n_chars", F.lit(1).cast("long"))
    found = repeats.shortened(rows)
    assert found.columns == rows.columns
    kept = sorted((r.doc_id, r.text, r.n_chars) for r in found.where("text is not null").collect())
    assert kept == [(1, passage, len(passage)), (2, "xy", 2), (4, "", 0), (6, "clean", 5), (6, "clean", 5)]
    assert found.where("text is null").count() == 1
    assert repeats.shortened(rows.limit(0)).collect() == []


def brute_edits(texts):
    order = sorted(texts)
    out = {}
    for n, (i, t) in enumerate(order):
        t, following = t or "", order[(n + 1) % len(order)][1] or ""
        cut = len(t) // 4
        out[i] = (len(t), t[: len(t) - cut] + following[:cut], following)
    return out


def test_edits_and_fingerprints(spark):
    texts = sample_texts(2)[:40]
    found = {r.doc_id: r for r in merkle.edited(frame(spark, texts)).collect()}
    expected = brute_edits(texts)
    plain = {r.doc_id: r for r in merkle.fingerprints(frame(spark, texts)).collect()}
    by_text = {}
    for i, t in texts:
        assert (found[i].n_chars, found[i].edited_text) == expected[i][:2]
        assert (found[i].root, found[i].sketch) == (plain[i].root, plain[i].sketch)
        by_text.setdefault(t or "", set()).add(plain[i].root)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_merkle_branches_locate_edits(spark):
    a = "one\ntwo\n\nthree\nfour\n\nfive"
    b = "one\ntwo\n\nthree\nFOUR\n\nfive\nsix"
    rows = merkle.fingerprints(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"))
    x, y = rows.where("doc_id = 1").alias("x"), rows.where("doc_id = 2").alias("y")
    pair = x.crossJoin(y).select(
        merkle.differing(F.col("x.sections"), F.col("x.paragraphs"), F.col("y.sections"), F.col("y.paragraphs")).alias("d")
    )
    assert [tuple(p) for p in pair.first().d] == [(1, 1), (2, 1)]


def test_likeness_and_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "lost"), (2, None)]
    found = merkle.edited(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() == 4
    near = merkle.likeness(F.col("root"), F.col("sketch"), F.col("next_root"), F.col("next_sketch"))
    assert all(0 <= r[0] <= 1 for r in found.select(near).collect())
    one = merkle.edited(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited_text == "abcdefab" and one.next_root == one.root
    assert merkle.edited(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_likeness_survives_insertions_and_white_space(spark):
    """Sketches against all runs of three words, written out; a word put in front changes hardly anything."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    texts = {
        1: " ".join(words),
        2: "new " + " ".join(words),
        3: "\n\n".join(" ".join(words[i : i + 30]) for i in range(0, 300, 30)),
        4: " ".join(words[:150] + ["put", "in"] + words[150:]),
        5: " ".join(f"v{n}" for n in range(300)),
        6: "one two",
        7: " one\ttwo\n",
        8: " \n ",
    }
    found = {r.doc_id: r for r in merkle.fingerprints(frame(spark, list(texts.items()))).collect()}
    runs = {i: {tuple(t.split()[n : n + 3]) for n in range(max(1, len(t.split()) - 2))} - {()} for i, t in texts.items()}
    for i, r in found.items():
        assert len(r.sketch) == min(64, len(runs[i])) and r.sketch == sorted(r.sketch)
    pairs = spark.createDataFrame(
        [(i, j, found[i].root, found[i].sketch, found[j].root, found[j].sketch) for i in texts for j in texts],
        "i int, j int, a string, x array<long>, b string, y array<long>",
    )
    near = {(r.i, r.j): r.near for r in pairs.select("i", "j", merkle.likeness(*map(F.col, "axby")).alias("near")).collect()}
    for i, j in near:
        exact = len(runs[i] & runs[j]) / max(1, len(runs[i] | runs[j]))
        assert near[i, j] == 1.0 if i == j else abs(near[i, j] - exact) < 0.25
        assert near[i, j] == near[j, i]
    assert near[1, 2] > 0.9 and near[1, 3] == near[6, 7] == 1.0 and near[1, 4] > 0.85
    assert near[1, 5] == near[5, 6] == near[1, 8] == 0.0


def test_query_names_the_branches_an_edit_changes(spark):
    folder = scratch_path(spark, "merkle-test")
    texts = {1: "a b\nc d\n\ne f\ng h", 2: "x y\nz", 3: None, 4: ""}
    frame(spark, list(texts.items())).write.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in queries.op4_merkle(spark, folder).collect()}
    assert (found[1].changed_paragraphs, found[1].first_change) == (2, "1/0")  # "e fx y" and an empty one
    assert (found[4].changed_paragraphs, found[4].first_change, found[3].changed_paragraphs) == (0, "", 0)
