"""Language, toxicity and decontamination: exact small cases and held-out rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, lookup_table, toxicity
from tidemark.llm.common import held_out, table

ODD = [(100, None), (101, ""), (102, "12 34 !?"), (103, "x"), (104, "the " * 20_000)]


def docs_of(spark, rows):
    """Documents with two columns whose names the operators use themselves."""
    made = [(i, t, la, 0.5, "k") for i, t, la in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, score double, letter string")


def test_key_table_finds_all_and_only_its_keys():
    rng = np.random.default_rng(1)
    ends = np.array([0, 1, 2, (1 << 64) - 1], dtype=np.uint64)
    keys = np.unique(np.append(rng.integers(0, 1 << 63, 5000, dtype=np.uint64), ends))
    table_ = lookup_table.KeyTable(keys)
    assert (table_.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 63, 5000, dtype=np.uint64), keys)
    assert (table_.find(others) == -1).all()
    assert (lookup_table.KeyTable(np.zeros(0, np.uint64)).find(keys) == -1).all()


def brute_bits(learned, text, order=3):
    """Code length of ``text`` from counts kept in plain dictionaries."""
    counts = {}
    for t in learned:
        data = b"\0" * order + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[i - k : i], Counter())[data[i]] += 1
    data, bits = b"\0" * order + text.encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k : i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits += math.log2((total + kinds) / seen[data[i]])
                break
            bits += math.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    learned = {"aa": ["abracadabra abra", "cadabra é"], "bb": ["zyx zyx abr", "q"]}
    rows = [(n, t, la) for n, (la, ts) in enumerate(learned.items()) for t in ts]
    model = language.fit(docs_of(spark, rows).select("lang", "text"))
    assert model.languages == ["aa", "bb"]
    for text in ("abracadabra", "zyx", "new words é", "\0\0a"):
        grams = next(language._blocks([text]))[1]
        found = model.code_lengths(grams).sum(axis=0)
        assert found == pytest.approx([brute_bits(learned[la], text) for la in model.languages], rel=1e-5)


@pytest.mark.parametrize("cells", [language.MAX_CELLS, 8])
def test_rare_strings_of_a_large_language_keep_their_counts(spark, cells):
    learned = {"aa": ["ab " * 90_000 + "zyxw abq"], "bb": ["zyx ab"]}
    rows = [(n, t, la) for n, (la, ts) in enumerate(learned.items()) for t in ts]
    model = language.fit(docs_of(spark, rows).select("lang", "text"), cells)
    assert (len(model.parts) > 1) == (cells == 8)
    texts = ["zyxw", "abq", "ab zyx", "new é ab"]
    expected = [[brute_bits(learned[la], t) for la in model.languages] for t in texts]
    for text, bits in zip(texts, expected, strict=True):
        grams = next(language._blocks([text]))[1]
        assert model.code_lengths(grams).sum(axis=0) == pytest.approx(bits, rel=1e-5)
    asked = docs_of(spark, [(i, t, None) for i, t in enumerate(texts)] + [(0, texts[0], None), (None, None, None)])
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.lang_pred, r.score) for r in language.predict(asked, model).collect())
    assert got[0] == (-1, "und", 0.0) and len(got) == 6 and got[1] == got[2]
    for (_, name, score), bits in zip(got[2:], expected, strict=True):
        assert name == model.languages[bits.index(min(bits))]
        assert score == pytest.approx(1 / sum(2 ** (min(bits) - b) for b in bits), rel=1e-3)


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SMALL, "documents")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id")))
    n, right = found.count(), found.where("lang = lang_pred").count()
    assert n > 20 and right >= 0.95 * n


def test_odd_texts_have_a_language_row(spark):
    model = language.fit(docs_of(spark, [(1, "the cat and the hat", "en"), (2, None, "en"), (3, "el gato", None)]).select("lang", "text"))
    rows = [(i, t, None) for i, t in ODD] + [(103, "x", None)]
    found = language.predict(docs_of(spark, rows), model)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in found.collect())
    assert [g[:2] for g in got] == [(100, "und"), (101, "und"), (102, "und"), (103, "en"), (103, "en"), (104, "en")]
    assert all(0 <= s <= 1 for *_, s in got)
    assert language.fit(docs_of(spark, []).select("lang", "text")) is None
    assert [r.lang_pred for r in language.predict(docs_of(spark, [(1, "abc", None)]), None).collect()] == ["und"]


def toxic_sample(n=1500):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(max(2, len(words) // 40)):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "foul"]))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_of_held_out_documents_and_odd_texts(spark):
    rows, labels = toxic_sample()
    rows += [(2000 + i, t, None) for i, t in ODD] + [(2000, None, None)]
    label_rows = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    docs = docs_of(spark, rows)
    model = toxicity.fit(docs, label_rows)
    found = toxicity.score(docs, model)
    assert sorted(found.columns) == sorted(docs.columns)
    got = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert got[2100] < 0.5 and got[2104] < 0.5
    truth = dict(labels)
    test = [r.doc_id for r in docs.where(held_out(F.col("doc_id")) & (F.col("doc_id") < 1500)).collect()]
    right = sum((got[i] >= 0.5) == bool(truth[i]) for i in test)
    assert len(test) > 200 and right >= 0.97 * len(test)


def test_toxicity_without_usable_labels(spark):
    rows, labels = toxic_sample(60)
    docs = docs_of(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    one_sided = spark.createDataFrame([(i, 0) for i, _ in labels], "doc_id long, toxic int")
    for given in (empty, one_sided):
        assert toxicity.fit(docs, given) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), None).collect() == []


def test_rare_toxic_words_carry_evidence(spark):
    """Words of five toxic documents, three or so of them learned from."""
    rows, labels, n = [], [], 0
    for i in range(400):
        words = [f"w{(i * 7 + j * j) % 300}" for j in range(1500)]
        if i % 4 == 0:
            words[700] = f"slur{n // 5}"
            n += 1
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(i % 4 == 0)))
    docs, label_rows = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, label_rows)
    got = {f"slur{i}": model.differences(f"slur{i}")[0] for i in range(20)}
    assert sum(e > 1 for e in got.values()) >= 14


def test_words_beyond_the_broadcast_size_are_joined(spark):
    rows, labels = toxic_sample(400)
    rows += [(2000 + i, t, None) for i, t in ODD] + [(2000, None, None), (1, rows[0][1], "x")]
    docs, label_rows = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    sent, kept = (toxicity.fit(docs, label_rows, broadcast_values=n) for n in (10_000, 2))
    assert sent.words is not None and kept.words is None
    a, b = (sorted(((r.doc_id or -1, r.lang or "", r.score) for r in toxicity.score(docs, m).collect())) for m in (sent, kept))
    assert [x[:2] for x in a] == [x[:2] for x in b] and len(a) == len(rows)
    assert [x[2] for x in a] == pytest.approx([x[2] for x in b], abs=1e-6)


def test_label_bound_takes_a_hashed_share(spark):
    rows, labels = toxic_sample(600)
    some = toxicity.labelled_rows(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), 100)
    assert 50 < some.count() < 200


def brute_alignment(document, item):
    best, h = 0, [[0] * (len(document) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(document, 1):
            step = h[i - 1][j - 1] + (decontaminate.MATCH if a == b else decontaminate.MISMATCH)
            h[i][j] = max(0, step, h[i - 1][j] + decontaminate.GAP, h[i][j - 1] + decontaminate.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_full_table():
    rng = random.Random(8)
    for _ in range(200):
        document = [b"%d" % rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        item = [b"%d" % rng.randrange(6) for _ in range(rng.randrange(1, 12))]
        score, first, end = decontaminate.align(document, item)
        assert score == brute_alignment(document, item)
        assert score == 0 or brute_alignment(document[first:end], item) == score


def contaminated(rng):
    vocabulary = [f"v{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(40))) for i in range(12)] + [(12, "A short one"), (13, None), (14, ""), (None, "v1 v2")]
    docs, truth = [], set()
    for i in range(120):
        words = text(rng.randrange(5, 200))
        if i % 3 == 0:
            item = items[i // 3 % 12]
            copy = item[1].split()
            if i % 2:  # an edit: some words replaced, some dropped, letters and marks changed
                copy = [rng.choice(vocabulary) if rng.random() < 0.12 else w for w in copy if rng.random() > 0.06]
                copy = [w.upper() + "," if rng.random() < 0.3 else w for w in copy]
            at = rng.randrange(len(words))
            words[at:at] = copy
            truth.add((i, item[0]))
        docs.append((i, " ".join(words), None))
    docs.append((500, "it had, a SHORT one!", None))
    truth.add((500, 12))
    return docs + [(600 + i, t, None) for i, t in ODD] + [(None, items[0][1], None)], items, truth


@pytest.mark.parametrize("hot", [1, 40])
def test_copies_and_edits_of_items_are_found(spark, hot):
    docs, items, truth = contaminated(random.Random(2))
    docs += [(1000 + i, f"x{i} {items[0][1]} y{i}", None) for i in range(hot)]
    truth |= {(1000 + i, 0) for i in range(hot)}
    rows, tests = docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(rows, tests)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == truth
    exact = found.where("doc_id = 0").first()
    assert exact.score == 1.0 and exact.end_word - exact.first_word == 40
    left = decontaminate.clean(rows, found)
    assert left.columns == rows.columns
    assert left.count() == len(docs) - len({d for d, _ in truth})


def test_decontamination_of_nothing(spark):
    docs, items, _ = contaminated(random.Random(2))
    rows, tests = docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.matches(rows.limit(0), tests).collect() == []
    assert decontaminate.matches(rows, tests.limit(0)).collect() == []


def test_edited_copies_headings_and_excerpts_of_items(spark):
    """Edits of every kind to all items of the benchmark, a heading that many share, parts of long items."""
    rng = random.Random(6)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r.text]
    noise = [w.decode() for _, t in items for w in decontaminate.words_of(t)]
    fresh = lambda: f"q{rng.randrange(10**6)}"
    edits = {
        "third replaced": lambda w: [fresh() if i % 3 == 2 else x for i, x in enumerate(w)],
        "third dropped": lambda w: [x for i, x in enumerate(w) if i % 3 != 2],
        "one more after two": lambda w: [y for i, x in enumerate(w) for y in ([x, fresh()] if i % 2 else [x])],
        "a third replaced by chance": lambda w: [fresh() if rng.random() < 0.33 else x for x in w],
        "verbatim": list,
    }
    docs, expected = [], {}
    for kind, edit in edits.items():
        for item, text in items:
            words = [w.decode() for w in decontaminate.words_of(text)]
            body = edit(words)
            around = [rng.choice(noise) for _ in range(60)]
            if decontaminate.align([w.encode() for w in body], [w.encode() for w in words])[0] >= 0.4 * 2 * len(words):
                expected.setdefault(kind, set()).add((len(docs), item))
            docs.append((len(docs), " ".join(around[:30] + body + around[30:])))
    plain = len(docs)
    docs += [(plain + n, " ".join(rng.choice(noise) for _ in range(200))) for n in range(100)]
    heading = " ".join(fresh() for _ in range(11))
    headed = [(1000 + n, heading + " " + " ".join(fresh() for _ in range(8))) for n in range(40)]
    docs += [(5000 + n, heading + " " + " ".join(fresh() for _ in range(30))) for n in range(40)]
    long = " ".join(fresh() for _ in range(1000))
    docs += [(6000, " ".join(rng.choice(noise) for _ in range(50)) + " " + " ".join(long.split()[300:360])), (6001, "only")]
    docs += [(6002, "rare " + " ".join(long.split()[10:18]) + " end")]
    items += [*headed, (2000, long), (2001, "only"), (2002, "two words")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(rows, tests).collect()}
    for kind, pairs in expected.items():
        assert len(pairs) >= 0.8 * (len(items) - 43) and len(pairs & found) >= (0.9 if "chance" in kind else 0.95) * len(pairs), kind
    assert not any(plain <= d < 6000 for d, _ in found)
    assert {p for p in found if p[0] >= 6000} == {(6000, 2000), (6001, 2001)}
    # Longer items do not widen the stretches of shorter ones.
    grams = decontaminate.item_grams(tests, 3)
    tables = decontaminate.bit_tables(grams)
    assert [reach for reach, _ in tables] == [64, 4096]
    wide = decontaminate.stretches(rows.where("doc_id < 50"), tables, 3)
    assert all(len(r.words.split()) <= 60 + 4 * 64 + 60 for r in wide.collect())


def test_common_seeds_single_seeds_and_templates_lose_no_pair(spark):
    """What a document holds of an item counts whatever other documents and items hold of it."""
    fresh = iter(range(10**6))
    text = lambda n: [f"c{next(fresh)}" for _ in range(n)]
    long, short, (left, right) = text(22), text(7), (text(20), text(19))
    items = [(0, " ".join(long)), (1, " ".join(short))]
    items += [(10 + n, " ".join([*left, *text(1), *right])) for n in range(6)]
    bodies = [(0, long), *[(1 + n, long[:9]) for n in range(150)], *[(200 + n, short[2:5]) for n in range(5)]]
    bodies += [(300, [*left, *text(1), *right])]
    docs = [(i, " ".join([*text(30), *body, *text(30)])) for i, body in bodies]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    found = decontaminate.matches(rows, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(d, i) for d, body in bodies for i, item in items if brute_alignment(body, item.split()) >= 0.4 * 2 * len(item.split())}
    assert len(expected) == 1 + 150 + 5 + 6 and {(r.doc_id, r.item_id) for r in found} == expected


def test_bound_of_alignments():
    rng = random.Random(9)
    for _ in range(200):
        document = [b"%d" % rng.randrange(9) for _ in range(rng.randrange(0, 30))]
        item = [b"%d" % rng.randrange(9) for _ in range(rng.randrange(1, 12))]
        known = np.array([w in set(item) for w in document], bool)
        assert decontaminate.highest_score(known) >= brute_alignment(document, item)
    assert decontaminate.highest_score(np.array([False, True, True, False, True, False, False])) == 5
