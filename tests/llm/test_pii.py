"""Personal data: exact spans against plain patterns, estimation on known labelers, spans that the method adds."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii, queries
from tidemark.llm.pii_spans import CARD, EMAIL, IP, KINDS, LABELERS, PHONE, candidates, exact_spans
from tidemark.session import scratch_path

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and max(int(p) for p in m.group().split(".")) > 255:
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


PIECES = ["a", "B", "_", ".", "@", "+", "-", " ", "(", ")", "%", "/", "é", "\n", "0", "1", "25", "255", "256", "4111", "1111"]
PIECES += ["4111 1111 1111 1111", "4111-1111", "10.0.0.1", "+1 (017) 555-7713", "a.b@c.de", "x@y", "555", "٣", "００"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_exact_spans_equal_plain_patterns(text):
    assert exact_spans(text) == plain_spans(text)
    found = candidates(text)
    assert [tuple(c.span) for c in found if c.exact] == plain_spans(text)
    for c in found:
        assert 0 <= c.span.start < c.span.end <= len(text) and len(c.traits) == 4
        assert c.exact or not any(s < c.span.end and c.span.start < e for s, _, e in plain_spans(text))


@pytest.mark.parametrize("piece", ["a", "1", "1.", "1 ", "@", "a@", "+1(", "+", "(at)", ":", "a.", "1-", "f:", "a@b.", " ", "[at] a"])
def test_time_grows_with_the_text(piece):
    start = time.perf_counter()
    candidates(piece * (400_000 // len(piece)))
    assert time.perf_counter() - start < 20


def test_reliabilities_of_known_labelers():
    """Votes drawn with known reliabilities: they are found without labels, and decide better than the majority."""
    rng = np.random.default_rng(4)
    right = (0.97, 0.9, 0.75, 0.7, 0.55)
    silent = (0.1, 0.0, 0.3, 0.5, 0.2)
    counts, truths = {}, {}
    for true in rng.random(30_000) < 0.4:
        votes = tuple(
            0 if rng.random() < s else (1 if (rng.random() < r) == bool(true) else -1) for r, s in zip(right, silent, strict=True)
        )
        pattern = (CARD, votes, "ss4.")
        counts[pattern] = counts.get(pattern, 0) + 1
        truths[pattern] = truths.get(pattern, 0) + int(true)
    model, truth = pii.reliabilities(counts)
    assert abs(model.prior[CARD] - 0.4) < 0.02
    for n, (r, s) in enumerate(zip(right, silent, strict=True)):
        assert abs(model.votes[CARD, n, 1, 2] - r * (1 - s)) < 0.03 and abs(model.votes[CARD, n, 0, 0] - r * (1 - s)) < 0.03
    decided = sum(truths[p] if y >= 0.5 else counts[p] - truths[p] for p, y in zip(counts, truth, strict=True))
    majority = sum(truths[p] if sum(p[1]) > 0 else counts[p] - truths[p] for p in counts)
    trained = pii.train(counts)
    learned = sum(truths[p] if trained.score(p) >= 0.5 else counts[p] - truths[p] for p in counts)
    assert decided > majority and decided > 0.95 * 30_000 and learned > 0.95 * 30_000


def sample():
    """Texts with exact spans, spans only the method can find, and numbers that are neither."""
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows, planted, decoys = [], [], 0
    for n in range(900):
        words = [rng.choice(("the", "river", "und", "ville", "casa", "lamp")) for _ in range(rng.randrange(5, 60))]
        kind = n % 9
        new = None
        if kind == 0:
            put = f"mail {rng.choice('abc')}{n}@post{n % 7}.example.org"
        elif kind == 1:
            put = f"phone +49 {digits(3)} {digits(7)}"
        elif kind == 2:
            new = f"{rng.choice('abc')}{n} [at] host{n % 5} [dot] com"
            put = f"contact {new}"
        elif kind == 3:
            new = f"(0{digits(2)}) {digits(3)}-{digits(4)}"
            put = f"tel {new}"
        elif kind == 4:
            put, decoys = f"order {digits(3)}-{digits(4)}-{digits(3)}", decoys + 1
        elif kind == 5:
            put, decoys = f"version 3.{n}.{digits(3)}{n}.1", decoys + 1
        elif kind == 6:
            put, decoys = f'token "{digits(9)}a{digits(13)}f{digits(8)}"', decoys + 1
        elif kind == 7:
            put = f"host 8{n % 10}.{n % 200}.7.{n % 90 + 10}"
        else:
            put, decoys = f"isbn {digits(13)}", decoys + 1
        at = rng.randrange(len(words) + 1)
        text = " ".join([*words[:at], put, *words[at:]])
        if new:
            start = text.index(new)
            planted.append((n, EMAIL if kind == 2 else PHONE, start, start + len(new)))
        rows.append((n, text))
    return rows, planted


def test_method_adds_spans_and_leaves_decoys(spark):
    rows, planted = sample()
    more = [(9000, None), (9001, ""), (9002, "é" * 70_000 + " a@b.de"), (None, "mail x@y.org"), (0, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows + more], "doc_id long, text string, found string").repartition(5)
    model = pii.fit(docs)
    found = pii.find(docs, model)
    assert found.columns == ["doc_id", "text", "found"]
    results = [(r.doc_id, r.text, [tuple(s) for s in r.found]) for r in found.collect()]
    assert len(results) == len(rows) + len(more)
    added = []
    for i, text, spans in results:
        exact = [(s, KINDS.index(k), e) for k, s, e, is_exact, _ in spans if is_exact]
        assert exact == plain_spans(text or "") and spans == sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        added += [(i, KINDS.index(k), s, e) for k, s, e, is_exact, _ in spans if not is_exact]
    hits = len(set(added) & set(planted))
    assert hits >= 0.95 * len(planted) and len(added) - hits <= 0.02 * len(rows), (hits, len(planted), len(added))
    counts = pii.patterns(docs)
    brute = {}
    for _, text in rows + more:
        for c in candidates(text or ""):
            brute[pii.pattern_of(c)] = brute.get(pii.pattern_of(c), 0) + 1
    assert counts == brute and len(counts) < pii.MAX_PATTERNS
    # The estimate decides: with the labelers' reliabilities turned round, nothing is added.
    turned, truth = pii.reliabilities(counts)
    assert model.weights and all(len(k) == len(LABELERS) for _, k, _ in counts) and turned.prior[PHONE] > 0.2


def test_no_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = pii.fit(docs)
    assert pii.find(docs, model).collect() == [] and model.score((IP, (1,) * 5, "ss2-")) < 0.5


def test_query(spark):
    folder = scratch_path(spark, "pii-test")
    texts = {1: "a@b.de, 10.0.0.1", 2: None, 3: "", 4: "+1 (017) 555-7713 4111 1111 1111 1111", 5: "none"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    for r in queries.op11_pii(spark, folder).collect():
        spans = plain_spans(texts[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in spans) for n in range(4))
        listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans == listed
