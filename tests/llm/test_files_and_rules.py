"""WARC archives, page text, url rules and packing."""

import base64
import hashlib
import io
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from tidemark.llm import html_text, packing, queries, url_rules, warc
from tidemark.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, payload string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "p") for i, u, h in rows], PAGES)


PAGE_ROWS = [
    (3, "http://a/1", "<p>é</p>" * 40),
    (1, "http://a/2", "<p>é</p>" * 40),
    (2, None, "<p>é</p>" * 40),
    (4, "http://a/3", "short"),
    (5, "http://a/4", "short"),
    (6, "http://a/5\r\nX: y", None),
    (7, "", ""),
    (8, "http://a/6", "\r\n\r\n" * 100),
    (8, "http://a/6", "\r\n\r\n" * 100),
    (9, "http://a/7", "x" * 3_000_000),
    (None, "http://a/8", "<p>é</p>" * 40),
]


def test_archives_read_back_what_was_written(spark):
    pages = pages_of(spark, PAGE_ROWS)
    archives = warc.write(pages, scratch_path(spark, "warc"), archive_bytes=2000)
    assert archives.agg({"records": "sum"}).first()[0] == len(PAGE_ROWS)
    found = warc.read(archives).collect()
    assert len(found) == len(PAGE_ROWS) and all(r.problem is None for r in found)
    expected = []
    for i, u, h in PAGE_ROWS:
        data = (h or "").encode()
        same = [p for p, _, g in PAGE_ROWS if (g or "").encode() == data and p is not None and len(data) >= 100]
        to = min(same) if same and i is not None and i != min(same) else None
        kind = "response" if to is None else "revisit"
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), kind, to, " ".join((u or "").split())))
    key = lambda r: (r[0] is None, r[0] or 0)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url) for r in found]
    assert sorted(got, key=key) == sorted(expected, key=key)
    bodies = {r.page_id: r.payload for r in found if r.record_type == "response"}
    assert bytes(bodies[1]).decode() == "<p>é</p>" * 40 and bytes(bodies[6]) == b""
    empty = warc.write(pages.limit(0), scratch_path(spark, "warc"))
    assert warc.read(empty).collect() == []


def test_written_records_have_what_the_format_demands(spark):
    archives = warc.write(pages_of(spark, PAGE_ROWS), scratch_path(spark, "warc"))
    heads = []
    for path in [r.path for r in archives.collect()]:
        with open(path.removeprefix("file:"), "rb") as stream:
            heads += [r.head for r in warc.records(stream)]
    assert len({h["warc-record-id"] for h in heads}) == len(heads) == len(PAGE_ROWS)
    for h in heads:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", h["warc-record-id"])
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["warc-date"])
        assert {"warc-type", "content-length", "content-type", "warc-target-uri"} <= set(h)
        if h["warc-type"] == "revisit":
            assert {"warc-profile", "warc-refers-to-target-uri", "warc-refers-to-date"} <= set(h)
    assert [h["warc-refers-to-target-uri"] for h in heads if h.get("x-page-id") == "2"] == ["http://a/2"]


def crawled(kind, block, content="application/http; msgtype=response", **head):
    told = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:0>", "WARC-Date": "2024-01-01T00:00:00Z"} | head
    told |= ({"Content-Type": content} if content else {}) | {"Content-Length": str(len(block))}
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in told.items())]
    return warc.gzip_member("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_of_other_writers():
    """What public crawls write: SHA-1 in base 32, records without an HTTP head, requests."""
    body = b"<p>crawled</p>\r\n\r\nmore"
    http = b"HTTP/1.1 200 OK\r\nX-A: b\r\n\r\n" + body
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    plain = b"software: x\r\n\r\nformat: WARC\r\n"
    data = [
        crawled("warcinfo", plain, "application/warc-fields"),
        crawled("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request"),
        crawled("response", http, **{"WARC-Block-Digest": sha1(http), "WARC-Payload-Digest": sha1(body)}),
        crawled("response", http, None, **{"WARC-Payload-Digest": "SHA-256:" + hashlib.sha256(body).hexdigest().upper()}),
        crawled("response", http, **{"WARC-Payload-Digest": "blake9:whatever", "WARC-Block-Digest": "md5:short"}),
        crawled("response", http, **{"WARC-Payload-Digest": sha1(b"other")}),
        crawled("resource", body, "text/html", **{"WARC-Payload-Digest": sha1(body)}),
        crawled("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", **{"WARC-Payload-Digest": sha1(body)}),
        crawled("metadata", b"a: b\r\n", "application/warc-fields"),
    ]
    found = list(warc.records(io.BytesIO(b"".join(data))))
    assert [r.problem for r in found] == [None] * 5 + ["the payload differs from its digest"] + [None] * 3
    assert found[0].payload == plain and found[1].payload == b"" and found[6].payload == body
    assert all(found[i].payload == body and found[i].payload_digest == hashlib.sha256(body).hexdigest() for i in (2, 3, 4))
    assert found[7].payload is None and found[7].payload_digest == sha1(body) and found[7].payload_bytes == 0


def archive(n=4):
    return [warc.gzip_member(warc.record(i, "u", b"body %d" % i * 50, hashlib.sha256(b"body %d" % i * 50).hexdigest(), None)) for i in range(n)]


def problems(data):
    return [r.problem for r in warc.records(io.BytesIO(data))]


def test_damage_is_reported_and_reading_goes_on():
    good = archive()
    assert problems(b"".join(good)) == [None] * 4
    plain = zlib.decompress(good[1], 31)
    for bad in (
        plain.replace(b"body 1", b"bodY 1", 1),
        plain.replace(b"Content-Length: ", b"Content-Length: 1", 1),
        plain[:-2],
        plain + b"more",
        b"no archive\r\n\r\n",
        plain.replace(b"WARC/1.1", b"HTTP/1.1", 1),
    ):
        found = problems(good[0] + warc.gzip_member(bad) + good[2])
        assert [p is None for p in found] == [True, False, True], found
    assert [p is None for p in problems(good[0] + good[1][:-20])] == [True, False]
    assert [p is None for p in problems(good[0] + b"junk" + good[1])] == [True, False]
    assert problems(b"") == []


ARTICLE = "<p>First, a sentence; with marks. And one more.</p><p>Second &amp; last&nbsp;one,\n here.</p>"
TEXT = "First, a sentence; with marks. And one more.\n\nSecond & last one, here."
AROUND = (
    "<!DOCTYPE html><html><head><title>T</title><style>p b</style><script>'</p>'</script></head><body>"
    "<header><p>Site name, a claim. More.</p></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
    "<div class='cookie-notice'><p>We use cookies, as all do. Agree?</p></div>{}"
    "<aside><p>See also, this. And that.</p></aside><div id=sidebar>Other, things. Here.</div>"
    "<form><p>Subscribe, now. Please.</p><input></form><section class='reader comments'><p>I, a reader, differ. Much.</p></section>"
    "<!-- <p>gone, never shown.</p> --><footer>&copy; host, a line. Another.</footer></body></html>"
)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("plain, text. Only.", "plain, text. Only."),
        (AROUND.format(f"<article>{ARTICLE}</article>"), TEXT),
        (AROUND.format(f"<main><div>{ARTICLE}</div></main>"), TEXT),
        (AROUND.format(f"<div class=x>{ARTICLE}</div>"), TEXT),
        (AROUND.format(f"<article><h1>Head</h1>{ARTICLE}<div class=ad>Buy, it. Now.</div></article>"), "Head\n\n" + TEXT),
        ("<article><p>one<p>two <b>bold<br>line</b>", "one\n\ntwo bold line"),
        ("<article><p>a < b &lt;i&gt; &#233;&#x41; &amp;amp;</p><p>cut <a hr", "a < b <i> éA &amp;\n\ncut"),
        ("<article><script>if (a<b) '</p>'</script><p>x</p><style>y", "x"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<article><p title='a>b'>ok</p></article><div>no, never. No.</div>", "ok"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "A long article, with many words. " * 20


@pytest.mark.parametrize(
    ("page", "kept", "gone"),
    [
        # Names that sound like an article, or like no article, are not enough.
        ("<div class='post-date'>1 May</div><div class='text'><p>{}</p></div>", [], ["1 May"]),
        (
            "<article><div class='article-header'><h1>Title</h1></div><p class='share-intro'>Intro words.</p>"
            "<div class='form-of-life'>Life, short.</div><p>{}</p></article>",
            ["Title", "Intro words.", "Life, short."],
            [],
        ),
        ("<main><p>{}</p><ul><li><a href=x>One link here</a></li><li><a href=y>Other</a></li></ul></main>", [], ["One link", "Other"]),
        # Without any names.
        (
            "<div><a href=a>Home</a> <a href=b>News</a></div><h1>Big title</h1><div><p>{}</p><p>Short one.</p></div>"
            "<div>Copyright 2020 Foo Inc. All rights reserved.</div>",
            ["Big title", "Short one."],
            ["Home", "Copyright"],
        ),
        # A form around the page, and one in the article.
        ("<form id=page><div>{}</div><nav><a href=x>q</a></nav></form>", [], ["q\n"]),
        ("<article><p>{}</p><form><p>Subscribe to our news, and get it all.</p></form><table><tr><td>5<td>ab</table></article>", ["5", "ab"], ["Subscribe"]),
        # Long comments, hidden text.
        ("<div><p>{}</p></div><section id='comments'><p>" + "I disagree, strongly, with that. " * 30 + "</p></section>", [], ["disagree"]),
        ("<div><p>{}</p></div><div class='comment-list'><p>" + "I disagree, strongly, with that. " * 15 + "</p></div>", [], ["disagree"]),
        ("<article><p>{}</p><p style='display: none'>Hidden, all of it. Really.</p></article>", [], ["Hidden"]),
    ],
)
def test_ratios_decide_and_names_weigh(page, kept, gone):
    text = html_text.main_text(page.format(LONG))
    assert LONG.strip() in text
    assert all(k in text.split("\n\n") for k in kept) and not any(g in text for g in gone), text


def test_short_articles_and_pages_without_any():
    assert html_text.main_text("<article><p>The</p></article><div class=ad>Buy our things now, they are good. Really.</div>") == "The"
    assert html_text.main_text("<nav>Menu words here.</nav><footer>Only a footer, nothing else. At all.</footer>") == ""
    assert html_text.main_text("<p><a href=x>Whole text is a link</a></p>") == "Whole text is a link"


def plain_scores(found):
    """The score of each path, written out."""
    paths = list(dict.fromkeys(b.path for b in found))
    per = {}
    for path in paths:
        mine = [b for b in found if b.path == path]
        unlinked = [max(0, len(b.text) - b.linked) for b in mine]
        size = sum(u + 0.01 * (len(b.text) - u) for b, u in zip(mine, unlinked, strict=True)) / len(mine)
        marks = sum(sum(c in ".,;:!?…。，、！？；：" for c in b.text) for b in mine if b.linked < len(b.text) / 2) / len(mine)
        per[path] = (size, marks, max(b.weight for b in mine), any(not b.in_form for b in mine))

    def smooth(i, what):
        near = [per[paths[min(max(j, 0), len(paths) - 1)]][what] for j in (i - 1, i, i + 1)]
        return (near[0] + 6 * near[1] + near[2]) / 8

    level = max(b.inside for b in found)
    outside_by = {p: 1 if any(b.inside == level for b in found if b.path == p) else (1, 0.25, 0.0625)[level] for p in paths}
    in_forms = sum(len(b.text) for b in found if b.in_form) / max(1, sum(len(b.text) for b in found))
    ratio, weight = {}, {}
    for i, path in enumerate(paths):
        size, _, named, outside = per[path]
        length = smooth(i, 0) if size >= 10 else min(size, smooth(i, 0))
        ratio[path] = length * (1 + 10 * smooth(i, 1) / (1 + smooth(i, 0)))
        weight[path] = (named if outside or in_forms >= 0.8 else named / 32) * outside_by[path]
    best = max([r for p, r in ratio.items() if weight[p] >= 1] or ratio.values())
    return {p: (ratio[p] / best) ** 0.5 * weight[p] for p in paths}


def test_scores_equal_plain_python_and_change_the_result(spark):
    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect() if r.html]
    pages += [AROUND.format(f"<div class=x>{ARTICLE}</div>"), "<form><p>a, b. c</p></form><p>d</p>"]
    changed = 0
    for page in pages:
        found = html_text.blocks(page)
        order, score = html_text.scores(found)
        expected = plain_scores(found)
        assert list(order) == list(expected)
        assert np.allclose(score, list(expected.values()), rtol=1e-12)
        picked = [b for b in html_text.select(found)]
        good = {p for p, s in expected.items() if s >= html_text.THRESHOLD}
        heads = {p[:-1] for p in good}
        heading = lambda b: b.path[-1].split(".")[0] in html_text.HEADINGS
        led = lambda n: next((b.path in good for b in found[n:] if not heading(b)), False)  # noqa: B023, E731
        assert picked == [
            b for n, b in enumerate(found)
            if b.path in good or heading(b) and (b.path[:-1] in heads or b.weight >= 1 and led(n))
        ]
        changed += html_text.main_text(page, 0.0) != html_text.main_text(page)
    assert changed > 0.9 * len(pages)


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>ü, ok.</p>"), (2, "v", "<p>" + "long, " * 200_000)]
    found = html_text.extract(pages_of(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text[:6], r.n_chars) for r in found.collect()), key=str)
    assert got == sorted([(1, "", 0), (1, "", 0), (None, "ü, ok.", 6), (2, "long, ", 1_199_999)], key=str)
    assert html_text.extract(pages_of(spark, [])).collect() == []


URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "http://x.net/a", "http://xnet/a", "http://a.example.NET/en/x",
    "http://example.net/en", "http://example.net/EN/", "https://www.example.com/de/1?x=/fr/#y", "https://org/fr/", "http://a.org/fr",
    "http://a.org/fr/?q", "ftp://b.org/fr/x#z", "http://x.com?u=http://y.net/", "http://m.casino-win.example.com/en/1",
    "http://mycasino.example.com/", "http://casino/", "http://a.com/casino", "http://éa.net/ü", "http://x.net/" + "a/" * 50_000,
]


def brute_verdict(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    end = min([i for i in (rest.find(c, cut) for c in "?#") if i >= 0] or [len(rest)])
    path, best = rest[cut:end], None
    for rule, _ in queries.LISTED:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def test_urls_equal_brute_force(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(5, URLS[5], "h"), (None, "http://x.net/a", "h")]
    found = url_rules.judge(pages_of(spark, rows), queries.URL_RULES).collect()
    assert len(found) == len(rows)
    verdicts = dict(queries.LISTED)
    for r in found:
        if r.page_id is None:
            assert (r.rule, r.verdict) == ("net/", "block")
            continue
        assert (r.host, r.path, r.rule) == brute_verdict(URLS[r.page_id]), URLS[r.page_id]
        if r.rule:
            assert r.verdict == verdicts[r.rule]
    block = {URLS[r.page_id] for r in found if r.page_id is not None and not r.rule and r.verdict == "block"}
    assert block == {"http://m.casino-win.example.com/en/1", "http://casino/"}
    assert url_rules.judge(pages_of(spark, []), queries.URL_RULES).collect() == []


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = spark.createDataFrame([("a.example.net", "/en/")] * 3 + [("b.net", "/")], "host string, path string")
    rules = [url_rules.host_rule("example.net/en/", "allow")]
    assert url_rules.token_counts(urls, rules) == {"example": 3, "net": 4, "en": 3}
    with pytest.raises(ValueError):
        url_rules.judge(pages_of(spark, []), rules * 3, max_rules=2)


def test_plan_uses_every_piece_once_and_packs_tightly():
    rng = random.Random(6)
    for top, n in ((2048, 3000), (60, 500), (2048, 7)):
        lengths = [rng.randrange(1, top + 1) if rng.random() < 0.8 else top // 3 for _ in range(n)]
        counts = {x: lengths.count(x) for x in set(lengths)}
        made = packing.plan(counts, top)
        used = {}
        for p in made:
            assert sum(p.lengths) <= top
            for x in p.lengths:
                used[x] = used.get(x, 0) + p.times
        assert used == counts
        assert sum(p.times for p in made) <= -(-sum(lengths) // top) * 1.03 + 2
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({2049: 1})


def test_exact_complements_come_before_best_fit():
    assert {p.lengths for p in packing.plan({7: 1, 3: 1, 6: 1, 2: 2, 5: 1, 4: 1, 1: 1}, 10)} == {(7, 3), (6, 4), (5, 2, 2, 1)}


def test_pieces_and_places(spark):
    rng = random.Random(7)
    vocabulary = ["the", "thanedble", "naïve", "12", "don't", "<|endoftext|>", "  ", "\n", "日本"]
    texts = [None, "", "a", "a", " ".join(rng.choice(vocabulary) for _ in range(9000))]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(900))) for _ in range(60)]
    rows = [(i, t, 5, "x") for i, t in enumerate(texts)] + [(3, "a", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long, piece string")
    pieces = packing.token_pieces(docs, *queries.vocabulary(), with_ids=True)
    found = packing.pack(pieces).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[3]) == 2
    for i, t in enumerate(texts):
        ids = np.array([*tokens.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        got = sorted(by[i], key=lambda r: r.piece)[: 1 if i == 3 else None]
        assert [x for r in got for x in r.ids] == ids.tolist()
        assert all(r.length == 2048 for r in got[1:])
        for r in got:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and len(r.ids) == r.length
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(pieces.limit(0)).collect() == []


def test_added_tokens_in_texts_are_one_id(spark):
    """The query's rows against tokenizers as it is set by default."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n  y", "<|endoftext", " don't<|endoftext|> 12", None, ""]
    folder = scratch_path(spark, "added-tokens")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in queries.op6_packing(spark, folder).collect()}
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in enumerate(texts):
        ids = np.array([*tokens.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("text", [" " * 5_000_000, "\n" * 5_000_000, "a" * 5_000_000, " " * 2_000_000 + "😀" + "\t" * 2_000_000, "😀" * 300_000])
def test_ids_of_long_runs_are_those_of_tokenizers(text):
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.encode(text, *queries.vocabulary(), queries.added_tokens())
    assert found == tokens.encode(text, add_special_tokens=False).ids


def test_a_long_run_does_not_end_the_job(spark):
    texts = [" " * 1_500_000, "x " + "\n" * 1_200_000 + "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = packing.token_pieces(docs, *queries.vocabulary(), added=queries.added_tokens()).groupBy("doc_id").agg({"length": "sum"})
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert dict(tuple(r) for r in found.collect()) == expected


def test_sums_of_lengths_equal_all_combinations():
    rng = random.Random(2)
    for _ in range(300):
        capacity = rng.choice((6, 11, 17))
        left = [0] + [rng.choice((0, 0, 1, 2)) for _ in range(capacity)]
        sums = packing._Sums(left)
        for _ in range(6):  # pieces are used up between the questions
            length = rng.randrange(1, capacity + 1)
            if not left[length]:
                continue
            gap, most = capacity - length, rng.choice((1, 2, 3))
            spare = [n - (i == length) for i, n in enumerate(left)]
            fits = [
                c for k in range(most + 1) for c in itertools.combinations_with_replacement(range(capacity, 0, -1), k)
                if sum(c) == gap and all(c.count(i) <= spare[i] for i in set(c))
            ]
            found = sums.filling(gap, most, (length,))
            assert (found is None) == (not fits) and (found is None or len(found) == min(map(len, fits)))
            if found:
                assert tuple(sorted(found, reverse=True)) in fits
                for i in (length, *found):
                    left[i] -= 1


@pytest.mark.parametrize("capacity", [10, 100, 2048])
def test_plans_use_every_piece_once(capacity):
    rng = random.Random(capacity)
    for _ in range(30):
        counts = {rng.randrange(1, capacity + 1): rng.choice((1, 2, 50)) for _ in range(rng.randrange(0, 200))}
        made = packing.plan(counts, capacity)
        used = {}
        for p in made:
            assert sum(p.lengths) <= capacity and p.times > 0
            for i in p.lengths:
                used[i] = used.get(i, 0) + p.times
        assert used == counts
        # Best fit leaves no two sequences that would go into one.
        total = sum(i * n for i, n in counts.items())
        assert -(-total // capacity) <= sum(p.times for p in made) <= 2 * -(-total // capacity)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_whole_tables(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    tables = {"doc_id": "documents", "page_id": "pages", "conv_id": "conversations", "vec_id": "embeddings"}
    key = next(k for k in tables if k in found.columns)
    source = spark.read.parquet(f"{SMALL}/{tables[key]}.parquet")
    assert found.count() > 0
    if name != "op3_decontaminate":
        assert found.select(key).distinct().count() == source.select(key).distinct().count()


def test_pipeline_stages_hand_on_documents(spark):
    import corpus_pipeline
    from tidemark.llm.common import DOCUMENT_COLUMNS, table

    docs = table(spark, SMALL, "documents").drop("nothing")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs.withColumn("score", docs.doc_id * 2), SMALL), f"test-{name}")
        assert docs.columns == list(DOCUMENT_COLUMNS)
        assert 0 < docs.count() <= seen
        assert docs.select("doc_id").distinct().count() == docs.count()
        seen = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == seen
    empty = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
