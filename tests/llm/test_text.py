"""Packing, token counts and HTML extraction."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm import catalogue, html_extract, packing, token_counts
from tillwright.llm.common import prepare
from tillwright.llm.packing import pack, plan, reduce_instance
from tillwright.llm.tokens import word_encoder

TOKENIZER = Tokenizer.from_file(catalogue.TOKENIZER)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


# --- encoding ---------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcXYZ 012.,!?'\"<|>_-éÉ×ñß\t\n\x1c\x01œ’—ı́　"))), max_size=4))
def test_ids_are_the_tokenizers(texts):
    found = word_encoder(catalogue.TOKENIZER).encode_block([t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain_ids(t) for t in texts]


def test_memory_of_words_starts_afresh(monkeypatch):
    monkeypatch.setattr("tillwright.llm.tokens.REMEMBERED", 5)
    coder = word_encoder(catalogue.TOKENIZER)
    coder.known.clear()
    texts = [" ".join(f"it's{i}w’{j}" for j in range(4)) for i in range(6)]
    found = coder.encode_block([t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain_ids(t) for t in texts]


# --- packing ------------------------------------------------------------------------


def sequences(counts, capacity):
    rows, number = plan(counts, capacity)
    out, seen = defaultdict(list), Counter()
    for length, low, high, first, each, at in rows:
        for rank in range(low, high):
            out[first + (rank - low) // each].append((at + (rank - low) % each * length, length))
            seen[length] += 1
    assert seen == Counter(counts) and sorted(out) == list(range(number))
    for own in out.values():
        stop = 0
        for offset, length in sorted(own):
            assert offset == stop
            stop += length
        assert stop <= capacity
    return number


def fewest(lengths, capacity):
    """The smallest number of sequences, by trying all."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                rest = list(rooms)
                rest[rest.index(room)] -= lengths[i]
                place(i + 1, rest)
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(2)
    for _ in range(150):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        fixed, rest = reduce_instance(dict(Counter(lengths)), 20)
        left = [v for v, n in rest.items() for _ in range(n)]
        used = sum(n for _, n in fixed)
        assert Counter(lengths) == Counter(left) + Counter(v for s, n in fixed for v in s * n)
        assert used + fewest(left, 20) == fewest(lengths, 20)


def test_plans_are_sound_and_tight():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([7, 20, 60])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        number = sequences(dict(Counter(lengths)), capacity)
        assert number <= 11 / 9 * max(1, -(-sum(lengths) // capacity)) * 1.2 + 1
    assert plan({}, 10) == ([], 0)


def check_packing(rows, found, capacity):
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {r[0] for r in rows}
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*plain_ids(text), 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            wanted[doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert wanted == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    lying = defaultdict(list)
    for r in found:
        lying[r.sequence_id].append((r.offset, r.length))
    for own in lying.values():
        stop = 0
        for offset, length in sorted(own):
            assert offset == stop
            stop += length
        assert stop <= capacity
    total = sum(r.length for r in found)
    return len(lying), -(-total // capacity)


def test_pack_edges(spark):
    prepare(spark)
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "no id"), (4, "word it's “odd” " * 30), (5, "x " * 90)]
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, length int, shard string")
    check_packing(rows, pack(docs, catalogue.TOKENIZER, 16).collect(), 16)
    assert pack(docs.limit(0), catalogue.TOKENIZER, 16).collect() == []


def test_pack_rows_that_are_alike(spark, monkeypatch):
    """A third of the rows equal in id and text: they are dealt over the shards like others."""
    prepare(spark)
    monkeypatch.setattr(packing, "SHARD_ROWS", 25)
    rows = [(7, "one and the same text")] * 400 + [(i, "words " * (i % 40)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = pack(docs, catalogue.TOKENIZER, 64)
    used, least = check_packing(rows, found.collect(), 64)
    assert used <= 1.05 * least
    pieces = packing.cut_pieces(docs, catalogue.TOKENIZER, 64).withColumn("row", F.monotonically_increasing_id())
    shard = F.pmod(F.xxhash64("row"), F.lit(16))
    sizes = [r[1] for r in pieces.where("doc_id = 7").groupBy(shard).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 60


def test_pack_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_packing(rows, catalogue.op9_best_fit_packing(spark, data).collect(), 4096)
    assert used <= least + 1


# --- token counts ---------------------------------------------------------------------


def plain_counts(text, sections):
    coder, _ = token_counts._coder(catalogue.RANKS)
    text, counts, none, stop = text or "", Counter(), 0, 0
    raw = text.encode()
    starts = [len(text[:a].encode()) for a, _ in sections]
    stops = [len(text[:b].encode()) for _, b in sections]
    for token in coder.encode_ordinary(text):
        start, stop = stop, stop + len(coder.decode_single_token_bytes(token))
        shares = [min(stop, b) - max(start, a) for a, b in zip(starts, stops, strict=True)]
        if shares and max(shares) > 0:
            counts[shares.index(max(shares))] += 1
        else:
            none += 1
    assert stop == len(raw)
    return counts, none


def lines(text):
    out, at = [], 0
    for line in (text or "").split("\n"):
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    out[-1] = (out[-1][0], len(text or ""))
    return out[:-1] if len(out) > 1 and out[-1][0] == out[-1][1] else out


def check_counts(rows, found):
    by_doc = defaultdict(dict)
    for r in found:
        by_doc[r.doc_id][r.section] = (r.start, r.stop, r.n_tokens)
    for doc_id, text in rows:
        own = lines(text)
        counts, none = plain_counts(text, own)
        assert none == 0
        assert by_doc[doc_id] == {i: (a, b, counts[i]) for i, (a, b) in enumerate(own)}


def test_count_edges(spark):
    prepare(spark)
    rows = [(1, None), (2, ""), (3, "one line"), (4, "a\n\n\nb  \n c é\n"), (5, "\n\n"), (6, "ü\n  \n日本\nx"), (7, "w " * 20_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, section int")
    check_counts(rows, token_counts.token_counts(docs, catalogue.RANKS).collect())
    assert token_counts.token_counts(docs.limit(0), catalogue.RANKS).collect() == []
    twice = token_counts.token_counts(docs.where("doc_id = 3").union(docs.where("doc_id = 3")), catalogue.RANKS)
    assert twice.count() == 2


def test_counts_of_given_sections(spark):
    prepare(spark)
    rng = random.Random(6)
    rows = []
    for i in range(40):
        text = "".join(rng.choices("ab é\n日 wordy", k=rng.randint(0, 60)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), 2 * rng.randint(0, 3)) // 2 * 2))
        rows.append((i, text, [tuple(cuts[j : j + 2]) for j in range(0, len(cuts), 2)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:long,stop:long>>")
    found = defaultdict(dict)
    for r in token_counts.token_counts(docs, catalogue.RANKS, sections=F.col("parts")).collect():
        found[r.doc_id][r.section] = r.n_tokens
    for i, text, parts in rows:
        counts, none = plain_counts(text, parts)
        assert found[i] == {**{k: counts[k] for k in range(len(parts))}, **({-1: none} if none else {})}


def test_count_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check_counts(rows, catalogue.op5_token_counts(spark, data).collect())


# --- HTML -----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Other things to see here</a></li></ul></nav>
<div class="ad">Buy our very good things now today</div>
<{open}><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text of the article that goes on for a while.</p>
<div class="advert">Advert in the middle of it all</div><p>S&eacute;cond part.<br>With a break</p><ul><li>One item</li></ul>
<p>x</p></{close}>
<aside>Some words at the side</aside><div id="comments"><p>A reader writes a long comment here about it.</p></div>
<form><p>Sign up to our letter</p><input></form><footer>&copy; nobody at all, all rights kept</footer><script>var a = "<p>no</p>";</script></body></html>"""
TEXT = "Head & line\n\nFirst bold text of the article that goes on for a while.\n\nSécond part. With a break\n\nOne item\n\nx"


def test_region_and_what_is_apart():
    weights = html_extract.learn([PAGE.format(open="article", close="article")] * 5)
    assert weights.cost["p"] < html_extract.BARRIER < weights.cost["article"]
    assert "footer" not in weights.cost
    for tag in ("article", "main", 'div class="story"'):
        page = PAGE.format(open=tag, close=tag.split()[0])
        assert html_extract.extract(page, weights) == TEXT
    assert html_extract.extract(PAGE.format(open="article", close="article"), html_extract.Weights()) == TEXT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a &lt;b&gt; &#233;&nbsp; c</p>", "a <b> é c"),
        ("<p>never closed <b>bold", "never closed bold"),
        ("<!-- never closed <p>x</p>", ""),
        ("<script>never closed <p>x</p>", ""),
        ("<nav>only a menu</nav>", ""),
        ("a < b and c", "a < b and c"),
        ("<p>one</p><p>   </p><p>two</p>", "one\n\ntwo"),
        ("<p>" + "long words " * 20_000 + "</p>", ("long words " * 20_000).strip()),
    ],
)
def test_odd_pages(html, text):
    assert html_extract.extract(html, html_extract.Weights()) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<ul><li class="share">a<li class="share">b</ul><p>rest of it', "rest of it"),
        ('<ul><li class="share">a<li>one<li>two</ul><p>rest', "one\n\ntwo\n\nrest"),
        ('<p class="notice">x<p>rest<p>more', "rest\n\nmore"),
        ('<p class="notice">x <b>y<div>rest</div>', "rest"),
        ('<div><p class="notice">x</div>rest', "rest"),
        ('<div><span class="share">x</div><p>rest', "rest"),
        ('<div><div class="ad">x<div>y</div></div></div><p>rest', "rest"),
        ('<dl><dt class="ad">x<dd>one<dt>two</dl>rest', "one\n\ntwo\n\nrest"),
        ('<table><tr><td class="ad">x<td>one<tr class="promo"><td>y<tr><td>two</table>rest', "one\n\ntwo\n\nrest"),
        ('<datalist><option>x<option>y</datalist><p>rest', "rest"),
        ('<ul><li class="share">a<ul><li>b</ul>c<li>one</ul>rest', "one\n\nrest"),
        ('<p class="notice">x <b>y</p><p>rest', "rest"),
        ('<b><p class="notice">x</b> y</p><p>rest', "rest"),
        ('<aside><p>x<ul><li>y</aside><p>rest', "rest"),
        ('<a class="promo"><p>x</a></p>rest', "rest"),
        ('<table><tr><td><div class="ad">x</td><td>one</table>rest', "one\n\nrest"),
    ],
)
def test_unclosed_elements_end_with_their_parent(html, text):
    page = f"<body><article><p>First words.</p>{html}</article><p class=x>"
    own = html_extract.tokens(page)
    skip = html_extract.apart(own)
    left = "".join(" " if t.key and t.name in html_extract.BLOCK else t.text for t, s in zip(own, skip, strict=True) if not s)
    assert left.split() == ["First", "words.", *text.split()]
    weights = html_extract.Weights({t.key: 0.01 for t in own if t.key})
    assert html_extract.extract(page, weights) == "First words.\n\n" + text


@pytest.mark.parametrize(
    "inner",
    [
        '<h2 class="section-header">{}</h2>',
        '<p class="ad-hoc">{}</p>',
        '<p class="form-factor">{}</p>',
        "<header><h1>{}</h1></header>",
        '<div class="header">{}</div>',
    ],
)
def test_names_alone_drop_nothing_of_an_article(inner):
    page = PAGE.format(open="article", close="article").replace("<p>x</p>", "<p>x</p>" + inner.format("More of it."))
    for weights in (html_extract.Weights(), html_extract.learn([PAGE.format(open="article", close="article")] * 5)):
        assert html_extract.extract(page, weights) == TEXT + "\n\nMore of it."


def test_names_are_learned_from_where_they_stand():
    def page(name, inside):
        box = f'<div class="{name}"><p>Some words in a box.</p></div>'
        return f"<body>{'' if inside else box}<article><p>The text.</p>{box if inside else ''}<p>Its end.</p></article>"

    weights = html_extract.learn([page("qux", False)] * 20 + [page("promo", True)] * 60)
    assert html_extract.extract(page("qux", True), weights) == "The text.\n\nIts end."
    assert html_extract.extract(page("promo", True), weights) == "The text.\n\nSome words in a box.\n\nIts end."
    assert html_extract.extract(page("quux", True), weights) == "The text.\n\nSome words in a box.\n\nIts end."


def test_unclosed_elements_take_linear_time():
    import time

    def seconds(n):
        page = "<article>" + "<div><p>word <b>bold<span class='x'>" * n + "</article>"
        start = time.perf_counter()
        html_extract.extract(page, html_extract.Weights())
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16_000) < 12 * max(seconds(4_000), 0.02)


def test_region_is_the_best_contiguous_one():
    """Against all pairs of ends."""
    import random

    rng = random.Random(4)
    weights = html_extract.Weights({"p": 0.4, "/p": 0.4, "div": 5.0, "/div": 5.0, "b": 0.1, "/b": 0.1}, 0.3)
    for _ in range(60):
        parts = [rng.choice(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "one two ", "a few more words "]) for _ in range(18)]
        own = html_extract.tokens("".join(parts))
        skip = [False] * len(own)
        value = [-weights.of(t) if t.key else weights.word * len(t.text.split()) for t in own]
        best = max((sum(value[i:j]) for i in range(len(own)) for j in range(i + 1, len(own) + 1)), default=0)
        first, end = html_extract.region(own, skip, weights)
        if best <= 0:
            assert (first, end) == (0, len(own))
            continue
        # Growth adds cheap tags only, to both sides of a best region.
        inner = [(i, j) for i in range(first, end) for j in range(i + 1, end + 1) if abs(sum(value[i:j]) - best) < 1e-9]
        assert inner


def test_page_table_edges(spark):
    prepare(spark)
    rows = [(1, "u", None), (2, None, ""), (2, "v", "<p>x y</p>"), (None, "w", PAGE.format(open="article", close="article"))]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted((tuple(r) for r in html_extract.extract_pages(pages).collect()), key=repr)
    assert found == sorted([(1, "u", "", 0), (2, None, "", 0), (2, "v", "x y", 3), (None, "w", TEXT, len(TEXT))], key=repr)
    assert html_extract.extract_pages(pages.limit(0)).collect() == []


def test_page_query_finds_the_articles(spark, data):
    """The given pages mark their article; the text must be its blocks."""
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    found = {r.page_id: r for r in catalogue.op6_html_extraction(spark, data).collect()}
    assert found.keys() == pages.keys()
    for page_id, html in pages.items():
        article = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts]
        assert found[page_id].text == "\n\n".join(b for b in blocks if b)
        assert found[page_id].n_chars == len(found[page_id].text)
