"""Language ID, quality and toxicity: edges, and accuracy on rows held out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm import catalogue, langid, quality, toxicity
from tillwright.llm.common import bounded_sample, prepare
from tillwright.llm.words import split

EDGE = [(1, None), (2, ""), (3, " \n"), (4, "123 !!"), (5, "a"), (5, "a"), (None, "no id"), (6, "word " * 40_000)]


def edge(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, "x", 7) for r in EDGE], "doc_id long, text string, lang string, score int")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- words ----------------------------------------------------------------------


def test_words_are_hashed_by_their_bytes():
    texts = ["a word, a WORD", "", "über-word 12word", "word"]
    words = split([t.encode() for t in texts], lower=True)
    shown = [words.raw[a:b].tobytes().decode() for a, b in zip(words.start, words.stop, strict=True)]
    assert shown == ["a", "word", ",", "a", "word", "über", "-", "word", "12", "word", "word"]
    assert words.owner.tolist() == [0, 0, 0, 0, 0, 2, 2, 2, 2, 2, 3]
    same = {}
    for name, value in zip(shown, words.hash.tolist(), strict=True):
        assert same.setdefault(name, value) == value
    assert len(set(same.values())) == len(same)
    stems = words.stem(2).tolist()
    assert stems[1] == stems[4] and stems[1] not in same.values()


# --- language ID ------------------------------------------------------------------


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(1)
    net = langid._start(["x", "y", "z"], rng)
    net = langid.Network(net.labels, *[w.astype("f8") for w in net.parts()])
    windows = rng.integers(97, 105, (4, 6)).astype(np.uint8)
    truth = np.array([0, 1, 2, 1])

    def loss():
        total = 0.0
        for row, label in zip(windows, truth, strict=True):
            p = _plain_positions(net, row)
            total -= np.log(p[:, label]).sum()
        return total / windows.size

    grads = langid._gradients(net, windows, truth)
    for w, g in zip(net.parts(), grads, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(s) for s in w.shape)
            if w.shape[:2] == (2, 256):
                at = (at[0], int(rng.integers(97, 105)), at[2])
            keep = w[at]
            w[at] = keep + 1e-4
            up = loss()
            w[at] = keep - 1e-4
            down = loss()
            w[at] = keep
            assert (up - down) / 2e-4 == pytest.approx(g[at], abs=2e-4, rel=2e-2)


def _plain_positions(net, row):
    """Probabilities of each byte, one step at a time."""
    h = langid.HIDDEN
    states = []
    for d, order in ((0, row), (1, row[::-1])):
        state, own = np.zeros(h), []
        for byte in order:
            a, u = net.byte_in[d, byte], state @ net.state_in[d]
            r, z = 1 / (1 + np.exp(-(a + u)[:h])), 1 / (1 + np.exp(-(a + u)[h : 2 * h]))
            n = np.tanh(a[2 * h :] + r * u[2 * h :])
            state = z * state + (1 - z) * n
            own.append(state)
        states.append(np.array(own if d == 0 else own[::-1]))
    logits = states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias
    p = np.exp(logits)
    return p / p.sum(1, keepdims=True)


def test_pooling_matches_byte_by_byte():
    net = langid._start(["x", "y"], np.random.default_rng(2))
    texts = [b"short", b"", b"abc def " * 60, b"z" * 128, b"q" * 129]
    pooled, marks = langid.Labeller(net).pooled(texts)
    for i, text in enumerate(texts):
        rows = []
        for at in range(0, len(text), langid.WINDOW):
            own = np.frombuffer(text[at : at + langid.WINDOW].ljust(langid.WINDOW, b"\0"), np.uint8)
            rows.append(_plain_positions(net, own)[: len(text) - at])
        expected = np.concatenate(rows).mean(0) if rows else np.zeros(2)
        assert pooled[i] == pytest.approx(expected, abs=1e-4)
        assert marks[i].sum() == len(text)


def test_language_edges(spark):
    net = langid.train([b"aaa bbb " * 9, b"xyz zyx " * 9], ["one", "two"])
    found = edge(spark).withColumn("score", langid.predict(net, F.col("text")))
    rows = [(r.doc_id, r.score.lang, r.score.score) for r in found.collect()]
    assert len(rows) == len(EDGE) and found.columns == ["doc_id", "text", "lang", "score"]
    by_id = {r[0]: r for r in rows}
    for none in (1, 2, 3, 4):
        assert by_id[none][1:] == ("und", 0.0)
    assert by_id[5][1] in ("one", "two") and all(0 <= r[2] <= 1 for r in rows)
    assert found.where("doc_id = 5").select("score").distinct().count() == 1
    long = spark.createDataFrame([("bbb aaa " * 40, "one"), ("zyx xyz " * 40, "two")], "text string, lang string")
    assert all(r[0].lang == r[1] for r in long.select(langid.predict(net, F.col("text")), "lang").collect())
    assert langid.learn(edge(spark).limit(0)) is None
    assert {r[0].lang for r in edge(spark).select(langid.predict(None, F.col("text"))).collect()} == {"und"}


def test_language_of_rows_held_out(spark, data):
    found = catalogue.op4_language_id(spark, data)
    truth = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.9 * len(rows)


# --- quality ------------------------------------------------------------------------


def test_contexts_match_a_plain_count():
    texts = ["the cat sat, the dog sat", "", "one", "two words"]
    total = np.zeros((quality.BUCKETS, quality.SIZE), np.int64)
    quality._add_contexts(total, [t.encode() for t in texts])
    expected = np.zeros_like(total)
    for t in texts:
        words = split([t.encode()])
        for i in range(len(words.hash)):
            for j in range(max(0, i - quality.REACH), min(len(words.hash), i + quality.REACH + 1)):
                if i != j:
                    row, h = int(words.hash[i]) % quality.BUCKETS, int(words.hash[j])
                    for k in range(quality.NONZERO):
                        bits = h >> (20 + 6 * k)
                        expected[row, bits % quality.SIZE] += 1 - 2 * (bits >> 5 & 1)
    assert (total == expected).all()


def test_quality_edges(spark):
    docs = edge(spark)
    marked = labels(spark, [(1, 1, 0), (2, 0, 0), (5, 1, 0), (6, 0, 0), (6, 0, 0), (4, None, None), (None, 1, 1), (99, 1, 1)])
    scorer = quality.train(docs, marked)
    rows = docs.select("doc_id", quality.score(scorer, F.col("text")).alias("s")).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.s <= 1 for r in rows)
    one = quality.train(docs, marked.where("quality = 1"))
    assert {r[0] for r in docs.select(quality.score(one, F.col("text"))).collect()} == {1.0}
    none = quality.train(docs, marked.limit(0))
    assert {r[0] for r in docs.select(quality.score(none, F.col("text"))).collect()} == {0.5}
    empty = docs.limit(0)
    assert empty.select(quality.score(quality.train(empty, marked), F.col("text"))).collect() == []


# --- toxicity -----------------------------------------------------------------------


def plain_segments(values):
    """Maximal scoring segments by their definition: take the best, then look left and right of it."""

    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                # Of equal sums the shortest: it has no empty end.
                if total > 1e-12 and (found is None or total > found[2] + 1e-12):
                    found = (i, j, total)
        return [] if found is None else [*best(lo, found[0]), found, *best(found[1] + 1, hi)]

    return best(0, len(values))


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(3)
    for _ in range(200):
        values = np.where(rng.random(25) < 0.35, rng.uniform(0.05, 2, 25), -0.3)
        places = np.flatnonzero(values > 0).tolist()
        found = toxicity.segments(values[places].tolist(), places, 0.3)
        expected = plain_segments(values.tolist())
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in expected])


def test_many_hits_take_linear_time():
    import time

    values = np.random.default_rng(1).uniform(0.05, 2, 100_000)
    start = time.perf_counter()
    for drift in (0.01, 0.6, 3.0):
        toxicity.segments(values.tolist(), list(range(0, 300_000, 3)), drift)
    falling = np.linspace(2, 1, 100_000)
    toxicity.segments(falling.tolist(), list(range(0, 300_000, 3)), 1.6)
    assert time.perf_counter() - start < 4


def test_segments_of_texts_match_the_plain_scan():
    rng = np.random.default_rng(6)
    names = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}zzzz" for i in range(40)]
    own = split([" ".join(names).encode()], lower=True)
    own_hash = own.hash[own.kind == 1]
    order = np.argsort(own_hash)
    value = rng.uniform(-1, 1.2, 40)
    judge = toxicity.Judge(toxicity.Lexicon(own_hash[order], value[order], -0.4), 1.0, 0.1)
    texts = [[rng.integers(0, 45) for _ in range(rng.integers(0, 30))] for _ in range(60)]
    raw = [" ".join(names[i] if i < 40 else "other" for i in t).encode() for t in texts]
    words, n, found = judge.found(raw)
    first = 0
    for t, segments in zip(texts, found, strict=True):
        plain = plain_segments([value[i] if i < 40 else -0.4 for i in t])
        assert [(a - first, b - first) for a, b, _ in segments] == [(a, b) for a, b, _ in plain]
        assert [s for *_, s in segments] == pytest.approx([s for *_, s in plain])
        first += len(t)


def test_extreme_value_parameters_are_found():
    """Greatest of Poisson many exponential scores, the law that is fitted."""
    rng = np.random.default_rng(8)
    tokens = rng.integers(50, 3000, 6000)
    best = np.array([max(rng.exponential(1 / 1.7, rng.poisson(0.002 * n)), default=0.0) for n in tokens])
    rate, scale = toxicity.extreme_value(best, tokens, 1.0)
    assert rate == pytest.approx(1.7, rel=0.1) and scale == pytest.approx(0.002, rel=0.1)


def test_one_document_of_a_labelled_id_is_learned_from(spark):
    prepare(spark)
    rows = [(1, f"the same id with text {i} and good words") for i in range(500)]
    rows += [(i, f"a vile thing numbered {i} for all") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = labels(spark, [(1, 1, 0)] + [(i, i % 2, 1) for i in range(2, 40)])
    found = docs.select(toxicity.score(toxicity.train(docs, marked), F.col("text")).alias("f"))
    assert found.count() == len(rows)
    assert quality.train(docs, marked).constant is None


def test_languages_of_rows_that_share_an_id(spark):
    """Labels of rows without an id, or with one id for all, are learned as well."""
    rows = [(None if i % 2 else 7, f"die W\u00f6rter Nummer {i} eines Textes", "de") for i in range(3000)]
    rows += [(i, f"the words number {i} of a text", "en") for i in range(300)]
    net = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=200)
    assert net.labels == ["de", "en"]
    hot = spark.createDataFrame([(None, "alles gleich hier", "de")] * 2000 + rows[-300:], "doc_id long, text string, lang string")
    assert langid.learn(hot, sample=200).labels == ["de", "en"]


def test_decay_solves_its_equation():
    values, counts = np.array([-1.0, 2.0]), np.array([9.0, 1.0])
    rate = toxicity.decay(values, counts)
    assert 0.9 * np.exp(-rate) + 0.1 * np.exp(2 * rate) == pytest.approx(1)


def test_toxicity_edges(spark):
    # Digits as letters: texts that differ in digits alone would count as copies.
    name = [str(i).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(200)]
    rows = [(i, f"ö {name[i]} fine day number {name[i + 1]} of all {name[i]} days", 0) for i in range(60)]
    rows += [(100 + i, f"ö {name[i + 60]} the vile number {name[i]} grim vile of {name[i + 1]} days", 1) for i in range(30)]
    prepare(spark)
    docs = spark.createDataFrame([(a, b, "c") for a, b, _ in rows] + [(*e, "c") for e in EDGE if e[0] != 6], "doc_id long, text string, label string")
    marked = labels(spark, [(a, 1, t) for a, _, t in rows] + [(None, 1, 1), (999, 0, None)])
    judge = toxicity.train(docs.drop("label"), marked)
    found = docs.select("doc_id", "text", toxicity.score(judge, F.col("text")).alias("f")).collect()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].f.score < 0.3 and not by_id[i].f.passages for i in range(60))
    for i in range(100, 130):
        (passage,) = by_id[i].f.passages
        assert by_id[i].f.score > 0.7
        assert by_id[i].text[passage.start : passage.stop].endswith("vile")
        assert "vile number" in by_id[i].text[passage.start :][:20]
    assert by_id[1].f.score == by_id[2].f.score < 0.3
    nothing = toxicity.train(docs.drop("label"), marked.where("toxic = 0"))
    assert {r[0].score for r in docs.select(toxicity.score(nothing, F.col("text"))).collect()} == {0.0}
    empty = docs.limit(0)
    assert empty.select(toxicity.score(toxicity.train(empty.drop("label"), marked), F.col("text"))).collect() == []


def test_models_on_rows_held_out(spark):
    """At sf0.01, where there are labels enough."""
    data = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{data}/labels.parquet")
    good = catalogue.op7_quality_classifier(spark, data).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in good) >= 0.95 * len(good)
    bad = catalogue.op10_toxicity(spark, data).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in bad) >= 0.9 * len(bad)
    assert not any(r.predicted for r in bad if r.toxic == 0)


def test_rare_languages_are_learned(spark):
    kinds = [("often", "aaa bbb ")] * 500 + [("some", "xyz zyx ")] * 300 + [("rare", "qqq kkk ")] * 3
    rows = spark.createDataFrame([(i, t * 9, k) for i, (k, t) in enumerate(kinds)], "doc_id long, text string, lang string")
    over_all = bounded_sample(rows, 40, "doc_id")
    assert "rare" not in {r.lang for r in over_all.collect()}
    net = langid.learn(rows, sample=40)
    assert sorted(net.labels) == ["often", "rare", "some"]
    found = rows.select("lang", langid.predict(net, F.col("text")).alias("f")).distinct().collect()
    assert all(r.f.lang == r.lang for r in found)
    assert [langid._share(c, 40) for c in ([500, 300, 3], [5, 6], [], [9] * 100)] == [18, 6, 1, 1]


def test_quality_scores_match_a_plain_version(spark):
    """Vectors, pooling, network and temperature, worked out word by word."""
    prepare(spark)
    texts = {i: f"good words number {i % 7} stand here and there {i % 3}" for i in range(40)}
    texts |= {100 + i: f"bad bad bad thing {i % 5} buy now now" for i in range(40)} | {200: "", 201: None, 202: "one"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marked = labels(spark, [(i, int(i < 100), 0) for i in texts if i < 200])
    scorer = quality.train(docs, marked)
    table = np.zeros((quality.BUCKETS, quality.SIZE))
    for text in texts.values():
        own = [int(h) for h in split([(text or "").encode()]).hash]
        for i, h in enumerate(own):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                for k in range(quality.NONZERO if i != j else 0):
                    bits = own[j] >> (20 + 6 * k)
                    table[h % quality.BUCKETS, bits % quality.SIZE] += 1 - 2 * (bits >> 5 & 1)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    assert np.abs(table - scorer.vectors).max() < 1e-5
    w1, b1, w2, b2 = scorer.weights
    for row in docs.select("doc_id", quality.score(scorer, F.col("text")).alias("score")).collect():
        own = [int(h) for h in split([(texts[row.doc_id] or "").encode()]).hash]
        pooled = np.zeros(quality.FEATURES)
        if own:
            vectors = np.array([table[h % quality.BUCKETS] for h in own])
            pooled[: quality.SIZE] = vectors.mean(0)
            pooled[quality.SIZE : 2 * quality.SIZE] = vectors.std(0)
            pooled[2 * quality.SIZE] = len(set(own)) / len(own)
        pooled[-1] = np.log1p(len(own)) / 10
        hidden = np.tanh((pooled - scorer.center) / scorer.scale @ w1 + b1)
        z = float(hidden @ w2 + b2) if np.ndim(hidden @ w2 + b2) == 0 else float((hidden @ w2 + b2)[0])
        assert row.score == pytest.approx(1 / (1 + np.exp(-z / scorer.temperature)), abs=1e-3)
    assert scorer.temperature > 0


def test_languages_match_a_plain_version(spark):
    """Every byte's probabilities by single steps, their mean, and the best label."""
    prepare(spark)
    net = langid.train([b"aaa bbb " * 9, b"xyz zyx " * 9, b"kkk qqq " * 9], ["one", "two", "three"])
    texts = ["aaa bbb", "xyz" * 100, "", None, "12 34", "é kkk qqq aaa" * 20, "z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in docs.select("doc_id", langid.predict(net, F.col("text")).alias("f")).collect():
        raw = (texts[row.doc_id] or "").encode()
        if not any(c.isalpha() for c in raw.decode()):
            assert (row.f.lang, row.f.score) == ("und", 0.0)
            continue
        parts = []
        for at in range(0, len(raw), langid.WINDOW):
            own = np.frombuffer(raw[at : at + langid.WINDOW].ljust(langid.WINDOW, b"\0"), np.uint8)
            parts.append(_plain_positions(net, own)[: len(raw) - at])
        every = np.concatenate(parts)
        assert row.f.lang == net.labels[every.mean(0).argmax()]
        assert row.f.score == pytest.approx(every.mean(0).max(), abs=1e-4)
        assert row.f.label_bytes == np.bincount(every.argmax(1), minlength=3).tolist()
