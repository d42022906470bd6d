"""Exact, SimHash and substring dedup against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import plan
from pyspark.sql import functions as F

from tillwright.llm import catalogue, simhash, substring_dedup
from tillwright.llm.components import components
from tillwright.llm.exact_dedup import DigestIndex, exact_dedup
from tillwright.llm.simhash import fingerprint, hex_print, links, near_duplicates

DOCS = "doc_id long, text string, digest string, fp long, keep_id long, n_chars int"


def docs(spark, rows):
    """Rows with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], DOCS)


EDGE = [
    (5, "same text here"),
    (3, "same  text\there\n"),
    (4, "sametexthere"),
    (9, None),
    (8, ""),
    (7, " \n"),
    (None, "without an id"),
    (1, "lone"),
    (2, "twice"),
    (2, "twice"),
    (6, "word " * 30_000),
]


def plain_exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, own in groups.items():
        best = max(own, key=lambda r: (len(r[1]), -(r[0] if r[0] is not None else 1 << 60)))
        left = 1
        for doc_id, text in own:
            kept = bool(left and (doc_id, text) == best)
            left -= kept
            out.append((doc_id, best[0], len(own), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_edges(spark):
    found = exact_dedup(docs(spark, EDGE))
    assert sorted(map(tuple, found.collect()), key=repr) == plain_exact(EDGE)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_empty(spark):
    assert exact_dedup(docs(spark, [])).collect() == []


def test_exact_hot_group(spark):
    rows = [(i, "copy") for i in range(40)] + [(100 + i, f"text {i}") for i in range(60)]
    assert sorted(map(tuple, exact_dedup(docs(spark, rows)).collect()), key=repr) == plain_exact(rows)


def test_index_remembers(spark, folder):
    index = DigestIndex(spark, "index_under_test", folder, buckets=4)
    first = index.add(docs(spark, [(1, "a b"), (2, "c")])).collect()
    assert all(r.kept for r in first)
    second = {r.doc_id: r for r in index.add(docs(spark, [(3, "ab"), (4, "d"), (5, "d")])).collect()}
    assert (second[3].kept, second[3].keep_id) == (False, 1)
    assert (second[4].kept, second[5].kept, second[5].keep_id) == (True, False, 4)
    assert index.rows().count() == 3
    index.forget()
    # The files outlive the name, and a batch that is repeated adds nothing.
    again = DigestIndex(spark, "index_under_test", folder, buckets=4)
    assert not any(r.kept for r in again.add(docs(spark, [(1, "a b"), (4, "d")])).collect())
    assert again.rows().count() == 3
    # Only the batch is shuffled to meet the index.
    batch = docs(spark, [(1, "a")]).select(F.unhex(F.sha2("text", 256)).alias("digest"))
    joined = batch.join(again.rows().hint("merge"), "digest", "left_anti")
    assert plan(joined).count("Exchange hashpartitioning") == 1
    again.forget()


def test_a_batch_that_is_repeated_keeps_its_rows(spark, folder):
    """The driver dies after the index knows the batch and before the answer is written."""
    index = DigestIndex(spark, "index_after_a_crash", folder, buckets=4)
    index.add(docs(spark, [(9, "old")]), batch="monday").collect()
    batch = docs(spark, [(1, "a b"), (2, "c"), (3, "ab"), (4, "o l d")])
    first = sorted(map(tuple, index.add(batch, batch="tuesday").collect()))
    again = sorted(map(tuple, index.add(batch, batch="tuesday").collect()))
    assert first == again and sorted(r[0] for r in first if r[3]) == [1, 2]
    assert index.rows().count() == 3
    # The same texts as another batch are known.
    assert not any(r.kept for r in index.add(batch, batch="wednesday").collect())
    index.forget()


def test_exact_hot_equal_rows_and_smallest_long(spark):
    rows = [(1, "copy")] * 3000 + [(-(1 << 63), "x"), (5, "x"), ((1 << 63) - 1, "x"), (None, "x")]
    rows += [(10 + i, f"text {i}") for i in range(100)]
    assert sorted(map(tuple, exact_dedup(docs(spark, rows)).collect()), key=repr) == plain_exact(rows)


def plain_print(text, words=3):
    own = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in ["", None, "One", "two Words", "ÉCOLE École", "a b c d e f g A B C", "x y\x1cz w v", "q " * 9000]:
        raw = text.encode() if text is not None else None
        assert fingerprint(raw, 3) & (1 << 64) - 1 == plain_print(text)


def reach(prints, distance):
    """Smallest place that each fingerprint reaches, all pairs compared."""
    values = np.array(prints, np.int64)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count((values ^ values[i]).view(np.uint64)) <= distance)
        for j in near:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("crowd", [1000, 3])
def test_links_reach_what_all_pairs_reach(spark, crowd):
    rng = random.Random(5)
    prints = []
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(12):
            value = base
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            prints.append(simhash._signed(value))
    prints = sorted(set(prints))
    found = components(links(spark.createDataFrame([(p,) for p in prints], "fp long"), 3, crowd=crowd))
    root = {r.node: r.root for r in found.collect()}
    expected = reach(prints, 3)
    groups = Counter(expected)
    for p, e in zip(prints, expected, strict=True):
        assert root.get(p, p) == prints[e]
        assert (p in root) == (groups[e] > 1)


def test_near_edges(spark):
    rows = [*EDGE, (20, "some words that are here for a test"), (21, "Some Words that are here for a test")]
    found = {}
    for r in near_duplicates(docs(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r.component_id)
    assert sum(map(len, found.values())) == len(rows)
    assert found[21] == [20] and found[2] == [2, 2]
    assert {*found[7], *found[8], *found[9]} == {7}
    assert found[None] == [None]
    assert near_duplicates(docs(spark, [])).collect() == []
    shown = near_duplicates(docs(spark, [(1, "")])).select(hex_print()).first()[0]
    assert shown == "0" * 16


def test_near_query(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    rows.sort()
    expected = reach([simhash._signed(plain_print(r.text)) for r in rows], 3)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in catalogue.op1_simhash_near_dedup(spark, data).collect()}
    for r, e in zip(rows, expected, strict=True):
        assert found[r.doc_id] == (f"{plain_print(r.text):016x}", rows[e].doc_id)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_substring(rows):
    """All runs of all documents, compared one by one."""
    first, cut = {}, {}
    ordered = sorted(rows, key=lambda r: r[0])
    for doc_id, text in ordered:
        raw = (text or "").encode()
        for a, b, own in substring_dedup.runs(raw):
            words = b" ".join(b" ".join(raw[s:e].split()) for s, e in substring_dedup.sentences(raw)[a : b + 1])
            origin = first.setdefault((b - a, words, own), (doc_id, a))
            if origin != (doc_id, a):
                cut.setdefault(doc_id, set()).update(range(a, b + 1))
    return {
        doc_id: b"".join(
            (text or "").encode()[s:e]
            for i, (s, e) in enumerate(substring_dedup.sentences((text or "").encode()))
            if i not in cut.get(doc_id, ())
        ).decode()
        for doc_id, text in ordered
    }


def test_sentences_cover_the_text():
    for text in ["", "a", "A b. C d! E?\nf", "..", "\n\n x. y", "no end", "é. ü! \n", "a.b c. d"]:
        raw = text.encode()
        spans = substring_dedup.sentences(raw)
        assert b"".join(raw[a:b] for a, b in spans) == raw


def test_substring_edges(spark):
    shared = "One two three four. Five six seven eight. Nine ten eleven twelve."
    long = " ".join(f"w{i}" for i in range(45)) + "."
    rows = [
        (1, f"Start here. {shared} Then more."),
        (2, f"Other start. {shared} And an end."),
        (3, f"{shared}\n{shared}"),
        (4, f"Intro. {long} After."),
        (5, f"Before that. {long}"),
        (6, None),
        (7, ""),
        (8, "Short one. Short two."),
        (9, "Short one. Short two."),
    ]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()}
    assert {k: r.text for k, r in found.items()} == plain_substring(rows)
    assert found[1].n_removed == 0 and found[2].text == "Other start. And an end."
    assert found[3].text == "" and found[3].n_removed == 6
    assert found[5].text == "Before that. " and found[8].n_removed == found[9].n_removed == 0
    assert substring_dedup.substring_dedup(docs(spark, [])).collect() == []


def test_substring_repeated_ids(spark):
    shared = "One two three four. Five six seven eight. Nine ten eleven twelve."
    rows = [(1, shared), (1, shared + " More words."), (None, shared), (2, "Alone.")]
    found = substring_dedup.substring_dedup(docs(spark, rows)).collect()
    assert len(found) == 4 and sum(r.n_removed == 3 for r in found) == 2


def test_substring_query(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r.text for r in catalogue.op2_substring_dedup(spark, data).collect()}
    assert found == plain_substring([tuple(r) for r in rows])


def every_repeat(rows):
    """All stretches of three sentences and 8 words, or of 40 words, compared as they are."""
    first, cut, own = {}, {}, {}
    for doc_id, text in sorted(rows):
        raw = text.encode()
        own[doc_id] = said = [raw[a:b] for a, b in substring_dedup.sentences(raw)]
        said = [b" ".join(s.split()) for s in said]
        size = [max(len(s.split()), len(s) // 16) for s in said]
        for a in range(len(said)):
            for b in range(a + 1, len(said) + 1):
                n = sum(size[a:b])
                if (n >= 8 and b - a >= 3) or n >= 40:
                    if first.setdefault(b" ".join(said[a:b]), (doc_id, a)) != (doc_id, a):
                        cut.setdefault(doc_id, set()).update(range(a, b))
    return {d: b"".join(s for i, s in enumerate(said) if i not in cut.get(d, ())).decode() for d, said in own.items()}


def test_every_long_enough_stretch_is_found(spark):
    def sentence(name, n):
        return " ".join(f"{name}{i}" for i in range(n)) + ". "

    tiny = "".join(f"Tiny{i}!! " for i in range(60))
    tail = sentence("a", 45) + sentence("b", 8) + sentence("c", 7)
    ends = sentence("d", 8) + "One. Two. Three. "
    lines = "".join(chr(0x4E00 + i) * 30 + "\n" for i in range(3))
    rows = []
    for i, passage in enumerate([tiny, tail, ends, lines]):
        rows += [(2 * i, f"Alone {i}. {passage}And {i}."), (2 * i + 1, f"Before {i}. {passage}After {i}.")]
    rng = random.Random(3)
    for i in range(30):
        rows.append((100 + i, "".join(sentence(rng.choice("xyz"), rng.choice([1, 1, 1, 2, 3, 20, 40])) for _ in range(rng.randint(1, 25)))))
    found = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()}
    assert found == every_repeat(rows)
    assert [found[2 * i + 1] for i in range(4)] == [f"Before {i}. After {i}." for i in range(4)]


def test_order_of_substrings_does_not_depend_on_other_rows(spark):
    """One unrelated row without an id, or one id twice, changes nothing for the others."""
    passage = "Here is a passage of many words that several documents share. It has a second sentence of some length. And it ends with a third."
    given = [(i, f"Own words of document {i}. {passage} The end of {i} is its own.") for i in (7, 1, 5, 3)]
    alone = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs(spark, given)).collect()}
    assert passage in alone[1] and not any(passage in alone[i] for i in (3, 5, 7))
    for more in ([(None, "something else")], [(9, "a"), (9, "b")], [(None, "x y z"), (None, "x y z")]):
        found = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs(spark, given + more)).collect()}
        assert {i: found[i] for i in alone} == alone


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_crowded_links_reach_the_same(spark, distance):
    rng = random.Random(distance)
    base = rng.getrandbits(64)
    values = {base}
    while len(values) < 60:
        values.add(rng.choice(sorted(values)) ^ 1 << rng.randrange(64))
    values = [simhash._signed(v) for v in values]
    want = reach(sorted(values), distance)
    for crowd in (1, 5, 1000):
        found = components(links(spark.createDataFrame([(v,) for v in values], "fp long"), distance, crowd=crowd))
        roots = {r.node: r.root for r in found.collect()}
        got = [roots.get(v, v) for v in sorted(values)]
        assert got == [sorted(values)[w] for w in want]
