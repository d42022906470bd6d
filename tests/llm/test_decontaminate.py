"""Winnowing against windows compared one by one."""

import hashlib
import random
import re

from tillwright.llm.decontaminate import decontaminate, fingerprints, gram_hashes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    out = []
    windows = []
    for item_id, text in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.append((item_id, own[i : i + size]))
    for doc_id, text in docs:
        own = words(text)
        hit, named = set(), set()
        for item_id, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    if item_id is not None:
                        named.add(str(item_id))
        names = ",".join(sorted(named))
        out.append(
            (doc_id, len(own), len(hit), len(named), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
        )
    return sorted(out, key=repr)


def run(spark, docs, items):
    left = spark.createDataFrame([(*d, 1, "y") for d in docs], "doc_id long, text string, start int, window string")
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, size int")
    return sorted(map(tuple, decontaminate(left, right).collect()), key=repr)


def test_edges(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [
        (1, f"before {item} after"),
        (2, "Alpha, BETA; gamma! delta-epsilon zeta (eta) theta iota: kappa"),
        (3, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (4, None),
        (5, ""),
        (6, f"{item} {item}"),
        (7, "...one two three..."),
        (7, "one two three"),
        (8, "Élan vital is not élan Vital"),
        (None, f"x {item}"),
        (9, "same same same same same same same same same same same same"),
        (10, ("noise " * 20_000) + item),
        (11, "...!"),
    ]
    items = [
        (30, item),
        (4, "lambda mu alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (100, "One Two three"),
        (5, None),
        (6, ""),
        (7, "élan vital"),
        (8, "same same same same same same same same same same same"),
        (None, "one two"),
        (9, "zeta"),
        (9, "zeta"),
    ]
    assert run(spark, docs, items) == plain(docs, items)
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, [], items) == []


def test_every_long_shared_run_is_found(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(4, 25)))) for i in range(12)]
    docs = []
    for i in range(60):
        own = rng.choices(vocabulary, k=rng.randint(0, 40))
        if i % 2:
            other = items[rng.randrange(12)][1].split()
            cut = rng.randrange(len(other))
            at = rng.randrange(len(own) + 1)
            own[at:at] = other[cut : cut + rng.randint(8, 14)]
        docs.append((i, " ".join(own)))
    assert run(spark, docs, items) == plain(docs, items)


def test_hashes_stand_for_their_words(spark):
    text = " ".join(f"t{i % 9}" for i in range(40))
    rows = spark.createDataFrame([(1, text.split()), (2, ["a"] * 7), (3, [])], "k int, own array<string>")
    found = {r.k: r.hashes for r in gram_hashes(rows).collect()}
    assert len(found[1]) == 33 and found[2] == [] and found[3] == []
    # Equal runs have equal hashes, and only those.
    assert [found[1][i] == found[1][0] for i in range(33)] == [i % 9 == 0 for i in range(33)]
    prints = fingerprints(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).collect()
    assert {r["print"] for r in prints} <= set(found[1])


def test_no_python_in_the_plan(spark, data):
    from tillwright.llm.catalogue import op3_benchmark_decontamination, op8_exact_dedup

    for query in (op3_benchmark_decontamination, op8_exact_dedup):
        plan = query(spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_capital_greek_between_other_marks(spark):
    """A capital sigma lowers to a final one before a space, not before ``.`` and a letter."""
    item = [f"{a}ΛΟΓΟΣ" for a in "ΑΒΓΔΕΖΗΘΙΚ"]
    docs = [(1, "πριν " + ".".join(item) + " μετά"), (2, "'".join(item)), (3, " ".join(item).lower()), (4, " ".join(item[:9]))]
    items = [(1, " ".join(item))]
    found = run(spark, docs, items)
    assert found == plain(docs, items)
    assert [r[-1] for r in found] == [True, True, False, False]
