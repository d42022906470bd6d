"""Short benchmark items: both ways of finding them give the same rows."""

import random

from test_decontaminate import plain, run

from tillwright.llm import decontaminate as module


def test_many_and_few_short_items(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 40)))) for i in range(60)]
    items = [(100 + i, " ".join(rng.choices(vocabulary, k=1 + i % 9))) for i in range(30)]
    few = run(spark, docs, items)
    assert few == plain(docs, items)
    monkeypatch.setattr(module, "FEW_SHORT", 5)
    assert run(spark, docs, items) == few
