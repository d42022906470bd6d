"""The pipeline against its rules, stage by stage, in plain Python."""

import corpus_pipeline as pipeline
from helpers import rows
from pyspark.sql import functions as F
from test_decontaminate import plain
from test_dedup import plain_exact, plain_print, reach
from test_text import check_packing

from tillwright.llm import simhash
from tillwright.llm.common import prepare
from tillwright.llm.langid import learn, predict


def test_names_and_shape():
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]


def test_pipeline_against_plain_rules(spark, data):
    prepare(spark)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    net = learn(pipeline.language_training_rows(docs))
    found = docs.select("doc_id", "text", predict(net, F.col("text")).alias("f")).collect()
    kept = [
        (r.doc_id, r.text) for r in found
        if r.f.lang != "und" and r.f.score >= pipeline.least_score(len(net.labels))
    ]
    assert len(kept) >= 0.97 * len(found)
    texts = dict(kept)
    kept = sorted((d, texts[d]) for d, *_, keep, _ in plain_exact(kept) if keep)
    near = reach([simhash._signed(plain_print(t)) for _, t in kept], 3)
    kept = [r for i, r in enumerate(kept) if near[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in plain(kept, items) if r[-1]}
    kept = [r for r in kept if r[0] not in dirty]
    used, least = check_packing(kept, pipeline.run(spark, data).collect(), 4096)
    assert used <= least + 1


def test_stages_take_any_table(spark, data):
    """Nulls, repeated rows, empty tables and columns that clash pass through every stage."""
    prepare(spark)
    kind = "doc_id long, text string, lang string, source string, n_chars long, fp long, digest string, order string"
    given = [
        (1, "the words of a text that is here", "en", None, 3, 1, "x", "y"),
        (1, "the words of a text that is here", "en", "a", None, 1, "x", "y"),
        (1, "short", "en", "a", 1, 1, "x", "y"),
        (2, None, None, None, None, None, None, None),
        (None, "no id at all", "en", "b", 2, 2, "x", "y"),
        (3, "", "de", "b", 0, 2, "x", "y"),
        (4, "die Wörter eines Textes " * 9_000, "de", "b", 0, 2, "x", "y"),
    ]
    docs = spark.createDataFrame(given, kind)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        ids = rows(out, "doc_id")
        assert stage(spark, docs.limit(0), data).count() == 0
        if name == "language_id":
            assert ids == [(1,), (1,), (1,), (4,), (None,)]
        elif name == "benchmark_decontamination":
            assert ids == rows(docs, "doc_id")
        else:  # one of the rows alike in id and text, one of the empty texts
            assert ids == [(1,), (1,), (2,), (4,), (None,)]
            assert {r.text for r in out.where("doc_id = 1").collect()} == {given[0][1], "short"}
    pieces = pipeline.pack_sequences(spark, docs, data)
    assert {r.doc_id for r in pieces.collect()} == {None, 1, 2, 3, 4}
    assert pipeline.pack_sequences(spark, docs.limit(0), data).count() == 0


def test_rows_without_an_id_of_their_own_are_judged_by_their_text(spark, data):
    """A third of the rows without an id, a third with the same one: only copies go."""
    prepare(spark)
    docs = spark.createDataFrame(
        [(i if i % 3 == 0 else (None if i % 3 == 1 else 7), f"text {i} with words {i * i} {i + 1}x of its own {i}", "en") for i in range(90)],
        "doc_id long, text string, lang string",
    )
    copies = docs.where("text LIKE 'text 1%'")
    doubled = docs.unionByName(copies.withColumn("text", F.concat(F.lit(" "), "text"))).unionByName(copies)
    found = pipeline.drop_exact_copies(spark, doubled, data)
    assert found.count() == 90
    # Of each group the text with one more blank is the longest.
    assert found.where("text LIKE ' %'").count() == copies.count()
    near = pipeline.drop_near_copies(spark, doubled, data)
    kept = [r.text.strip() for r in near.collect()]
    prints = {simhash._signed(plain_print(r.text)) for r in docs.collect()}
    assert len(kept) == len(set(kept)) == len(set(reach(sorted(prints), 3)))
    items = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").limit(1).collect()]
    dirty = spark.createDataFrame([(None, f"a {items[0]} b", "en"), (7, f"c {items[0]} d", "en")], docs.schema)
    clean = pipeline.drop_contaminated(spark, docs.unionByName(dirty), data)
    assert rows(clean, "text") == rows(docs, "text")
    assert pipeline.language_id(spark, docs, data).count() == 90


def test_the_language_limit_follows_the_number_of_languages():
    assert [pipeline.least_score(k) for k in (0, 1, 2, 3, 4, 100)] == [0.6, 0.6, 0.6, 0.39999999999999997, 0.3, 0.012]


def test_a_run_leaves_its_pieces_only(spark, data, folder, monkeypatch):
    from tillwright.llm import common

    written, gone = [], []
    stage, drop = common.staged, common.discard
    monkeypatch.setattr(common, "staged", lambda df, name: written.append(stage(df, name)) or written[-1])
    monkeypatch.setattr(common, "discard", lambda spark, *paths: gone.extend(paths) or drop(spark, *paths))
    pieces = pipeline.run(spark, data)
    assert pieces.count() > 0
    left = {path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for _, path in written if path not in gone}
    assert left == {"pieces"}
