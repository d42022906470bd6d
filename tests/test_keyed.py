"""Keyed state in a stream against the batch upsert."""

import time
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from helpers import rows

from tillwright.operators import quality, upsert
from tillwright.streaming import ingest, keyed

KIND = "k string, updated_at timestamp, operation string, v bigint, note string"


def at(day):
    return datetime(2024, 1, day) if day else None


def arrive(spark, folder, *records):
    df = spark.createDataFrame([(k, at(d), o, v, n) for k, d, o, v, n in records], KIND).coalesce(1)
    df.write.mode("append").parquet(f"{folder}/in")
    return df


def run(spark, folder, schema, **more):
    stream = ingest.parquet_stream(spark, f"{folder}/in", schema)
    keyed.keyed_load(stream, f"{folder}/log", f"{folder}/checkpoint", "k", **more)
    return keyed.read_keyed(spark, f"{folder}/log", "k")


BATCHES = [
    [("a", 3, "upsert", 1, "first"), ("b", 3, "upsert", None, None), ("c", 3, "upsert", 3, "x"), (None, 3, "upsert", 9, "no key")],
    # Late, repeated, newer, deleted, deleted and loaded at once, and a key never seen deleted.
    [("a", 1, "upsert", 5, "late"), ("a", 3, "upsert", 1, "first"), ("b", 4, "upsert", 7, None),
     ("c", None, "delete", None, None), ("d", 2, "delete", None, None), ("d", 2, "upsert", 4, "back"), ("z", 1, "d", None, None)],
    [("c", 1, "upsert", 8, "older than what was deleted"), ("a", None, "upsert", 6, "no time"), ("b", 4, "upsert", 6, "same time")],
    [("a", 9, " Delete ", None, None), ("b", 5, "upsert", 1 << 60, "large")],
]


def test_stream_state_equals_batches(spark, folder):
    state = None
    for batch in BATCHES:
        df = arrive(spark, folder, *batch)
        found = run(spark, folder, df.schema)
        loads, deletes = quality.split_deletes(df)
        state = upsert.upsert(upsert.apply_deletes(state, deletes, "k"), loads, "k").checkpoint()
        assert rows(found, "k", "updated_at", "v", "note") == rows(state, "k", "updated_at", "v", "note")
    assert rows(found, "k", "v") == [("b", 1 << 60), ("c", 8), ("d", 4)]


def test_restart_and_repeated_batch(spark, folder, monkeypatch):
    df = arrive(spark, folder, *BATCHES[0])
    step = ingest.run_batches

    def die_after_writing(stream, checkpoint, batch, mode):
        def write_and_die(rows, number):
            batch(rows, number)
            raise OSError("gone")

        step(stream, checkpoint, write_and_die, mode=mode)

    monkeypatch.setattr(keyed, "run_batches", die_after_writing)
    with pytest.raises(Exception, match="gone"):
        run(spark, folder, df.schema)
    monkeypatch.setattr(keyed, "run_batches", step)
    arrive(spark, folder, *BATCHES[1])
    found = run(spark, folder, df.schema)
    assert rows(found, "k", "v", "note") == [("a", 1, "first"), ("b", 7, None), ("d", 4, "back")]
    # Nothing new: nothing changes.
    assert rows(run(spark, folder, df.schema)) == rows(found)


def test_a_key_that_is_forgotten_takes_any_record(spark, folder):
    df = arrive(spark, folder, ("a", 5, "upsert", 1, "first"))
    run(spark, folder, df.schema, forget_after="1 second")
    time.sleep(1.5)
    arrive(spark, folder, ("b", 5, "upsert", 2, "lets time pass"))
    run(spark, folder, df.schema, forget_after="1 second")
    arrive(spark, folder, ("a", 1, "upsert", 3, "older"))
    found = run(spark, folder, df.schema, forget_after="1 second")
    assert rows(found, "k", "v") == [("a", 3), ("b", 2)]


ORDER = ["updated_at", "v", "note"]


def few_rows(seed):
    """A key's rows of one batch, with ties, nulls and equal rows; ``n`` tells them apart."""
    pick = np.random.default_rng(seed)
    n = int(pick.integers(1, 20))
    days = pick.choice(pd.to_datetime(["2024-01-01", "2024-01-02", None]), n)
    return pd.DataFrame(
        {
            "updated_at": pd.Series(days, dtype="datetime64[ns]"),
            "v": pick.choice([1.5, 2.5, np.nan], n),
            "note": pick.choice(np.array(["a", "b", None], dtype=object), n),
            "n": range(n),
        }
    )


def test_the_last_row_is_the_sort_s_without_its_cost():
    last = keyed.last_by(ORDER)
    frames = [few_rows(seed) for seed in range(300)]

    def by_sort(rows):
        return rows.sort_values(ORDER, na_position="first", kind="stable").tail(1)

    def timed(pick):
        start = time.process_time()
        found = [int(pick(rows)["n"].iloc[0]) for rows in frames]
        return found, time.process_time() - start

    (found, cost), (expected, sort_cost) = timed(last), timed(by_sort)
    assert found == expected
    assert cost < sort_cost
