"""Keyed state kept inside a stream, instead of a table that each batch rewrites.

The stream holds the latest record of every key. A batch emits one row for each key that it
changed, and these rows are appended to a change log; the table is the last row of each key
in the log. State, log and progress survive a restart from the checkpoint, and a batch that
is repeated writes its rows to the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillwright.operators.quality import is_delete
from tillwright.streaming.ingest import run_batches

GONE = "_gone"


def last_by(order: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Picks the greatest row by the columns, nulls lowest; the last one of equal rows.

    One column after the other leaves its greatest rows, mostly one after the first. A sort
    by all columns costs milliseconds a key, however few rows it has.
    """

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        for name in order:
            if len(rows) == 1:
                break
            values = rows[name].to_numpy()
            known = ~pd.isna(values)
            if known.any():
                places = np.flatnonzero(known)
                values = values[places]
                rows = rows.iloc[places[values == values.max()]]
        return rows.tail(1)

    return last


def keyed_changes(
    changes: DataFrame, key: str, timestamp: str = "updated_at", forget_after: str | None = None
) -> DataFrame:
    """The changes that a stream of change records makes to its keyed state.

    Within a batch the deletes of a key apply to the state before it, then the key's latest
    record (greatest timestamp, then greatest values) is put in if it is no older than the
    state's. Emitted is the key's new row, with ``_gone`` true for one that was deleted.
    Null keys take no part; a null timestamp counts as oldest.

    A deleted key leaves nothing in the state. With ``forget_after`` (such as ``30 days``,
    processing time) a key that has not changed for so long leaves it too: its row stays in
    the log, and a later record is taken whatever its timestamp.
    """
    rows = changes.withColumn(GONE, is_delete(changes)).where(F.col(key).isNotNull())
    fields = [f for f in rows.schema if f.name != GONE]
    names = [f.name for f in fields]
    out = T.StructType([*fields, T.StructField(GONE, T.BooleanType())])
    # The state holds what decides, as text: pandas would change integers with nulls.
    kept = T.StructType([T.StructField("at", T.StringType()), T.StructField("there", T.BooleanType())])
    last = last_by([timestamp, *[n for n in names if n != timestamp]])
    wait = pd.Timedelta(forget_after).value // 1_000_000 if forget_after else None

    def text(value) -> str | None:
        return None if pd.isna(value) else pd.Timestamp(value).isoformat()

    def update(own_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        at, there = state.get if state.exists else (None, False)
        best, deletes = None, None
        for batch in batches:
            gone = batch[GONE].to_numpy(dtype=bool)
            if gone.any():
                deletes = batch[gone].tail(1)
            if not gone.all():
                loads = last(batch[~gone])
                best = loads if best is None else last(pd.concat([best, loads]))
        if deletes is not None:
            at, there = None, False
        if best is not None:
            moment = text(best[timestamp].iloc[0])
            if not there or (moment or "") >= (at or ""):
                at, there = moment, True
            else:
                best = None
        if best is not None:
            yield best
        elif deletes is not None:
            yield deletes
        if there:
            state.update((at, there))
            if wait:
                state.setTimeoutDuration(wait)
        elif state.exists:
            state.remove()

    timeout = GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(update, out, kept, "update", timeout)


def keyed_load(
    stream: DataFrame,
    log: str,
    checkpoint: str,
    key: str,
    timestamp: str = "updated_at",
    forget_after: str | None = None,
) -> None:
    """Run a stream of change records over what has arrived, and append to its change log."""
    changed = keyed_changes(stream, key, timestamp, forget_after)

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    # With a timer Spark would go on with batches without data for ever; timers that are due
    # go off in the next batch that has some.
    conf, setting = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(setting)
    conf.set(setting, "false")
    try:
        run_batches(changed, checkpoint, batch, mode="update")
    finally:
        conf.set(setting, before)


def read_keyed(spark: SparkSession, log: str, key: str) -> DataFrame:
    """The table that a change log stands for: the last row of each key that is not gone."""
    rows = spark.read.option("mergeSchema", True).parquet(log)
    names = [n for n in rows.columns if n not in ("batch", GONE)]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*names, GONE), F.col("batch").cast("bigint")).alias("row"))
    return last.where(f"NOT row.{GONE}").select(*[F.col(f"row.{n}") for n in names])
