"""Streaks of absence as keyed state that survives restarts and begins with what the catalog knows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FIRED = "key string, run long, missing int"
#: Spark's state store on disk: state needn't fit into memory, and recovers from its change log.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class Streak(StatefulProcessor):
    """How many complete runs in a row lacked a version, and the last run that counted: runs that come again change nothing."""

    def __init__(self, threshold: int) -> None:
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("streak", "missing int, run long")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        first = initialState.iloc[0]
        self.state.update((int(first["missing"]), int(first["run"])))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        missing, last = self.state.get() if self.state.exists() else (0, None)
        fired = []
        for r in pd.concat(list(rows)).sort_values("run").itertuples():
            if last is not None and r.run <= last:
                continue
            last = int(r.run)
            if r.found:
                missing = 0
            elif r.complete:
                missing += 1
                if missing == self.threshold:
                    fired.append((key[0], last, missing))
        if last is not None:
            self.state.update((missing, last))
        yield pd.DataFrame(fired, columns=["key", "run", "missing"])


def streaks(coverage: DataFrame, known: DataFrame | None = None, threshold: int = 2) -> DataFrame:
    """A stream of ``key, run (long), found, complete`` -> ``key, run, missing`` whenever a version's streak reaches the threshold.

    A sighting resets the count, an incomplete list changes nothing, a run not after the last one is passed over. ``known(key, missing, run)``: counts to begin with, one row for each
    key, used when the stream starts for the first time. Needs ``use_disk_state``. A key's rows of one micro-batch meet in one task.
    """
    start = known.groupBy("key") if known is not None else None
    return coverage.groupBy("key").transformWithStateInPandas(Streak(threshold), FIRED, "append", "none", initialState=start)
