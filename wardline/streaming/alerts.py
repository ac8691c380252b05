"""Follow-up alerts over a stream of scored records: one per patient until it expires."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Executors get the processor with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOUND, OPEN_DAYS = 0.5, 30
ALERT = "patient_name string, record_id bigint, timestamp timestamp, probability double"


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers needs a store that keeps them; set before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Groups of patients by the hash of their name. A group's state goes in and out as one value, so a trigger costs a call of
#: Python a group and not one a patient or record.
GROUPS = 1024
#: Undecided records, in no order, and when each open alert ends.
STATE = ("patient_name array<string>, us array<bigint>, record_id array<bigint>, probability array<double>, "
         "open_name array<string>, until_ms array<bigint>")


class FollowUps:
    """High records wait until the watermark has passed them, and are taken in order of time, so that the order of
    arrival does not matter. One starts an alert where its patient has none open; an alert is removed when it ends.

    The state of a group of patients has one timer, for the next record or end to be passed.
    """

    def __init__(self, open_days: float):
        self.open_ms = int(open_days * 86_400_000)

    def __call__(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *kept, names, ends = state.get if state.exists else ([],) * 6
        waiting = {(name, us, record): probability for name, us, record, probability in zip(*kept)}
        until = dict(zip(names, ends))
        if not state.hasTimedOut:
            for pdf in rows:
                waiting.update(zip(zip(pdf["patient_name"], pdf["us"].tolist(), pdf["record_id"].tolist()), pdf["probability"].tolist()))
        now = state.getCurrentWatermarkMs()
        started = []
        for name, us, record in sorted(k for k in waiting if _millis(k[1]) <= now):
            probability = waiting.pop((name, us, record))
            if name not in until or us >= until[name] * 1000:
                until[name] = _millis(us) + self.open_ms
                started.append((name, record, us, probability))
        until = {name: end for name, end in until.items() if end > now}
        if waiting or until:
            kept = [list(x) for x in zip(*waiting)] if waiting else [[], [], []]
            state.update((*kept[:3], list(waiting.values()), list(until), list(until.values())))
            due = min([_millis(us) for _, us, _ in waiting] + list(until.values()))
            state.setTimeoutTimestamp(max(1, due - 1))  # it ends when the watermark is beyond it
        elif state.exists:
            state.remove()
        if started:
            out = pd.DataFrame(started, columns=["patient_name", "record_id", "timestamp", "probability"])
            yield out.assign(timestamp=pd.to_datetime(out["timestamp"], unit="us"))


def _millis(us: int) -> int:
    return -(-us // 1000)


def follow_up_alerts(stream: DataFrame, bound: float = BOUND, open_days: float = OPEN_DAYS, groups: int = GROUPS) -> DataFrame:
    """(patient_name, record_id, timestamp, probability) of the records that start an alert.

    ``stream`` has these columns and a watermark on ``timestamp``; a record above ``bound`` starts an alert if its patient's
    last one began ``open_days`` or more before, by event time; of records of one time the smaller id. Records behind the watermark
    are dropped, and what is not behind it at the end has not been decided. A record without a time, patient or
    probability starts nothing. State holds patients' undecided records and open alerts only, by ``groups`` of
    patients; their number stays as it is while a checkpoint lives.
    """
    high = (F.col("probability") > bound) & F.col("patient_name").isNotNull() & F.col("record_id").isNotNull()
    # One test that needs the time stays above the watermark, which so moves with all records.
    rows = stream.where(F.when(F.col("timestamp").isNotNull(), high)).withColumn("us", F.unix_micros("timestamp"))
    return rows.withColumn("patients", F.pmod(F.xxhash64("patient_name"), F.lit(groups))).groupBy("patients").applyInPandasWithState(
        FollowUps(open_days), outputStructType=ALERT, stateStructType=STATE, outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)
