"""Acceptance of claims as a stream, with a sink that creates each batch once.

A worker's claims get ordinals in the order in which they first arrive. A
claim that arrives again keeps its id: with the same digest it is unchanged,
with another one it is a drift and what was accepted stays. The state is a
map by worker, so a restart from the checkpoint goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SCHEMA = "worker string, seq long, claim string, digest string, claim_id string, status string"
#: The state store that maps of state need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Acceptance(StatefulProcessor):
    """Holds each worker's accepted claims: digest and ordinal by claim, and how many there are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getMapState("accepted", "claim string", "digest string, ordinal long")
        self.number = handle.getValueState("number", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # each call of the state is a round trip, so a claim is asked for once a batch, and not at all of a new worker
        before = self.number.get() if self.number.exists() else None
        n, held = before[0] if before else 0, {}
        # the rows of a batch come in any order; seq says which was first
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        out = []
        for seq, claim, digest in batch[["seq", "claim", "digest"]].itertuples(index=False):
            known = held.get(claim) or (self.accepted.getValue((claim,)) if before else None)
            if known:
                first, ordinal = held[claim] = known
                status = "unchanged" if first == digest else "drift"
            else:
                n += 1
                first, ordinal, status = digest, n, "accepted"
                held[claim] = (digest, ordinal)
                self.accepted.updateValue((claim,), (digest, ordinal))
            out.append((key[0], seq, claim, first, f"c-{key[0]}-{ordinal}", status))
        self.number.update((n,))
        yield pd.DataFrame(out, columns=["worker", "seq", "claim", "digest", "claim_id", "status"])


def accepted(deliveries: DataFrame) -> DataFrame:
    """worker, seq, claim, digest (the accepted one), claim_id, status for each delivery of a stream.

    deliveries: worker, seq, claim and digest, none of them null. seq orders
    the deliveries of a batch; those of later batches come later. One batch of
    one worker is sorted in a task; the state of a worker is read by claim.
    Needs STORE as the session's state store.
    """
    rows = deliveries.select(F.col("worker").cast("string").alias("worker"), F.col("seq").cast("long").alias("seq"), F.col("claim").cast("string").alias("claim"), "digest")
    return rows.groupBy("worker").transformWithStateInPandas(statefulProcessor=Acceptance(), outputStructType=SCHEMA, outputMode="Append", timeMode="None")


def frozen_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that writes batch n to path/batch=n, once.

    A batch that is run again, as after a failure between its write and its
    commit, must hold the same rows; then nothing is written, else it is an
    error and what is there stays. A half-written batch has another name, as
    it is only renamed when it is whole.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        final, half = (jvm.org.apache.hadoop.fs.Path(f"{path}/{name}") for name in (f"batch={number}", f"_half-{number}"))
        files = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(final):
            there = spark.read.schema(batch.schema).parquet(final.toString())
            counted = [x.groupBy(*x.columns).count() for x in (batch, there)]
            if not counted[0].exceptAll(counted[1]).isEmpty() or not counted[1].exceptAll(counted[0]).isEmpty():
                raise ValueError(f"batch {number} was written with other rows")
            return
        batch.write.mode("overwrite").parquet(half.toString())
        if not files.rename(half, final):
            raise OSError(f"batch {number} could not be put in its place")

    return write


def run(deliveries: DataFrame, path: str, checkpoint: str) -> None:
    """Accept all deliveries that are there now, from where the checkpoint ends, and append them to path."""
    spark = deliveries.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STORE)
    try:
        query = accepted(deliveries).writeStream.foreachBatch(frozen_batches(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
