"""A durable type-2 history that change batches are applied to.

Below ``root`` lie a change log reduced to one value per (key, date, field)
and the history made from it, both as of the last compaction, and the batches
that came after it. A batch writes its own changes and nothing else, so it
costs what it holds. A reader takes the stored history of the keys that no
later batch names and rebuilds the others from their changes (merge on read);
``compact`` writes the merged state. So the result does not depend on how
changes fall into batches: several dates of a key in one batch open one
version each.

What a commit names exists; anything else below ``root`` is left over from a
failure. Commits are numbered and each holds the whole state: the stored
tables, the batches since, and the last epoch of every writer. A writer (a
stream, by its checkpoint, or a job, by its name) counts its own epochs, so
several may feed one sink; an epoch that is applied again (Spark retries one
after a failure) finds itself in the ledger and does nothing. Writers at the
same time commit one after the other. Earlier commits can be read and
restored until ``vacuum`` drops them.

``late`` says what happens to a change that is dated on or before the last
accepted change of its key: ``"rewrite"`` gives it its place in the past,
``"ignore"`` leaves it out, as the timestamp strategy does, so that a closed
version stays as it is. All changes of one batch are judged by the state
before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.operators.history import scd2_history
from vireo.sources import storage

#: Writer name of ``append``.
APPENDED = "append"


class HistorySink:
    """History of ``base`` (one row per key) under change batches, kept below ``root``."""

    def __init__(self, spark: SparkSession, base: DataFrame, root: str, *, key: str, base_date: str, date: str,
                 field: str, value: str, fields: Sequence[str], late: str = "rewrite"):
        if late not in ("rewrite", "ignore"):
            raise ValueError(f"late is 'rewrite' or 'ignore', not {late!r}")
        self.spark, self.base, self.root, self.late = spark, base, root, late
        self.names = dict(key=key, base_date=base_date, date=date, field=field, value=value, fields=list(fields))
        self.commits = storage.CommitLog(spark, root)

    def _log(self, rows: DataFrame) -> DataFrame:
        """One value per (key, date, field): the larger one wins a tie."""
        n = self.names
        return rows.groupBy(n["key"], n["date"], n["field"]).agg(F.max(n["value"]).alias(n["value"]))

    def _changes(self, state: dict) -> DataFrame:
        """The reduced changes of a state: the stored log and the batches since."""
        parts = ([state["log"]] if state["log"] else []) + state["batches"]
        return self._log(self.spark.read.parquet(*parts))

    def _accepted(self, batch: DataFrame, state: dict | None) -> DataFrame:
        """The changes of a batch that count."""
        n = self.names
        batch = self._log(batch.select(n["key"], n["date"], n["field"], n["value"]))
        if self.late == "rewrite" or state is None:
            return batch
        last = self._changes(state).join(batch.select(n["key"]).distinct(), n["key"], "left_semi").groupBy(n["key"]).agg(F.max(n["date"]).alias("_last"))
        return batch.join(last, n["key"], "left").where(F.col("_last").isNull() | (F.col(n["date"]) > F.col("_last"))).drop("_last")

    def apply(self, batch: DataFrame, epoch: int | None, writer: str = "stream") -> int | None:
        """Merge one batch of changes as an epoch of ``writer`` (None: its next one); the epoch, or None if it was applied before."""
        written: dict[str, str] = {}
        given = None

        def change(state: dict | None) -> dict | None:
            nonlocal given
            ledger = state["writers"] if state else {}
            given = ledger.get(writer, -1) + 1 if epoch is None else epoch
            if given <= ledger.get(writer, -1):
                given = None
                return None
            judged = json.dumps([state["log"], state["batches"]]) if state and self.late == "ignore" else ""  # what the judgement rests on
            if judged not in written:
                written[judged] = f"{self.root}/data/{uuid.uuid4().hex}"
                self._accepted(batch, state).write.parquet(written[judged])
            new = state or {"log": None, "history": None, "batches": [], "compactions": 0, "writers": {}}
            return {**new, "batches": [*new["batches"], written[judged]], "writers": {**ledger, writer: given}}

        self.commits.update(change)
        return given

    def append(self, batch: DataFrame, writer: str = APPENDED) -> int:
        """Apply a batch as the next epoch of ``writer`` and return its number."""
        return self.apply(batch, None, writer)

    def _state(self, as_of: int | None) -> dict | None:
        return self.commits.latest()[1] if as_of is None else self.commits.read(as_of)

    def history(self, as_of: int | None = None) -> DataFrame | None:
        """The history as of a commit (default: the last one; None before the first)."""
        state = self._state(as_of)
        if state is None:
            return None
        n = self.names
        if state["history"] is None:
            return scd2_history(self.base, self._changes(state), **n)
        stored = self.spark.read.parquet(state["history"])
        if not state["batches"]:
            return stored
        touched = self.spark.read.parquet(*state["batches"]).select(n["key"]).distinct()
        rebuilt = scd2_history(self.base.join(touched, n["key"], "left_semi"), self._changes(state).join(touched, n["key"], "left_semi"), **n)
        return stored.join(touched, n["key"], "left_anti").unionByName(rebuilt)

    def compact(self) -> bool:
        """Store the merged state, so that readers need not merge; batches that come meanwhile stay as they are."""
        state, n = self._state(None), self.names
        if state is None or not state["batches"]:
            return False
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        for name, rows in (("log", self._changes(state)), ("history", self.history())):
            rows.repartition(n["key"]).sortWithinPartitions(n["key"]).write.parquet(f"{folder}/{name}")

        def change(now: dict) -> dict | None:
            if now["compactions"] != state["compactions"] or now["batches"][:len(state["batches"])] != state["batches"]:
                return None  # another compaction or a restore came first
            return {**now, "log": f"{folder}/log", "history": f"{folder}/history", "compactions": now["compactions"] + 1,
                    "batches": now["batches"][len(state["batches"]):]}
        return self.commits.update(change) is not None

    def restore(self, number: int) -> int:
        """Make the data of an earlier commit the current one. Epochs stay counted: what is undone is not applied again."""
        old = self.commits.read(number)
        return self.commits.update(lambda now: {**old, "writers": now["writers"], "compactions": now["compactions"] + 1})

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the last ``keep`` commits and the folders that these do not name; returns how many folders.

        Only to be run while nothing is being applied: a batch that is written but not committed looks left over.
        """
        kept = self.commits.numbers()[-keep:]
        states = [s for s in map(self.commits.read, kept) if s]
        named = {p for s in states for p in [*s["batches"], s["log"], s["history"]] if p}
        old = [f for f in storage.children(self.spark, f"{self.root}/data") if not any(p.startswith(f"{self.root}/data/{f}") for p in named)]
        for f in old:
            storage.delete(self.spark, f"{self.root}/data/{f}")
        if kept:
            self.commits.forget_before(kept[0])
        return len(old)


def stream_name(spark: SparkSession, checkpoint_location: str) -> str:
    """The id that Spark gives a stream in its checkpoint: a fresh checkpoint, which counts from 0 again, has another."""
    return json.loads(storage.read_text(spark, f"{checkpoint_location}/metadata"))["id"]


def start(sink: HistorySink, changes_dir: str, schema: str, checkpoint_location: str):
    """Run the files of ``changes_dir`` through the sink until no new one is left, then stop."""
    def into_sink(batch: DataFrame, epoch: int) -> None:
        sink.apply(batch, epoch, stream_name(sink.spark, checkpoint_location))

    stream = sink.spark.readStream.schema(schema).parquet(changes_dir)
    query = (stream.writeStream.foreachBatch(into_sink).option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
