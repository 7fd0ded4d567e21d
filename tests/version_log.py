"""A log of row versions that grows commit by commit, for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quaylake.operators import dml, versions


class Log:
    def __init__(self, spark, schema):
        self.n = 0
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.log = spark.createDataFrame([], f"{columns}, _row_id string, _commit_id long, _op string")

    def _add(self, rows):
        # stored, so that row ids stay what they are
        rows = rows.checkpoint(eager=True)
        self.log = self.log.unionByName(rows)
        return self.n

    def _row_id(self):
        return F.concat(F.lit(f"{self.n}-"), F.monotonically_increasing_id().cast("string"))

    def state(self):
        return versions.current(self.log, with_ids=True)

    def _entries(self, rows, op):
        return rows.withColumn("_commit_id", F.lit(self.n).cast("long")).withColumn("_op", F.lit(op))

    def insert(self, rows):
        self.n += 1
        return self._add(self._entries(rows.withColumn("_row_id", self._row_id()), "I"))

    def update(self, predicate, assignments):
        self.n += 1
        hit = self.state().where(dml._pred(predicate))
        return self._add(self._entries(dml.update_where(hit, F.lit(True), assignments), "U"))

    def delete(self, predicate):
        self.n += 1
        return self._add(self._entries(self.state().where(dml._pred(predicate)), "D"))

    def merge(self, source, on, update):
        self.n += 1
        merged = dml.merge_into(self.state(), source, on, update=update, matched_flag="_met")
        fresh = merged.where("_met IS NULL").drop("_met").withColumn("_row_id", self._row_id())
        rows = self._entries(fresh, "I")
        if update:
            rows = rows.unionByName(self._entries(merged.where("_met").drop("_met"), "U"))
        return self._add(rows)

    def commits(self):
        start = F.lit(dt.datetime(2001, 8, 1)).cast("timestamp_ntz")
        return versions.recorded(self.log, F.timestamp_add("DAY", F.col("commit_id").cast("int"), start))

    def as_of(self, commit_id):
        return versions.as_of(self.log, self.commits(), commit_id)

    def current(self):
        return versions.current(self.log)
