"""Tables that grow by commits: what is not named by a published manifest is not there.

Data of a delivery are written to a folder that no reader looks at. A manifest then names the folder and
the units in it, and is published by one rename. Whether a unit is done follows from the manifests alone, so
a job that dies between data and mark leaves neither half a unit nor a mark without data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.tables import DELIVERY

COMPLETE, EMPTY, FAILED = "complete", "empty", "failed"


@dataclass(frozen=True)
class CommitTable:
    """A table at ``place`` with rows of ``schema``, in units named by ``keys``."""

    spark: SparkSession
    place: str
    keys: tuple[str, ...]
    schema: T.StructType

    def _manifest_schema(self) -> T.StructType:
        own = T.StructType([f for f in self.schema if f.name in self.keys])
        return own.add(DELIVERY, "string").add("attempt", "string").add("status", "string").add("reason", "string").add("n_rows", "long")

    def _folder_exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _table(self, folder: str, schema: T.StructType) -> DataFrame:
        path = f"{self.place}/{folder}"
        return self.spark.read.schema(schema).parquet(path) if self._folder_exists(path) else self.spark.createDataFrame([], schema)

    def append(self, rows: DataFrame, delivery: str | None = None, asked: DataFrame | None = None) -> None:
        """Write ``rows`` and commit them with their units.

        ``delivery`` names where they come from (without it the column ``_delivery`` does); one that comes
        again replaces what it brought before. ``asked`` are the units that were wanted: those of which no row
        came are recorded as empty, and are asked for again.
        """
        named = rows if delivery is None else rows.withColumn(DELIVERY, F.lit(delivery))
        named = named.select(*self.schema.names, DELIVERY)
        attempt = uuid.uuid4().hex
        folder = f"{self.place}/data/attempt={attempt}"
        named.write.partitionBy(DELIVERY, *self.keys).parquet(folder)
        written = self.spark.read.schema(named.schema).parquet(folder)
        units = written.groupBy(*self.keys, DELIVERY).agg(F.count(F.lit(1)).alias("n_rows"))
        found = self._marked(units, attempt, COMPLETE)
        if asked is not None:
            absent = asked.select(*self.keys).distinct().join(units.select(*self.keys), list(self.keys), "left_anti")
            absent = absent.withColumns({DELIVERY: F.lit(delivery or attempt), "n_rows": F.lit(0).cast("long")})
            found = found.unionByName(self._marked(absent, attempt, EMPTY))
        self.publish(found)

    def fail(self, units: DataFrame, reason: str) -> None:
        """Record units that could not be had; they are asked for again."""
        attempt = uuid.uuid4().hex
        lost = units.select(*self.keys).distinct().withColumns({DELIVERY: F.lit(attempt), "n_rows": F.lit(0).cast("long")})
        self.publish(self._marked(lost, attempt, FAILED, reason))

    def _marked(self, units: DataFrame, attempt: str, status: str, reason: str | None = None) -> DataFrame:
        out = units.withColumns({"attempt": F.lit(attempt), "status": F.lit(status), "reason": F.lit(reason).cast("string")})
        return out.select(*self._manifest_schema().names)

    def publish(self, manifest: DataFrame) -> None:
        """Make a manifest visible, as the next commit, by a rename that fails if another one was faster."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        staged = f"{self.place}/staging/{uuid.uuid4().hex}"
        manifest.write.parquet(staged)
        source = jvm.org.apache.hadoop.fs.Path(staged)
        files = source.getFileSystem(conf)
        log = jvm.org.apache.hadoop.fs.Path(f"{self.place}/log")
        files.mkdirs(log)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        while True:
            taken = [int(s.getPath().getName().removeprefix("commit=")) for s in files.listStatus(log)]
            target = jvm.org.apache.hadoop.fs.Path(f"{self.place}/log/commit={max(taken, default=0) + 1}")
            try:
                context.rename(files.makeQualified(source), files.makeQualified(target), options)
                return
            except Exception:
                if not files.exists(target):
                    raise

    def manifests(self) -> DataFrame:
        """Every published line, with its commit."""
        return self._table("log", self._manifest_schema().add("commit", "long"))

    def _current(self) -> DataFrame:
        """Lines of the last commit of each delivery."""
        lines = self.manifests()
        last = lines.groupBy(DELIVERY).agg(F.max("commit").alias("last_commit"))
        return lines.join(last, DELIVERY).where(F.col("commit") == F.col("last_commit")).drop("last_commit")

    def states(self) -> DataFrame:
        """Each unit with its state: complete if any delivery brought rows, else what happened last."""
        whole = F.bool_or(F.col("status") == COMPLETE)
        last = F.max_by("status", "commit")
        return self._current().groupBy(*self.keys).agg(F.when(whole, COMPLETE).otherwise(last).alias("status"), F.sum("n_rows").alias("n_rows"))

    def pending(self, units: DataFrame) -> DataFrame:
        """Units that are not complete: never asked for, failed, or empty."""
        done = self.states().where(F.col("status") == COMPLETE).select(*self.keys)
        return units.join(done, list(self.keys), "left_anti")

    def read(self) -> DataFrame:
        """The rows of all current deliveries; folders that no manifest names are skipped before they are read."""
        full = T.StructType([*self.schema]).add("attempt", "string").add(DELIVERY, "string")
        named = self._current().where(F.col("status") == COMPLETE).select("attempt", DELIVERY).distinct()
        return self._table("data", full).join(named, ["attempt", DELIVERY], "left_semi").select(*self.schema.names)


def once(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """A stream without repeats of ``keys`` that come within ``delay`` of each other; the state forgets older ones."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
