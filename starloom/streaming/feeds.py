"""Daily feeds taken in incrementally: what has arrived, then stop."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions.columns import code
from starloom.model import Parent
from starloom.operators.scd2 import DuplicateKeyError, prepare_feed
from starloom.session import stage
from starloom.sources.history import HistoryStore, TooOldError
from starloom.sources.readers import CORRUPT, Csv, with_csv_options


def _csv_stream(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    return with_csv_options(spark.readStream, schema).csv(source)


def ingest(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str
) -> Csv:
    """Land the files that arrived since the last run, each exactly once.

    Lines that do not parse are landed too, marked, and split off on reading.
    """
    landing = (
        _csv_stream(spark, source, schema)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    landing.awaitTermination()
    landed = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    rows = landed.parquet(target)
    bad = F.col(CORRUPT).isNotNull()
    return Csv(rows.where(~bad).select(*schema.names), rows.where(bad).select(CORRUPT))


#: Why a day's rows were set aside, by the error that refused them.
REFUSED = {DuplicateKeyError: "a key twice", TooOldError: "older than the first load"}


class DeadLetters:
    """Rows of days that a dimension refused, kept under ``folder`` until they are replayed."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType, apply: Callable[[DataFrame, date, str], object]
    ):
        self.spark, self.folder, self.apply = spark, folder, apply
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        self.columns = schema.names
        self.schema = f"{kinds}, file string, reason string, detail string, batch long, feed_date date"

    def keep(self, rows: DataFrame, error: Exception, batch: int, day: date) -> None:
        """Set a day's rows aside; a batch that runs again writes the same folder."""
        marked = rows.withColumn("reason", F.lit(REFUSED[type(error)])).withColumn("detail", F.lit(str(error)))
        path = f"{self.folder}/letters/batch={batch}/feed_date={day}"
        marked.select(*self.columns, "file", "reason", "detail").write.mode("overwrite").parquet(path)

    def open(self) -> DataFrame:
        """Rows that were set aside and not replayed yet."""
        return self._read("letters").join(self._read("replayed", "batch long, feed_date date"), ["batch", "feed_date"], "left_anti")

    def _read(self, kind: str, schema: str | None = None) -> DataFrame:
        schema = schema or self.schema
        path = f"{self.folder}/{kind}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def report(self) -> DataFrame:
        """Refused days with their reason, files and rows."""
        return self.open().groupBy("batch", "feed_date", "reason").agg(
            F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_set("file")).alias("files")
        )

    def replay(self, mend: Callable[[DataFrame], DataFrame]) -> list[date]:
        """Apply the open days again, mended, oldest first; the days that went through."""
        letters = self.open()
        done = []
        # one row per refused day
        for r in sorted(letters.select("feed_date", "batch").distinct().collect()):
            rows = letters.where((F.col("batch") == r["batch"]) & (F.col("feed_date") == F.lit(r["feed_date"])))
            try:
                self.apply(mend(rows.select(*self.columns)), r["feed_date"], f"replay of {r['batch']}")
            except tuple(REFUSED):
                continue
            mark = self.spark.createDataFrame([(r["batch"], r["feed_date"])], "batch long, feed_date date")
            mark.write.mode("append").parquet(f"{self.folder}/replayed")
            done.append(r["feed_date"])
        return done


def apply_feed(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    store: HistoryStore,
    parents: tuple[Parent, ...],
    dims: dict[str, DataFrame],
    checkpoint: str,
    rejects: str,
) -> DeadLetters:
    """Apply the change files that arrived to the stored dimension, day by day.

    Each row carries its ``feed_date``, codes are trimmed and upper-cased. Days may come
    in any order; a batch that runs again passes over the days it has applied. A day that
    the dimension refuses becomes dead letters, and the stream goes on.
    """
    dated = T.StructType([*schema.fields, T.StructField("feed_date", T.DateType())])
    codes = {c: code(F.col(c)) for c in schema.names if c.endswith("_code")}

    def apply_day(rows: DataFrame, day: date, batch: str) -> DataFrame:
        feed = prepare_feed(rows.withColumns(codes), store.spec, parents, dims)
        store.apply(feed.accepted, day, batch)
        return feed.rejects

    dead = DeadLetters(spark, f"{rejects}/dead", schema, apply_day)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        bad = F.col(CORRUPT).isNotNull() | F.col("feed_date").isNull()
        batch = stage(batch, "feed")
        days = batch.where(~bad).select("feed_date").distinct().collect()  # one row per day
        for day in sorted(r["feed_date"] for r in days):
            of_day = batch.where(~bad & (F.col("feed_date") == F.lit(day)))
            try:
                lost = apply_day(of_day.select(*schema.names), day, str(batch_id))
            except tuple(REFUSED) as error:
                dead.keep(of_day, error, batch_id, day)
                continue
            lost.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}/day={day}")
        batch.where(bad).select(CORRUPT).write.mode("overwrite").parquet(
            f"{rejects}/batch={batch_id}/unreadable"
        )

    query = (
        _csv_stream(spark, source, dated)
        .withColumn("file", F.col("_metadata.file_path"))
        .writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return dead
