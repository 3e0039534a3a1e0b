"""The ledger of processed parts: one row per part and task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The two tasks that make a part complete.
TASKS = ("geo", "script")

LEDGER_SCHEMA = (
    "task string, status string, error string, batch_id bigint, "
    "started_at timestamp, finished_at timestamp, year string, part string, attempt string"
)

LEDGER_COLUMNS = ["task", "status", "error", "batch_id", "started_at", "finished_at", "year", "part", "attempt"]


def append(rows: DataFrame, path: str) -> None:
    """Add rows of attempts at parts, as one file; earlier attempts stay."""
    rows.select(*LEDGER_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def attempts(ledger: DataFrame) -> DataFrame:
    """Per attempt at a part: success only if every task is there and none failed; errors and seconds.

    The rows are dealt out by part, so what is asked about parts needs no other exchange and,
    the attempts of a part being sorted next to one another, no other sort.
    """
    complete = (F.count_distinct(F.when(F.col("task").isin(*TASKS), F.col("task"))) == len(TASKS)) & F.bool_and(
        F.col("status") == "success"
    )
    elapsed = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return ledger.repartition("year", "part").groupBy("year", "part", "attempt").agg(
        F.when(complete, "success").otherwise("failed").alias("status"),
        F.count("*").alias("n_tasks"),
        F.min("error").alias("error"),
        (F.sum(elapsed) / 1_000_000).alias("seconds"),
        F.max("finished_at").alias("finished_at"),
    )


def ledger_status(ledger: DataFrame) -> DataFrame:
    """Per part, its last attempt."""
    last = F.max(F.struct("finished_at", "attempt", "status", "n_tasks", "error", "seconds")).alias("last")
    by_part = attempts(ledger).groupBy("year", "part").agg(last)
    return by_part.select("year", "part", *[F.col(f"last.{c}").alias(c) for c in ("status", "n_tasks", "error", "seconds")])


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Parts per year and status, with their run time."""
    return (
        ledger_status(ledger)
        .groupBy("year", "status")
        .agg(F.count("*").alias("n_parts"), F.sum("seconds").alias("seconds"))
    )


def completed(ledger: DataFrame) -> DataFrame:
    """(year, part, attempt, finished_at): for each part that was ever complete, the last attempt that was."""
    done = attempts(ledger).where(F.col("status") == "success").groupBy("year", "part")
    return done.agg(F.max(F.struct("finished_at", "attempt")).alias("last")).select("year", "part", "last.attempt", "last.finished_at")
