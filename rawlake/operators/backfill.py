"""Date-range backfill: which dates to do, and doing them, each for itself."""

from __future__ import annotations

from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from rawlake.operators.sink import Written
from rawlake.sources.inventory import calendar


def pending(spark: SparkSession, start: str, end: str, published: DataFrame, file_type: str = "date") -> DataFrame:
    """Dates of the range that have no published output (``d``) yet."""
    return calendar(spark, start, end, file_type).join(published.select("d").distinct(), "d", "left_anti")


def backfill(job: Any, start: str, end: str, on_error: str = "skip") -> dict[str, Any]:
    """Ingest a whole range; dates without files are skipped.

    The range is one Spark job. What is wrong with cells, records, headers or
    files is found there, and keeps only the outputs concerned from being published
    (``Job.write``). If the job itself fails, as it does on an archive that breaks off,
    the range is done in halves, and these in halves, until the dates that fail stand
    alone: k such dates among n cost some k log n jobs. All other outputs are published.

    Tells ``outputs``, ``failed``, ``files``, ``rows``, ``errors`` (see ``Job.write``) and
    ``unreadable``, a list of dates that failed as a whole and why. With
    ``on_error="raise"`` the first problem raises, and nothing is published.
    """
    days = [r["d"] for r in calendar(job.spark, start, end, job.templates[0].file_type).orderBy("d").collect()]  # checks the range
    if on_error == "raise":
        return job.write(start, end, allow_empty=True)
    done: list[Written] = []
    unreadable: list[tuple[str, str]] = []
    ranges = [days]
    while ranges:
        own = ranges.pop()
        try:
            done.append(job.write(own[0], own[-1], allow_empty=True, on_error="skip"))
        except (PySparkException, Py4JJavaError) as e:
            # Other errors are those of the configuration: they meet every date alike.
            if len(own) == 1:
                unreadable.append((own[0], _reason(e)))
            else:
                ranges += [own[len(own) // 2 :], own[: len(own) // 2]]
    told: dict[str, Any] = {k: sum(w[k] for w in done) for k in ("files", "rows")}
    told.update({k: sorted(p for w in done for p in w[k]) for k in ("outputs", "failed")})
    errors = reduce(DataFrame.unionByName, [w["errors"] for w in done]) if done else None
    return {**told, "errors": errors, "unreadable": sorted(unreadable)}


def _reason(e: Exception) -> str:
    """The line of an error that says what it is."""
    lines = [line.strip() for line in str(e).splitlines() if line.strip()]
    return next((line for line in lines if "Exception" in line or "Error" in line), lines[0] if lines else type(e).__name__)
