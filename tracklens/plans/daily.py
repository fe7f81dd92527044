"""The encounter job fed by daily files.

``ingest_day`` cleans one day and adds it to a store; ``from_store`` gives
what the rest of the job needs.  A day costs a scan of that day and of the
carry, never a reread of the month or of the states of earlier days:

* ``clean/day=...``      the day's cleaned pings (O17-O22)
* ``carry/through=...``  every vessel's last fix up to that day: the next
                         day's first rows are compared with it
* ``state/day=...``      counts of SOGs and last pings of that day
                         (:mod:`tracklens.operators.day_state`), merged when read
* ``days``               the days that are complete; written last, so a day
                         that broke off is simply ingested again

Days arrive in order (gaps are allowed); a ping of another day fails the job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.config import EncounterConfig
from tracklens.operators.day_state import STATE, day_state, merge_states, state_medians
from tracklens.operators.filters import select_pings
from tracklens.operators.tracks import clean_tracks, last_fix, moving_list, pings_of

_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class DailyStore:
    """What the days ingested so far add up to."""

    days: list[dt.date]
    cleaned: DataFrame  # the cleaned pings of all days
    state: DataFrame
    movers: DataFrame  # vessels that are not stationary over all days
    clean: DataFrame  # their cleaned pings


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def ingested_days(spark: SparkSession, store: str) -> list[dt.date]:
    """The complete days of a store, in order (one row a day on the driver)."""
    if not _exists(spark, f"{store}/days"):
        return []
    return sorted(r["day"] for r in spark.read.parquet(f"{store}/days").distinct().collect())


def _of_day(pings: DataFrame, day: dt.date) -> DataFrame:
    start = (day - _EPOCH).days * 86400
    inside = F.col("ts_unix").between(start, start + 86399)
    return pings.filter(F.assert_true(inside, F.lit(f"a ping does not lie in {day}")).isNull())


def ingest_day(
    spark: SparkSession,
    pings: DataFrame,
    day: dt.date,
    store: str,
    cfg: EncounterConfig | None = None,
    order: Sequence[str] | None = None,
) -> None:
    """Clean the pings of ``day`` and add them to ``store``.  A day that is
    already complete, or that lies before one that is, is refused."""
    cfg = (cfg or EncounterConfig()).validate()
    done = ingested_days(spark, store)
    if done and day <= done[-1]:
        raise ValueError(f"{day} is not after {done[-1]}, the last day of the store")
    selected = select_pings(_of_day(pings.where("ts_unix IS NOT NULL"), day), cfg)
    before = done[-1] if done else None
    carry = spark.read.parquet(f"{store}/carry/through={before}") if before else None
    cleaned = clean_tracks(selected, cfg, order, carry=carry)
    cleaned.write.mode("overwrite").parquet(f"{store}/clean/day={day}")
    last_fix(selected, order, carry).write.mode("overwrite").parquet(f"{store}/carry/through={day}")
    state = day_state(spark.read.parquet(f"{store}/clean/day={day}"))
    state.select(*STATE).write.mode("overwrite").parquet(f"{store}/state/day={day}")
    spark.createDataFrame([(day,)], "day date").coalesce(1).write.mode("append").parquet(f"{store}/days")
    for old in done[:-1]:  # the version before stays until the next day is complete
        fs, p = _hadoop(spark, f"{store}/carry/through={old}")
        fs.delete(p, True)


def _state(spark: SparkSession, store: str, days: list[dt.date]) -> DataFrame:
    """The state of all ``days``.  Days without one of their own were ingested
    when a store kept one state of all days up to the last."""
    merged = [d for d in days if not _exists(spark, f"{store}/state/day={d}")]
    paths = [f"{store}/state/through={d}" for d in merged[-1:]] + [f"{store}/state/day={d}" for d in days if d not in merged]
    return merge_states(*[spark.read.parquet(p) for p in paths])


def from_store(spark: SparkSession, store: str, cfg: EncounterConfig | None = None) -> DailyStore:
    """The cleaned pings and per-vessel tables of all complete days."""
    cfg = (cfg or EncounterConfig()).validate()
    days = ingested_days(spark, store)
    if not days:
        raise ValueError(f"{store} holds no complete day")
    cleaned = spark.read.option("basePath", f"{store}/clean").parquet(*[f"{store}/clean/day={d}" for d in days])
    state = _state(spark, store, days)
    movers = moving_list(state_medians(state), cfg)
    return DailyStore(days, cleaned, state, movers, pings_of(cleaned, movers))
