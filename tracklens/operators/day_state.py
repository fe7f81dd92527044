"""Mergeable state of vessels over daily files.

One row per (vessel, SOG) with the number of pings and the time of the last
one holds everything the month needs besides the pings themselves: the median
SOG (a weighted rank over the counts), every vessel's last ping and the end of
the data.  States of disjoint sets of pings merge by adding counts and taking
the later time, in any order, so a day is added without rereading the month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.config import EncounterConfig
from tracklens.operators.reaction import genuine_among, silence_from_last
from tracklens.operators.tracks import weighted_median

_DEFAULT = EncounterConfig()
STATE = ("mmsi", "sog", "n", "last_unix")


def day_state(pings: DataFrame) -> DataFrame:
    """``mmsi, sog, n, last_unix`` of some pings (null SOGs are a row too)."""
    return pings.groupBy("mmsi", "sog").agg(F.count(F.lit(1)).alias("n"), F.max("ts_unix").alias("last_unix"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all pings behind ``states``."""
    both = states[0].select(*STATE)
    for s in states[1:]:
        both = both.unionByName(s.select(*STATE))
    return both.groupBy("mmsi", "sog").agg(F.sum("n").alias("n"), F.max("last_unix").alias("last_unix"))


def state_medians(state: DataFrame) -> DataFrame:
    """``mmsi, median_sog``: equals ``median_speed`` of the pings."""
    return weighted_median(state.select("mmsi", "sog", "n"))


def state_last_ping(state: DataFrame) -> DataFrame:
    """``mmsi, last_ping_unix``: equals ``last_ping`` of the pings."""
    return state.groupBy("mmsi").agg(F.max("last_unix").alias("last_ping_unix"))


def state_genuine_last_ping(state: DataFrame, movers: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """``genuine_last_ping`` of the pings of the vessels of ``movers``."""
    return genuine_among(state_last_ping(state).join(movers, "mmsi", "left_semi"), cfg)


def state_silence_flags(cands: DataFrame, state: DataFrame, movers: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """``silence_flags`` without reading the pings."""
    return silence_from_last(cands, state_genuine_last_ping(state, movers, cfg), cfg)
