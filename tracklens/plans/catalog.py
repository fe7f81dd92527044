"""Registered queries: every operator of the inventory run over the whole
fixture derived from the driver's ``events`` table.

Outputs use ``*_unix`` epoch seconds instead of timestamps and round values
computed with transcendental functions or float sums to 6 decimals, so they
compare exactly with the DuckDB oracle (``tracklens.plans.oracle``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.config import EncounterConfig
from tracklens.functions.geo import haversine_nm, utc_day
from tracklens.operators import day_state as ds
from tracklens.operators import filters as flt
from tracklens.operators import proximity as prox
from tracklens.operators import reaction as rx
from tracklens.operators import score as sc
from tracklens.operators import tracks as tr
from tracklens.operators import trajectory as tj
from tracklens.plans.daily import from_store, ingest_day
from tracklens.plans.materialize import materialize, shared_checkpoint_dir
from tracklens.operators.tracks import TRACK_KEYS
from tracklens.schema import CSV_COLUMNS
from tracklens.sources.ais_csv import parse_ais, split_ais_csv
from tracklens.sources.fixture import FIXTURE_ORDER, pings_from_events
from tracklens.sources.store import DAY_COLUMN, read_pings, write_pings

CFG = EncounterConfig()
BASE = ["event_id", "mmsi", "ts_unix", "lat", "lon", "sog", "cog", "name", "ship_type", "mobile_type"]
PAIR = ["mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "lat_a", "lon_a", "lat_b", "lon_b"]
CAND = [
    "mmsi_a", "mmsi_b", "name_a", "name_b", "ts_unix_a", "ts_unix_b", "lat_a", "lon_a", "lat_b", "lon_b",
    "sog_a", "sog_b", "distance_nm", "closing_speed_kn", "vessels_in_cell_a", "vessels_in_cell_b",
]
SCORED = CAND + [
    "last_ping_a", "last_ping_b", "event_unix", "silence_a", "silence_b", "silent_a", "silent_b",
    "silence_count", "min_silence_s", "max_sog_drop", "max_cog_change", "post_event_divergence",
    "scene_density", "collision_score",
]
SILENCE = [
    "mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "last_ping_a", "last_ping_b", "event_unix", "silence_a",
    "silence_b", "silent_a", "silent_b", "silence_count", "min_silence_s",
]
TRAJECTORY = ["rank", "side", "mmsi", "vessel_label", "event_unix", "ts_unix", "lat", "lon", "sog", "cog", "phase"]
ROUNDED = {
    "dist_center_nm", "dist_prev", "implied_speed", "distance_nm", "closing_speed_kn", "max_sog_drop",
    "max_cog_change", "post_event_divergence", "collision_score", "sog_before", "sog_after", "cog_before",
    "cog_after", "distance_m",
}


def out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Project ``cols``; round the float-noise columns to 6 decimals."""
    return df.select(*[F.round(c, 6).alias(c) if c in ROUNDED else F.col(c) for c in cols])


class Fixture:
    """Lazily built stages of the pipeline over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: EncounterConfig = CFG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg.validate()
        self.order = FIXTURE_ORDER

    @cached_property
    def raw(self) -> DataFrame:
        # Written once like an ingested input: left lazy, Catalyst would inline
        # the fixture's CASE expressions into every downstream predicate; read
        # from files, the track shuffle is shared by both lag branches.
        return materialize(pings_from_events(self.spark, self.spark.read.parquet(f"{self.sf_dir}/events.parquet")))

    @cached_property
    def from_files(self):
        """The fixture written as CSV files and read back: pings, rejects."""
        folder = f"{shared_checkpoint_dir(self.spark)}/ais-{uuid.uuid4().hex}"
        write_ais_files(_ais_text(self), f"{folder}/csv")
        return split_ais_csv(self.spark, f"{folder}/csv", f"{folder}/tables")

    @cached_property
    def valid(self):
        return flt.valid_pings(self.raw)

    @cached_property
    def timew(self):
        return flt.time_window(self.valid, self.cfg)

    @cached_property
    def bbox(self):
        return flt.bbox_filter(self.timew, self.cfg)

    @cached_property
    def radius(self):
        return flt.radius_filter(self.bbox, self.cfg)

    @cached_property
    def classa(self):
        return flt.class_filter(self.radius, self.cfg)

    @cached_property
    def notsar(self):
        return flt.exclude_mmsi_prefix(self.classa, self.cfg)

    @cached_property
    def withdist(self):
        return tr.distance_to_previous(tr.previous_fix(self.notsar, self.cfg, self.order))

    @cached_property
    def dedup(self):
        return tr.dedup_pings(self.withdist, self.order)

    @cached_property
    def cleaned_helpers(self):
        return tr.speed_filter(tr.implied_speed(self.dedup), self.cfg)

    # Fan-out points (each feeds several branches) are materialised once.
    @cached_property
    def cleaned(self):
        return materialize(tr.clean_tracks(self.notsar, self.cfg, self.order), TRACK_KEYS, num_buckets=self.cfg.track_buckets)

    @cached_property
    def daily(self):
        """The same pings stored by day and ingested one day after the other."""
        folder = f"{shared_checkpoint_dir(self.spark)}/daily-{uuid.uuid4().hex}"
        inside = flt.time_window(self.raw.where("ts_unix IS NOT NULL"), self.cfg)
        write_pings(inside, f"{folder}/pings")
        pings = read_pings(self.spark, f"{folder}/pings")
        for row in pings.select(DAY_COLUMN).distinct().orderBy(DAY_COLUMN).collect():  # the window's days
            day = row[DAY_COLUMN]
            ingest_day(self.spark, pings.where(F.col(DAY_COLUMN) == F.lit(day)).drop(DAY_COLUMN), day, f"{folder}/store", self.cfg, self.order)
        return from_store(self.spark, f"{folder}/store", self.cfg)

    @cached_property
    def moving(self):
        return tr.moving_vessels(self.cleaned, self.cfg, materialize)

    @cached_property
    def clean(self):
        return materialize(self.moving, TRACK_KEYS, num_buckets=self.cfg.track_buckets)

    @cached_property
    def pp(self):
        # from the cleaned pings and the list of moving vessels: the pairing reads
        # them twice, which costs less than another table of nearly all pings
        return materialize(prox.pairing_pings(self.moving, self.cfg, self.order))

    def pairs(self, strategy: str = "border"):
        return prox.with_closing_speed(prox.proximity_pairs(self.pp, self.cfg, strategy))

    @cached_property
    def adaptive(self):
        """The pair join over cells that are quartered beyond eight pings, so
        that the cells of this fixture are."""
        cfg = replace(self.cfg, max_cell_pings=8)
        return prox.proximity_pairs(self.pp, cfg, "adaptive", materialize(prox.hot_cells(self.pp, cfg)))

    @cached_property
    def conv(self):
        return prox.converging(self.pairs(), self.cfg)

    @cached_property
    def top3(self):
        return prox.top_n_per_pair(self.conv, self.cfg.candidates_per_pair)

    @cached_property
    def density(self):
        return prox.cell_density(self.pp)

    @cached_property
    def cands(self):
        return materialize(prox.find_candidates(self.moving, self.cfg, self.order, pp=self.pp, cut=materialize))

    @cached_property
    def sil(self):
        return rx.silence_flags(self.cands, self.clean, self.cfg)

    @cached_property
    def events(self):
        return rx.event_keys(self.cands)

    @cached_property
    def rx(self):
        return rx.event_reaction(self.cands, self.clean, self.cfg)

    @cached_property
    def scored(self):
        return sc.score_candidates(self.cands, self.clean, self.cfg)

    @cached_property
    def top(self):
        return materialize(sc.top_k_pairs(self.scored, self.cfg.top_k_pairs), small=True)

    @cached_property
    def win(self):
        return sc.winner_from_top(self.top)

    @cached_property
    def wevent(self):
        return sc.winner_event(self.win, self.cands)

    @cached_property
    def traj(self):
        return tj.trajectories(self.clean, self.top, self.cfg)


def _by_stage(groups: DataFrame, stages: list[str]) -> DataFrame:
    """One row per vessel or pair with its row count at each stage -> one row
    per stage: rows, and groups that have any."""
    totals = groups.agg(
        *[F.coalesce(F.sum(s), F.lit(0)).alias(f"rows_{s}") for s in stages],
        *[F.count(F.when(F.col(s) > 0, 1)).alias(f"groups_{s}") for s in stages],
    )
    rows = [F.struct(F.lit(s).alias("stage"), F.col(f"rows_{s}").alias("n_rows"), F.col(f"groups_{s}").alias("n_vessels")) for s in stages]
    return totals.select(F.inline(F.array(*rows)))


def _stage_counts(fx: Fixture) -> DataFrame:
    """Rows and distinct vessels (or pairs) after every stage.  All row filters
    are counted in one pass over the raw pings, the three pair stages in one
    pass over the pair join (the cut to the top n follows from the counts)."""
    reached = flt.stage_reached(fx.raw, fx.cfg)
    steps = list(flt.STAGES)
    filters = reached.groupBy("mmsi").agg(*[F.count(F.when(F.col("stage") >= i, 1)).alias(s) for i, s in enumerate(steps)])
    out = _by_stage(filters, steps)
    for stage, df in (("dedup", fx.dedup), ("implied_speed", fx.cleaned), ("moving_vessels", fx.clean), ("moving_pings", fx.pp)):
        out = out.unionByName(_by_stage(df.groupBy("mmsi").agg(F.count(F.lit(1)).alias(stage)), [stage]))
    fast = F.col("closing_speed_kn") > fx.cfg.min_closing_speed_kn
    pairs = fx.pairs().groupBy("mmsi_a", "mmsi_b").agg(F.count(F.lit(1)).alias("close_pairs"), F.count(F.when(fast, 1)).alias("converging"))
    pairs = pairs.withColumn("top3", F.least(F.col("converging"), F.lit(fx.cfg.candidates_per_pair)))
    return out.unionByName(_by_stage(pairs, ["close_pairs", "converging", "top3"]))


def _trajectory_one(fx: Fixture) -> DataFrame:
    """The winning event's vessel A.  Its MMSI and time are one row."""
    ev = fx.wevent.first()
    t = tj.trajectory_one(fx.clean, ev["mmsi_a"], ev["event_unix"], fx.cfg.trajectory_window_s)
    return t.select(F.lit(ev["mmsi_a"]).cast("long").alias("mmsi"), "ts_unix", "lat", "lon", "sog", "cog")


def _ais_text(fx: Fixture) -> DataFrame:
    """The fixture as an AIS table arrives: text columns under the CSV's
    headers, with bad numbers and timestamps among them."""
    c, bad = CSV_COLUMNS, F.col("event_id") % 89
    stamp = F.concat_ws(" ", F.date_format(utc_day(F.col("ts_unix")), "dd/MM/yyyy"), F.substring(tj.utc_text(F.col("ts_unix")), 12, 8))
    text = {
        "ts": F.when(bad == 1, "2021-12-01").otherwise(stamp), "mmsi": F.when(bad == 2, "n/a").otherwise(F.col("mmsi").cast("string")),
        "lat": F.when(bad == 3, "55,2").otherwise(F.col("lat").cast("string")), "lon": F.col("lon").cast("string"),
        "sog": F.when(bad == 4, "").otherwise(F.col("sog").cast("string")), "cog": F.col("cog").cast("string"),
        "name": F.col("name"), "ship_type": F.col("ship_type"), "mobile_type": F.col("mobile_type"),
    }
    return fx.raw.select("event_id", *[text[k].alias(header) for k, header in c.items()])


def write_ais_files(text: DataFrame, folder: str, per_file: int = 20_000) -> None:
    """``text`` (``event_id`` and the CSV's columns) as files of some ``per_file``
    lines with a header each; every 83rd line is cut off, every 71st too long."""
    cols = [F.coalesce(F.concat(F.lit('"'), F.col(f"`{c}`"), F.lit('"')), F.lit("")) for c in CSV_COLUMNS.values()]
    line = F.when(F.col("event_id") % 83 == 8, F.concat_ws(",", *cols[:3])).when(F.col("event_id") % 71 == 9, F.concat_ws(",", *cols, F.lit("surplus"), F.lit("")))
    lines = text.select((F.col("event_id") / per_file).cast("long").alias("file"), "event_id", line.otherwise(F.concat_ws(",", *cols)).alias("value"))
    header = lines.select("file").distinct().select("file", F.lit(-1).cast("long").alias("event_id"), F.lit(",".join(CSV_COLUMNS.values())).alias("value"))
    rows = lines.unionByName(header).repartition("file").sortWithinPartitions("file", "event_id")
    rows.select("file", "value").write.partitionBy("file").text(folder)


def _content_order(fx: Fixture) -> DataFrame:
    """Default cleaning: no row id, every 13th report received twice."""
    p = fx.notsar.select(*[c for c in BASE if c != "event_id"], "event_id")
    twice = p.unionByName(p.where("event_id % 13 = 0")).drop("event_id")
    return tr.clean_tracks(twice, fx.cfg).select(*[c for c in BASE if c != "event_id"])


def _lines(fx: Fixture) -> DataFrame:
    lines = tj.trajectory_lines(fx.traj)

    def path(c):
        pt = lambda p: F.concat_ws(
            " ", F.round(p["lon"] * 1e6).cast("long").cast("string"), F.round(p["lat"] * 1e6).cast("long").cast("string")
        )
        return F.when(F.col(c).isNotNull(), F.array_join(F.transform(c, pt), ",")).alias(c)

    return lines.select(
        "rank", "side", "mmsi", "vessel_label", "event_unix", "n_before", "n_after", path("line_before"), path("line_after"),
        "start_lat", "start_lon", "end_lat", "end_lon",
    )


def _neighbor_cells(fx: Fixture) -> DataFrame:
    return prox.neighbor_cells(fx.pp).select(
        "event_id", "mmsi", "time_bucket", "grid_lat", "grid_lon", "join_grid_lat", "join_grid_lon"
    )


def _radius(fx: Fixture) -> DataFrame:
    d = haversine_nm(fx.cfg.center_lat, fx.cfg.center_lon, "lat", "lon")
    return out(fx.radius.withColumn("dist_center_nm", d), BASE + ["dist_center_nm"])


QUERIES: dict[str, Callable[[Fixture], DataFrame]] = {
    "ais_parse": lambda fx: flt.valid_pings(parse_ais(_ais_text(fx))).select(*[c for c in BASE if c != "event_id"]),
    "ais_csv": lambda fx: fx.from_files[0].select(*[c for c in BASE if c != "event_id"]),
    "ais_csv_rejects": lambda fx: fx.from_files[1].select("reason", "mmsi", F.col("_line").isNotNull().alias("malformed")),
    "clean_tracks_content_order": _content_order,
    "valid_pings": lambda fx: out(fx.valid, BASE),
    "time_window": lambda fx: out(fx.timew, BASE),
    "geo_bbox": lambda fx: out(fx.bbox, BASE),
    "geo_radius": _radius,
    "class_a": lambda fx: out(fx.classa, BASE),
    "not_sar": lambda fx: out(fx.notsar, BASE),
    "previous_fix": lambda fx: out(fx.withdist, BASE + ["prev_lat", "prev_lon", "prev_unix", "dist_prev"]),
    "dedup_pings": lambda fx: out(fx.dedup, BASE + ["prev_unix", "dist_prev"]),
    "implied_speed": lambda fx: out(fx.cleaned_helpers, BASE + ["implied_speed"]),
    "clean_tracks": lambda fx: out(fx.cleaned, BASE),
    "median_speed": lambda fx: tr.median_speed(fx.cleaned),
    "moving_vessels": lambda fx: out(fx.clean, BASE),
    "moving_pings": lambda fx: out(fx.pp, BASE + ["grid_lat", "grid_lon", "time_bucket", "prev_lat", "prev_lon", "prev_unix"]),
    "neighbor_cells": _neighbor_cells,
    "close_pairs": lambda fx: out(fx.pairs("border"), PAIR + ["distance_nm"]),
    "proximity_pairs": lambda fx: out(fx.pairs("neighbors"), PAIR + ["distance_nm"]),
    "chord_pairs": lambda fx: out(fx.pairs("chord"), PAIR + ["distance_nm"]),
    "daily_trajectories": lambda fx: tj.trajectories(fx.daily.clean, fx.top, fx.cfg, DAY_COLUMN).select(*TRAJECTORY),
    "adaptive_pairs": lambda fx: out(fx.adaptive, PAIR + ["distance_nm"]),
    "daily_clean_tracks": lambda fx: out(fx.daily.cleaned, BASE),
    "daily_median_speed": lambda fx: ds.state_medians(fx.daily.state),
    "daily_last_ping": lambda fx: ds.state_genuine_last_ping(fx.daily.state, fx.daily.movers, fx.cfg),
    "daily_silence_flags": lambda fx: out(ds.state_silence_flags(fx.cands, fx.daily.state, fx.daily.movers, fx.cfg), SILENCE),
    "closing_speed": lambda fx: out(fx.pairs(), PAIR + ["distance_nm", "closing_speed_kn"]),
    "converging_pairs": lambda fx: out(fx.conv, PAIR + ["distance_nm", "closing_speed_kn"]),
    "top3_per_pair": lambda fx: out(fx.top3, PAIR + ["distance_nm", "closing_speed_kn"]),
    "cell_density": lambda fx: fx.density,
    "pair_density": lambda fx: out(fx.cands, ["mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "vessels_in_cell_a", "vessels_in_cell_b"]),
    "candidates": lambda fx: out(fx.cands, CAND),
    "last_ping": lambda fx: rx.genuine_last_ping(fx.clean, fx.cfg),
    "silence_flags": lambda fx: out(fx.sil, SILENCE),
    "event_keys": lambda fx: fx.events,
    "event_window_pings": lambda fx: rx.event_window_pings(
        fx.events, fx.clean, fx.cfg.reaction_window_s, fx.cfg.track_chunk_s
    ).select(
        "mmsi", "event_unix", "ts_unix", "offset_s", "sog", "cog"
    ),
    "pre_post_kinematics": lambda fx: out(
        rx.pre_post_kinematics(fx.events, fx.clean, fx.cfg),
        ["mmsi", "event_unix", "sog_before", "sog_after", "cog_before", "cog_after"],
    ),
    "event_reaction": lambda fx: out(
        fx.rx, ["mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "max_sog_drop", "max_cog_change", "post_event_divergence"]
    ),
    "scene_density": lambda fx: out(sc.scene_density(fx.cands), ["mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "scene_density"]),
    "score": lambda fx: out(fx.scored, SCORED),
    "score_without_tracks": lambda fx: out(
        sc.score_candidates(fx.cands, None, fx.cfg),
        CAND + ["ais_silence", "silence_count", "min_silence_s", "max_sog_drop", "max_cog_change",
                "post_event_divergence", "scene_density", "collision_score"],
    ),
    "best_per_pair": lambda fx: out(sc.best_per_pair(fx.scored), SCORED),
    "top5_pairs": lambda fx: out(fx.top, ["rank"] + SCORED),
    "winner": lambda fx: out(sc.winner(fx.scored), SCORED),
    "winner_event": lambda fx: out(
        fx.wevent,
        ["mmsi_a", "mmsi_b", "name_a", "name_b", "event_unix", "event_lat", "event_lon", "distance_nm", "distance_m", "collision_score"],
    ),
    "trajectory_one": _trajectory_one,
    "trajectories": lambda fx: fx.traj.select(*TRAJECTORY),
    "trajectory_lines": _lines,
    "event_report": lambda fx: tj.event_report(fx.wevent),
    "stage_counts": _stage_counts,
}


class FixturePool:
    """The fixtures of one set of queries: one per application and input
    folder, so that the queries of a set share the stages they have in common."""

    def __init__(self) -> None:
        self._made: dict[tuple[str, str], Fixture] = {}

    def __call__(self, spark: SparkSession, sf_dir: str) -> Fixture:
        key = (spark.sparkContext.applicationId, str(sf_dir))
        if key not in self._made:
            self._made[key] = Fixture(spark, sf_dir)
        return self._made[key]


def spark_queries(pool: FixturePool | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a function of (spark, folder).  Stages are shared within
    ``pool`` (a new one by default) and nowhere else."""
    pool = pool or FixturePool()

    def bind(fn):
        return lambda spark, sf_dir: fn(pool(spark, sf_dir))

    return {k: bind(v) for k, v in QUERIES.items()}
