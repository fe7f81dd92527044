"""The encounter job: ``detect_encounters`` returns every result as a
DataFrame (fan-out points materialised), ``run_job`` also writes them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracklens.config import EncounterConfig
from tracklens.operators.filters import select_pings
from tracklens.operators.proximity import find_candidates, pairing_pings
from tracklens.operators.score import score_candidates, top_k_pairs, winner_event, winner_from_top
from tracklens.operators.tracks import TRACK_KEYS, clean_tracks, moving_vessels
from tracklens.operators.trajectory import event_report, trajectories, trajectory_lines
from tracklens.plans.materialize import data_buckets, materialize, shared_checkpoint_dir, workspace


@dataclass(frozen=True)
class Encounters:
    clean: DataFrame
    candidates: DataFrame
    scored: DataFrame
    winner: DataFrame
    top: DataFrame
    winner_event: DataFrame
    trajectories: DataFrame
    lines: DataFrame
    report: DataFrame


def clean_pings(pings: DataFrame, cfg: EncounterConfig, order: Sequence[str] | None = None) -> DataFrame:
    """Filters, track cleaning and the stationary-vessel filter."""
    return moving_vessels(clean_tracks(select_pings(pings, cfg), cfg, order), cfg)


def detect_encounters(
    pings: DataFrame,
    cfg: EncounterConfig | None = None,
    order: Sequence[str] | None = None,
    strategy: str = "border",
    clean: DataFrame | None = None,
    candidates: DataFrame | None = None,
    scored: DataFrame | None = None,
    day_column: str | None = None,
) -> Encounters:
    """All results as DataFrames.  The fan-out points (clean tracks, pairing
    pings, candidates, top-k report) are materialised on the way (see
    :mod:`tracklens.plans.materialize`); everything after them is lazy.
    ``clean`` / ``candidates`` / ``scored`` may be passed in precomputed;
    ``day_column`` names the UTC day column of a day-partitioned store."""
    cfg = (cfg or EncounterConfig()).validate()
    if clean is None:
        selected = select_pings(pings, cfg, day_column)
        if cfg.track_buckets is None:
            cfg = replace(cfg, track_buckets=data_buckets(selected))
        cleaned = materialize(clean_tracks(selected, cfg, order), TRACK_KEYS, num_buckets=cfg.track_buckets, dealt=True)
        clean = materialize(moving_vessels(cleaned, cfg, materialize), TRACK_KEYS, num_buckets=cfg.track_buckets, dealt=True)
    if candidates is None:
        pp = materialize(pairing_pings(clean, cfg, order))
        candidates = materialize(find_candidates(clean, cfg, order, strategy, pp=pp, cut=materialize))
    cands = candidates
    scored = scored if scored is not None else score_candidates(cands, clean, cfg)
    top = materialize(top_k_pairs(scored, cfg.top_k_pairs), small=True)
    win = winner_from_top(top)
    wev = winner_event(win, cands)
    traj = trajectories(clean, top, cfg)
    return Encounters(
        clean=clean,
        candidates=cands,
        scored=scored,
        winner=win,
        top=top,
        winner_event=wev,
        trajectories=traj,
        lines=trajectory_lines(traj),
        report=event_report(wev),
    )


def run_job(
    spark: SparkSession,
    pings: DataFrame,
    output_dir: str,
    cfg: EncounterConfig | None = None,
    order: Sequence[str] | None = None,
    strategy: str = "border",
    mode: str = "overwrite",
    day_column: str | None = None,
) -> dict[str, int]:
    """Run the whole job and write scored / top / trajectories / lines /
    report as Parquet (report also as JSON) under ``output_dir``.

    Requires the shared checkpoint folder (``spark.checkpoint.dir``): the
    fan-out points are cut from their lineage there, so a lost executor
    re-reads checkpoint files instead of re-running the scan and self-join.
    Those tables are dropped at the end; the counts returned were taken while
    the tables were written."""
    if not shared_checkpoint_dir(spark):
        raise RuntimeError("set spark.checkpoint.dir (a shared folder) before run_job")
    with workspace(spark):
        first = detect_encounters(pings, cfg, order, strategy, day_column=day_column)
        # The scored output doubles as the lineage cut for everything after it.
        rows = Observation()
        first.scored.observe(rows, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(f"{output_dir}/scored")
        scored = spark.read.parquet(f"{output_dir}/scored")
        res = detect_encounters(
            pings, cfg, order, strategy, clean=first.clean, candidates=first.candidates, scored=scored
        )
        for name, df in (
            ("top", res.top),
            ("trajectories", res.trajectories),
            ("lines", res.lines),
            ("report", res.report),
        ):
            df.write.mode(mode).parquet(f"{output_dir}/{name}")
        res.report.write.mode(mode).json(f"{output_dir}/report_json")
        return {"clean": first.clean.n_rows, "candidates": first.candidates.n_rows, "scored": rows.get["n"]}
