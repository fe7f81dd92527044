"""Periodic runs of words: every maximal repetition of each text.

A run is a stretch of words with smallest period q (words q apart are equal)
of at least max(``LEAST``, 2 q) words that no neighbour extends.

How (recursive frequency splitting, then a lag scan):

1. Every word of a run occurs at least twice in it.  A word that occurs only
   once in its segment (at first the whole text) can join no run and splits the
   segment; segments of fewer than ``LEAST`` words go.  A segment is split again
   until every word in it occurs twice; one that is stable is set aside, so a
   round only reads segments that changed.  With each word's previous and next
   place, "once in the segment" is two comparisons.
2. The surviving segments are scanned lag by lag, lags q of one binary
   magnitude at a time (only in segments of 2 q words).  A run has at least
   max(q, LEAST - q) consecutive matches at its lag, so some stretch of half as
   many words, starting at a multiple of that half, repeats q words later: only
   places and lags with such a match are looked at.  They are found by sorting
   names of the stretches; the names are exact (pairs of names of half the
   length).  In a segment of m words a magnitude has at most about 2 m of them,
   however periodic the text.
3. A match is extended both ways by doubling steps over the same names.  The
   least lag of a maximal stretch is its period.

Most texts end at step 1; a slice of texts is worked on as one flat array.

Edge cases: null and wordless texts have no words and no run; rows are judged
one by one, so repeated rows and ids repeat their results; a null doc_id is
passed through (and its words are never replaced by ``planted_repeats``); an
empty table gives an empty result; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.text import encode, flat_words, owners, slices

LEAST = 12


def split_segments(code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, past the last) of the segments in which every word occurs at
    least twice; ``code`` names the words of texts that lie between ``off``."""
    n = len(code)
    doc = owners(off)
    order = np.lexsort((np.arange(n), code, doc))
    again = (code[order][1:] == code[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][again]] = order[:-1][again]
    after[order[:-1][again]] = order[1:][again]
    lo, hi = off[:-1], off[1:]
    done_lo, done_hi = [], []
    while True:
        long = hi - lo >= LEAST
        lo, hi = lo[long], hi[long]
        if not len(lo):
            break
        size = hi - lo
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(start[-1]) + np.repeat(lo - start[:-1], size)
        rare = (before[at] < np.repeat(lo, size)) & (after[at] >= np.repeat(hi, size))
        cuts = np.add.reduceat(rare, start[:-1])
        done_lo.append(lo[cuts == 0]), done_hi.append(hi[cuts == 0])
        # the words between one cut (or segment end) and the next
        keep = np.repeat(cuts > 0, size) & ~rare
        at, number = at[keep], np.repeat(np.arange(len(lo)), size)[keep]
        if not len(at):
            break
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(number) != 0)])
        lo = at[new]
        hi = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + 1
    if not done_lo:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = np.concatenate(done_lo), np.concatenate(done_hi)
    order = np.argsort(lo)
    return lo[order], hi[order]


class _Names:
    """Exact names of all stretches of 2^j words; equal names, equal words.
    Past the last length that occurs twice nothing is kept."""

    def __init__(self, code: np.ndarray):
        self.n = len(code)
        self.levels: list[np.ndarray] = []
        self.twice: list[np.ndarray] = []
        name = np.unique(code, return_inverse=True)[1]
        span = 1
        while True:
            twice = np.bincount(name, minlength=1)[name] > 1 if span == 1 else twice_next
            if not twice.any():
                break
            self.levels.append(name), self.twice.append(twice)
            name, twice_next = self.pairs(len(self.levels) - 1, 2 * span)
            span *= 2

    def pairs(self, j: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of all stretches of ``length`` words (2^j to 2^(j+1)), and
        which of them occur twice; the others have names of their own."""
        step, name, twice = length - (1 << j), self.levels[j], self.twice[j]
        out = np.arange(self.n) + self.n
        many = np.zeros(self.n, bool)
        at = np.flatnonzero(twice[: max(self.n - length + 1, 0)])
        at = at[twice[at + step]]
        if len(at):
            _, first, back, count = np.unique(name[at] * (2 * self.n) + name[at + step], return_index=True, return_inverse=True, return_counts=True)
            out[at], many[at] = back, count[back] > 1
            alone = at[count[back] == 1]
            out[alone] = alone + self.n
        return out, many

    def reach(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far the words from x and from y on agree, and before them."""
        right, left = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            name, span = self.levels[j], 1 << j
            to = np.minimum(y + right, self.n - 1)
            right += np.where((y + right < self.n) & (name[np.minimum(x + right, self.n - 1)] == name[to]), span, 0)
            back = x - left - span
            left += np.where((back >= 0) & (name[np.maximum(back, 0)] == name[np.maximum(y - left - span, 0)]), span, 0)
        return right, left


def scan_lags(code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs inside the segments [lo, hi)."""
    size = hi - lo
    start = np.concatenate([[0], np.cumsum(size)])
    segment = np.repeat(np.arange(len(lo)), size)
    at = np.arange(start[-1]) - start[segment] + lo[segment]
    own = np.unique(code[at], return_inverse=True)[1] * max(len(lo), 1) + segment  # words of two segments never match
    names = _Names(own)
    found: list[np.ndarray] = []
    lag = 1
    while len(lo) and (size >= max(LEAST, 2 * lag)).any():
        lags = np.arange(lag, 2 * lag)
        half = (int(np.maximum(lags, LEAST - lags).min()) + 1) // 2
        j = half.bit_length() - 1
        if j >= len(names.levels):
            break
        name, twice = names.pairs(j, half)
        usable = np.flatnonzero(twice & (size >= max(LEAST, 2 * lag))[segment])
        key = np.sort(name[usable] * (2 * names.n) + usable)
        x = usable[usable % half == 0]
        first = np.searchsorted(key, name[x] * (2 * names.n) + x + lag)
        count = np.searchsorted(key, name[x] * (2 * names.n) + x + 2 * lag) - first
        x, first = np.repeat(x, count), np.repeat(first, count)
        y = key[first + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)] % (2 * names.n)
        right, left = names.reach(x, y)
        period = y - x
        length = right + left + period
        ok = length >= np.maximum(LEAST, 2 * period)
        found.append(np.unique(np.stack([(x - left)[ok], length[ok], period[ok]], 1), axis=0))
        lag *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):  # one stretch, several lags: the least is its period
        runs = runs[np.concatenate([[True], (np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0)])]
    return at[runs[:, 0]], runs[:, 1], runs[:, 2]


def _runs(remap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                words, off = flat_words(rows.column("text"), lower=False)
                if remap is not None:
                    words = words.take(pa.array(remap(rows.column("doc_id").to_pylist(), off)))
                code = encode(words)[0].astype(np.int64) if len(words) else np.zeros(0, np.int64)
                start, length, period = scan_lags(code, *split_segments(code, off))
                doc = np.searchsorted(off, start, side="right") - 1
                order = np.lexsort((period, start))
                doc, start, length, period = (v[order] for v in (doc, start, length, period))
                drop = np.zeros(len(words) + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, start + length, -1)
                stays = np.cumsum(drop)[:-1] == 0
                kept_off = np.concatenate([[0], np.cumsum(stays)])[off]
                kept = pc.binary_join(pa.LargeListArray.from_arrays(kept_off, words.filter(pa.array(stays))), " ").cast(pa.string())
                items = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in (start - off[doc], length, period)], ["start", "length", "period"])
                bounds = np.searchsorted(doc, np.arange(len(off))).astype(np.int32)
                cols = [rows.column("doc_id"), pa.array(np.diff(off)), pa.ListArray.from_arrays(pa.array(bounds), items), kept]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, remap=None) -> DataFrame:
    """doc_id, n_words, runs (of start, length, period: word numbers, by start
    and period), collapsed (the words outside every run and those of each
    run's first period, joined by a space) of every row of ``docs`` (doc_id,
    text).  ``remap(doc_ids, offsets)`` may replace words before the search:
    it returns for each flat word the flat number of the one to take."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_runs(remap), schema)


def planted_repeats(doc_ids: list[int | None], off: np.ndarray) -> np.ndarray:
    """Texts of every tenth id (by crc32) end in a repetition of their words."""
    index = np.arange(off[-1])
    for k, d in enumerate(doc_ids):
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        n = int(off[k + 1] - off[k])
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            index[off[k] + a : off[k + 1]] = off[k] + a + np.arange(n - a) % p
    return index


def query(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), planted_repeats)
    line = lambda r: F.concat(*[x for c in ("start", "length", "period") for x in (r[c].cast("string"), F.lit("," if c != "period" else "\n"))])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
