"""Substring dedup on a compacted de Bruijn graph of repeated word windows.

A window of ``K`` = 13 words is an edge from its first 12 words to its last
12; only windows that start in at least two documents become edges.

1. Anchors.  The minimizer of a window (the least hash of its 9 five-word
   grams) depends on its words alone, so windows whose minimizer occurs in one
   document only cannot repeat.  Documents post distinct minimizers (about a
   fifth of their windows) instead of windows; equal texts post once.
2. Edges.  The windows over shared minimizers are counted; an edge keeps its
   source coordinates, the first occurrence in the smallest doc_id.
3. Compaction.  Edges that follow each other in one source document, with no
   branch between, form a piece; pieces that meet in a vertex with one way in
   and one way out are joined, and the connected pieces are a path (unitig).
   Only pieces, not edges, take part in the iterative joins.
4. Spans.  A document's occurrences that run along one path beside one source
   form a span.  Both coordinates of every span are read back and compared by
   a digest of the words; a span that differs (a hash collision) is taken
   apart and its windows are compared one by one.
5. The words under a verified span whose source has a smaller doc_id go.

Equal texts are settled before the graph: all but those of the smallest
doc_id are repeats as a whole (if they hold a window at all).

Edge cases: null and wordless texts have no words; a row with a null doc_id
keeps its words and is no source; rows of one doc_id never remove words from
each other, and each is judged by its own text; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.stages import components, discard, settle
from tracklens.llm.text import as_long, flat_words, hash_words, mix, owners, released, slices, window_hashes

K = 13
GRAM = 5
DIGESTS = ((101, 0x9E3779B97F4A7C15), (202, 0xC2B2AE3D27D4EB4F))  # (seed, odd base) of the span comparison
WORD = re.compile(r"[^\x20\x09-\x0D]+")


class _Part:
    """Words, hashes and signatures of one slice of texts."""

    def __init__(self, texts: pa.Array):
        self.words, self.off = flat_words(texts, lower=False)
        self.h = hash_words(self.words)

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each document's word sequence."""
        place = (np.arange(len(self.h)) - self.off[:-1][owners(self.off)]).astype(np.uint64)
        m = mix(self.h + place * np.uint64(0x9E3779B97F4A7C15))
        total = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        a, b = total(m), total(mix(m ^ np.uint64(0xD6E8FEB86659FD93)))
        return as_long(a[self.off[1:]] - a[self.off[:-1]]), as_long(b[self.off[1:]] - b[self.off[:-1]])

    def minimizers(self, k: int) -> np.ndarray:
        """Of the window that starts at each word (only ``bounds`` are valid)."""
        g = window_hashes(self.h, GRAM)
        n = len(self.h) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        low = g[:n].copy()
        for j in range(1, k - GRAM + 1):
            np.minimum(low, g[j : j + n], out=low)
        return low

    def bounds(self, k: int):
        """(document, first window, past the last window)"""
        for i, (a, z) in enumerate(zip(self.off[:-1].tolist(), self.off[1:].tolist(), strict=True)):
            if z - a >= k:
                yield i, a, z - k + 1


def _posts(k: int):
    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = _Part(rows.column("text"))
                low, (sa, sb) = as_long(part.minimizers(k)), part.signatures()
                anchors: list = [None] * rows.num_rows
                for i, a, z in part.bounds(k):
                    anchors[i] = np.unique(low[a:z])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("h"), pa.array(np.diff(part.off)), pa.array(sa), pa.array(sb), pa.array(anchors, pa.list_(pa.int64()))],
                    ["doc_id", "h", "n_words", "sig_a", "sig_b", "anchors"],
                )

    return run


def _own(rows: pa.RecordBatch, part: _Part) -> np.ndarray:
    """Rows whose text is the one their class was made from."""
    sa, sb = part.signatures()
    return (rows.column("sig_a").to_numpy() == sa) & (rows.column("sig_b").to_numpy() == sb)


def _occurrences(k: int):
    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = _Part(rows.column("text"))
                low, vertex, own = as_long(part.minimizers(k)), as_long(window_hashes(part.h, k - 1)), _own(rows, part)
                anchors = rows.column("anchors")
                at, row = [], []
                for i, a, z in part.bounds(k):
                    if own[i]:
                        hit = np.flatnonzero(np.isin(low[a:z], anchors[i].values.to_numpy()))
                        at.append(hit + a)
                        row.append(np.full(len(hit), i))
                at, row = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, row))
                cls, doc = rows.column("cls").to_numpy()[row], rows.column("doc").to_numpy()[row]
                cols = [vertex[at], vertex[at + 1], doc, cls, at - part.off[:-1][row]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["v_in", "v_out", "doc", "cls", "pos"])

    return run


def range_digests(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """One 64-bit hash of each range of word hashes, from running sums (the
    odd base has an inverse modulo 2^64)."""
    power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(hashes), base, np.uint64))])
    inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(hashes), pow(base, -1, 1 << 64), np.uint64))])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1], dtype=np.uint64)])
    return mix((total[end] - total[start]) * inverse[start])


def _digests(k: int):
    """128 bits of every wanted range, from word hashes of other seeds than
    the graph's.  The starts of one claim whose words have one digest stay one
    row, however often a text repeats itself."""

    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = _Part(rows.column("text"))
                rows, first = rows.filter(own := pa.array(_own(rows, part))), part.off[:-1][own.to_numpy(zero_copy_only=False)]
                sizes = pc.list_value_length(rows.column("ranges")).to_numpy(zero_copy_only=False).astype(np.int64)
                claims = rows.column("ranges").flatten()
                row, count = np.repeat(np.arange(rows.num_rows), sizes), pc.list_value_length(claims.field("starts")).to_numpy(zero_copy_only=False).astype(np.int64)
                claim, start = np.repeat(np.arange(len(claims)), count), claims.field("starts").flatten().to_numpy()
                a = first[row][claim] + start
                z = a + claims.field("n").to_numpy()[claim] + k - 1
                da, db = (as_long(range_digests(hash_words(part.words, seed), a, z, base)) for seed, base in DIGESTS)
                order = np.lexsort((start, db, da, claim))
                claim, start, da, db = claim[order], start[order], da[order], db[order]
                new = np.ones(len(claim), bool)
                new[1:] = (claim[1:] != claim[:-1]) | (da[1:] != da[:-1]) | (db[1:] != db[:-1])
                at = np.flatnonzero(new)
                starts = pa.ListArray.from_arrays(pa.array(np.append(at, len(claim)), pa.int32()), pa.array(start))
                of = claim[at]
                cols = [rows.column(c).to_numpy()[row[of]] for c in ("cls", "doc")] + [claims.field(c).to_numpy()[of] for c in ("o_cls", "o_start", "n")]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), starts, pa.array(da[at]), pa.array(db[at])], ["cls", "doc", "o_cls", "o_start", "n", "starts", "da", "db"])

    return run


def _islands(rows: DataFrame, group: str, pos: str, same: list[str]) -> DataFrame:
    """Number (``run``) the stretches of consecutive ``pos`` in each group over
    which the columns ``same`` stay as they are; a true ``cut`` starts anew.
    A group is one document's windows."""
    w = Window.partitionBy(group).orderBy(pos)
    goes_on = F.col(pos) == F.lag(pos).over(w) + 1
    for c in same:
        goes_on = goes_on & F.col(c).eqNullSafe(F.lag(c).over(w))
    new = F.when(goes_on & ~F.coalesce(F.col("cut"), F.lit(False)), 0).otherwise(1)
    return rows.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def compact(edges: DataFrame) -> DataFrame:
    """``edges`` (v_in, v_out, o_doc, o_cls, o_pos) plus path: the nonbranching
    path each edge lies on."""
    forks = edges.groupBy(F.col("v_in").alias("v")).count().where("count > 1").select("v")
    forks = settle(forks.union(edges.groupBy(F.col("v_out").alias("v")).count().where("count > 1").select("v")).distinct().withColumn("cut", F.lit(True)), "forks")
    marked = edges.join(forks.withColumnRenamed("v", "v_in"), "v_in", "left")
    runs = settle(_islands(marked, "o_cls", "o_pos", []).drop("cut"), "runs")
    ends = runs.groupBy("o_cls", "run").agg(F.min_by("v_in", "o_pos").alias("first"), F.max_by("v_out", "o_pos").alias("last"))
    pieces = settle(ends.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    meet = pieces.select(F.col("piece").alias("a"), F.col("last").alias("v")).join(pieces.select(F.col("piece").alias("b"), F.col("first").alias("v")), "v")
    comp = components(meet.join(forks.select("v"), "v", "left_anti").select("a", "b"), "paths")
    paths = pieces.select("o_cls", "run", "piece").join(comp.withColumnRenamed("node", "piece"), "piece", "left").select("o_cls", "run", F.coalesce("comp", "piece").alias("path"))
    out = settle(runs.join(paths, ["o_cls", "run"]).drop("run"), "edges")
    discard(forks, runs, pieces)
    return out


def _agreeing(spans: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Spans split into those whose words equal their source's and the rest.
    All spans of a text over one stretch of a source are one row with their
    ``starts`` (a text that repeats two words has one for every repetition)."""
    claim = ["cls", "o_cls", "o_start", "n"]
    own = spans.groupBy(*claim).agg(F.collect_list("start").alias("starts"))  # at most the text's own windows
    sources = spans.select(F.col("o_cls").alias("cls"), *claim[1:]).distinct().withColumn("starts", F.array("o_start"))
    wanted = own.unionByName(sources).groupBy("cls").agg(F.collect_list(F.struct(*claim[1:], "starts")).alias("ranges")).join(classes, "cls")
    on = [c for c in ("doc_id", "h") if c in docs.columns]
    texts = docs.join(wanted.withColumnRenamed("doc", "doc_id"), on).select("cls", F.col("doc_id").alias("doc"), "sig_a", "sig_b", "ranges", "text")
    dig = settle(texts.mapInArrow(_digests(k), "cls long, doc long, o_cls long, o_start long, n long, starts array<long>, da long, db long").distinct(), "digests")
    there = dig.where("cls = o_cls").select(*claim[1:], F.col("da").alias("oa"), F.col("db").alias("ob"))  # no span has its own text as source
    both = dig.where("cls <> o_cls").join(there, claim[1:]).withColumn("ok", F.expr("da = oa AND db = ob"))
    both = settle(both.drop("da", "db", "oa", "ob"), "compared")
    discard(dig)
    return both.where("ok").drop("ok"), both.where("NOT ok").drop("ok")


def repeated_ranges(docs: DataFrame, k: int = K) -> DataFrame:
    """The word ranges to remove: doc_id, h (the text's hash), ranges (of
    sig_a, sig_b, start, end; a range counts for a text with that signature)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))
    sig = settle(docs.mapInArrow(_posts(k), "doc_id long, h long, n_words long, sig_a long, sig_b long, anchors array<long>"), "posts")
    fit = sig.where((F.col("n_words") >= k) & F.col("doc_id").isNotNull())
    classes = fit.groupBy("sig_a", "sig_b", "n_words").agg(F.min(F.struct("doc_id", "h")).alias("s"), F.first("anchors").alias("anchors"))
    classes = classes.select("sig_a", "sig_b", "n_words", F.col("s.doc_id").alias("doc"), F.col("s.h").alias("h"), "anchors")
    classes = settle(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    names = classes.select("cls", "doc", "h", "sig_a", "sig_b")
    copies = fit.select("doc_id", "h", "sig_a", "sig_b", "n_words").join(names.drop("h"), ["sig_a", "sig_b"]).where("doc_id > doc")
    copies = copies.select("doc_id", "h", "sig_a", "sig_b", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
    copies = settle(copies.distinct(), "copies")  # a repeated row needs no range of its own
    discard(sig)
    # 1: shared minimizers
    posts = classes.select("cls", "doc", F.explode("anchors").alias("anchor"))
    common = posts.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor")
    common = settle(common, "anchors")
    wanted = posts.join(common, "anchor", "left_semi").groupBy("cls").agg(F.collect_list("anchor").alias("anchors"))  # at most the document's own
    wanted = settle(wanted.join(names, "cls"), "wanted")
    names = settle(names, "names")
    discard(classes, common)
    # 2: edges
    texts = docs.join(wanted.withColumn("doc_id", F.col("doc")), ["doc_id", "h"]).select("cls", "doc", "sig_a", "sig_b", "anchors", "text")
    seen = settle(texts.mapInArrow(_occurrences(k), "v_in long, v_out long, doc long, cls long, pos long"), "windows")
    discard(wanted)
    edges = seen.groupBy("v_in", "v_out").agg(F.min(F.struct("doc", "cls", "pos")).alias("o"), F.max("doc").alias("hi")).where("o.doc < hi")
    edges = settle(edges.select("v_in", "v_out", F.col("o.doc").alias("o_doc"), F.col("o.cls").alias("o_cls"), F.col("o.pos").alias("o_pos")), "repeated")
    # 3, 4: paths, spans
    paths = compact(edges)
    discard(edges)
    along = seen.join(paths, ["v_in", "v_out"]).where("o_doc < doc").select("cls", "doc", "pos", "path", "o_cls", "o_doc", "o_pos", (F.col("o_pos") - F.col("pos")).alias("shift"))
    along = _islands(along.distinct().withColumn("cut", F.lit(None).cast("boolean")), "cls", "pos", ["path", "o_cls", "shift"])
    spans = along.groupBy("cls", "doc", "o_cls", "run").agg(F.min("pos").alias("start"), F.min("o_pos").alias("o_start"), F.count(F.lit(1)).alias("n"))
    spans = settle(spans.drop("run"), "spans")
    discard(seen, paths)
    good, bad = _agreeing(spans, names, docs, k)
    discard(spans)
    if not bad.isEmpty():  # single windows of spans that differ somewhere
        step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
        single = bad.withColumn("start", F.explode("starts")).withColumn("i", step).select("cls", "doc", "o_cls", (F.col("start") + F.col("i")).alias("start"), (F.col("o_start") + F.col("i")).alias("o_start"), F.lit(1).cast("long").alias("n"))
        good = good.unionByName(_agreeing(settle(single, "single"), names, docs, k)[0])
    # 5: ranges by text
    own = ["sig_a", "sig_b"]
    span = lambda s: F.struct(*own, s.alias("start"), (s + F.col("n") + k - 1).alias("end"))
    found = good.join(names.select("cls", "h", *own), "cls").select(F.col("doc").alias("doc_id"), "h", F.transform("starts", span).alias("ranges"))
    whole = copies.select("doc_id", "h", F.array(F.struct(*own, "start", "end")).alias("ranges"))
    ranges = found.unionByName(whole).groupBy("doc_id", "h").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    ranges = settle(ranges, "ranges")
    discard(copies, names)
    return ranges


def _covered(ranges: list[dict] | None, sig: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Disjoint word ranges of the text with this signature, in order."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], min(r["end"], n)) for r in ranges or () if (r["sig_a"], r["sig_b"]) == sig):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_ranges(docs: DataFrame, k: int) -> DataFrame:
    ranges = repeated_ranges(docs.select("doc_id", "text"), k).withColumnsRenamed({"ranges": "_ranges", "h": "_h"})
    return docs.withColumn("_h", F.xxhash64(F.col("text").cast("string"))).join(ranges, ["doc_id", "_h"], "left")


def digest_kept(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``."""

    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = _Part(rows.column("text"))
                sa, sb = part.signatures()
                ranges, stays = rows.column("_ranges"), np.ones(len(part.words), bool)
                for i in np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    at = int(part.off[i])
                    for a, b in _covered(ranges[i].as_py(), (int(sa[i]), int(sb[i])), int(part.off[i + 1]) - at):
                        stays[at + a : at + b] = False
                off = np.concatenate([[0], np.cumsum(stays)])[part.off]
                kept = pc.binary_join(pa.LargeListArray.from_arrays(off, part.words.filter(pa.array(stays))), " ")
                digest = [hashlib.sha256(x).hexdigest() for x in kept.cast(pa.large_binary()).to_pylist()]
                n = np.diff(part.off)
                cols = [rows.column("doc_id"), pa.array(n), pa.array(n - np.diff(off)), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, k: int = K) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with the repeated spans cut
    out of text; untouched rows stay as they are, rows of which no word is
    left go."""
    columns = docs.columns
    inner = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(columns)]

    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = _Part(rows.column("text"))
                sa, sb = part.signatures()
                ranges, texts, keep = rows.column("_ranges"), rows.column("text").to_pylist(), []
                for i, text in enumerate(texts):
                    n = int(part.off[i + 1] - part.off[i])
                    cut = _covered(ranges[i].as_py(), (int(sa[i]), int(sb[i])), n) if ranges[i].is_valid else []
                    keep.append(not cut or sum(b - a for a, b in cut) < n)
                    if cut and keep[-1]:
                        at = [m.span() for m in WORD.finditer(text)]
                        out, last = [], 0
                        for a, b in cut:
                            out.append(text[last : at[a][0]])
                            last = at[b - 1][1]
                        texts[i] = ("".join(out) + text[last:]).strip("\x20\t\n\v\f\r")
                cols = [pa.array(texts, pa.string()) if c == "text" else rows.column(c) for c in inner]
                yield pa.RecordBatch.from_arrays(cols, columns).filter(pa.array(keep))

    joined = _with_ranges(docs.toDF(*inner), k)
    return joined.select(*inner, "_ranges").mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return digest_kept(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS MATERIALIZED (SELECT doc_id, p, array_to_string(ws[p:p + {K - 1}], ' ') AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {K - 2})) AS p FROM d WHERE len(ws) >= {K})),
f AS (SELECT t, min(doc_id) AS first FROM w GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {K})) AS q FROM w JOIN f ON w.t = f.t WHERE f.first < w.doc_id),
g AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY q) AS t FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.q = gone.q GROUP BY 1)
SELECT d.doc_id, len(ws) AS n_words, coalesce(len(qs), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
