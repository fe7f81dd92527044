"""Suffix-array dedup of byte strings, built by linear grouping.

Every byte covered by a string of ``WIDTH`` bytes that also starts anywhere
else (in another text or the same one) goes.

1. Anchors.  A window of ``WIDTH`` bytes is dealt by its minimizer, the least
   hash of its ``GRAM``-byte strings (leftmost, so the window alone decides).
   Equal texts are one class; classes post their minimizers, and windows whose
   minimizer occurs once cannot repeat.
2. Pieces.  Consecutive windows of one shared minimizer form a piece.  Each
   window lies in one piece; equal pieces are one row with a weight before
   they are grouped.
3. Suffix arrays.  Pieces are bucketed by minimizer (a bucket holds about
   ``BUCKET_BYTES``), so equal windows meet in one bucket and at the same
   distance from their minimizer.  Pieces are read as ``BLOCK``-byte symbols
   counted from the minimizer.  The bucket's suffix array is built as in Baier
   (2016): groups of suffixes by Lyndon prefix are processed in descending
   order along previous-smaller pointers, then each group's order is emitted;
   nothing is renamed recursively.  Neighbours that share all whole symbols of
   a window and its remaining ``BLOCK`` bytes are equal windows.
4. Minimizers whose distinct pieces exceed ``BUCKET_BYTES`` (a passage in a
   third of all texts, each time in other surroundings) are split: their pieces
   are cut into single windows, counted by 128-bit digest; those rows are
   linear in the pieces and need no common task.
5. The repeated windows of a piece all hold its minimizer, so they cover one
   range; ranges go back to the texts by their digest.

Equal texts of at least ``WIDTH`` bytes are repeats of each other as a whole.

Edge cases: null texts are empty; shorter texts keep all bytes; repeated rows
are texts of their own and remove each other; doc_id is only passed through
(null and repeated ids do no harm); texts over ``PART_BYTES`` are read in
overlapping parts; an empty table gives an empty result; other columns of the
input are ignored.  Texts and pieces are identified by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.stages import discard, settle
from tracklens.llm.text import as_long, mix, slices

WIDTH = 200
GRAM = 48  # a multiple of BLOCK
BLOCK = 8
BUCKET_BYTES = 1 << 20
PART_BYTES = 4 << 20  # below 2^24: a place in a part takes 24 bits beside the hash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # masks of the first k of eight bytes


def _eight(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place (zeros past the end) as one number."""
    padded = np.concatenate([raw, np.zeros(BLOCK, np.uint8)])
    return np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (ints; the last is the unique smallest)."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(text[order]) != 0]))
    start = np.repeat(first, np.diff(np.append(first, n)))
    place, group = np.empty(n, np.int64), np.empty(n, np.int64)
    place[order], group[order] = np.arange(n), start
    sizes = np.zeros(n, np.int64)
    sizes[first] = np.diff(np.append(first, n))
    sa, at, group, size = order.tolist(), place.tolist(), group.tolist(), sizes.tolist()
    smaller = [-1] * n  # previous suffix of a lower group; -1 reads the sentinel's entry, which is lowest
    high = n - 1
    while high > 0:  # groups in descending order
        g = group[sa[high]]
        if g == high:  # one suffix; its predecessor's word grows
            s = sa[g]
            p = s - 1
            while group[p] > g:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                old = group[p]
                left = size[old]
                if left > 1:
                    end = old + left - 1
                    a, q = at[p], sa[end]
                    sa[a], sa[end], at[q], at[p] = q, p, a, end
                    size[old], size[end], group[p] = left - 1, 1, end
            high = g - 1
            continue
        runs: dict[int, int] = {}
        for s in sorted(sa[g : high + 1]):
            p = s - 1
            while group[p] > g:
                p = smaller[p]
            if group[p] == g:  # the same Lyndon word right before: its predecessor is ours
                p = smaller[p]
            smaller[s] = p
            runs[p] = runs.get(p, 0) + 1
        runs.pop(-1, None)
        counts = set(runs.values())
        if len(counts) == 1:
            batches = (runs,)
        else:
            batches = [[p for p, k in runs.items() if k == c] for c in sorted(counts, reverse=True)]
        for batch in batches:  # predecessors whose word grows by k copies leave to the top of their group
            moved: dict[int, int] = {}
            for p in batch:
                old = group[p]
                left = size[old]
                end = old + left - 1
                a, q = at[p], sa[end]
                sa[a], sa[end], at[q], at[p] = q, p, a, end
                size[old] = left - 1
                moved[old] = moved.get(old, 0) + 1
            for old, k in moved.items():
                new = old + size[old]
                size[new] = k
                for i in range(new, new + k):
                    group[sa[i]] = new
        high = g - 1
    out, done = [n - 1] * n, [False] * n
    done[n - 1] = True
    slot = list(range(n))
    for i in range(n):
        j = out[i] - 1
        while not done[j]:
            g = group[j]
            out[slot[g]] = j
            slot[g] += 1
            done[j] = True
            j = smaller[j]
    return np.array(out, np.int64)


def _parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, rows, bases): stretches of the texts to be read at
    once; a text over ``PART_BYTES`` comes in parts that share the bytes of
    the windows between them."""
    texts = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
    _, where, data = texts.buffers()
    off = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    for i, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        if z - a > PART_BYTES:
            for b in range(a, z - WIDTH + 1, PART_BYTES):
                e = min(b + PART_BYTES + WIDTH - 1, z)
                yield raw[b:e], np.array([0, e - b]), np.array([i]), np.array([b - a])
    rows = np.flatnonzero((np.diff(off) >= WIDTH) & (np.diff(off) <= PART_BYTES))
    size = np.cumsum(np.diff(off)[rows])
    for k in range(int(size[-1] // PART_BYTES) + 1 if len(rows) else 0):
        some = rows[size // PART_BYTES == k]
        if len(some):
            bounds = np.concatenate([[0], np.cumsum(np.diff(off)[some])])
            yield np.concatenate([raw[off[i] : off[i + 1]] for i in some.tolist()]), bounds, some, np.zeros(len(some), np.int64)


def pieces(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one minimizer: text, first window,
    number of windows, place of the minimizer, its hash."""
    eight = _eight(raw)
    n = len(raw) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for j in range(0, GRAM, BLOCK):
        h = h * _ODD + mix(eight[j : j + n]) if j == 0 else (h ^ (h >> np.uint64(29))) * _ODD + eight[j : j + n]
    h = mix(h)
    low = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    span, need = 1, WIDTH - GRAM + 1
    while span < need:
        step = min(span, need - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    last = np.repeat(off[1:], np.diff(off))[: len(low)] - WIDTH  # last window of the text around
    fits = np.arange(len(low)) <= last
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | ~fits[:-1]
    first = np.flatnonzero(new & fits)
    stops = np.append(np.flatnonzero(new | ~fits), len(low))
    end = stops[np.searchsorted(stops, first, side="right")]
    place = (low[first] & _PLACE).astype(np.int64)
    return np.searchsorted(off, first, side="right") - 1, first, end - first, place, h[place]


def _posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's minimizers, a value that occurs again in it twice."""
    for batch in batches:
        for rows in slices(batch):
            found: dict[int, list[np.ndarray]] = {}
            for raw, off, row, _ in _parts(rows.column("text")):
                doc, _, _, _, h = pieces(raw, off)
                for i, hashes in zip(row.tolist(), np.split(h, np.searchsorted(doc, np.arange(1, len(row)))), strict=True):
                    found.setdefault(i, []).append(hashes)
            anchors = []
            for i in range(rows.num_rows):
                value, n = np.unique(np.concatenate(found[i]), return_counts=True) if i in found else (np.zeros(0, np.uint64), np.zeros(0, int))
                anchors.append(as_long(np.repeat(value, np.minimum(n, 2))))
            cols = [rows.column(c) for c in ("digest", "rid")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(anchors, pa.list_(pa.int64()))], ["digest", "rid", "anchors"])


_PIECE = "digest string, weight long, anchor long, piece_id binary, lead int, start long, windows int, bytes binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces over shared minimizers; a slice ships the bytes of equal
    pieces once."""
    for batch in batches:
        for rows in slices(batch):
            sent: set[bytes] = set()
            out: list[list] = [[] for _ in range(8)]
            digest, weight, anchors = rows.column("digest").to_pylist(), rows.column("weight").to_pylist(), rows.column("anchors")
            for raw, off, row, base in _parts(rows.column("text")):
                doc, first, count, place, h = pieces(raw, off)
                h = as_long(h)
                for k, i in enumerate(row.tolist()):
                    a, z = np.searchsorted(doc, [k, k + 1])
                    for p in (np.flatnonzero(np.isin(h[a:z], anchors[i].values.to_numpy())) + a).tolist():
                        s, n, lead = int(first[p]), int(count[p]), int(place[p] - first[p])
                        data = raw[s : s + n + WIDTH - 1].tobytes()
                        name = hashlib.blake2b(data, digest_size=16, salt=lead.to_bytes(2, "little")).digest()
                        row_out = (digest[i], weight[i], int(h[p]), name, lead, s - int(off[k]) + int(base[k]), n, None if name in sent else data)
                        sent.add(name)
                        for col, v in zip(out, row_out, strict=True):
                            col.append(v)
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], [c.split()[0] for c in _PIECE.split(", ")])


def repeated_windows(data: list[bytes], lead: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pieces of one bucket: (piece, first, last repeated window)."""
    size = np.array([len(d) for d in data], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    raw = np.frombuffer(b"".join(data), np.uint8)
    eight = _eight(raw)
    skew = lead % BLOCK
    blocks = (size - skew) // BLOCK
    head = np.concatenate([[0], np.cumsum(blocks + 1)])  # first symbol of each piece, a separator after its last
    owner = np.repeat(np.arange(len(data)), blocks + 1)
    nth = np.arange(head[-1]) - head[owner]
    inside = nth < blocks[owner]
    symbol = np.ones(head[-1] + 1, np.int64)
    symbol[-1] = 0
    symbol[:-1][inside] = np.unique(eight[(begin + skew)[owner[inside]] + BLOCK * nth[inside]], return_inverse=True)[1] + 2
    sa = suffix_array(symbol)
    # stretches of the suffix array whose suffixes share the whole symbols of a window
    whole = WIDTH // BLOCK - 1
    left = np.append(np.where(inside, blocks[owner] - nth, 0), 0)
    padded = np.concatenate([symbol, np.full(whole, -1)])
    same = (left[sa[1:]] >= whole) & (left[sa[:-1]] >= whole)
    for t in range(whole):
        i = np.flatnonzero(same)
        same[i] = padded[sa[i] + t] == padded[sa[i + 1] + t]
    stretch = np.empty(len(sa), np.int64)
    stretch[sa] = np.concatenate([[0], np.cumsum(~same)])
    # windows: the symbols from the first whole one on, and the bytes before and after them
    n = size - WIDTH + 1
    piece = np.repeat(np.arange(len(data)), n)
    s = np.arange(len(piece)) - np.concatenate([[0], np.cumsum(n)])[:-1][piece]
    block = -((skew[piece] - s) // BLOCK)  # of the first whole symbol
    before = skew[piece] + BLOCK * block - s
    group = stretch[head[piece] + block]
    load = np.bincount(stretch, minlength=len(sa))[group]  # suffixes that could be partners
    keep = (load > 1) | (weight[piece] > 1)
    piece, s, before, group = piece[keep], s[keep], before[keep], group[keep]
    place = begin[piece] + s
    rest = (eight[place] & _LOW[before]) | ((eight[place + before + BLOCK * whole] & _LOW[BLOCK - before]) << (8 * before % 64).astype(np.uint64))
    key = group * BLOCK + before
    order = np.lexsort((rest, key))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(key[order]) != 0) | (rest[order][1:] != rest[order][:-1])
    total = np.bincount(np.cumsum(new) - 1, weights=weight[piece[order]]) if len(order) else np.zeros(0)
    again = order[total[np.cumsum(new) - 1] > 1] if len(order) else order
    piece, s = piece[again], s[again]
    lo, hi = np.full(len(data), np.iinfo(np.int64).max), np.full(len(data), -1)
    np.minimum.at(lo, piece, s)
    np.maximum.at(hi, piece, s)
    some = np.flatnonzero(hi >= 0)
    return some, lo[some], hi[some]


def _bucket(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    lead, weight = (table.column(c).to_numpy().astype(np.int64) for c in ("lead", "weight"))
    some, lo, hi = repeated_windows(table.column("bytes").to_pylist(), lead, weight)
    ids = [table.column(c).take(pa.array(some)) for c in ("anchor", "piece_id")]
    return pa.table([*ids, pa.array(lo), pa.array(hi)], ["anchor", "piece_id", "lo", "hi"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the pieces, one by one."""
    for batch in batches:
        for rows in slices(batch, "bytes", PART_BYTES >> 4):
            out: list[list] = [[] for _ in range(5)]
            for anchor, name, weight, data in zip(*[rows.column(c).to_pylist() for c in ("anchor", "piece_id", "weight", "bytes")], strict=True):
                n = len(data) - WIDTH + 1
                out[0] += [anchor] * n
                out[1] += [name] * n
                out[2] += [weight] * n
                out[3] += range(n)
                out[4] += [hashlib.blake2b(data[s : s + WIDTH], digest_size=16).digest() for s in range(n)]
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["anchor", "piece_id", "weight", "s", "window"])


def _digest(text: Column) -> Column:
    return F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def repeated_ranges(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """digest (md5 of the text), ranges (of start, end: bytes to remove, not
    yet merged), one row for each distinct text that loses any."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("rid"), F.col("text").cast("string").alias("text"))
    docs = docs.where(F.octet_length("text") >= WIDTH).withColumn("digest", _digest(F.col("text")))
    posts = settle(docs.mapInArrow(_posts, "digest string, rid long, anchors array<long>"), "posts")
    classes = posts.groupBy("digest").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies"), F.first("anchors").alias("anchors"))
    classes = settle(classes, "classes")
    discard(posts)
    # 1: shared minimizers
    anchors = classes.select("digest", F.explode("anchors").alias("anchor"))
    common = settle(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    shared = anchors.join(common, "anchor", "left_semi").groupBy("digest").agg(F.collect_set("anchor").alias("anchors"))  # at most the text's own
    weight = F.when(F.col("copies") > 1, 2).otherwise(1).cast("long").alias("weight")
    wanted = settle(shared.join(classes.select("digest", "rid", weight), "digest"), "wanted")
    # 2: pieces; a text with copies is gone as a whole, its pieces only stand against others
    texts = docs.join(wanted, ["digest", "rid"]).select("digest", "weight", "anchors", "text")
    found = settle(texts.mapInArrow(_pieces, _PIECE), "pieces")
    discard(common, wanted)
    once = found.groupBy("anchor", "piece_id").agg(F.sum("weight").alias("weight"), F.first("lead").alias("lead"), F.max("bytes").alias("bytes"))
    once = settle(once, "distinct_pieces")
    # 3: buckets
    per_anchor = once.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size"))
    total = per_anchor.agg(F.sum(F.when(F.col("size") <= bucket_bytes, F.col("size")))).first()[0] or 0
    hot = settle(per_anchor.where(F.col("size") > bucket_bytes).select("anchor"), "hot_anchors")
    buckets = max(1, -(-total // bucket_bytes))
    calm = once.join(hot, "anchor", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    result = "anchor long, piece_id binary, lo long, hi long"
    spans = calm.select("bucket", "anchor", "piece_id", "weight", "lead", "bytes").groupBy("bucket").applyInArrow(_bucket, result)
    # 4: minimizers beyond a bucket
    windows = once.join(hot, "anchor", "left_semi").mapInArrow(_windows, "anchor long, piece_id binary, weight long, s long, window binary")
    windows = settle(windows, "hot_windows")
    again = windows.groupBy("window").agg(F.sum("weight").alias("n")).where("n > 1").select("window")
    beyond = windows.join(again, "window", "left_semi").groupBy("anchor", "piece_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    spans = settle(spans.unionByName(beyond), "spans")
    # 5: back to the texts
    alone = found.where("weight = 1").select("digest", "anchor", "piece_id", "start").join(spans, ["anchor", "piece_id"])
    ranges = alone.select("digest", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi") + WIDTH).alias("end"))
    ranges = ranges.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))  # at most one for each piece of the text
    copies = classes.where("copies > 1").select("digest", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit((1 << 62)).cast("long").alias("end"))).alias("ranges"))
    ranges = settle(ranges.unionByName(copies), "ranges")
    discard(classes, found, once, hot, windows, spans)
    return ranges


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal ranges that the given ones cover."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            out: list[list] = [[] for _ in range(4)]
            for text, ranges in zip(rows.column("text"), rows.column("ranges"), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                kept, removed, spans = data, 0, 0
                if ranges.is_valid:
                    lo, hi = merge(*[ranges.values.field(c).to_numpy() for c in ("start", "end")])
                    hi = np.minimum(hi, len(data))
                    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                    removed, spans = len(data) - len(kept), len(lo)
                for col, v in zip(out, (len(data), removed, spans, kept), strict=True):
                    col.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes; a cut
    may fall inside a character) of every row of ``docs`` (doc_id, text)."""
    ranges = repeated_ranges(docs.select("doc_id", "text"), bucket_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("digest", _digest(F.col("text"))).join(ranges, "digest", "left")
    return rows.select("doc_id", "text", "ranges").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    cut = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
