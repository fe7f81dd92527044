"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items form one automaton (every item starts again at the
root, so no match crosses items).  The words of each training text are
streamed through it; the state and the length of the longest match ending at
each word tell which words lie in a window of ``WINDOW`` consecutive item
words (or in a whole item of fewer words), and which items the windows belong
to.  Words outside the items' vocabulary reset the automaton, so runs of
vocabulary words too short to hold any window are skipped at once.

Items are dealt to blocks of at most ``BLOCK_WORDS`` words; a block's
automaton is what is broadcast (a state or two a word, so its size is proven
by that bound).  An item of over half a block is cut into pieces that overlap
by a window less one word, so every window lies in one piece.  Several blocks
are applied one after another, each adding its spans and items to the rows.

Edge cases: null and wordless texts have no words and no hits; items that are
null, wordless or have a null id are ignored; rows of one item_id are parts of
one item; a repeated row of an item adds nothing; repeated documents are judged
alike; extra columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.stages import discard, settle
from tracklens.llm.text import encode, flat_alnum_words, released, slices

WINDOW = 10
BLOCK_WORDS = 200_000
MAX_COVERAGE = 0.8  # a text with a larger hit share is dropped whole

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


class Automaton:
    """Suffix automaton of several word sequences (Blumer et al., extended
    by restarting at the root for every sequence)."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.least = window
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        marks: list[tuple[int, int, int]] = []  # (state, length of a short item, item)
        ends: list[tuple[int, int]] = []
        for name, seq in items:
            if not seq:
                continue
            at = 0
            for w in seq:
                at = self._extend(at, self.vocab.setdefault(w, len(self.vocab)))
                ends.append((at, number[name]))
            if len(seq) < window:
                marks.append((at, len(seq), number[name]))
                self.least = min(self.least, len(seq))
        self._windows(ends, marks)

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _windows(self, ends, marks) -> None:
        """Per state: ``full``, the ancestor-or-self that holds the window-long
        suffix, with its items; ``short``, the short items that end here as
        (length, item), longest first, including the ancestors'."""
        n = len(self.next)
        items: list[set[int]] = [set() for _ in range(n)]
        for state, item in ends:
            items[state].add(item)
        order = sorted(range(1, n), key=self.length.__getitem__, reverse=True)
        for v in order:  # suffixes occur wherever the longer string does; strings below a window need no items
            if self.length[self.link[v]] >= self.window:
                items[self.link[v]] |= items[v]
        own: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for state, size, item in marks:
            own[state].append((size, item))
        # A short item is its end state's longest string or one of its suffixes.
        self.full = [-1] * n
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for v in reversed(order):
            self.short[v] = sorted(set(own[v]) | set(self.short[self.link[v]]), reverse=True)
            if self.length[v] >= self.window:
                self.full[v] = v if self.length[self.link[v]] < self.window else self.full[self.link[v]]
        # items of a window = items of every state below its ``full`` state
        below: dict[int, set[int]] = {}
        for v in order:
            if self.full[v] >= 0:
                below.setdefault(self.full[v], set()).update(items[v])
        self.items = {v: sorted(s) for v, s in below.items()}

    def scan(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """(spans of hit words as [start, end), items, longest match)."""
        nxt, link, length, window, full, short, items = self.next, self.link, self.length, self.window, self.full, self.short, self.items
        v = l = longest = 0
        spans: list[list[int]] = []
        found: set[int] = set()
        done = -1
        for i, c in enumerate(codes):
            to = nxt[v].get(c)
            while to is None and v:
                v = link[v]
                l = length[v]
                to = nxt[v].get(c)
            if to is None:
                l = 0
                continue
            v = to
            l += 1
            if l > longest:
                longest = l
            start = -1
            if l >= window:
                # the match is a suffix of v's longest string; its window suffix lives in full[v]
                start = i + 1 - window
                if full[v] != done:
                    done = full[v]
                    found.update(items[done])
            for size, item in short[v]:
                if size <= l:
                    found.add(item)
                    if start < 0 or i + 1 - size < start:
                        start = i + 1 - size
            if start >= 0:
                if spans and start <= spans[-1][1]:
                    while len(spans) > 1 and start <= spans[-2][1]:
                        spans.pop()
                    spans[-1][0] = min(spans[-1][0], start)
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])
        return [(a, b) for a, b in spans], found, longest


def _scan_part(auto: Automaton, texts: pa.Array):
    """(word count, spans, item names, longest match) of every text."""
    flat, off = flat_alnum_words(texts)
    code, distinct = encode(flat)
    known = np.fromiter((auto.vocab.get(w, -1) for w in distinct.to_pylist()), np.int64, len(distinct))
    ids = known[code] if len(code) else np.zeros(0, np.int64)
    inside = np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])
    inside_at = np.diff(inside)
    start, end = np.flatnonzero(inside_at == 1), np.flatnonzero(inside_at == -1)
    # runs of known words end at document bounds too
    doc = np.searchsorted(off, start, side="right") - 1
    runs: dict[int, list[tuple[int, int]]] = {}
    for d, a, z in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True):
        while a < z:
            stop = min(z, int(off[d + 1]))
            if stop - a >= auto.least:
                runs.setdefault(d, []).append((a, stop))
            a, d = stop, d + 1
    for d in range(len(off) - 1):
        base, spans, found, longest = int(off[d]), [], set(), 0
        for a, z in runs.get(d, ()):
            s, f, l = auto.scan(ids[a:z].tolist())
            spans += [(x + a - base, y + a - base) for x, y in s]
            found |= f
            longest = max(longest, l)
        yield int(off[d + 1] - off[d]), spans, [auto.names[i] for i in sorted(found)], longest


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_pieces(items: DataFrame, window: int, block_words: int) -> DataFrame:
    """name, text, size (in words) of the distinct items, long ones in pieces
    that overlap by ``window`` - 1 words."""
    piece = max(block_words // 2, 2 * window)
    step = piece - (window - 1)
    items = items.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))
    items = items.where("name IS NOT NULL AND text IS NOT NULL").distinct()
    items = items.withColumn("ws", F.filter(F.split("text", _BREAK), lambda w: w != "")).withColumn("size", F.size("ws"))
    short = items.where(F.col("size") <= piece).select("name", "text", "size")
    starts = F.sequence(F.lit(1), F.col("size") - (window - 1), F.lit(step))  # each piece has a window at least
    long = items.where(F.col("size") > piece).select("name", F.explode(F.transform(starts, lambda a: F.slice("ws", a, piece))).alias("ws"))
    return short.unionByName(long.select("name", F.array_join("ws", " ").alias("text"), F.size("ws").alias("size")))


def item_blocks(items: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """(name, text) of all items in lists of at most ``block_words`` words."""
    pieces = settle(item_pieces(items, window, block_words), "items")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(total / (block_words / 2)))  # dealt by hash: half full on average
    block = F.pmod(F.xxhash64("name", "text"), F.lit(blocks))
    for b in range(blocks):
        rows, size = [], 0
        for r in pieces.where(block == b).select("name", "text", "size").collect():
            if rows and size + r["size"] > block_words:  # more than the hash deals on average
                yield rows
                rows, size = [], 0
            rows.append((r["name"], r["text"]))
            size += r["size"]
        if rows:
            yield rows
    discard(pieces)


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>, longest long"


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, finish=None) -> DataFrame:
    """``docs`` (with text) plus n_words, spans (hit words, disjoint), items
    (ids as strings) and longest (longest match in words, inside one piece of
    an item that had to be cut).  ``finish``, a pair of a function and a schema, makes the rows of the result instead from a
    record batch, its word counts and its spans, in the same pass."""
    spark = docs.sparkSession
    own = ["n_words", "spans", "items", "longest"]
    docs = docs.select(*[c for c in docs.columns if c not in own])
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(df: DataFrame, auto, last: bool) -> DataFrame:
        columns = [c for c in df.columns if c not in own]
        later = len(df.columns) > len(columns)

        @released()
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    n, spans, names, longest = zip(*_scan_part(auto.value, part.column("text")), strict=True)
                    if later:
                        spans = [merge_spans([(x["start"], x["end"]) for x in old] + new) for old, new in zip(part.column("spans").to_pylist(), spans, strict=True)]
                        names = [sorted({*old, *new}) for old, new in zip(part.column("items").to_pylist(), names, strict=True)]
                        longest = [max(x) for x in zip(part.column("longest").to_pylist(), longest, strict=True)]
                    if last and finish:
                        yield finish[0](part, n, spans)
                        continue
                    spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type)
                    made = [pa.array(n, pa.int64()), spans, pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *made], [*columns, *own])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        return df.mapInArrow(run, finish[1] if last and finish else f"{kinds}, {_FOUND}")

    out, ahead = docs, item_blocks(items, window, block_words)
    rows = next(ahead, [])
    while rows is not None:
        later = next(ahead, None)
        auto = spark.sparkContext.broadcast(Automaton([(name, words(text)) for name, text in rows], window))
        out = apply(out, auto, later is None)
        if later is not None:
            out = settle(out, "contamination")
        rows = later
    return out


def cut_words(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of the spans (and what stands between them)."""
    if not spans or text is None:
        return text
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join(out) + text[last:]


def remove_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` with the hit spans cut out of text; a text of whose words more
    than ``max_coverage`` are hit is dropped.  Clean rows stay as they are."""
    columns = docs.columns
    inner = [c if c == "text" else f"c{i}" for i, c in enumerate(columns)]  # no clash with the columns of the search

    def cut(part: pa.RecordBatch, n_words, spans) -> pa.RecordBatch:
        texts = part.column("text").to_pylist()
        keep = [sum(b - a for a, b in s) <= max_coverage * n for n, s in zip(n_words, spans, strict=True)]
        texts = [cut_words(t, list(s)) if k else t for t, s, k in zip(texts, spans, keep, strict=True)]
        cols = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in inner]
        return pa.RecordBatch.from_arrays(cols, columns).filter(pa.array(keep, pa.bool_()))

    return find_contamination(docs.toDF(*inner), items, window, finish=(cut, docs.schema))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


ORACLE = rf"""
WITH low AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM low),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS k, array_to_string(ws[p:p + least(len(ws), {WINDOW}) - 1], ' ') AS w
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
grams AS (SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS w
          FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k)),
hits AS MATERIALIZED (SELECT g.doc_id, g.p, g.k, win.item_id FROM grams g JOIN win ON g.w = win.w AND g.k = win.k),
words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(ws) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""
