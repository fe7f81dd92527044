"""Packing by cutting-stock column generation.

Documents become token ids (a public tokenizer, plus an end id) and are cut
into full sequences and a rest.  The histogram of the pieces' lengths, in
classes of ``GRAIN`` tokens, is all that the driver sees; its size is bounded
by the sequence length, not by the corpus.  A linear program chooses how often
each pattern (a multiset of classes that fits one sequence) is used; new
patterns are priced by a knapsack over the dual values until none improves.
Rounded down, the patterns cover all but a bounded remainder, which first-fit
decreasing places.  Pieces are then ranked within their class and each rank
looks up its pattern copy: an equi-join with the plan, no piece meets another
before the sequences are formed.

Edge cases: a null or empty text has the end id only; rows with a null doc_id
and repeated rows are packed like others; an empty table gives no sequences;
extra columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.stages import dense_rank_from_zero, settle
from tracklens.llm.text import encode, flat_words, released, slices

LENGTH = 4096
GRAIN = 8
END = 2
VOCABULARY = "word_bpe_49k.json"
GAP = 1e-3  # column generation stops within this share of the LP's optimum
RANK_ROWS = 50_000
CACHED_WORDS = 250_000  # per Python worker, before the next slice adds its own
TOKEN_BYTES = 1 << 20  # of text at a time: the arrays of its words and ids are tens of times as large
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation but the apostrophe, which may start a suffix
SPLITTABLE = r"[0-9a-z\x{df}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]$"  # ends in a Latin letter (but U+0130, which lowers to a letter and a mark) or digit
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
# A byte-level model spells a byte as the character of that number, or, for the bytes that
# have no visible one (0-32, 127-160, 173), as the next character from number 256 on.
_UNSEEN = [b for b in range(256) if b < 33 or 127 <= b <= 160 or b == 173]
BYTE_LETTERS = [chr(256 + _UNSEEN.index(b)) if b in _UNSEEN else chr(b) for b in range(256)]


class WordIds:
    """Token ids of white-space separated words, with a bounded cache.

    The vocabulary's tokens never reach over white space, nor from a letter or
    digit into the punctuation after it, so a text's ids are those of its
    words, and a word's are those of its stem and of the ``TAIL`` behind it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self._clear()

    def _clear(self) -> None:
        self.pieces: dict[str, int] = {"": 0}  # piece -> its place in start
        self.start, self.flat = np.zeros(2, np.int64), np.zeros(0, np.uint32)

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece; words of lower-case Latin letters, which the
        normaliser and the splitter leave as they are, go to the merge model at
        once (as bytes in the model's letters), the rest in one call."""
        plain = [PLAIN(p) is not None for p in pieces]
        rest = iter(self.tokenizer.encode_batch_fast([p for p, x in zip(pieces, plain, strict=True) if not x], add_special_tokens=False))
        merge = self.merge
        spell = lambda p: p if p.isascii() else "".join(map(BYTE_LETTERS.__getitem__, p.encode()))
        return [[t.id for t in merge(spell(p))] if x else next(rest).ids for p, x in zip(pieces, plain, strict=True)]

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where ``start`` has each of the distinct pieces; new ones are added."""
        known, n = self.pieces, len(self.start) - 1
        new = [p for p in pieces if p not in known]
        if new:
            known.update(zip(new, range(n, n + len(new))))
            ids = self._encode(new)
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(x) for x in ids])])
            self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.uint32)])
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def __call__(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first, past the last) of the stem and the tail of each of
        the distinct words: arrays of two columns."""
        if len(self.pieces) > CACHED_WORDS or len(self.flat) > 16 * CACHED_WORDS:
            self._clear()
        stem = pc.utf8_rtrim(distinct, TAIL)
        stem = pc.if_else(pc.match_substring_regex(stem, SPLITTABLE), stem, distinct)
        cut = (pc.binary_length(distinct).to_numpy() - pc.binary_length(stem).to_numpy()).astype(np.int64)
        ends = np.flatnonzero(cut)
        tail = pa.array([w[-k:] for w, k in zip(distinct.take(pa.array(ends)).to_pylist(), cut[ends].tolist(), strict=True)], pa.string())
        at = np.zeros((len(distinct), 2), np.int64)  # no tail: the empty piece
        for side, rows, values in ((0, slice(None), stem), (1, ends, tail)):
            code, once = encode(values)
            at[rows, side] = self._places(once.to_pylist())[code]
        return self.flat, self.start[at], self.start[at + 1]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_ids(texts: pa.Array, ids: WordIds, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``end``, and the texts' offsets."""
    words, off = flat_words(texts, lower=True)  # the tokenizer lowers case; doing it first leaves fewer words
    code, distinct = encode(words)
    flat, first, last = ids(distinct)
    first, size = first[code], (last - first)[code]
    until = np.concatenate([[0], np.cumsum(size.sum(1))])[off]  # ids before each text
    doc_off = until + np.arange(len(off))
    first, size = first.ravel(), size.ravel()  # stem, tail, stem, tail, ...
    first, size = first[size > 0], size[size > 0]
    source = np.arange(until[-1]) + np.repeat(first - np.cumsum(size) + size, size)
    out = np.full(int(doc_off[-1]), end, np.uint32)
    inside = np.ones(len(out), bool)
    inside[doc_off[1:] - 1] = False
    out[inside] = flat[source]
    return out, doc_off


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = False, keep_cache: bool = True) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length,
    ids_crc32, doc_tokens and, if asked for, ids.  With ``keep_cache`` a Python
    worker keeps its words' ids for its next task."""
    where = path

    @released(*([] if keep_cache else [word_ids.cache_clear]))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(where or vocabulary_path())
        for batch in batches:
            for rows in slices(batch, max_bytes=TOKEN_BYTES):
                ids, off = text_ids(rows.column("text"), coder, end)
                raw = ids.astype("<u4")
                total = np.diff(off)
                count = -(-total // length)
                row = np.repeat(np.arange(len(total)), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * length
                size = np.minimum(length, total[row] - start)
                first = off[row] + start
                data = memoryview(raw).cast("B")
                crc = [zlib.crc32(data[4 * a : 4 * z]) for a, z in zip(first.tolist(), (first + size).tolist(), strict=True)]
                cols = [rows.column("doc_id").take(pa.array(row)), *[pa.array(x, pa.int64()) for x in (start, size, crc, total[row])]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:  # the pieces lie one after another
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(raw)), pa.int32()), pa.array(raw.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, kinds)


def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of ``sizes`` within ``room`` of the
    largest total ``value`` (its value, the count of each size)."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, v = sizes[order], value[order]
    fits = np.searchsorted(s, np.arange(room + 1), side="right")
    for r in range(1, room + 1):
        k = fits[r]
        if k:
            got = best[r - s[:k]] + v[:k]
            i = int(got.argmax())
            if got[i] > best[r - 1]:
                best[r], pick[r] = got[i], i
                continue
        best[r] = best[r - 1]
    count, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            count[order[pick[r]]] += 1
            r -= int(s[pick[r]])
    return float(best[room]), count


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Columns and multiplicities of a near-optimal basic LP solution
    (revised simplex; min total multiplicity, columns @ x = demand)."""
    m = len(sizes)
    cols = np.diag(room // sizes).astype(np.float64)
    inv = np.diag(1.0 / np.diag(cols))
    x = inv @ demand
    for _ in range(40 * m + 40):
        dual = inv.sum(0)
        value, pattern = best_pattern(dual, sizes, room)
        if value <= 1 + gap:
            break
        step = inv @ pattern
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        pivot = inv[out] / step[out]
        inv -= np.outer(step, pivot)
        inv[out] = pivot
        x = np.maximum(x - theta * step, 0)
        x[out] = theta
        cols[:, out] = pattern
    return cols.astype(np.int64), x


def plan_sequences(histogram: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """(multiplicity, {class: copies}) of the patterns that hold every piece
    of the histogram exactly once."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    cols, x = solve_patterns(sizes, demand.astype(np.float64), room)
    times = np.floor(x + 1e-7).astype(np.int64)
    plan = []
    left = demand.copy()
    for j in np.flatnonzero(times):
        col = cols[:, j]
        n = min([int(times[j]), *(left[col > 0] // col[col > 0]).tolist()])
        if n > 0:
            left -= n * col
            plan.append((n, {int(sizes[i]): int(col[i]) for i in np.flatnonzero(col)}))
    bins: list[tuple[int, dict[int, int]]] = []  # of the remainder: under one pattern's worth per basis column
    open_by_room: dict[int, list[int]] = {}
    for i in np.argsort(-sizes):
        size = int(sizes[i])
        for _ in range(int(left[i])):
            fit = min((r for r, b in open_by_room.items() if r >= size and b), default=None)
            if fit is None:
                bins.append((1, {}))
                j, fit = len(bins) - 1, room
            else:
                j = open_by_room[fit].pop()
            bins[j][1][size] = bins[j][1].get(size, 0) + 1
            open_by_room.setdefault(fit - size, []).append(j)
    return plan + bins


def pack(pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """``pieces`` (doc_id, start, length) plus sequence_id and offset."""
    room = length // grain
    p = settle(pieces.withColumn("_class", F.ceil(F.col("length") / grain).cast("int")), "pieces")
    histogram = {r["_class"]: r["count"] for r in p.groupBy("_class").count().collect()}  # at most `room` rows
    rows: dict[int, list[tuple[int, int, int]]] = {c: [] for c in histogram}
    used, base = dict.fromkeys(histogram, 0), 0
    for times, pattern in plan_sequences(histogram, room):
        for c, copies in pattern.items():
            rows[c].append((used[c], base, copies))
            used[c] += times * copies
        base += times
    table = [(c, [x[0] for x in r], [x[1] for x in r], [x[2] for x in r]) for c, r in rows.items()]
    plan = p.sparkSession.createDataFrame(table, "_class int, _from array<long>, _base array<long>, _copies array<long>")
    blocks = math.ceil(max(histogram.values(), default=1) / RANK_ROWS)
    block = F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks))
    ranked = dense_rank_from_zero(p, ["_class"], [F.col("doc_id"), F.col("start"), F.col("length")], block, "_r")
    i = F.size(F.filter("_from", lambda x: x <= F.col("_r")))
    placed = ranked.join(plan, "_class").withColumn("_i", i)
    at = lambda c: F.element_at(c, F.col("_i"))
    placed = placed.withColumn("sequence_id", (at("_base") + F.floor((F.col("_r") - at("_from")) / at("_copies"))).cast("long"))
    before = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "doc_id", "start", "_r").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return out.drop("_class", "_r", "_from", "_base", "_copies", "_i")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(token_pieces(docs))
