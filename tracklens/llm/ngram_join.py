"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct 5-word shingles (a shorter text: the whole
word sequence as one element).  Documents with intersection / union >= 0.8
link; the result is the connected component of every document.

How (prefixes after Wang, Li and Feng, "Can we beat the prefix filtering?",
2012): under one global order of the tokens, two sets that overlap in t tokens
share at least l tokens among the first |x| - t + l of x and the first
|y| - t + l of y, for every l.

1. Texts become token sets (one pass).  Equal sets are one class.
2. Under hash order every class posts a prefix with l = 1 + 5 % of its size.
   A class of which fewer tokens occur in any other class's prefix than every
   partner would have to share links with nothing; most of the table ends
   here, before any document frequency has to be counted.
3. The rest gets exact document frequencies and the order rare -> frequent.
   A class with over 20 % unshared tokens ends here.  Every other class takes
   the l (up to ``MAX_MATCHES``) of least estimated cost: postings read (sum
   of its prefix tokens' frequencies) plus verifications (that sum / l bounds
   the partners that share l tokens).
4. Hub round: in each token's posting list only the class that carries the
   token earliest (it has the fewest rare tokens, so it is nearest to the
   others) is paired with the rest; every class is verified against the
   ``HUBS`` hubs it meets most often, links are contracted to components.
5. The remaining candidates are pairs of *different* components that share
   min(l_x, l_y) tokens: all are verified but those that the intersections
   with a common hub already exclude.

Pairs inside a component that already holds together are never formed, so a
group of n near copies costs about n pairs, not n^2; no link between different
components is lost.

Edge cases: null or wordless texts have the empty set and link with nothing
(component: their own doc_id); a null doc_id gets a null component and links
with nothing; rows sharing a doc_id are judged by their own sets.  Tokens are
64-bit hashes; a set is identified by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.stages import components, discard, settle
from tracklens.llm.text import as_long, flat_words, hash_words, mix, released, slices, window_hashes

SHINGLE = 5
NUM, DEN = 4, 5  # similarity of at least NUM / DEN
BASE_SHARE = 20  # the first prefixes ask for 1 + size / BASE_SHARE shared tokens
MAX_MATCHES = 16
HUBS = 2
VERIFY_COST = 6  # one verification in posting reads, per 100 tokens


def token_sets(batch: pa.RecordBatch, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct token hashes (uint64) of every text."""
    words, off = flat_words(batch.column("text"), lower=True)
    h = hash_words(words)
    win = window_hashes(h, width)
    out = []
    for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if z - a >= width:
            out.append(np.unique(win[a : z - width + 1]))
        elif z > a:
            out.append(window_hashes(h[a:z] + np.uint64(z - a), z - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on the order of the set."""
    m = mix(tokens + np.uint64(0x2545F4914F6CDD1D))
    return int(as_long(np.add.reduce(tokens * np.uint64(0x9E3779B97F4A7C15), keepdims=True))[0]), int(as_long(np.add.reduce(m, keepdims=True))[0])


def least_overlap(n: int) -> int:
    """Tokens that any partner of a set of n tokens shares with it."""
    return -(-NUM * n // DEN)


def base_matches(n: int) -> int:
    return 1 + n // BASE_SHARE


@released()
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = token_sets(part)
            sig = [set_signature(s) if len(s) else (0, 0) for s in sets]
            prefix = [as_long(s[: len(s) - least_overlap(len(s)) + base_matches(len(s))]) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()), part.column("h"), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in sig], pa.int64()),
                    pa.array([b for _, b in sig], pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                ],
                ["doc_id", "h", "n_shingles", "sig_a", "sig_b", "prefix"],
            )


@released()
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token sets of the texts whose set is that of the class they stand for."""
    for batch in batches:
        for part in slices(batch):
            keep, sets = [], []
            want = zip(part.column("sig_a").to_pylist(), part.column("sig_b").to_pylist(), strict=True)
            for i, (tokens, sig) in enumerate(zip(token_sets(part), want, strict=True)):
                if len(tokens) and set_signature(tokens) == sig:
                    keep.append(i)
                    sets.append(as_long(tokens))
            if keep:
                cols = [part.column(c).take(pa.array(keep)) for c in ("cls", "n")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(sets, pa.list_(pa.int64()))], ["cls", "n", "tokens"])


def choose_matches(df: np.ndarray, n: int) -> int:
    """The l of least estimated cost for a set of n tokens whose shared tokens
    have the ascending document frequencies ``df`` (unshared ones come first).
    The cost is that of partners of equal size, whose prefixes are the usual
    case; what is posted covers partners of every size."""
    unshared = n - len(df)
    cum = np.concatenate([[0], np.cumsum(df)])
    most = max(1, min(MAX_MATCHES, least_overlap(n)))
    l = np.arange(1, most + 1)
    equal = -(-2 * NUM * n // (NUM + DEN))  # least overlap with a set of the same size
    inside = np.clip(n - equal + l - unshared, 0, len(df))
    reads = cum[inside].astype(np.float64)
    return int(l[np.argmin(reads + VERIFY_COST * (n / 100) * reads / l)])


@released()
def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cls, n, [(df, token)] -> postings of the adaptive prefix."""
    for batch in batches:
        out = {k: [] for k in ("cls", "n", "common", "need", "pos", "token")}
        for cls, n, shared in zip(batch.column("cls").to_pylist(), batch.column("n").to_pylist(), batch.column("shared"), strict=True):
            rows = shared.values
            df, token = rows.field("df").to_numpy(), rows.field("token").to_numpy()
            order = np.lexsort((token, df))
            df, token = df[order], token[order]
            if len(df) < least_overlap(n):
                continue
            need = choose_matches(df, n)
            k = max(0, min(n - least_overlap(n) + need - (n - len(df)), len(df)))
            out["cls"].append(np.full(k, cls)), out["n"].append(np.full(k, n)), out["common"].append(np.full(k, len(df))), out["need"].append(np.full(k, need))
            out["pos"].append(np.arange(k) + n - len(df)), out["token"].append(token[:k])
        cat = {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in out.items()}
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in cat.values()], list(cat))


_OVERLAP = f"ceil({NUM}.0D * (a_n + b_n) / {NUM + DEN})"  # least overlap of a pair at the threshold
_NEED = "least(a_need, b_need)"
#: The token lies in both sets' prefixes for this pair's sizes and its l.
_ADMISSIBLE = f"{DEN} * a_n >= {NUM} * b_n AND {DEN} * b_n >= {NUM} * a_n AND a_pos < a_n - {_OVERLAP} + {_NEED} AND b_pos < b_n - {_OVERLAP} + {_NEED}"


def _via_hubs() -> str:
    """Two classes compared with one hub share at most what both share with it
    plus what either shares with anyone else; the pair stays if that reaches
    the least overlap for every hub they have in common."""
    terms = []
    for i in range(HUBS):
        for j in range(HUBS):
            a, b = f"a_inter{i}", f"b_inter{j}"
            reach = f"least({a}, {b}) + least(a_common - {a}, b_common - {b}) >= {_OVERLAP}"
            terms.append(f"(NOT (a_hub{i} <=> b_hub{j}) OR a_hub{i} IS NULL OR {reach})")
    return " AND ".join(terms)


def _compared(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) with the size of their intersection and the verdict."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("inter", F.size(F.array_intersect("x", "y")))
    links = DEN * F.col("inter") >= NUM * (F.size("x") + F.size("y") - F.col("inter"))
    return settle(both.select("a", "b", "inter", links.alias("links")), name)


def _hub_pairs(prefixes: DataFrame) -> DataFrame:
    """Each class with the ``HUBS`` hubs it shares the most prefix tokens with.
    The hub of a posting list is the class that carries the token earliest."""
    earliest = F.min(F.struct((F.col("pos") / F.col("n")).alias("at"), "cls", "n", "need", "pos"))
    hub = prefixes.groupBy("token").agg(earliest.alias("h"), F.count(F.lit(1)).alias("c")).where("c > 1")
    hub = hub.select("token", F.col("h.cls").alias("a"), *[F.col(f"h.{c}").alias(f"a_{c}") for c in ("n", "need", "pos")])
    other = prefixes.select("token", F.col("cls").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("n", "need", "pos")])
    pairs = hub.join(other, "token").where("a <> b").where(_ADMISSIBLE).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    best = Window.partitionBy("b").orderBy(F.col("shared").desc(), "a")  # at most one row per token of b's prefix
    return pairs.withColumn("r", F.row_number().over(best)).where(F.col("r") <= HUBS).select("a", "b")


def _cross_pairs(prefixes: DataFrame, comp: DataFrame, by_hub: DataFrame) -> DataFrame:
    """All pairs of different components that share enough prefix tokens.

    In a posting list only the classes outside the hub's component meet the
    whole list: members of one large component are never paired.  What both
    sides share with a hub they were compared with bounds what they can share
    with each other; most pairs of a large loose group end at that bound."""
    compared = by_hub.groupBy(F.col("b").alias("cls")).agg(F.collect_list(F.struct(F.col("a").alias("hub"), F.col("inter").cast("long").alias("inter"))).alias("h"))  # HUBS at most
    hubs = [f"{c}{i}" for i in range(HUBS) for c in ("hub", "inter")]
    compared = compared.select("cls", *[F.expr(f"get(h, {c[-1]}).{c[:-1]}").alias(c) for c in hubs])
    labelled = prefixes.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    mixed = labelled.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct((F.col("pos") / F.col("n")).alias("at"), "comp")).alias("h")
    )
    mixed = mixed.where("lo < hi").select("token", F.col("h.comp").alias("main"))
    rest = settle(labelled.join(mixed, "token").join(compared, "cls", "left"), "mixed")
    side = lambda s: [F.col("cls").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "need", "pos", "comp", "common", *hubs)]]
    outside = rest.where("comp <> main").select("token", "main", *side("a"))
    met = outside.join(rest.select("token", *side("b")), "token").where("a_comp <> b_comp AND (b_comp = main OR a < b)").where(_ADMISSIBLE)
    met = met.where(_via_hubs())
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.expr(_NEED).alias("need"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("need").alias("need")).where("shared >= need").select("a", "b")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))  # rows that share an id are told apart by their texts
    sig = settle(docs.mapInArrow(_signatures, "doc_id long, h long, n_shingles long, sig_a long, sig_b long, prefix array<long>"), "signatures")
    linked = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("sig_a", "sig_b").agg(F.min(F.struct("doc_id", "h")).alias("s"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"))
    classes = classes.select("sig_a", "sig_b", F.col("s.doc_id").alias("rep"), F.col("s.h").alias("h"), "n", "prefix")
    classes = settle(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    # 2: hash-order prefixes
    posts = classes.select("cls", "n", F.explode("prefix").alias("token"))
    common = posts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    common = settle(common, "common")
    smallest = F.ceil(NUM * F.col("n") / DEN)
    needed = 1 + F.floor(smallest / BASE_SHARE)
    active = posts.join(common, "token", "left_semi").groupBy("cls", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= needed)
    active = settle(classes.select("cls", "n", "rep", "h", "sig_a", "sig_b").join(active.select("cls"), "cls"), "active")
    text = docs.join(active.withColumnRenamed("rep", "doc_id"), ["doc_id", "h"])
    sets = text.select("cls", "n", "sig_a", "sig_b", "text").mapInArrow(_sets, "cls long, n long, tokens array<long>")
    sets = settle(sets.dropDuplicates(["cls"]), "sets")  # a repeated row of the representative
    # 3: exact frequencies, adaptive prefixes
    tokens = sets.select("cls", "n", F.explode("tokens").alias("token"))
    df = settle(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    shared = tokens.join(df, "token").groupBy("cls", "n").agg(F.collect_list(F.struct("df", "token")).alias("shared"))  # at most the document's own tokens
    prefixes = settle(shared.mapInArrow(_prefixes, "cls long, n long, common long, need long, pos long, token long"), "prefixes")
    # 4: hubs, then 5: what is left between components
    by_hub = _compared(_hub_pairs(prefixes), sets, "hub_pairs")
    links = by_hub.where("links").select("a", "b")
    more = _compared(_cross_pairs(prefixes, components(links, "hub_components"), by_hub), sets, "cross_pairs").where("links")
    comp = components(links.union(more.select("a", "b")), "components")
    # class -> smallest doc_id of its component
    of_class = classes.select("cls", "rep", "sig_a", "sig_b").join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = of_class.join(of_class.groupBy("comp").agg(F.min("rep").alias("component_id")), "comp").select("sig_a", "sig_b", "component_id")
    result = sig.select("doc_id", "n_shingles", "sig_a", "sig_b").where("n_shingles > 0").join(named, ["sig_a", "sig_b"], "left")
    result = result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    result = settle(result.unionByName(sig.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))), "similar")
    discard(sig, classes, common, active, sets, df, prefixes, by_hub)
    return result


def query(spark, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, coalesce(len(sh), 0) AS n_shingles FROM s),
t AS (SELECT doc_id, unnest(sh) AS tok FROM s),
shared AS (SELECT tok FROM t GROUP BY tok HAVING count(*) > 1),
ts AS (SELECT t.* FROM t SEMI JOIN shared ON t.tok = shared.tok),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM ts a JOIN ts b ON a.tok = b.tok AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n_shingles + y.n_shingles - i)),
e AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (WITH RECURSIVE reach(doc_id, c) AS (SELECT a, a FROM e UNION SELECT e.b, reach.c FROM reach JOIN e ON e.a = reach.doc_id AND reach.c < e.b) SELECT doc_id, min(c) AS c FROM reach GROUP BY 1)
SELECT n.doc_id, n_shingles, least(n.doc_id, coalesce(c, n.doc_id)) AS component_id FROM n LEFT JOIN r ON n.doc_id = r.doc_id
"""
