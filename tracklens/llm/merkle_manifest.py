"""Merkle manifest of a dataset, with a proof and a check for every row.

Each row is a leaf, the sha256 of its length-prefixed fields.  The leaves of a
source, in order of doc_id, are reduced ``FANOUT`` at a time to a subroot, and
the subroots in order of source to the root.  A row's proof is all siblings on
its way up; folding a leaf with them gives the root again, or not, if the row
has changed.

How (cogrouped subtree exchange):

1. Leaves are numbered within their source: a range partitioning orders them,
   each partition numbers its own rows, and a running sum over the partitions'
   counts shifts them.  A source with a third of all rows spreads over many
   partitions.
2. ``FANOUT ** HEIGHT`` consecutive leaves of a source are a superblock; each
   is reduced to one node in its own task call.  Small sources share calls.
3. The superblocks' nodes are reduced in the same way until one is left for
   each source, then the subroots likewise; on the way back every node gets the
   siblings above it.  A round handles 1 / 4096 of the rows of the one before.
4. The leaves and the outer siblings of their superblock are cogrouped by
   superblock: one call repeats the local reduction, joins local and outer
   siblings to proofs and folds every presented leaf.

Edge cases: a null field is hashed as ``-``; a null source is a source of its
own and comes first; null doc_ids come first in their source and are never
tampered with; rows of one doc_id are ordered by leaf, equal rows take one
place each; a lone leaf is its own subroot and a lone subroot the root (the
proof is the hash of nothing); an empty table has no rows and no root; columns
beside the five hashed ones are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.stages import dense_rank_from_zero, discard, settle

FANOUT = 16
HEIGHT = 3  # levels that one task call reduces
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64  # characters of a digest


def leaf_hash(fields: Iterable[Column]) -> Column:
    """sha256 of the fields, each ``-`` or byte count, ``:``, value."""
    parts = []
    for c in fields:
        c = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels(n: int) -> int:
    """Reductions until ``n`` nodes are one."""
    k = 0
    while n > 1:
        n, k = -(-n // FANOUT), k + 1
    return k


def _hash(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def local_tree(nodes: list[bytes], height: int) -> list[list[bytes]]:
    """For each level the concatenated digests of its runs, then the top."""
    out = []
    for _ in range(height):
        runs = [b"".join(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        out.append(runs)
        nodes = [_hash(r) for r in runs]
    return [*out, nodes]


def _stretches(rows: pd.DataFrame):
    """(group, nodes in the group, rows in order) of a task call's superblocks."""
    for g, part in rows.sort_values(["g", "i"], kind="stable").groupby("g", sort=False):
        yield g, int(part["m"].iloc[0]), part


def _reduce(rows: pd.DataFrame, height: int) -> pd.DataFrame:
    out, block = [], FANOUT**height
    for g, m, part in _stretches(rows):
        top = local_tree([x.encode() for x in part["node"]], min(levels(m), height))[-1]
        out.append((g, int(part["i"].iloc[0]) // block, -(-m // block), top[0].decode()))
    return pd.DataFrame(out, columns=["g", "i", "m", "node"])


def _outer(ats: np.ndarray, others: np.ndarray) -> list[tuple[int, bytes]]:
    return [(int(a) * HEX, o.encode()) for a, o in zip(ats, others, strict=True)]


def _path(tree: list[list[bytes]], j: int) -> list[tuple[int, bytes]]:
    """(place of the own digest, siblings) of the ``j``th node at each level."""
    out = []
    for runs in tree[:-1]:
        at = j % FANOUT * HEX
        j //= FANOUT
        run = runs[j]
        out.append((at, run[:at] + run[at + HEX :]))
    return out


def _descend(rows: pd.DataFrame, above: pd.DataFrame, height: int) -> pd.DataFrame:
    """The siblings on each node's way to its group's top."""
    up = {g: (list(a), list(o), t) for g, a, o, t in zip(above["g"], above["ats"], above["others"], above["top"], strict=True)}
    out = []
    for g, m, part in _stretches(rows):
        ats, others, top = up[g]
        tree = local_tree([x.encode() for x in part["node"]], min(levels(m), height))
        for j, i in enumerate(part["i"]):
            own = _path(tree, j)
            out.append((g, i, [a // HEX for a, _ in own] + ats, [o.decode() for _, o in own] + others, top))
    return pd.DataFrame(out, columns=["g", "i", "ats", "others", "top"])


def _finish(leaves: pd.DataFrame, above: pd.DataFrame, height: int) -> pd.DataFrame:
    """Local reduction, proofs and folds of the superblocks of one call."""
    up = {r.g: (_outer(r.ats, r.others), r.subroot, r.root) for r in above.itertuples()}
    out = []
    for g, m, part in _stretches(leaves):
        outer, subroot, root = up[g]
        tail = b"".join(o for _, o in outer)
        nodes = [x.encode() for x in part["node"]]
        tree = local_tree(nodes, min(levels(m), height))
        for j, (doc_id, leaf, shown) in enumerate(zip(part["doc_id"], part["node"], part["shown"], strict=True)):
            own = _path(tree, j)
            proof = sha256(b"".join(o for _, o in own) + tail).hexdigest()
            node = shown.encode()
            for at, others in own + outer:
                node = _hash(others[:at] + node + others[at:])
            folded = node.decode()
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _with_superblock(rows: DataFrame, small_calls: int, block: int, index: Column) -> DataFrame:
    """sg, sb: the task call of each node.  A group of more than a superblock
    has one call for each, smaller groups share ``small_calls`` calls."""
    big = F.col("m") > block
    return rows.withColumn("sg", F.when(big, F.col("g")).otherwise(F.pmod(F.xxhash64("g"), F.lit(small_calls)))).withColumn(
        "sb", F.when(big, index).otherwise(F.lit(-1).cast("long"))
    )


def _calls(rows: DataFrame, block: int) -> tuple[int, int]:
    """(calls that the small groups share, nodes of the largest group)"""
    small, most = rows.agg(F.count(F.when(F.col("m") <= block, True)), F.max("m")).first()
    return max(1, -(-small // block)), most or 0


_NODE = "g long, i long, m long, node string"


def _reduced(rows: DataFrame, height: int, name: str) -> DataFrame:
    """One node for each superblock of ``rows`` (with sg, sb)."""
    calls = rows.select("sg", "sb", "g", "i", "m", "node").groupBy("sg", "sb")
    return settle(calls.applyInPandas(lambda pdf: _reduce(pdf, height), _NODE), name)


def _paths(nodes: DataFrame, height: int) -> DataFrame:
    """g, i, ats, others (arrays, level by level: own place among the run, the
    siblings' digests concatenated), top (the group's last node) of every node."""
    block = FANOUT**height
    small, most = _calls(nodes, block)
    if most <= 1:
        none = [F.array().cast("array<long>").alias("ats"), F.array().cast("array<string>").alias("others")]
        return nodes.select("g", "i", *none, F.col("node").alias("top"))
    placed = _with_superblock(nodes, small, block, F.floor(F.col("i") / block))
    above = _paths(_reduced(placed, height, "nodes"), height).join(nodes.select("g", "m").distinct(), "g")
    above = settle(_with_superblock(above, small, block, F.col("i")).drop("m"), "above")
    both = placed.groupBy("sg", "sb").cogroup(above.groupBy("sg", "sb"))
    return settle(both.applyInPandas(lambda rows, up: _descend(rows, up, height), "g long, i long, ats array<long>, others array<string>, top string"), "paths")


def _numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with nth: the place in the group, from 0."""
    dealt = rows.withColumn("_salt", F.rand(17)).repartitionByRange(group, *order, "_salt").drop("_salt")
    parts = settle(dealt.withColumn("_part", F.spark_partition_id()), name)
    return dense_rank_from_zero(parts, [group], [F.col(c) for c in order], F.col("_part"), "nth").drop("_part")


def manifest(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for
    ``leaves``: doc_id, source, leaf, shown (the leaf to be verified).  A task
    call takes ``FANOUT ** height`` leaves of a source."""
    block = FANOUT**height
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-"))  # a null first, others in their own order
    rows = leaves.select(key.alias("key"), "doc_id", "leaf", "shown")
    ranked = settle(_numbered(rows, "key", ["doc_id", "leaf", "shown"], "leaves"), "numbered")
    sources = ranked.groupBy("key").agg(F.count(F.lit(1)).alias("m")).withColumn("all", F.lit(0))
    sources = settle(_numbered(sources, "all", ["key"], "sources").select("key", "m", F.col("nth").alias("g")), "numbered_sources")
    text_id = F.col("doc_id").cast("string").alias("doc_id")  # pandas has no long with nulls
    nodes = ranked.join(sources, "key").select("g", F.col("nth").alias("i"), "m", F.col("leaf").alias("node"), text_id, "shown")
    small, _ = _calls(nodes, block)
    nodes = settle(_with_superblock(nodes, small, block, F.floor(F.col("i") / block)), "placed")
    within = _paths(_reduced(nodes, height, "superblocks"), height)
    subroots = within.where("i = 0").select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(sources.count()).cast("long").alias("m"), F.col("top").alias("node"))
    over = _paths(settle(subroots, "subroots"), height).select(F.col("i").alias("g"), F.col("ats").alias("ats2"), F.col("others").alias("others2"), F.col("top").alias("root"))
    outer = within.join(over, "g").join(sources.select("g", "m"), "g")
    outer = outer.select("g", "i", "m", F.concat("ats", "ats2").alias("ats"), F.concat("others", "others2").alias("others"), F.col("top").alias("subroot"), "root")
    outer = settle(_with_superblock(outer, small, block, F.col("i")).drop("m"), "outer")
    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    done = nodes.groupBy("sg", "sb").cogroup(outer.groupBy("sg", "sb")).applyInPandas(lambda rows, up: _finish(rows, up, height), schema)
    discard(ranked, sources)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """The leaves of ``docs``; those whose doc_id's crc32 is a multiple of 5
    are shown with the A-Z of their text in lower case."""
    fields = {c: F.col(c) for c in FIELDS}
    lower = fields | {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    leaf = leaf_hash(fields.values())
    hit = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    return docs.select("doc_id", "source", leaf.alias("leaf"), F.when(hit, leaf_hash(lower.values())).otherwise(leaf).alias("shown"))


def query(spark, sf_dir: str) -> DataFrame:
    return manifest(tampered_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, four bits at a time."""
    table = [zlib.crc32(bytes([k])) for k in range(256)]
    nibble = [0] * 16
    for k in range(16):  # of the reflected polynomial
        c = k
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        nibble[k] = c
    assert table[0] ^ table[1] == nibble[1] >> 4 ^ nibble[nibble[1] & 15]
    values = "[" + ", ".join(f"{v}::BIGINT" for v in nibble) + "]"
    step = lambda x: f"xor(({x}) >> 4, {values}[(({x}) & 15) + 1])"
    byte = step(step("xor(acc, b)"))
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda acc, b: {byte}), 4294967295::BIGINT)"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


def _siblings_sql(tree: str) -> str:
    run = f"PARTITION BY g, lvl, i // {FANOUT} ORDER BY i ROWS BETWEEN"
    return f"""SELECT g, lvl, i, coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
       coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {tree} WHERE n > 1"""


def _tree_sql(start: str, name: str) -> str:
    return f"""{start} UNION ALL
  SELECT g, lvl + 1, i // {FANOUT}, sha256(string_agg(node, '' ORDER BY i)), (n + {FANOUT - 1}) // {FANOUT} FROM {name} WHERE n > 1 GROUP BY g, lvl, i // {FANOUT}, n"""


ORACLE = f"""
WITH RECURSIVE
d AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
      {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low,
      doc_id IS NOT NULL AND {_crc32_sql("coalesce(doc_id, 0)::VARCHAR")} % 5 = 0 AS hit FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) AS n FROM documents GROUP BY source),
p AS MATERIALIZED (SELECT d.*, s.g, s.n, CASE WHEN hit THEN low ELSE leaf END AS shown,
      row_number() OVER (PARTITION BY s.g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
t(g, lvl, i, node, n) AS ({_tree_sql("SELECT g, 0, i, leaf, n FROM p", "t")}),
sib AS MATERIALIZED ({_siblings_sql("t")}),
sub AS MATERIALIZED (SELECT g, node AS subroot FROM t WHERE n = 1),
t2(g, lvl, i, node, n) AS ({_tree_sql("SELECT 0, 0, g, subroot, (SELECT count(*) FROM s) FROM sub", "t2")}),
sib2 AS MATERIALIZED ({_siblings_sql("t2")}),
f(g0, i0, lvl, i, cur, acc) AS (SELECT g, i, 0, i, shown, '' FROM p UNION ALL
  SELECT f.g0, f.i0, f.lvl + 1, f.i // {FANOUT}, sha256(before || cur || after), acc || before || after FROM f JOIN sib ON sib.g = f.g0 AND sib.lvl = f.lvl AND sib.i = f.i),
f1 AS (SELECT g0, i0, max_by(cur, lvl) AS cur, max_by(acc, lvl) AS acc FROM f GROUP BY g0, i0),
f2(g0, i0, lvl, i, cur, acc) AS (SELECT g0, i0, 0, g0, cur, acc FROM f1 UNION ALL
  SELECT f2.g0, f2.i0, f2.lvl + 1, f2.i // {FANOUT}, sha256(before || cur || after), acc || before || after FROM f2 JOIN sib2 ON sib2.lvl = f2.lvl AND sib2.i = f2.i),
f3 AS (SELECT g0, i0, max_by(cur, lvl) AS cur, max_by(acc, lvl) AS acc FROM f2 GROUP BY g0, i0),
r AS (SELECT node AS root FROM t2 WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(acc) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM p JOIN f3 ON p.g = f3.g0 AND p.i = f3.i0 JOIN sub ON p.g = sub.g CROSS JOIN r
"""
