import hashlib
import zlib

import duckdb
import pytest

from tracklens.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g int, node string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    d, _, lang, source, n = row
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)])


def reduce(nodes):
    """(levels, top)"""
    out = []
    while len(nodes) > 1:
        out.append(nodes)
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return out, nodes[0]


def siblings(levels, i):
    for nodes in levels:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        yield run[: i % 16], run[i % 16 + 1 :]
        i //= 16


def brute(rows):
    if not rows:
        return []
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    names = sorted(by_source, key=first)
    trees = {}
    for s in names:
        shown = []
        for r in by_source[s]:
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if hit else r[1]
            shown.append((first(r[0]), leaf(r, r[1]), leaf(r, low), r[0]))
        shown.sort()
        trees[s] = (shown, *reduce([x[1] for x in shown]))
    above, root = reduce([trees[s][2] for s in names])
    out = []
    for k, s in enumerate(names):
        shown, levels, subroot = trees[s]
        for i, (_, own, cur, d) in enumerate(shown):
            proof = []
            for left, right in [*siblings(levels, i), *siblings(above, k)]:
                proof += [*left, *right]
                cur = H(*left, cur, *right)
            out.append((d, own, subroot, root, H(*proof), cur, cur == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)


def run(spark, rows, **kw):
    out = M.manifest(M.tampered_leaves(table(spark, rows)), **kw)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus():
    rows = [(i * 7 % 1001, f"Text Nr {i} é", "en" if i % 3 else None, "hot", i) for i in range(300)]
    rows += [(2000 + i, f"T{i}", "de", f"s{i % 40}", None) for i in range(90)]
    rows += [(3000 + i, None if i % 2 else "", "de", None, 1) for i in range(17)]
    rows += [(4000, "Lone", "fr", "é", 4), (5, "AB", "en", "twice", 2), (5, "AB", "en", "twice", 2), (5, "CD", "en", "twice", 2), (None, "N", None, "twice", 1)]
    return rows


@pytest.mark.parametrize("height", [1, 2, 3])
def test_matches_brute_force(spark, height):
    rows = corpus()
    got = run(spark, rows, height=height)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows) / 2


def test_a_source_of_several_superblocks(spark):
    rows = [(i, "A", "en", "one", 1) for i in range(4096 + 20)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(7, "Only", "en", "s", 4)]])
def test_smallest_tables(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_sql_agrees(spark):
    rows = corpus()
    con = duckdb.connect()
    con.register("documents_frame", table(spark, rows).toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    con.execute("CREATE VIEW documents AS SELECT * FROM documents_frame")
    assert sorted(con.execute(M.ORACLE).fetchall(), key=str) == brute(rows)


def test_crc32_in_sql():
    ids = ["0", "1", "-5", "1234567890123"]
    rows = duckdb.execute(f"SELECT x, {M._crc32_sql('x')} FROM (VALUES {', '.join(f'({i!r})' for i in ids)}) t(x)").fetchall()
    assert dict(rows) == {i: zlib.crc32(i.encode()) for i in ids}
