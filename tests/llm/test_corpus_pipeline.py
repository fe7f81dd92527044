"""The pipeline's stages against brute force, and the registered queries."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from pyspark.sql import functions as F

from tests.llm.test_cutting_stock import check as check_packing
from tests.llm.test_debruijn_dedup import brute as brute_repeats
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_suffix_automaton import brute as brute_hits
from tracklens.llm import subword_quality as Q
from tracklens.llm import suffix_automaton as S
from tracklens.llm.stages import settle
from tracklens.plans.verify import compare, duckdb_views

SF = "/root/testdata/sf0.001"
NAMES = ["quality", "near_duplicates", "repeated_spans", "benchmark_passages", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, "a null id and some words in a row", "en", "s", 5), (900001, None, "en", "s", 0), (900002, "", None, None, None)], docs.schema)
    out = [docs.unionByName(extra).unionByName(docs.where("doc_id = 3"))]
    for name, stage in C.STAGES:
        out.append(settle(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_columns(stages):
    assert [n for n, _ in C.STAGES] == NAMES and C.ORACLE_SQL is None
    for df in stages[1:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(r.n_chars == len(r.text) for r in df.where("text IS NOT NULL AND doc_id < 900000").collect())


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    w, b = Q.learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    want = [(r.doc_id, r.text) for r in Q.score_texts(stages[0], w, b).where(f"score >= {Q.THRESHOLD}").collect()]
    assert sorted(rows(stages[1]), key=str) == sorted(want, key=str)
    assert 0 < len(want) < stages[0].count()


def test_near_duplicates_leave_the_smallest_of_each_group(stages):
    before = rows(stages[1])
    stay = {d for d, _, c in brute_groups(before) if d == c}
    want = {d: t for d, t in before if d in stay}
    got = rows(stages[2])
    assert {d: t for d, t in got if d is not None} == want
    assert sum(d is not None for d, _ in got) == len(want)
    assert sorted(t for d, t in got if d is None) == sorted(t for d, t in before if d is None)


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    text = lambda a, n=40: " ".join(f"w{a}x{i}" for i in range(n))
    near = text(1).split()
    near[-1] = "other"
    rows_in = [(3, text(1), "en", "s", 1), (7, " ".join(near), "en", "s", 2), (7, text(2), "en", "s", 3)]
    rows_in += [(9, text(100 + i), "en", "s", i) for i in range(30)] + [(9, text(100), "en", "s", 0)] * 5  # one id, different texts
    rows_in += [(4, text(2), "en", "s", 4), (5, None, "x", "s", 0), (5, "x", None, "s", 0), (None, text(1), None, None, 6)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    want = [(3, text(1)), (4, text(2)), *[(9, text(100 + i)) for i in range(30)], (5, None), (5, "x"), (None, text(1))]
    got = C.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(rows(got), key=str) == sorted(want, key=str)


def test_repeated_spans_go(stages):
    before, after = rows(stages[2]), {d: t for d, t in rows(stages[3])}
    want = {d: (n, gone) for d, n, gone, _ in brute_repeats(before)}
    for d, t in before:
        n, gone = want[d]
        if gone == 0:
            assert after[d] == t
        elif gone < n:
            assert len(re.split(r"[\x20\x09-\x0d]+", after[d])) == n - gone
        else:
            assert d not in after
    assert any(gone for _, gone in want.values())


def test_benchmark_passages_go(spark, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = dict(rows(stages[4]))
    for d, t in rows(stages[3]):
        n, hit, _ = brute_hits(t, items)
        if not hit:
            assert after[d] == t
        elif len(hit) <= S.MAX_COVERAGE * n:
            assert len(S.words(after[d])) == n - len(hit)
        else:
            assert d not in after


def test_packing_holds_every_id(stages):
    texts = {}
    for d, t in rows(stages[4]):
        texts.setdefault(d, []).append(t)
    check_packing(stages[5].collect(), texts)


def test_empty_table(spark, stages):
    none = stages[0].limit(0)
    for _, stage in C.STAGES:
        none = settle(stage(spark, none, SF), "empty")
        assert none.count() == 0


def test_clashing_columns(spark, stages):
    own = ["_row", "_quality", "row", "of", "score", "c0", "h", "_h", "_ranges", "doc", "spans"]
    docs = stages[0].where("doc_id < 80").withColumns({c: F.lit(f"own {c}") for c in own} | {"m": F.create_map(F.lit("a"), F.col("doc_id")), "v": F.array("n_chars")})
    for name, stage in C.STAGES[:4]:
        out = settle(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.count() > 0
        assert out.where(" AND ".join(f"`{c}` = 'own {c}'" for c in own) + " AND m['a'] = doc_id").count() == out.count()
        docs = out


@pytest.mark.parametrize("key", sorted(E.LLM_ORACLES))
def test_query_matches_its_sql(spark, key):
    ok, msg = compare(E.queries()[key](spark, SF), duckdb_views(SF), E.LLM_ORACLES[key])
    assert ok, msg


def test_one_query_an_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in E.LLM_QUERIES if k != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


def test_the_rest_does_not_import_the_subpackage():
    root = Path(E.__file__).parent
    for f in [*root.glob("tracklens/**/*.py"), *root.glob("*.py"), *root.glob("tests/*.py")]:
        if "llm" not in f.relative_to(root).parts and f.name not in ("corpus_pipeline.py", "__spark_entry__.py"):
            assert "tracklens.llm" not in f.read_text(), f
