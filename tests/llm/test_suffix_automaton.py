import hashlib
import random

import pytest

from tracklens.llm import suffix_automaton as S

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, items string, note int"


def windows(w, size=S.WINDOW):
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def brute(text, items):
    """(words, hit positions, item names) by looking at every window."""
    w = S.words(text)
    hit, names = set(), set()
    for name, item in items:
        for win in windows(S.words(item)):
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    names.add(name)
    return len(w), hit, names


def cases(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(6)]
    items = [(str(i), " ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 4, 9, 10, 12, 25])))) for i in range(rnd.randint(1, 9))]
    items = [(n, t) for n, t in items if seed % 2 or len(t.split()) > 3]
    items.append((items[0][0] if items else "0", "Ünï, w1 w2-w3 " + " ".join(rnd.choices(vocab, k=11))))
    docs = []
    for _ in range(30):
        parts = [" ".join(rnd.choices(vocab + ["zz"], k=rnd.randint(0, 12)))]
        for _ in range(rnd.randint(0, 2)):
            w = rnd.choice(items)[1].split()
            a = rnd.randrange(len(w))
            parts += [" ".join(w[a : a + rnd.randint(1, 20)]).upper(), " ".join(rnd.choices(vocab + ["zz", "ünï"], k=rnd.randint(0, 8)))]
        docs.append(rnd.choice([" ", "\n", ", "]).join(parts))
    return docs + ["", None, "?!", "zz " * 3000], items


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(docs)], DOCS)
    i = spark.createDataFrame(items, "item_id string, text string")
    return {r.doc_id: r for r in S.find_contamination(d, i, **kw).collect()}


@pytest.mark.parametrize("seed", range(12))
def test_automaton_against_brute_force(seed):
    docs, items = cases(seed)
    auto = S.Automaton([(n, S.words(t)) for n, t in items])
    for text in docs:
        w = S.words(text)
        code = [auto.vocab.get(x, 10**9) for x in w]
        spans, found, longest = auto.scan(code)
        _, hit, names = brute(text, items)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert {auto.names[i] for i in found} == names
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize("block_words", [S.BLOCK_WORDS, 60])
def test_operator(spark, block_words):
    docs, items = cases(3)
    items = [*items, (None, "w1 w2"), ("9", None), ("8", " ,")]
    named = [x for x in items if x[0] is not None and x[1] is not None]
    got = run(spark, docs, items, block_words=block_words)
    for i, text in enumerate(docs):
        n, hit, names = brute(text, named)
        r = got[i]
        assert (r.n_words, sorted(r["items"]), r.note) == (n, sorted(names), 1)
        assert {p for s in r.spans for p in range(s.start, s.end)} == hit


def test_removal_keeps_clean_text(spark):
    item = " ".join(f"q{i}" for i in range(14))
    docs = [(1, "Clean,  text\n stays"), (2, "Before. " + item.upper() + "! after " + "more " * 20), (3, item), (4, None), (5, "")]
    d = spark.createDataFrame([(i, t, "en", 7) for i, t in docs], "doc_id long, text string, lang string, spans int")
    got = {r.doc_id: r for r in S.remove_contamination(d, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1].text == docs[0][1] and got[4].text is None and got[5].text == "" and got[2].spans == 7
    assert got[2].text == "Before. ! after " + "more " * 20


def test_empty_tables_and_query(spark):
    assert run(spark, [], [("1", "a b")]) == {}
    got = run(spark, ["a b", None], [])
    assert [got[i].n_words for i in range(2)] == [2, 0] and not got[0].spans
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = S.query(spark, SF).collect()
    assert len(rows) == len(docs) and any(r.contaminated for r in rows)
    for r in rows[:60]:
        n, hit, names = brute(docs[r.doc_id], items)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(names), digest, bool(hit))


def test_repeated_items_and_long_items(spark):
    """Rows of one item repeated for a third of the table, and items of many blocks."""
    rnd = random.Random(5)
    book = [f"b{rnd.randrange(40)}" for _ in range(700)]
    items = [("hot", "one line that very many rows repeat word for word here")] * 50 + [(str(i), " ".join(rnd.choices([f"v{j}" for j in range(9)], k=rnd.choice([3, 12, 20])))) for i in range(100)]
    items += [("book", ", ".join(book)), ("book", ", ".join(book)), ("just", " ".join(f"j{i}" for i in range(31)))]
    docs = [" ".join(book[a : a + n]) for a, n in [(0, 700), (15, 10), (25, 12), (691, 9), (690, 10)]]
    docs += [" ".join(book[a : a + 10]) for a in range(0, 691, 7)] + [items[0][1], items[60][1].upper(), " ".join(f"j{i}" for i in range(20, 31)), None]
    got = run(spark, docs, items, block_words=60)
    for i, text in enumerate(docs):
        n, hit, names = brute(text, sorted(set(items)))
        assert (got[i].n_words, sorted(got[i]["items"])) == (n, sorted(names)), text
        assert {p for s in got[i].spans for p in range(s.start, s.end)} == hit


def test_blocks_hold_every_window_once_dealt(spark):
    words = [f"w{i}" for i in range(500)]
    items = spark.createDataFrame([(1, " ".join(words))] * 3 + [(2, "a b")], "item_id int, text string")
    blocks = list(S.item_blocks(items, 10, 60))
    assert all(sum(len(t.split()) for _, t in b) <= 60 for b in blocks)
    assert {w for b in blocks for n, t in b if n == "1" for w in windows(t.split())} == windows(words)
    assert sum((n, t) == ("2", "a b") for b in blocks for n, t in b) == 1
