import random
import re

from pyspark.sql import functions as F

from tracklens.llm.quote_threads import thread_conversations

SCHEMA = "conv_id long, turn long, role string, text string, body string, note string"


def level(line):
    return len(re.match(r"^(?:[ \t]*>)*", line)[0].replace(" ", "").replace("\t", ""))


def norm(s):
    return re.sub(r"[\x20\x09-\x0d]+", " ", s.translate({c: c + 32 for c in range(65, 91)})).strip(" ")


def pieces(text):
    """(level, hashable text, whole?) of every passage and line."""
    runs, out = [], []
    for raw in re.split(r"\r?\n", text) if text is not None else []:
        q = level(raw)
        body = re.sub(r"^(?:[ \t]*>)+[ \t]?", "", raw) if q else raw
        if not runs or runs[-1][0] != q:
            runs.append((q, []))
        if norm(body):
            runs[-1][1].append(norm(body))
    for q, lines in runs:
        if lines:
            out.append((q, " ".join(lines), 1))
            out += [(q, x, 0) for x in lines]
    return out


def brute(rows):
    """One conversation with distinct turns: {turn: (depth, parent, reply depth, position)}."""
    rows = sorted(rows, key=lambda r: r[1])
    parent = {}
    for i, r in enumerate(rows):
        best = None
        for q, text, whole in pieces(r[3]):
            if q:
                for e in rows[:i]:
                    if any(x[:2] == (q - 1, text) for x in pieces(e[3])):
                        cand = (-q, whole, len(text), e[1])
                        # the latest original of this piece only
                        later = [z[1] for z in rows[:i] if any(x[:2] == (q - 1, text) for x in pieces(z[3]))]
                        if e[1] == max(later) and (best is None or cand > best):
                            best = cand
        parent[r[1]] = best[3] if best else None
    path = {}
    for r in rows:
        path[r[1]] = (path[parent[r[1]]] if parent[r[1]] is not None else ()) + (r[1],)
    order = sorted(path, key=path.get)
    return {t: (parent[t], len(path[t]) - 1, order.index(t)) for t in path}


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows, convs = [], {}
    for conv in range(6):
        own = []
        for turn in range(14):
            lines = [f"{rnd.choice('abcd')} word{rnd.randrange(30)}" for _ in range(rnd.randint(1, 3))]
            text = "\n".join(lines)
            if own and rnd.random() < 0.6:
                src = rnd.choice(own)
                quote = src.split("\n")
                if rnd.random() < 0.4:
                    quote = quote[: max(1, len(quote) // 2)]
                text = "\n".join(rnd.choice(["> ", ">", " >  "]) + x.upper() for x in quote) + "\n" + text
            own.append(text)
            rows.append((conv, turn, "user", text, "clash", f"n{turn}"))
        convs[conv] = brute([r for r in rows if r[0] == conv])
    got = thread_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows) and any(r.reply_depth > 1 for r in got)
    for r in got:
        assert (r.parent_turn, r.reply_depth, r.position) == convs[r.conv_id][r.turn], r
        assert not any(x.lstrip().startswith(">") for x in r.body.split("\n"))
        assert r.note == f"n{r.turn}"


def test_edge_rows(spark):
    rows = [
        (1, 0, "user", None, None, None), (1, 1, None, "", None, None), (None, 5, "user", "x\n> y", None, None), (None, 6, "user", "> x", None, None),
        (2, None, "user", "hello", None, None), (2, 1, "user", "> hello\nyes", None, None), (2, 1, "user", "> hello\nyes", None, None), (3, 0, "user", "> > nothing\n>\n", None, None),
    ]
    got = thread_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = lambda c: sorted((r.position, r.turn, r.parent_turn, r.reply_depth) for r in got if r.conv_id == c)
    assert by(1) == [(0, 0, None, 0), (1, 1, None, 0)]
    assert sorted(r.position for r in got if r.conv_id is None) == [0, 0]
    assert [r.position for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)] == [0, 1, 2]
    assert {r.reply_depth for r in got if r.conv_id == 2} == {0, 1}
    empty = spark.createDataFrame([], SCHEMA)
    assert thread_conversations(empty).count() == 0


def test_long_conversation_is_numbered_in_blocks(spark):
    n = 6000
    rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), (F.col("id") % 3000).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("m"), "id").alias("text"))
    got = thread_conversations(rows).select("turn", "position").collect()
    assert sorted(r.position for r in got) == list(range(n))
    assert [r.turn for r in sorted(got, key=lambda r: r.position)] == sorted(r.turn for r in got)


def test_sql_agrees_on_nested_quotes(spark, tmp_path):
    import duckdb

    from tracklens.llm import quote_threads as Q
    from tracklens.plans.verify import compare

    rnd = random.Random(8)
    rows = []
    for conv in range(5):
        own = []
        for turn in range(12):
            text = "\n".join(f"{rnd.choice('abcd')} word{rnd.randrange(20)}" for _ in range(rnd.randint(1, 3)))
            if own and rnd.random() < 0.7:
                quote = rnd.choice(own).split("\n")
                quote = quote[: rnd.randint(1, len(quote))]
                text = "\n".join(rnd.choice(["> ", ">"]) + x.upper() for x in quote) + rnd.choice(["\n", "\r\n"]) + text
            own.append(text)
            rows.append((conv, turn, "user", rnd.choice([text] * 20 + [None, ""])))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = Q.query(spark, str(tmp_path))
    assert got.where("reply_depth > 1").count() > 0
    ok, msg = compare(got, con, Q.ORACLE)
    assert ok, msg


def test_columns_with_names_of_inner_ones(spark):
    own = ["msg", "_conv", "_b", "_alone", "path", "_size", "_block", "parent", "b", "x0", "step", "block", "here"]
    rows = [(1, t, "user", x) for t, x in enumerate(["Hello there", "> Hello there\nHi", ">> Hello there\n> Hi\nwell", None])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = [tuple(r) for r in thread_conversations(df).orderBy("position").collect()]
    from pyspark.sql import functions as F

    wide = df.withColumns({c: F.lit(777) for c in own} | {"m": F.create_map(F.lit("a"), F.col("turn"))})
    got = thread_conversations(wide).orderBy("position")
    assert got.columns == ["conv_id", "turn", "role", "text", *own, "m", "body", "quote_depth", "parent_turn", "reply_depth", "position"]
    for r, p in zip(got.collect(), plain, strict=True):
        assert all(r[c] == 777 for c in own) and r["m"] == {"a": r.turn}
        assert (r.conv_id, r.turn, r.role, r.text, r.body, r.quote_depth, r.parent_turn, r.reply_depth, r.position) == p


def test_a_line_that_is_quoted_over_many_blocks_of_turns(spark):
    """The last earlier original is found in the quote's own block of turns or
    in any block before it."""
    rows, last = [], None
    expected = {}
    for t in range(0, 3000, 7):
        if t % 5 == 0 and (t < 200 or t > 2500):
            rows.append((1, t, "user", "the common line"))
            last = t
        else:
            rows.append((1, t, "user", f"> the common line\nanswer {t}"))
            expected[t] = last
    rows.append((1, None, "user", "the common line"))
    got = {r.turn: r.parent_turn for r in thread_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {t: got[t] for t in expected if expected[t] is not None} == {t: p for t, p in expected.items() if p is not None}
