"""Chat formatting by quotation linking (native).

Messages may quote earlier ones with ``>`` prefixes (``>``, ``> >``, ``>>``).
Every text is split into lines; a line's quote level is the number of its
leading ``>`` marks.  Consecutive lines of one level form a passage, whose
normalised text (A-Z lowered, white space collapsed) is hashed.  A quoted
passage of level q links the message to the latest earlier message of the
conversation that contains the same passage at level q - 1 (what was the
author's own text, or itself a quote one level shallower).  The parent of a
message is the linked message of its shallowest quote (the latest, when
several passages of that level link); a message without a link belongs to the
conversation's main line.  The reply order puts each message after its parent
and before the parent's next sibling.

A passage may be a part of a message: quoting writers cut.  So every level is
indexed twice, by whole passages and by single lines, and a quoted passage
links by itself first, else by its longest line that links.

Edge cases: null and empty texts have no passages and keep their place in the
main line; null turns sort first; messages of a null conversation each stand
alone; repeated (conv_id, turn) rows are ordered by role and text.  Only an
earlier turn can be a parent, so replies never form cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.stages import dense_rank_from_zero, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKS = r"^(?:[ \t]*>)+"
BLOCK_TURNS = 500  # turns of one conversation that meet in a task for numbering


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+", " "))


def quote_lines(messages: DataFrame) -> DataFrame:
    """One row per line: the message's columns, line number, level, body."""
    lines = messages.select("*", F.posexplode(F.split(F.col("text"), r"\r?\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 0)
    level = F.length(F.regexp_replace(marks, "[^>]", ""))
    body = F.when(level > 0, F.regexp_replace("raw", MARKS + r"[ \t]?", "")).otherwise(F.col("raw"))
    return lines.withColumns({"level": level, "body": body}).drop("raw", "text")


def own_text(text: Column) -> Column:
    """The text without its quoted lines."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: ~x.rlike(MARKS))
    return F.coalesce(F.trim(F.array_join(lines, "\n")), F.lit(""))


def _pieces(lines: DataFrame) -> DataFrame:
    """Normalised lines and passages: msg, conv_id, turn, level, passage
    number, hash, length.  A passage row and its line rows share a number."""
    by_line = Window.partitionBy("msg").orderBy("line")
    text = normalised(F.col("body"))
    new = (F.col("level") != F.lag("level", 1, -1).over(by_line)).cast("int")
    rows = lines.withColumns({"norm": text, "new": new}).withColumn("passage", F.sum("new").over(by_line)).where("norm <> ''")
    whole = rows.groupBy("msg", "conv_id", "turn", "level", "passage").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "norm"))), lambda x: x["norm"]), " ").alias("norm"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    single = rows.select("msg", "conv_id", "turn", "level", "passage", "norm", F.lit(1).cast("long").alias("n_lines"))
    pieces = whole.withColumn("whole", F.lit(1)).unionByName(single.withColumn("whole", F.lit(0)))
    return pieces.select("msg", "conv_id", "turn", "level", "passage", "whole", F.sha2("norm", 256).alias("hash"), F.length("norm").alias("chars"))


def quote_links(messages: DataFrame) -> DataFrame:
    """(msg, parent): the earlier message whose text each message quotes.

    Quoted pieces are joined to originals on (conversation, level, hash).
    Of a piece that many messages contain only the latest earlier one can be
    the parent, so originals and quotes are merged in turn order per hash, a
    block of turns at a time, and the last original is carried forward: no
    pairs are formed.
    """
    pieces = settle(_pieces(quote_lines(messages)), "pieces")
    quoted = pieces.where("level > 0").select("conv_id", (F.col("level") - 1).alias("level"), "hash").distinct()
    originals = pieces.join(quoted, ["conv_id", "level", "hash"], "left_semi").select(
        "conv_id", "level", "hash", "turn", F.lit(0).alias("side"), F.col("msg").alias("source"), F.lit(None).cast("long").alias("msg"),
        F.lit(None).cast("long").alias("passage"), F.lit(None).cast("int").alias("whole"), F.lit(None).cast("int").alias("chars"), F.lit(None).cast("long").alias("quote_level"),
    )
    quotes = pieces.where("level > 0").select(
        "conv_id", (F.col("level") - 1).alias("level"), "hash", "turn", F.lit(1).alias("side"), F.lit(None).cast("long").alias("source"), "msg",
        "passage", "whole", "chars", F.col("level").cast("long").alias("quote_level"),
    )
    # Only a block of turns meets in a task: the last original of each block is carried over the (small)
    # table of blocks to the later ones.  A message at the same turn is not earlier: quotes sort before
    # originals of their turn.
    group = ["conv_id", "level", "hash"]
    turns = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 61)))  # a null turn sorts first
    both = originals.unionByName(quotes).withColumn("block", turns)
    original = F.when(F.col("side") == 0, F.struct("turn", "source"))
    seen = Window.partitionBy(*group, "block").orderBy(F.col("turn"), F.col("side").desc(), F.col("source")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*group, "block").agg(F.max(original).alias("final")).withColumn("before", F.last("final", ignorenulls=True).over(earlier)).drop("final")
    linked = both.withColumn("here", F.last(original, ignorenulls=True).over(seen)).where("side = 1")
    keys = [linked[c].eqNullSafe(carried[c]) for c in (*group, "block")]
    found = F.coalesce("here", "before")
    linked = linked.join(carried, keys, "left").select("msg", "quote_level", "whole", "chars", found["source"].alias("parent"), found["turn"].alias("parent_turn"))
    linked = linked.where("parent IS NOT NULL")
    best = F.struct(-F.col("quote_level"), F.col("whole"), F.col("chars"), F.col("parent_turn"), F.col("parent"))
    return linked.groupBy("msg").agg(F.max(best).alias("b")).select("msg", F.col("b.parent").alias("parent"))


def thread_conversations(messages: DataFrame) -> DataFrame:
    """All columns of ``messages`` (conv_id, turn, role, text) with: body (own
    text), quote_depth, parent_turn, reply_depth, position (gapless from 0 in
    each conversation, replies after what they answer)."""
    own = ["body", "quote_depth", "parent_turn", "reply_depth", "position"]
    extra = [c for c in messages.columns if c not in ["conv_id", "turn", "role", "text", *own]]
    names, extra = extra, [f"x{i}" for i in range(len(extra))]  # no clash with the columns made on the way
    messages = messages.select("conv_id", "turn", "role", "text", *[F.col(f"`{c}`").alias(x) for c, x in zip(names, extra, strict=True)])
    level = F.array_max(F.transform(F.split(F.coalesce("text", F.lit("")), r"\r?\n"), lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", ""))))
    m = messages.select("conv_id", "turn", "role", "text", *extra).withColumns({"quote_depth": level, "msg": F.monotonically_increasing_id()})
    m = settle(m, "messages")
    quoting = m.where("quote_depth > 0").select("conv_id").distinct()
    in_quoting = m.select("msg", "conv_id", "turn", "text").where("conv_id IS NOT NULL").join(quoting, "conv_id", "left_semi")
    links = settle(quote_links(in_quoting), "links")
    # Paths from the main line: one join per reply depth, over messages with a link only.
    key = F.struct(F.coalesce(F.col("turn"), F.lit(-(1 << 62))).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.xxhash64("text").alias("t"), F.col("msg").alias("msg"))
    main = m.join(links, "msg", "left_anti").select("msg", "turn", F.array(key).alias("path"), F.lit(None).cast("long").alias("parent_turn"))
    done = frontier = settle(main, "main")
    replies = settle(links.join(m.select("msg", "turn", key.alias("step")), "msg"), "replies")
    while not frontier.join(replies.select(F.col("parent").alias("msg")), "msg", "left_semi").isEmpty():
        above = frontier.select(F.col("msg").alias("parent"), F.col("turn").alias("parent_turn"), "path")
        frontier = settle(replies.join(above, "parent").select("msg", "turn", F.concat("path", F.array("step")).alias("path"), "parent_turn"), "replies")
        done = done.unionByName(frontier)
    rows = m.join(done.select("msg", "path", "parent_turn"), "msg")
    # A null conversation's messages stand alone: each is a conversation of its own for the numbering.
    rows = rows.withColumn("_alone", F.when(F.col("conv_id").isNull(), F.col("msg")).otherwise(-1)).withColumn("_conv", F.coalesce("conv_id", F.lit(0)))
    # Blocks follow the path order: by main-line turn, then by first reply turn.
    part = lambda i: F.coalesce(F.floor(F.try_element_at("path", F.lit(i))["turn"] / BLOCK_TURNS), F.lit(-(1 << 61)))
    block = F.struct(part(1).alias("b"), F.try_element_at("path", F.lit(1)).alias("r"), part(2).alias("c"))
    single = F.struct(part(1).alias("b"), F.lit(None).cast(rows.select(block.alias("x")).schema["x"].dataType["r"].dataType).alias("r"), F.lit(None).cast("long").alias("c"))
    many = rows.groupBy("_conv", "_alone", part(1).alias("_b")).agg(F.count(F.lit(1)).alias("_size"))
    rows = rows.withColumn("_b", part(1)).join(many, ["_conv", "_alone", "_b"])
    rows = dense_rank_from_zero(rows, ["_conv", "_alone"], [F.col("path")], F.when(F.col("_size") > 4 * BLOCK_TURNS, block).otherwise(single), "position")
    return rows.select(
        "conv_id", "turn", "role", "text", *[F.col(x).alias(c) for c, x in zip(names, extra, strict=True)], own_text(F.col("text")).alias("body"), "quote_depth", "parent_turn",
        (F.size("path") - 1).alias("reply_depth"), "position",
    )


def query(spark, sf_dir: str) -> DataFrame:
    m = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    t = thread_conversations(m)
    return t.select(
        "conv_id", "turn", "role", F.sha2(F.col("body"), 256).alias("body_sha256"), F.col("quote_depth").cast("long").alias("quote_depth"),
        "parent_turn", F.col("reply_depth").cast("long").alias("reply_depth"), "position",
    )


#: The same for tables whose (conv_id, turn) are distinct (ties are Spark's by content).
ORACLE = rf"""
WITH RECURSIVE
m AS (SELECT conv_id, turn, role, text, row_number() OVER () AS msg, regexp_split_to_array(coalesce(text, ''), '\r?\n') AS ls FROM conversations),
l AS (SELECT msg, conv_id, turn, raw, line, regexp_extract(raw, '^(?:[ \t]*>)+') AS marks
      FROM (SELECT msg, conv_id, turn, unnest(ls) AS raw, unnest(range(1, len(ls) + 1)) AS line FROM m)),
b AS (SELECT *, length(regexp_replace(marks, '[^>]', '', 'g')) AS level, CASE WHEN marks <> '' THEN regexp_replace(raw, '^(?:[ \t]*>)+[ \t]?', '') ELSE raw END AS body FROM l),
n AS (SELECT *, trim(regexp_replace(translate(body, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
             CASE WHEN level IS DISTINCT FROM lag(level, 1, -1) OVER (PARTITION BY msg ORDER BY line) THEN 1 ELSE 0 END AS new FROM b),
r AS (SELECT * FROM (SELECT *, sum(new) OVER (PARTITION BY msg ORDER BY line) AS passage FROM n) WHERE norm <> ''),
pieces AS (SELECT msg, conv_id, turn, level, 1 AS whole, string_agg(norm, ' ' ORDER BY line) AS t FROM r GROUP BY msg, conv_id, turn, level, passage
           UNION ALL SELECT msg, conv_id, turn, level, 0, norm FROM r),
linked AS (SELECT q.msg, q.level, q.whole, length(q.t) AS chars, max(o.turn) AS parent_turn
           FROM pieces q JOIN pieces o ON q.conv_id = o.conv_id AND o.level = q.level - 1 AND o.t = q.t AND o.turn < q.turn
           WHERE q.level > 0 GROUP BY q.msg, q.level, q.whole, q.t),
links AS (SELECT msg, parent_turn FROM (SELECT *, row_number() OVER (PARTITION BY msg ORDER BY level, whole DESC, chars DESC, parent_turn DESC) AS k FROM linked) WHERE k = 1),
tree AS (SELECT m.msg, m.conv_id, m.turn, links.parent_turn FROM m LEFT JOIN links ON m.msg = links.msg),
paths(msg, conv_id, turn, path) AS (
  SELECT msg, conv_id, turn, [coalesce(turn, -4611686018427387904)] FROM tree WHERE parent_turn IS NULL
  UNION ALL SELECT tree.msg, tree.conv_id, tree.turn, list_append(paths.path, tree.turn) FROM tree JOIN paths ON tree.conv_id = paths.conv_id AND tree.parent_turn = paths.turn),
placed AS (SELECT msg, path, row_number() OVER (PARTITION BY conv_id, CASE WHEN conv_id IS NULL THEN msg END ORDER BY path) - 1 AS position FROM paths)
SELECT m.conv_id, m.turn, m.role,
       sha256(trim(array_to_string(list_filter(ls, lambda x: NOT regexp_matches(x, '^(?:[ \t]*>)+')), chr(10)), ' ')) AS body_sha256,
       CAST(list_max(list_transform(ls, lambda x: length(regexp_replace(regexp_extract(x, '^(?:[ \t]*>)+'), '[^>]', '', 'g')))) AS BIGINT) AS quote_depth,
       tree.parent_turn, len(path) - 1 AS reply_depth, position
FROM m JOIN tree ON m.msg = tree.msg JOIN placed ON m.msg = placed.msg
"""
