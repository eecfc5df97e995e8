"""Quotation linking: conversations without quotes, in the order of replies.

1. Every line's quote level is the number of ``>`` before it; consecutive lines of
   a level are a passage (a line like "Ann wrote:" above a deeper one goes).
2. Passages, their paragraphs and their lines are normalised (lower case, white space
   collapsed) and hashed. A quoted passage is looked up, whole and by paragraphs, among
   what earlier messages of its conversation say unquoted; one that is not found so, as
   when some lines were cut from it, by its lines. That is a running maximum over the
   hash's turns, cut into slices, not a join of all quotes with all originals: a phrase
   that every message has costs as many rows as messages.
3. A message answers the latest message that its least nested linked quote comes from;
   one that quotes nothing known begins a thread. These links all lead to earlier turns,
   so a thread is a tree and its first turn the root.
4. Messages are numbered thread by thread in the order of replies: a message, then each
   answer to it, by turn, with all that followed from that answer. The tour around each
   tree is a linked list that is ranked by pointer doubling, so neither a long chain of
   replies nor a message with many answers is one task; numbers are a distributed sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, pick
from quayside.operators.sequence import dense_sequence, previous_value, running_max_before

MARKS = r"^((?:[ \t]*>)*)"
WROTE = r"^[^\n]{1,200} wrote:[ \t]*$"
SLICE = 100_000


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x09-\x0D\x20]+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """(mid, at, level, text): the passages of ``messages`` (mid, text) in order."""
    lines = messages.where("text is not null").select("mid", F.posexplode(F.split("text", "\r?\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 1)
    lines = lines.select("mid", "line", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                         F.regexp_replace("raw", MARKS + " ?", "").alias("bare"), "raw")
    # an unquoted line keeps its own indentation
    lines = lines.withColumn("body", F.when(F.col("level") == 0, F.col("raw")).otherwise(F.col("bare")))
    order = Window.partitionBy("mid").orderBy("line")
    lines = lines.withColumn("below", F.lead("level").over(order)).withColumn("above", F.lag("level").over(order))
    lines = lines.withColumn("drop", F.coalesce((F.col("below") > F.col("level")) & F.col("body").rlike(WROTE), F.lit(False)))
    new = F.when(F.col("above").isNull() | (F.col("above") != F.col("level")), 1).otherwise(0)
    lines = lines.withColumn("at", F.sum(new).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("not drop")
    rows = lines.groupBy("mid", "at", "level").agg(F.array_sort(F.collect_list(F.struct("line", "body"))).alias("l"))
    return rows.select("mid", "at", "level", F.array_join(F.transform("l", lambda x: x["body"]), "\n").alias("text"))


def hashes(parts: DataFrame) -> DataFrame:
    """(mid, at, level, grain, h): digests of each passage and of its paragraphs (grain 0)
    and of its other lines (grain 1); empty ones have none."""
    coarse = F.transform(F.concat(F.array("text"), F.split("text", r"\n[ \t]*\n")), normal)
    lines = F.array_except(F.transform(F.split("text", "\n"), normal), coarse)
    of = lambda c, grain: F.transform(
        F.filter(F.array_distinct(c), lambda p: p != ""), lambda p: F.struct(F.lit(grain).alias("grain"), p.alias("p")))
    rows = parts.select("mid", "at", "level", F.inline(F.concat(of(coarse, 0), of(lines, 1))))
    return rows.select("mid", "at", "level", "grain", F.md5("p").alias("h"))


def reply_order(answers: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(mid, root, place): for each message of ``answers`` (mid, turn, to), the answered
    ones included, the first message of its tree and its place in the tree, rising along a walk
    that goes on from a message to the first answer to it and only then to the next one.

    ``to`` is an earlier message, so the links are trees; of an answered message that
    answers nothing itself, ``to`` is never a ``mid``. The walk enters and leaves every message;
    what follows a step is known from the message alone, and the rank of a step is the number
    of entries from it to the end. Each round doubles how far a step has looked ahead. A step
    that has not reached the end is the target of one other at most: no key is hot."""
    spark = answers.sparkSession
    scratch = Scratch(spark, "reply-order")
    answers = scratch.keep(answers, "answers")
    first = answers.groupBy("to").agg(F.min(F.struct("turn", "mid"))["mid"].alias("child"))
    nexts = previous_value(answers.select("mid", "to", (-F.col("turn").cast("bigint")).alias("t"), (-F.col("mid")).alias("m"),
                                          F.col("mid").alias("sibling")), ["to"], ["t", "m"], "sibling", "after")
    inner = nexts.select("mid", "to", "after")
    roots = first.select(F.col("to").alias("mid")).join(answers.select("mid"), "mid", "left_anti")
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    members = inner.select("mid").union(roots)
    entries = members.join(first.withColumnRenamed("to", "mid"), "mid", "left").select(
        enter("mid").alias("x"), F.coalesce(enter("child"), leave("mid")).alias("nxt"), F.lit(1).cast("bigint").alias("d"),
        F.lit(False).alias("done"))
    ends = roots.select(F.col("mid").alias("to"), F.lit(True).alias("top"))
    exits = inner.join(ends, "to", "left").select(
        leave("mid").alias("x"), F.coalesce(enter("after"), leave("to")).alias("nxt"), F.lit(0).cast("bigint").alias("d"),
        (F.col("after").isNull() & F.coalesce("top", F.lit(False))).alias("done"))
    steps = scratch.keep(entries.union(exits), "steps0")
    for k in range(1, max_rounds + 1):
        if steps.where("not done").isEmpty():
            break
        ahead = pick(scratch.again(steps), nxt="x", far="nxt", more="d", there="done")
        further = steps.where("not done").join(ahead, "nxt").select(
            "x", F.col("far").alias("nxt"), (F.col("d") + F.col("more")).alias("d"), F.col("there").alias("done"))
        new = scratch.keep(steps.where("done").union(further), f"steps{k}")
        scratch.drop(steps)
        steps = new
    else:
        raise RuntimeError(f"reply order: {max_rounds} rounds and still steps")
    return steps.where("x % 2 = 0").select(F.expr("x div 2").alias("mid"), F.expr("nxt div 2").alias("root"), (-F.col("d")).alias("place"))


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, n_quotes, n_linked, reply_to, thread, position, formatted).

    One row per row of ``messages``: ``text`` without quotes (null stays null),
    quoted passages, how many of them were found, the turn answered, the thread's first
    turn, the place from 0 in the conversation by thread and, within it, in the order of
    replies, and the text under its role, as chat formats have it. Repeated rows are messages
    of their own; of several messages of a turn any may be the one answered, a message never
    answers its own turn.
    A null conversation or turn links with nothing; its thread is its own turn.
    """
    scratch = Scratch(messages.sparkSession, "quoting")
    rows = scratch.keep(pick(messages, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
                        .withColumn("mid", F.monotonically_increasing_id()), "messages")
    quoting = F.col("text").rlike(r"(^|\n)[ \t]*>")
    plain = rows.where(~F.coalesce(quoting, F.lit(False))).select("mid", F.lit(1).alias("at"), F.lit(0).alias("level"), "text")
    parts = scratch.keep(passages(rows.where(quoting).select("mid", "text")).select("mid", "at", "level", "text")
                         .union(plain.where("text is not null").select("mid", F.col("at").cast("bigint"), "level", "text")), "passages")
    place = rows.where("conv is not null and turn is not null").select("mid", "conv", "turn")
    marked = hashes(parts).join(place, "mid").select(
        "mid", "at", "level", "grain", F.md5(F.concat_ws(":", F.col("conv").cast("string"), "h")).alias("g"), "turn")
    # quotes of a turn stand before what that turn says itself
    marked = scratch.keep(marked.withColumn("o", F.col("turn").cast("bigint") * 2 + F.when(F.col("level") == 0, 1).otherwise(0))
                          .withColumn("said", F.when(F.col("level") == 0, F.col("turn").cast("bigint"))), "marked")
    quoted = marked.where("level > 0").select("g").distinct()  # what nobody quotes needn't be ordered
    asked = marked.join(quoted, "g", "left_semi").select("mid", "at", "level", "grain", "g", "o", "said")
    known = running_max_before(asked, "g", "o", "said", "origin", SLICE).where("level > 0 and origin is not null")
    origin = [F.max(F.when(F.col("grain") == g, F.col("origin"))) for g in (0, 1)]
    known = known.groupBy("mid", "at", "level").agg(F.coalesce(*origin).alias("origin"))
    known = scratch.keep(known.groupBy("mid").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "origin"))["origin"].alias("reply_to"), F.count(F.lit(1)).alias("n_linked")), "known")
    # messages of one turn stand for each other: the first of them is answered
    first = place.groupBy("conv", "turn").agg(F.min("mid").alias("to"))
    answers = known.join(place, "mid").join(first.withColumnsRenamed({"conv": "c", "turn": "t"}),
                                            (F.col("conv") == F.col("c")) & (F.col("reply_to") == F.col("t")))
    order = scratch.keep(reply_order(answers.select("mid", "turn", "to")), "order")
    order = order.join(rows.select(F.col("mid").alias("root"), F.col("turn").alias("thread")), "root")
    n = parts.groupBy("mid").agg(
        F.count(F.when(F.col("level") > 0, 1)).alias("n_quotes"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("at", "text")))),
                                 lambda x: x["text"]), "\n").alias("own"))
    out = rows.join(n, "mid", "left").join(known, "mid", "left").join(order, "mid", "left")
    own = F.when(F.coalesce(F.col("n_quotes"), F.lit(0)) > 0, F.regexp_replace("own", r"^[\s]+|[\s]+$", "")).otherwise(F.col("text"))
    out = out.select("mid", "conv", "turn", "role", own.alias("text"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
                     F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to", F.when(F.col("root").isNull(), F.col("turn")).otherwise(F.col("thread")).alias("thread"),
                     F.coalesce("root", "mid").alias("root"), F.coalesce("place", F.lit(0)).alias("place"))
    out = out.withColumn("group", F.coalesce(F.col("conv").cast("string"), F.lit("")))
    out = dense_sequence(out, "group", ["thread", "root", "place"], "position")
    return out.select("conv", "turn", "role", "text", "n_quotes", "n_linked", "reply_to", "thread", "position",
                      F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")))
                      .alias("formatted"))


# ---- mail-like messages derived from a table of plain conversations ----------------

def quoting_messages(conversations: DataFrame) -> DataFrame:
    """Conversations in which some turns quote: by conversation + 3 * turn, modulo 5, a
    turn quotes the one before (0), that and, nested, the one before it (1), the one two
    turns back under a line that says who wrote it (2), nothing (3), or every other line
    of the one before (4)."""
    base = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    earlier = base.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    back = lambda k: earlier.select(F.col("conv_id").alias(f"c{k}"), (F.col("turn") + k).alias(f"t{k}"), F.col("said").alias(f"said{k}"))
    rows = base
    for k in (1, 2):
        b = back(k)
        rows = rows.join(b, (F.col("conv_id") == F.col(f"c{k}")) & (F.col("turn") == F.col(f"t{k}")), "left")
    how = F.pmod(F.col("conv_id") + 3 * F.col("turn"), F.lit(5))
    quote = lambda c, mark: F.concat(F.lit(mark), F.regexp_replace(c, "\n", f"\n{mark}"), F.lit("\n"))
    some = quote(F.array_join(F.filter(F.split("said1", "\n"), lambda x, k: k % 2 == 0), "\n"), "> ")
    one, nested, two = quote("said1", "> "), quote("said2", "> > "), quote("said2", "> ")
    head = (F.when((how == 0) & F.col("said1").isNotNull(), one)
            .when((how == 1) & F.col("said1").isNotNull(), F.concat(F.coalesce(nested, F.lit("")), one))
            .when((how == 2) & F.col("said2").isNotNull(), F.concat(F.lit("Someone wrote:\n"), two))
            .when((how == 4) & F.col("said1").isNotNull(), some).otherwise(""))
    return rows.select("conv_id", "turn", "role", F.when(F.col("text").isNotNull(), F.concat(head, F.col("text"))).alias("text"))


_NORMAL = r"trim(regexp_replace(lower({}), '[\x09-\x0D\x20]+', ' ', 'g'), ' ')"
ORACLE = rf"""
WITH RECURSIVE base AS (SELECT row_number() OVER () AS mid, conv_id, turn, role, text FROM conversations),
said AS (SELECT conv_id, turn, min(text) AS said FROM base WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
heads AS (
  SELECT mid, b.conv_id, b.turn, role, text, (b.conv_id + 3 * b.turn) % 5 AS how,
    '> ' || replace(s1.said, chr(10), chr(10) || '> ') || chr(10) AS one,
    '> > ' || replace(s2.said, chr(10), chr(10) || '> > ') || chr(10) AS nested,
    '> ' || replace(s2.said, chr(10), chr(10) || '> ') || chr(10) AS two,
    '> ' || array_to_string(list_filter(string_split(s1.said, chr(10)), lambda x, k: k % 2 = 1), chr(10) || '> ') || chr(10) AS trimmed
  FROM base b LEFT JOIN said s1 ON s1.conv_id = b.conv_id AND s1.turn + 1 = b.turn
    LEFT JOIN said s2 ON s2.conv_id = b.conv_id AND s2.turn + 2 = b.turn),
msg AS (
  SELECT mid, conv_id, turn, role, CASE WHEN text IS NOT NULL THEN CASE WHEN how = 0 AND one IS NOT NULL THEN one
    WHEN how = 1 AND one IS NOT NULL THEN coalesce(nested, '') || one
    WHEN how = 2 AND two IS NOT NULL THEN 'Someone wrote:' || chr(10) || two
    WHEN how = 4 AND trimmed IS NOT NULL THEN trimmed ELSE '' END || text END AS text FROM heads),
split AS (SELECT mid, regexp_split_to_array(text, '\r?\n') AS l FROM msg WHERE text IS NOT NULL),
raw AS (SELECT mid, generate_subscripts(l, 1) AS line, unnest(l) AS raw FROM split),
levels AS (
  SELECT mid, line, raw, length(regexp_replace(regexp_extract(raw, '{MARKS}', 1), '[^>]', '', 'g')) AS level FROM raw),
bodies AS (
  SELECT mid, line, level, CASE WHEN level = 0 THEN raw ELSE regexp_replace(raw, '{MARKS} ?', '') END AS body,
    lead(level) OVER w AS below, lag(level) OVER w AS above FROM levels WINDOW w AS (PARTITION BY mid ORDER BY line)),
runs AS (
  SELECT *, sum(CASE WHEN above IS NULL OR above <> level THEN 1 ELSE 0 END) OVER (PARTITION BY mid ORDER BY line) AS spot FROM bodies),
parts AS (
  SELECT mid, spot, level, string_agg(body, chr(10) ORDER BY line) AS t FROM runs
  WHERE NOT coalesce(below > level AND regexp_matches(body, '{WROTE}'), false) GROUP BY ALL),
pieces AS (
  SELECT mid, spot, level, unnest(list_prepend(t, regexp_split_to_array(t, '\n[ \t]*\n'))) AS p, 0 AS grain FROM parts
  UNION ALL SELECT mid, spot, level, unnest(string_split(t, chr(10))), 1 FROM parts),
hashes AS (SELECT mid, spot, level, {_NORMAL.format("p")} AS h, min(grain) AS grain FROM pieces GROUP BY ALL),
marked AS (SELECT * FROM hashes JOIN msg USING (mid) WHERE h <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
origins AS (
  SELECT q.mid, q.spot, q.level, coalesce(max(o.turn) FILTER (q.grain = 0), max(o.turn) FILTER (q.grain = 1)) AS origin
  FROM marked q JOIN marked o ON o.conv_id = q.conv_id AND o.h = q.h AND o.level = 0 AND o.turn < q.turn WHERE q.level > 0 GROUP BY ALL),
known AS (SELECT mid, arg_max(origin, (-level) * 1000000000 + origin) AS reply_to, count(*) AS n_linked FROM origins GROUP BY mid),
firsts AS (SELECT conv_id, turn, min(mid) AS mid FROM msg GROUP BY ALL),
walk AS (
  SELECT m.mid, m.conv_id, [m.turn, m.mid] AS path, k.reply_to AS up FROM msg m LEFT JOIN known k USING (mid)
  UNION ALL
  SELECT w.mid, w.conv_id, list_concat([f.turn, f.mid], w.path), k.reply_to FROM walk w JOIN firsts f
    ON f.conv_id = w.conv_id AND f.turn = w.up LEFT JOIN known k ON k.mid = f.mid),
threads AS (SELECT mid, path, path[1] AS thread FROM walk WHERE up IS NULL),
own AS (
  SELECT mid, count(*) FILTER (level > 0) AS n_quotes, string_agg(t, chr(10) ORDER BY spot) FILTER (level = 0) AS own FROM parts GROUP BY mid)
SELECT conv_id, turn, role, CASE WHEN coalesce(n_quotes, 0) > 0 THEN regexp_replace(own, '^\s+|\s+$', '', 'g') ELSE text END AS text,
  coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, CAST(reply_to AS BIGINT) AS reply_to, thread,
  row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS position,
  '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(
    CASE WHEN coalesce(n_quotes, 0) > 0 THEN regexp_replace(own, '^\s+|\s+$', '', 'g') ELSE text END, '') AS formatted
FROM msg LEFT JOIN own USING (mid) LEFT JOIN known USING (mid) LEFT JOIN threads USING (mid)
"""
