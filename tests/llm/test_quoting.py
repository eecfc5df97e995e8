import re

from quayside.llm import quoting as Q
from quayside.llm.common import table


def normal(t):
    return re.sub(r"[\x09-\x0D ]+", " ", t.lower()).strip(" ")


def plain(rows):
    """(conv, turn, reply_to, thread) of rows (conv, turn, text), one row a turn."""
    def parts(text):
        out, lines = [], re.split(r"\r?\n", text or "")
        marks = [re.match(r"((?:[ \t]*>)*)", x)[1] for x in lines]
        for k, (m, x) in enumerate(zip(marks, lines, strict=True)):
            level = m.count(">")
            body = x if not level else re.sub(r"^(?:[ \t]*>)* ?", "", x)
            if k + 1 < len(lines) and marks[k + 1].count(">") > level and re.match(Q.WROTE, body):
                out.append([level, []]) if not out or out[-1][0] != level else None
                continue
            if not out or out[-1][0] != level:
                out.append([level, []])
            out[-1][1].append(body)
        return [(lv, {normal(p) for p in ["\n".join(b), *re.split(r"\n[ \t]*\n", "\n".join(b))]} - {""}, {normal(p) for p in b} - {""})
                for lv, b in out]

    own, answer = {}, {}
    for conv, turn, text in rows:
        own[conv, turn] = set().union(*[p | x for lv, p, x in parts(text) if lv == 0], set())
    for conv, turn, text in rows:
        latest = lambda p: max((t for c, t in own if c == conv and t < turn and own[c, t] & p), default=-1)
        found = [(-lv, latest(p) if latest(p) >= 0 else latest(lines)) for lv, p, lines in parts(text) if lv]
        found = [f for f in found if f[1] >= 0]
        answer[conv, turn] = max(found)[1] if found else None
    out = set()
    for conv, turn, _ in rows:
        root = turn
        while answer[conv, root] is not None:
            root = answer[conv, root]
        out.add((conv, turn, answer[conv, turn], root))
    return out


def walked(got):
    """The turns of one conversation in the order of replies, one row a turn."""
    def on(turn):
        return [turn, *[t for r in sorted(x.turn for x in got if x.reply_to == turn) for t in on(r)]]

    return [t for root in sorted(r.turn for r in got if r.reply_to is None) for t in on(root)]


def test_whole_table_as_brute_force(spark):
    plainly = table(spark, "/root/testdata/sf0.01", "conversations")
    messages = Q.quoting_messages(plainly)
    rows = [(r.conv_id, r.turn, r.text) for r in messages.collect()]
    got = Q.link(messages).collect()
    assert {(r.conv, r.turn, r.reply_to, r.thread) for r in got} == plain(rows)
    said = {(r.conv_id, r.turn): r.text for r in plainly.collect()}
    assert all(r.text == said[r.conv, r.turn].strip() for r in got)
    for conv in {r.conv for r in got}:
        mine = sorted((r for r in got if r.conv == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(mine)))
        assert [r.turn for r in mine] == walked(mine)
    assert sum(r.n_linked for r in got) > 100
    some = [r for r in got if (r.conv + 3 * r.turn) % 5 == 4 and r.turn and "\n" in said[r.conv, r.turn - 1]]
    assert len(some) > 20 and all(r.reply_to == r.turn - 1 for r in some)  # only some lines quoted


def test_trimmed_quotes_link_by_lines_and_branches_stay_together(spark):
    rows = [(1, 0, "alpha one\nalpha two\nalpha three"), (1, 1, "> alpha two\nbeta"), (1, 2, "> alpha one\n> [...]\n> alpha three\ngamma"),
            (1, 3, "> beta\ndelta"), (1, 4, "> gamma\nepsilon"), (1, 5, "> delta\nzeta"), (1, 6, "new thread"), (1, 7, "> ALPHA   two\neta"),
            (1, 8, "> alpha one\n> alpha two\n> alpha three\n>\n> beta\ntheta")]
    messages = spark.createDataFrame([(c, t, "user", x, 7, 7, 7, 7) for c, t, x in rows], "conv_id long, turn int, role string, text string, "
                                     "mid int, at int, root int, place int")
    got = sorted(Q.link(messages).collect(), key=lambda r: r.position)
    assert {(r.conv, r.turn, r.reply_to, r.thread) for r in got} == plain(rows)
    assert [(r.turn, r.reply_to) for r in got] == [(0, None), (1, 0), (3, 1), (5, 3), (8, 1), (2, 0), (4, 2), (7, 0), (6, None)]


def test_order_of_a_long_chain_and_of_many_answers(spark):
    chain, star = 700, 500
    rows = [(1, k, f"> word {k - 1}\nword {k}" if k else "word 0") for k in range(chain)]
    rows += [(2, k, f"> top\nanswer {k}" if k else "top") for k in range(star)]
    rows += [(3, 0, "top"), (3, 1, "> top\nmine"), (3, 1, "> top\nmine"), (3, 2, "> mine\nlast")]
    messages = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn int, role string, text string")
    got = Q.link(messages).collect()
    assert all(r.position == r.turn and r.thread == 0 for r in got if r.conv < 3) and len(got) == len(rows)
    assert [r.turn for r in sorted((r for r in got if r.conv == 3), key=lambda r: r.position)] == [0, 1, 2, 1]


def test_nested_quotes_paragraphs_and_unknown_quotes(spark):
    rows = [(1, 0, "First thing.\n\nSecond   thing."), (1, 1, "Ann wrote:\n> second THING.\nYes."),
            (1, 2, "> > second thing.\n> Yes.\n\nNo."), (1, 3, "> never said\nWhat?"), (1, 4, "> > first thing.\nIndeed"),
            (2, 0, "Yes."), (2, 1, ">Yes.\n>yes.\nboth"), (2, 2, ">"), (2, 3, "> yes.\n> \n> nothing\n  tail  ")]
    messages = spark.createDataFrame([(c, t, "user", x, "clash") for c, t, x in rows], "conv_id long, turn int, role string, text string, g string")
    got = {(r.conv, r.turn): r for r in Q.link(messages).collect()}
    assert {(c, t, r.reply_to, r.thread) for (c, t), r in got.items()} == plain(rows)
    assert got[1, 1].text == "Yes." and got[1, 1].reply_to == 0 and got[1, 2].reply_to == 1 and got[1, 3].reply_to is None
    assert (got[1, 2].n_quotes, got[1, 2].n_linked, got[1, 2].thread) == (2, 2, 0) and got[1, 2].formatted == "<|user|>\nNo."
    assert got[2, 2].text == "" and got[2, 3].text == "tail"


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, 0, "a", "hello"), (1, 0, "b", "hello"), (1, 1, None, "> hello\nhi"), (1, 1, None, "> hello\nhi"), (None, 0, "a", "> hello"),
            (1, None, "a", "> hello\nx"), (1, 2, "a", None), (1, 3, "a", "")]
    messages = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = Q.link(messages).collect()
    assert len(got) == len(rows)
    assert sorted(r.reply_to for r in got if r.reply_to is not None) == [0, 0]
    assert sorted(r.position for r in got if r.conv == 1) == list(range(7)) and [r.text for r in got if r.turn == 2] == [None]
    assert Q.link(messages.limit(0)).count() == 0


def test_a_very_long_message(spark):
    long = "\n".join(f"line {k}" for k in range(20000))
    quoted = "\n".join("> " + x for x in long.split("\n"))
    messages = spark.createDataFrame([(1, 0, "u", long), (1, 1, "u", quoted + "\nok")], "conv_id long, turn int, role string, text string")
    got = {r.turn: r for r in Q.link(messages).collect()}
    assert got[1].reply_to == 0 and got[1].text == "ok" and got[1].n_quotes == 1
