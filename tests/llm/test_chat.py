import cases

from meterqa.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n int, conv string"


def table(spark, chats):
    rows = [(c, t, r, x, 1, "z") for c, turns in chats for t, r, x in turns]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute(chats):
    convs = {}
    for c, turns in chats:
        convs.setdefault(c, []).extend(turns)
    key = lambda t: (t[0] is not None, t[0] or 0, t[1] or "unknown", t[2] or "")
    convs = {c: tuple((t, r or "unknown", x or "") for t, r, x in sorted(turns, key=key)) for c, turns in convs.items()}
    out = []
    for c, turns in convs.items():
        equal = [d for d, o in convs.items() if o == turns]
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values())
        if not longer and c == min(equal, key=lambda d: (d is not None, d or 0)):
            text = "".join(f"<|{r}|>\n{x.replace('<|', '<' + chr(92) + '|')}\n<|end|>\n" for _, r, x in turns)
            out.append((c, len(turns), len(equal), text))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_snapshots_against_brute_force(spark):
    talk = [(0, "user", "hi"), (1, "assistant", "hello"), (2, "user", None), (3, None, "<|end|> trick")]
    long = [(i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(1300)]
    chats = [
        (1, talk[:1]), (2, talk[:2]), (3, talk), (4, talk), (5, [(0, "user", "hi"), (1, "assistant", "other")]),
        (6, long[:700]), (7, long), (8, long[:512]), (9, long[:512] + [(512, "user", "else")]),
        (None, [(0, "user", "nobody")]), (10, [(0, "user", ""), (0, "user", "")]), (11, [(0, "user", "")]),
        (12, [(None, "user", "first"), (0, "user", "hi")]), (13, [(0, "assistant", "hi")]),
        (14, [(0, "user", "x" * 200_000)]),
    ]
    got = chat.rendered(table(spark, chats))
    assert cases.tuples(got, "conv_id", "n_turns", "n_copies", "chat") == brute(chats)


def test_place_and_not_number_decides(spark):
    """Shifted numbers, gaps of a span or more, and a null number are the same places in a conversation."""
    roles = ("user", "assistant")
    turns = [(roles[i % 2], f"turn {i}") for i in range(601)]
    numbered = lambda first, step, n: [(first + step * i, *turns[i]) for i in range(n)]
    chats = [
        (1, numbered(0, 1, 600)), (2, numbered(1, 1, 601)),
        (3, [(0, "user", "gap"), (5000, "assistant", "b")]), (4, [(7, "user", "gap"), (8, "assistant", "b")]),
        (5, [(None, "user", "null")]), (6, [(3, "user", "null"), (4, "assistant", "c")]),
    ]
    got = chat.rendered(table(spark, chats)).select("conv_id", "n_turns", "n_copies").collect()
    assert sorted(tuple(r) for r in got) == [(2, 601, 1), (3, 2, 2), (6, 2, 1)]


def test_tied_numbers_against_the_sql(spark):
    """Turns of one number, in the order of role and text wherever they count."""
    import random

    import duckdb

    from meterqa.llm.queries import ORACLES

    rng = random.Random(12)
    chats = []
    for c in range(0, 400, 2):
        turns = [(rng.choice([None, 0, 0, 1, 600]), rng.choice(["user", "assistant"]), rng.choice("ab") * rng.randint(0, 2)) for _ in range(rng.randint(1, 3))]
        chats += [(c, turns), (c + 1, turns + [(rng.choice([0, 1, 700]), "user", rng.choice("abc"))])]
    rows = [(c, t, r, x) for c, turns in chats for t, r, x in turns]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = chat.rendered(table(spark, chats))
    assert cases.tuples(got, "conv_id", "n_turns", "n_copies", "chat") == sorted(
        con.execute(f"SELECT conv_id, n_turns, n_copies, chat FROM ({ORACLES['op3_chat_format']})").fetchall()
    )


def test_empty(spark):
    assert chat.rendered(table(spark, [])).count() == 0


def test_native(spark):
    plan = chat.rendered(table(spark, [(1, [(0, "user", "x")])]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
