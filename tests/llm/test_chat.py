import random

from quirework.llm.chat import format_chat, read_chat

SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_control_strings_come_back(spark):
    rng = random.Random(4)
    parts = ["<turn:", "</turn>", "<turn", "\\", "<\\turn", "<\\\\/turn>", "\n", ">", "\n</turn>\n", "### Assistant:", "<", "é", " ", "ok", "user>\n"]
    rows, want = [], {}
    for c in range(60):
        talk = []
        for t in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "a>b", "x\\y", "q\n", "\\g", "", "</turn"])
            text = "".join(rng.choices(parts, k=rng.randrange(9)))
            rows.append((c, t, role, text))
            talk.append((role, text))
        want[c] = talk
    rng.shuffle(rows)
    for r in read_chat(format_chat(frame(spark, rows))).collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)


def test_machine(spark):
    talks = {1: "user assistant", 2: "system user assistant user assistant", 3: "user user", 4: "assistant", 5: "user", 6: "user assistant tool", 7: "system assistant"}
    rows = [(c, i, role, "t") for c, roles in talks.items() for i, role in enumerate(roles.split())]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in format_chat(frame(spark, rows)).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 1), 4: (False, 0), 5: (False, 1), 6: (False, 2), 7: (False, 1)}


def test_nulls_ties_and_empty(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "first"), (None, 0, "user", "x"), (2, 0, "assistant", "")]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_chat(format_chat(frame(spark, rows).selectExpr("*", "1 as segments"))).collect()}
    assert got == {1: [("user", "first"), ("", ""), ("", "")], None: [("user", "x")], 2: [("assistant", "")]}
    assert format_chat(frame(spark, rows).limit(0)).count() == 0


def test_a_long_conversation_and_a_long_text(spark):
    long = "a </turn> \\ é" * 150_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "!")] + [(2, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(4_000)]
    got = {r.conv_id: r for r in read_chat(format_chat(frame(spark, rows).selectExpr("*", "1 as turns", "2 as loss_text"))).collect()}
    assert [t.text for t in got[1].turns] == [long, long + "!"] and got[1].loss_text == long + "!"
    assert [t.text for t in got[2].turns] == [f"t{t}" for t in range(4_000)] and got[2].loss_text == "".join(f"t{t}" for t in range(1, 4_000, 2))
