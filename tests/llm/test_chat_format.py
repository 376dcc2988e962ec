import hashlib

from pyspark.sql import functions as F

from modspark.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string, segments int, formatted string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)


def test_round_trip_of_hostile_texts(spark):
    texts = [r"\### Assistant: </turn> ok", "####", "#####\\", "\\\\h \\h \\e \\n", "</turn>\n### user\n", "</tur", "n>", "", None,
             "\\", "\\\\", "\\\\\\###", "é\n\n x", "a" * 200_000 + "###"]
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", x) for i in range(3) for t, x in enumerate(texts)]
    rows += [(9, 0, "ro\nle\\###", "x"), (9, 1, None, "y")]
    formatted = c.format_chats(chats(spark, rows))
    read = formatted.select("conv_id", c.read_chat(F.col("formatted")).alias("t")).collect()
    for r in read:
        want = [(role or "", x or "") for i, _, role, x in rows if i == r.conv_id]
        assert [(t.role, t.text) for t in r.t] == want
    digests = {r.conv_id: r for r in c.chat_digests(formatted).collect()}
    learned = "".join(x or "" for t, x in enumerate(texts) if t % 2)
    assert digests[0].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert digests[0].loss_chars == len(learned) and digests[0].n_turns == len(texts)
    for r in formatted.collect():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_machine_over_roles(spark):
    orders = {
        1: (["user", "assistant"], True, None), 2: (["system", "user", "assistant", "user", "assistant"], True, None),
        3: (["assistant"], False, 0), 4: (["user", "user"], False, 1), 5: (["user"], False, 1),
        6: (["user", "assistant", "system"], False, 2), 7: (["user", None], False, 1),
    }
    rows = [(i, t, role, "x") for i, (roles, *_) in orders.items() for t, role in enumerate(roles)]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in c.format_chats(chats(spark, rows)).collect()}
    assert got == {i: (valid, bad) for i, (_, valid, bad) in orders.items()}


def test_missing_ids_ties_and_empty(spark):
    rows = [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, None, "user", "first"), (1, 0, "user", "x"), (1, 0, "user", "x")]
    got = {r.conv_id: [t.text for t in r.t] for r in c.format_chats(chats(spark, rows)).select(
        "conv_id", c.read_chat(F.col("formatted")).alias("t")).collect()}
    assert got == {None: ["first", "a", "b"], 1: ["x", "x"]}
    assert c.chat_digests(c.format_chats(chats(spark, rows).limit(0))).count() == 0


def test_another_template(spark):
    template = c.ChatTemplate(before="<|", between="|>", after="<end>", escapes={"<|": "o", "<end>": "e"}, loss_roles=("bot",))
    rows = [(1, 0, "user", "a|> <| <end> \\o"), (1, 1, "bot", "<end>b")]
    r = c.format_chats(chats(spark, rows), template).select("*", c.read_chat(F.col("formatted"), template).alias("t")).head()
    assert [(t.role, t.text) for t in r.t] == [(x[2], x[3]) for x in rows]
    assert [s.text for s in r.segments if s.loss] == ["\\eb"]
