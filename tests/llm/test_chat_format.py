import hashlib
import random

from pyspark.sql import types as T

from quire.llm import chat_format as c
from quire.llm.queries import HOSTILE

ROLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = f"conv_id long, turn long, role string, parts array<{c.PART}>"
NASTY = ["\\", "### ", "</turn>", "<|", "|>", "<", "#", " ", "\n", "a", "é", "😀", ": ", "User", "&", "+", "image:0", "$1"]


def esc(s):
    s = s.replace("\\", "\\\\")
    return s.replace("### ", "##\\# ").replace("</turn>", "<\\/turn>").replace("<|", "<\\|")


def shown(role):
    return ROLES[role] if role in ROLES else "@" + esc(role).replace(": ", ":\\ ")


def brute(rows):
    """Digests of conversations by their definition."""
    chats = {}
    for i, t, r, x in rows:
        chats.setdefault(i, []).append((t is not None, t or 0, r is not None, r or "", x or ""))
    out = {}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, turns in chats.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        text = "".join(f"### {shown(r)}: {esc(x)}</turn>\n" for *_, r, x in turns)
        out[i] = (len(turns), sha(said), len(loss), sha(loss), len(text))
    return out


def digests(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return {r.conv_id: tuple(r)[1:] for r in c.conversation_digests(df).collect()}


def nasty(rng, n):
    return "".join(rng.choice(NASTY) for _ in range(rng.randrange(n)))


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, t, rng.choice([*ROLES, "critic: x", "", "@user", "User", "a</turn>\n### "]), nasty(rng, 12))
            for i in range(40) for t in range(rng.randrange(1, 6))]
    rows += [
        (-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE),
        (50, 0, None, None), (50, None, "assistant", "null turns come first"), (50, 1, "assistant", None),
        (51, 0, "user", "no answer"), (None, 0, "user", "no id"), (None, 1, "assistant", "none"),
        (52, 0, "user", "same"), (52, 0, "user", "same"), (52, 0, "assistant", "tie"),  # ties and repeated rows
        (53, 0, "assistant", "long " * 60_000 + "</turn>"),
    ]
    assert digests(spark, rows) == brute(rows)


def test_many_turns_and_empty_table(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} ### ") for t in range(3000)]
    assert digests(spark, rows) == brute(rows)
    assert digests(spark, []) == {}


def part(kind, text=None, ref=None, **size):
    return (kind, text, ref, size.get("width"), size.get("height"), size.get("seconds"), size.get("pages"))


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 0, "user", [part("text", "see <|"), part("text", "and"), part("image", ref="a.png", width=57, height=28),
                        part("audio", ref="b.wav", seconds=2.0), part("text", "")]),
        (1, 1, "assistant", [part("text", "é<"), part("document", ref="c.pdf", pages=3), part("text", "|x"),
                             part(None, "kind?")]),
        (1, 2, "user", None),
        (1, 3, "assistant", [part("image", ref=None)]),
    ]
    chats = c.format_chats(spark.createDataFrame(rows, PARTS).repartition(2))
    r = chats.first()
    assert r.formatted == (
        "### User: see <\\|<|+|>and<|image:2|><|audio:3|></turn>\n"
        "### Assistant: é<<|document:5|>|x<|+|>kind?</turn>\n"
        "### User: </turn>\n### Assistant: <|image:8|></turn>\n"
    )
    got = [(a.turn, a.number, a.kind, a.ref, a.tokens) for a in r.attachments]
    assert got == [(0, 2, "image", "a.png", 3), (0, 3, "audio", "b.wav", 25), (1, 5, "document", "c.pdf", 768),
                   (3, 8, "image", None, 1)]
    assert r.attached_tokens == 797
    for a in r.attachments:
        assert r.formatted[a.start:].startswith(f"<|{a.kind}:{a.number}|>")
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["é<", "|x", "kind?"]
    back = c.read_chats(chats).first()
    assert [(t.role, [(p.kind, p.text, p.number) for p in t.parts]) for t in back.turns] == [
        ("user", [("text", "see <|", None), ("text", "and", None), ("image", None, 2), ("audio", None, 3)]),
        ("assistant", [("text", "é<", None), ("document", None, 5), ("text", "|x", None), ("text", "kind?", None)]),
        ("user", []),
        ("assistant", [("image", None, 8)]),
    ]
    assert back.loss_text == "é<|xkind?"


def test_random_parts_come_back(spark):
    rng = random.Random(8)
    make = lambda: part("text", nasty(rng, 6)) if rng.random() < 0.6 else part(rng.choice(["image", "audio", "document"]))
    rows = [(i, t, rng.choice([*ROLES, "x: <|"]), [make() for _ in range(rng.randrange(5))])
            for i in range(30) for t in range(3)]
    back = {r.conv_id: r for r in c.read_chats(c.format_chats(spark.createDataFrame(rows, PARTS))).collect()}
    for i in range(30):
        said = {t: (r, [(p[0], p[1]) for p in ps if p[0] != "text" or p[1]]) for j, t, r, ps in rows if j == i}
        got = {t: (x.role, [(p.kind, p.text) for p in x.parts]) for t, x in enumerate(back[i].turns)}
        assert got == said


def test_extra_columns_with_clashing_names(spark):
    schema = T.StructType(
        [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
         T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
        + [T.StructField(n, T.StringType()) for n in ("seq", "line", "start", "pieces", "parts", "kept", "formatted", "base")]
    )
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame([(*r, *"12345678") for r in rows], schema)
    assert {r.conv_id: tuple(r)[1:] for r in c.conversation_digests(df).collect()} == brute(rows)


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    plan = c.conversation_digests(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
