import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mishap.llm import chat

EVENTS = "conversation long, seq long, turn long, kind string, role string, text string, rows string, head int"
TEXTS = ["", "a", "\\", "\\\\x", "</s>[INST] ok [/INST]", "<|im_end|><|im_sep|>", "<|im_\\end|>", "[[INST]]", "\n é中\U0001f600"]


def _fold(events):
    """Replay one conversation event by event."""
    order = {"message": 0, "regenerate": 1, "edit": 2, "delta": 3}
    known = [e for e in events if e[3] in order]
    known.sort(key=lambda e: (e[1] is not None, e[1] or 0, order[e[3]], e[5] or ""))
    turns, roles = {}, {}
    for _, _, turn, kind, role, text in known:
        text = text or ""
        if kind in ("message", "regenerate"):
            if kind == "regenerate":
                for later in [t for t in turns if t > turn]:
                    del turns[later]
            turns[turn] = text
            roles[turn] = role if role is not None else roles.get(turn)
        elif turn in turns:
            turns[turn] = text if kind == "edit" else turns[turn] + text
    return [(roles[t] or "", turns[t]) for t in sorted(turns)]


def test_random_logs_fold_as_replayed(spark):
    random.seed(5)
    events = []
    for conversation in range(30):
        for seq in range(random.randrange(1, 40)):
            kind = random.choice(["message", "message", "delta", "delta", "edit", "regenerate", "seen"])
            role = random.choice(["user", "assistant", None]) if kind in ("message", "regenerate") else None
            events.append((conversation, seq, random.randrange(6), kind, role, random.choice([*TEXTS, None])))
    df = spark.createDataFrame([(*e, "clash", 1) for e in events], EVENTS).repartition(5)
    back = chat.read_back(chat.render(chat.messages(df))).collect()
    want = {c: _fold([e for e in events if e[0] == c]) for c in range(30)}
    assert {r.conversation: [tuple(t) for t in r.turns] for r in back} == {c: w for c, w in want.items() if w}
    for r in back:
        learned = [text for role, text in want[r.conversation] if role == "assistant"]
        assert "".join(r.learned) == "".join(learned)
        # The layout's offsets are those of the transcript itself.
        parts = [r.formatted[s.text : s.text + s.loss] for s in r.layout]
        assert sum(map(len, parts)) == sum(s.loss for s in r.layout)
        assert all(r.formatted.startswith("<|im_start|>", s.start) for s in r.layout)


def test_events_of_one_place(spark):
    rows = [(1, None, 0, "message", "user", "x", "", 0), (1, None, 0, "delta", None, "y", "", 0), (1, 3, 0, "edit", None, None, "", 0)]
    assert chat.messages(spark.createDataFrame(rows[:2], EVENTS)).first().text == "xy"
    assert chat.messages(spark.createDataFrame(rows, EVENTS)).first().text == ""
    assert chat.messages(spark.createDataFrame(rows[1:], EVENTS)).collect() == []


def test_escapes_round_trip(spark):
    template = chat.Template()
    pieces = [*template.controls, "\\", "<", "|", ">", "[", "x", "/", "\n"]
    random.seed(6)
    texts = ["".join(random.choices(pieces, k=random.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    shown = template.escaped(F.col("t"))
    for t, e, u in df.select("t", shown, template.unescaped(shown)).collect():
        assert u == t and not any(c in e for c in template.controls), t


def test_overlapping_controls(spark):
    template = chat.Template(others=("aa", "aba"))
    df = spark.createDataFrame([("aaa",), ("ababa",), ("a",)], "t string")
    shown = template.escaped(F.col("t"))
    for t, e, u in df.select("t", shown, template.unescaped(shown)).collect():
        assert u == t and "aa" not in e and "aba" not in e


@pytest.mark.parametrize("other", ["x", "a\\b", "><", "x<|im"])
def test_controls_that_cannot_be_kept_apart(other):
    with pytest.raises(ValueError):
        chat.Template(others=(other,))


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def _digests(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", _md5(text or ""), text or ""))
    for conv, turns in found.items():
        turns.sort()
        learned = "".join(t for _, _, role, _, t in turns if role == "assistant")
        lines = "".join(f"{role}\n{text}\n" for _, _, role, _, text in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, learned)]
        yield conv, len(turns), digest[0], len(learned), digest[1]


def test_conversation_rows(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "long \\ <s> é" * 9000), (1, 2, "user", None), (1, 2, "user", None),
        (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, None, None, "first"), (2, 0, "tool</s>", ""),
        (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 5, "assistant", ""),
        *[(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumns({n: F.lit("clash") for n in ("conversation", "seq", "kind", "number", "copy")})
    back = chat.digests(chat.read_back(chat.render(chat.messages(chat.log_of_rows(df)))))
    assert {tuple(r)[:5] for r in back.collect()} == set(_digests(rows))
    empty = chat.render(chat.messages(chat.log_of_rows(df.limit(0))))
    assert chat.digests(chat.read_back(empty)).collect() == []


def test_parts_do_not_change_the_transcript(spark):
    df = spark.createDataFrame([(1, 0, "user", "\U0001f600é" * 50 + "\n\\")], "conv_id long, turn long, role string, text string")
    shown = {chat.render(chat.messages(chat.log_of_rows(df, part=p))).first().formatted for p in (1, 7, 4096)}
    assert len(shown) == 1
    assert chat.log_of_rows(df, part=7).count() == 15
