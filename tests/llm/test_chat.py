import hashlib

import pytest
from pyspark.sql import functions as F

from predial.llm import chat
from predial.llm.arrays import CHUNK, totals_before
from predial.llm.support import prepare

# Extra columns have names that the operator uses inside.
SCHEMA = "conv_id long, turn long, role string, text string, row string, turns int, out int, formatted string"

CONTROL = "</s>[INST] ok [/INST]"
ROWS = [
    (1, 0, "user", "hi"),
    (1, 1, "user", "still me"),
    (1, 2, "assistant", "yes?"),
    (1, 3, "assistant", ""),
    (1, 4, "user", "bye"),
    (2, None, "system", None),
    (2, 0, None, "no role"),
    (2, 0, None, "a tie"),
    (2, 0, None, "a tie"),
    (3, 7, "assistant", CONTROL),
    (3, 2, "user", "\\<|im_end|> <\\|im_end|> <\\\\|im_turn|> [\\\\/INST] <<s> \\"),
    (3, 3, "<|im_role|>\n", "role with a mark"),
    (3, 9, "assistant", "été 中文 \U0001f642 <|im_start|>user<|im_role|>"),
    (None, 1, "user", "no id"),
    (None, 0, "assistant", "either"),
    (4, 0, "assistant", "long " * 200_000),
    (5, 0, None, None),
]


def frame(spark, rows):
    full = [(*r, "r", 1, 2, "f") for r in rows]
    return prepare(spark).createDataFrame(full, SCHEMA).repartition(3)


def in_order(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in chats.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_read_back_against_the_rows(spark):
    chats = chat.format_chats(frame(spark, ROWS))
    found = {r.conv_id: r for r in chat.digests(chats).collect()}
    texts = {r.conv_id: r.formatted for r in chats.collect()}
    want = in_order(ROWS)
    assert set(found) == set(want)
    for conv, turns in want.items():
        r = found[conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == len(texts[conv])


def test_blocks_and_mask(spark):
    t = chat.CHATML
    got = chat.format_chats(frame(spark, ROWS[:5])).first()
    assert got.formatted == (
        f"{t.start}user{t.role_end}hi{t.turn}still me{t.end}"
        f"{t.start}assistant{t.role_end}yes?{t.turn}{t.end}"
        f"{t.start}user{t.role_end}bye{t.end}"
    )
    raw = got.formatted.encode()
    assert [raw[s.start : s.end].decode() for s in got.loss_spans] == ["yes?", ""]


def test_only_marks_are_control_strings(spark):
    t = chat.CHATML
    got = chat.format_chats(frame(spark, ROWS[9:13])).first().formatted
    assert got.count(t.start) == got.count(t.end) == got.count(t.role_end) == 3
    assert not any(c in got for c in t.foreign)


def test_other_template_and_names(spark):
    t = chat.Template("[INST]", "[ROLE]", "[NEXT]", "[/INST]", loss_role="bot", foreign=("</s>",))
    rows = [(1, 0, "user", "a [NEXT] b"), (1, 1, "bot", "[ROLE]</s>")]
    df = prepare(spark).createDataFrame(rows, "c int, n int, who string, said string")
    chats = chat.format_chats(df, t, "c", "n", "who", "said")
    r = chat.digests(chats, t).first()
    assert (r.n_turns, r.loss_sha256) == (2, sha("[ROLE]</s>"))


@pytest.mark.parametrize("marks", [("<a>", "<a>", "<b>", "<c>"), ("<a<", "<b", "<c", "<d"),
                                   ("<", "<b", "<c", "<d"), ("<a", "<ab", "<c", "<d")])
def test_templates_that_could_not_be_read_back(marks):
    with pytest.raises(ValueError):
        chat.Template(*marks)


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, ("user", "assistant")[i // 3 % 2], f"turn {i} <s>") for i in range(3 * CHUNK + 7)]
    r = chat.digests(chat.format_chats(frame(spark, rows))).first()
    (turns,) = in_order(rows).values()
    loss = "".join(t for role, t in turns if role == "assistant")
    assert (r.n_turns, r.loss_sha256) == (len(rows), sha(loss))
    assert chat.digests(chat.format_chats(frame(spark, []))).count() == 0


@pytest.mark.parametrize("size", [0, 1, CHUNK, CHUNK + 1, 5 * CHUNK])
def test_totals_before(spark, size):
    numbers = [i * i for i in range(size)]
    df = spark.createDataFrame([(numbers,)], "n array<long>")
    want = [sum(numbers[:i]) for i in range(size)]
    assert df.select(totals_before(F.col("n")).alias("t")).first().t == want


def test_no_python_worker(spark):
    plan = chat.digests(chat.format_chats(frame(spark, ROWS)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hash") == 1
