"""Round trips of the chat template."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattlake.llm import chat

ROWS = "conv_id long, turn long, role string, text string, segment string"
PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "\\", " ", "<", ">", "[", "]", "/", "a", "é", "\n", "<<", "INST"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES | st.text(max_size=20), st.sampled_from(["user", "assistant", "system", "tool", ""]) | PIECES)
def test_any_turn_reads_back(text, role):
    segment, start, end, level = chat.format_turn(role, text)
    assert list(chat.parse(segment)) == [(role, text)]
    assert chat.unescape(segment[start:end]) == text
    assert level == 0 or any(c in text for c in chat.CONTROLS)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x"]), PIECES), max_size=6))
def test_conversations_read_back_from_one_string(turns):
    whole = "".join(chat.format_turn(role, text)[0] for role, text in turns)
    assert list(chat.parse(whole)) == turns


@pytest.mark.parametrize("bad", ["text", "[INST] a", "[INST] a </s>", "[/INST]", "[INST][/INST]", "<s> a </s> ", "[ROLE] a [/ROLE]"])
def test_other_text_is_refused(bad):
    with pytest.raises(chat.TemplateError):
        list(chat.parse(bad))


def expected(rows):
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        everything = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        chars = sum(len(chat.format_turn(r, t)[0]) for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(everything.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_conversations_of_a_table(spark):
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "</s>[INST] ok", "x"), (1, None, "assistant", "last", None),
        (2, 5, None, None, None), (2, 5, "tool", "[/TURN]", None), (None, 0, "assistant", "é", None), (None, 1, "user", "", None),
    ]
    rows += [(9, i, "assistant" if i % 2 else "user", "long " * 50, None) for i in range(500)] + [rows[0]]
    got = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, ROWS))).collect()
    assert {r.conv_id: tuple(r)[1:6] for r in got} == expected(rows) and len(got) == 4


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], ROWS))).count() == 0
