import hashlib
import json

import pytest

from threadsift.llm import chat

ROWS = "conv_id long, turn long, role string, text string, piece int"


def expected(rows):
    convs = {}
    for n, (conv, turn, role, text) in enumerate(rows):
        key = (conv,) if conv is not None else (None, n)
        convs.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for (conv, *_), turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out.append((str(conv), len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out)


def result(frame):
    return sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect())


def test_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "\\", "\\<s>", "<\\s>", "<<SYS>>x<</SYS>>", "[INST][INST]", "<s", "s>", "a\nb\\", "é😀 ", "<</s>", "[[/INST]", ""]
    rows = [(i, t, role, text) for i, text in enumerate(hard) for t, role in enumerate(("user", "assistant", "assistant"))]
    rows += [(50, 1, "tool [INST]", None), (50, None, None, "first"), (50, 0, "assistant", "b"), (50, 0, "assistant", "a"), (50, 0, "assistant", "a")]
    rows += [(None, 0, "assistant", "alone"), (None, 0, "assistant", "alone"), (60, 0, "user", "no answer")]
    table = spark.createDataFrame([(*r, 1) for r in rows], ROWS)
    formatted = chat.format_turns(chat.canonical_turns(table)).cache()
    assert result(chat.read_back(formatted)) == expected(rows)
    for r in formatted.collect():
        marks = sum(r.piece.count(c) for c in chat.CONTROL)
        assert marks == 4 and r.piece.startswith(chat.OPEN) and r.piece.endswith(chat.CLOSE)
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: r.turn_no):
        whole.setdefault(r.conv_key, "")
        assert len(whole[r.conv_key]) == r.at
        whole[r.conv_key] += r.piece
    assert {r.formatted_chars for r in chat.read_back(formatted).collect()} == {len(x) for x in whole.values()}


def test_no_turns(spark):
    assert chat.read_back(chat.format_turns(chat.canonical_turns(spark.createDataFrame([], ROWS)))).collect() == []


@pytest.mark.parametrize(
    ("schema", "row", "turns"),
    [
        ("id long, messages array<struct<role:string,content:string>>", (1, [("user", "a"), ("assistant", None)]), [("user", "a"), ("assistant", "")]),
        ("id long, conversations array<struct<from:string,value:string>>", (1, [("human", "a"), ("gpt", "b")]), [("user", "a"), ("assistant", "b")]),
        ("id long, prompt string, response string", (1, "a", "b"), [("user", "a"), ("assistant", "b")]),
        ("id long, instruction string, input string, output string", (1, "a", None, "c"), [("user", "a"), ("assistant", "c")]),
        ("id long, system string, question string, answer string, extra int", (1, "s", "a", "b", 3), [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ],
)
def test_layouts_of_tables(spark, schema, row, turns):
    got = chat.canonical_turns(spark.createDataFrame([row], schema)).orderBy("turn").collect()
    assert [(r.role, r.text) for r in got] == turns and {r.conv_id for r in got} == {1}


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "a long, b string"))


def test_mixed_json_records(spark):
    records = [
        json.dumps({"id": "1", "messages": [{"role": "user", "content": "hi"}, {"content": "yes", "role": "assistant"}]}),
        json.dumps({"id": "2", "prompt": "p", "response": "r"}),
        json.dumps({"output": "o", "instruction": "i", "input": None, "id": "3"}),
        json.dumps({"id": "4", "something": 1}),
        "{broken",
        None,
    ]
    rows = chat.canonical_json_turns(spark.createDataFrame([(r,) for r in records], "j string"), "j").collect()
    got = sorted((r.conv_id or "", r.layout or "", -1 if r.turn is None else r.turn, r.role or "", r.text or "") for r in rows)
    assert got == [
        ("", "", -1, "", ""), ("", "", -1, "", ""), ("", "", -1, "", ""),
        ("1", "messages", 0, "user", "hi"), ("1", "messages", 1, "assistant", "yes"),
        ("2", "prompt", 0, "user", "p"), ("2", "prompt", 1, "assistant", "r"),
        ("3", "instruction", 0, "user", "i"), ("3", "instruction", 1, "assistant", "o"),
    ]
