import hashlib

import pytest

from millrace.llm import chat

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


@pytest.mark.parametrize(
    "text",
    ["", "\\", "\\\\<", "</s>[INST] ok [/INST]", "<<SYS>><</SYS>>", "<|turn|>a<|body|>b<|end|>\n", "<\\|x", "[\\INST]", "<<s>", "<|image:0|>", "\n\\\n"],
)
def test_escape_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    for mark in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"):
        assert mark not in escaped


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_are_flattened_in_order(llm):
    parts = [
        part("text", "see <|image:0|> "), part("image", ref="s3://a.png", width=57, height=28), None, part("audio", ref="b.wav", seconds=1.5),
        part("text", None), part("document", ref="c.pdf", pages=3), part("video", ref="d.mp4"), part(None, "end"),
    ]
    frame = llm.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {PARTS}")
    first, second = chat.format_turns(frame.selectExpr("*", "1 AS piece")).orderBy("turn").collect()
    body = first.piece[len("<|turn|>user<|body|>") : -len("<|end|>\n")]
    assert body == "see <\\|image:0|> <|image:0|><|audio:1|><|document:2|><|other:3|>end"
    assert [(a.number, a.type, a.ref, a.tokens) for a in first.attachments] == [
        (0, "image", "s3://a.png", 3), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 768), (3, "other", "d.mp4", 0),
    ]
    assert all(body[a.at :].startswith(f"<|{a.type}:{a.number}|>") for a in first.attachments)
    assert first.expanded_tokens == 3 + 38 + 768
    assert (first.loss_start, first.loss_end) == (None, None)
    assert second.loss_start == second.loss_end == len("<|turn|>assistant<|body|>")
    assert chat.read_piece(first.piece) == ("user", "see <|image:0|> end")


def test_conversations_against_plain_python(llm):
    rows = [
        (1, 1, "assistant", "é\\n</s>"), (1, 0, "user", None), (1, None, "system", "s"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
        (None, 0, None, "x"), (None, 1, "assistant", "y"), (2, 0, "ro<|body|>le", "z" * 300_000), (3, 0, "assistant", ""),
    ]
    rows += [(9, i, "assistant", f"turn {i}") for i in range(2000)]
    frame = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(frame.withColumn("parts", chat.text_part(frame.text)))
    got = {r[0]: tuple(r)[1:] for r in chat.conversations(formatted).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda o: (o[0], o[1] or 0, o[2], chat.escape(o[3])))
        told = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        loss = "".join(x for *_, r, x in own if r == "assistant")
        size = sum(25 + len(chat.escape(r)) + len(chat.escape(x)) for *_, r, x in own) - len(own)
        want[conv] = (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)
    assert got == want


def test_sizes_that_are_no_sizes(llm):
    odd = [float("nan"), float("inf"), -float("inf"), -2.0, 1e300]
    parts = [part("audio", seconds=s) for s in odd] + [part("image", width=-57, height=-28), part("document", pages=-1), part("image", width=10)]
    frame = llm.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {PARTS}")
    row = chat.format_turns(frame).first()
    assert [a.tokens for a in row.attachments] == [0, 0, 0, 0, chat.MOST_TOKENS, 0, 0, 0]
    assert row.expanded_tokens == chat.MOST_TOKENS


def test_no_conversations(llm):
    frame = llm.createDataFrame([], f"conv_id long, turn long, role string, parts {PARTS}")
    assert chat.conversations(chat.format_turns(frame)).count() == 0
