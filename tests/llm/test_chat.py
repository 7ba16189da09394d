from __future__ import annotations

from parampipe.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, spans int, piece string"


def brute(rows, chunk):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(r[1] is None, r[1] or 0, r[2] or "unknown", r[3] or "") for r in rows if r[0] == conv]
        for view in {s for _, _, s, _ in own if s != "system"}:
            at, parts = 0, {}
            for _, _, s, text in sorted(own):
                head = "system" if s == "system" else "assistant" if s == view else "user name=" + s
                opening = f"<|im_start|>{head}\n"
                piece = opening + text + "<|im_end|>\n"
                spans = [(at + len(opening), at + len(piece) - 1)] if s == view else []
                key = parts.setdefault(at // chunk, ["", [], 0])
                key[0], key[1], key[2] = key[0] + piece, key[1] + spans, key[2] + 1
                at += len(piece)
            out.update({(conv, view, k): tuple(v) for k, v in parts.items()})
    return out


def run(spark, rows, chunk=chat.CHUNK):
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)
    found = chat.dialogues(chat.messages(df), chunk).collect()
    return {(r.conv_id, r.perspective, r.chunk): (r.text, [tuple(s) for s in r.spans], r.n_messages) for r in found}


def test_every_speaker_sees_the_dialogue(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé😀llo"), (1, 3, "ann", "bye")]
    found = run(spark, rows)
    assert found == brute(rows, chat.CHUNK)
    text, spans, _ = found[1, "bob", 0]
    assert [text[a:b] for a, b in spans] == ["hé😀llo<|im_end|>"]


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "ann", "last"), (1, 0, "ann", ""),
        (None, 5, "ann", "no conversation"), (2, 0, "system", "alone"), (3, 1, "x", "t" * 5000),
    ]
    assert run(spark, rows) == brute(rows, chat.CHUNK)
    assert (2, "system", 0) not in run(spark, rows)


def test_long_dialogue_in_chunks(spark):
    rows = [(7, t % 150, ["ann", "bob", "cy"][t % 3], f"turn {t}") for t in range(400)]
    assert run(spark, rows, 500) == brute(rows, 500)


def test_empty(spark):
    assert run(spark, []) == {}
