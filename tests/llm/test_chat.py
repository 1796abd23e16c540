import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from panelwright.llm.chat import (
    CONTROLS,
    FORGED,
    PART,
    Digest,
    digest_conversations,
    escape,
    format_message,
    format_turns,
    text_part,
    unescape,
)

PIECES = [*CONTROLS, "\\", "\\\\", "[\\INST]", "<", "[", "|>", "/", "é", "\n", "a", "<|", "s>", "🎉"]


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
        out = escape(text)
        assert unescape(out) == text
        assert not any(c in out for c in CONTROLS)


def part(kind, **values):
    return {"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | values


def test_parts_are_visited_in_order():
    parts = [
        part("text", text="see </s> "),
        part("image", ref="a.png", width=56, height=29),
        part("audio", ref="b.wav", seconds=2.02),
        part(None, text="and"),
        part("document", ref="c.pdf", pages=3),
        part("image"),
    ]
    out, loss, attachments = format_message("assistant", parts, trained=True)
    assert out == "<|turn|>assistant<|text|>see <\\/s> <|image|><|audio|>and<|document|><|image|><|end|>"
    assert [out[a:b] for a, b in loss] == ["see <\\/s> ", "and"]
    assert [(p, k, r, t) for p, k, r, _, t in attachments] == [
        (1, "image", "a.png", 4),
        (2, "audio", "b.wav", 51),
        (4, "document", "c.pdf", 1536),
        (5, "image", None, 1),
    ]
    assert all(out[at:].startswith(f"<|{k}|>") for _, k, _, at, _ in attachments)
    with pytest.raises(ValueError):
        format_message("user", [part("smell")], trained=False)


def test_broken_turn_is_noticed():
    state = Digest()
    state.feed("<|turn|>user<|text|>no end", [])
    with pytest.raises(ValueError):
        state.row(1)


def sha(text):
    return sha256(text.encode()).hexdigest()


def brute(rows):
    """{conv_id: digest} from (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        spoken = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (
            len(turns),
            sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)),
            len(spoken),
            sha(spoken),
            sum(len(escape(r[2] or "") + escape(r[3] or "")) + 23 for r in turns),
        )
    return out


def test_conversations_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i} {rng.choice(PIECES)}") for i in range(3000)]
    for conv in range(2, 40):
        for turn in rng.sample(range(20), rng.randrange(1, 9)):
            text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(12)))
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "a\nb<|text|>"]), text))
    rows += [(-1, 0, "user", FORGED), (-1, 1, "assistant", FORGED)]
    rows += [(50, 0, "assistant", None), (50, 1, None, "x"), (50, None, "user", ""), (None, 0, "assistant", "lost")]
    rows += [(51, 0, "assistant", "same"), (51, 0, "assistant", "same"), (52, 0, "assistant", "long " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("parts", text_part(F.col("text"))).withColumn("formatted", F.lit("clash")).withColumn("loss", F.lit(1))
    got = digest_conversations(format_turns(df)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_attachments_in_frames(spark):
    schema = f"conv_id long, turn long, role string, parts array<{PART}>"
    rows = [
        (1, 0, "user", [("image", None, "x.png", 28, 28, None, None), ("text", "what?", None, None, None, None, None)]),
        (1, 1, "assistant", None),
    ]
    got = sorted(format_turns(spark.createDataFrame(rows, schema)).collect(), key=lambda r: r["turn"])
    assert got[0]["formatted"] == "<|turn|>user<|text|><|image|>what?<|end|>" and got[0]["loss"] == []
    assert [(a["ref"], a["tokens"]) for a in got[0]["attachments"]] == [("x.png", 1)] and got[0]["extra_tokens"] == 0
    assert got[1]["formatted"] == "<|turn|>assistant<|text|><|end|>"
    empty = spark.createDataFrame([], schema)
    assert digest_conversations(format_turns(empty)).collect() == []
