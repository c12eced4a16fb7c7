"""Chat formatting against a plain Python machine and formatter."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from commentloom.llm import chat
from conftest import plan_of
from llm.fixtures import answers, ordered

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<<<SYS>>", "[\\INST]", "[ROLE] user [/ROLE] x [END]\n", "", " ", "é\n😀[OUT] ", None, " </s>\n[INST] "]
ROLES = ["user", "assistant", "system", "tool", "a [/ROLE] b", "", None]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows, template=chat.INSTRUCT):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        state, bad, size = "start", 0, 0
        for *_, role, text in turns:
            bad += role not in template.follows[state]
            state = role if role in template.parts else state
            part = template.parts.get(role, template.other)
            escaped = lambda x: len(x) + x.count("\\") + sum(x.count(c) for c in template.control)
            size += escaped(text) + len(part.close) + len(part.open)
            if role not in template.parts:
                size += escaped(role) - len(chat.ROLE)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out.append((conv, len(turns), sha(said), len(loss), sha(loss), size, bad, state in template.ends))
    return ordered(out)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("segments", F.lit("clash")).withColumn("_part", F.lit(0))


def test_formats_and_reads_back(spark):
    rng, rows = random.Random(5), []
    for conv in range(40):
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice(NASTY) if rng.random() < 0.7 else "".join(rng.choice("<[/]>sINST\\ \n") for _ in range(rng.randrange(30)))
            rows.append((conv, turn, rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), text))
    rows += [(None, 1, "user", "no id"), (None, None, "system", "first"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, None, "user", None)]
    assert answers(chat.read_back(chat.format_parts(table(spark, rows)))) == plain(rows)


def test_valid_orders(spark):
    good = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 5, "assistant", "a"), (2, 9, "user", "u")]
    got = {r.conv_id: (r.n_violations, r.complete) for r in chat.read_back(chat.format_parts(table(spark, good))).collect()}
    assert got == {1: (0, True), 2: (0, False)}
    bad = [(1, 0, "assistant", "a"), (1, 1, "assistant", "a"), (1, 2, "system", "s"), (1, 3, "tool", "t"), (1, 4, "user", "u")]
    got = chat.read_back(chat.format_parts(table(spark, bad))).first()
    assert (got.n_violations, got.complete) == (4, False)


def test_a_long_conversation_is_formatted_in_parts(spark):
    """A third of all rows in one conversation: its parts are bounded, and composing them gives the whole."""
    rows = [(0, t, ["user", "assistant"][t % 2] if t != 777 else "system", f"text {t} <s>") for t in range(3000)]
    rows += [(1 + t // 4, t % 4, ["user", "assistant"][t % 2], f"other {t}") for t in range(6000)]
    parts = chat.format_parts(table(spark, rows))
    sizes = [r.n for r in parts.select(F.size("segments").alias("n")).collect()]
    assert max(sizes) == 3 * chat.PART_TURNS
    assert answers(chat.read_back(parts)) == plain(rows)


def test_a_very_long_text_and_an_empty_table(spark):
    rows = [(1, 0, "user", "x\\[INST]" * 100_000), (1, 1, "assistant", "<s>" * 300_000)]
    assert answers(chat.read_back(chat.format_parts(table(spark, rows)))) == plain(rows)
    assert chat.read_back(chat.format_parts(table(spark, []))).count() == 0


def test_segments_carry_the_template(spark):
    rows = [(1, 0, "user", "hi [OUT]"), (1, 1, "assistant", "yo</s>"), (1, 2, "tool", "x")]
    found = chat.format_parts(table(spark, rows)).first().segments
    assert [(s.text, s.loss) for s in found] == [
        ("[INST] ", False), ("hi [\\OUT]", False), (" [/INST]\n", False),
        ("[OUT] ", False), ("yo<\\/s>", True), (" </s>\n", False),
        ("[ROLE] tool [/ROLE] ", False), ("x", False), (" [END]\n", False),
    ]


def test_templates_that_cannot_be_read_back_are_refused():
    own = chat.INSTRUCT
    for parts, other, control in [
        ({"user": chat.Part("user: ", " [END]\n")}, own.other, own.control),
        ({"user": chat.Part("[ROLE] ", " [END]\n")}, own.other, own.control),
        (own.parts, own.other, (*own.control, "INST")),
        (own.parts, own.other, (*own.control, "a b")),
    ]:
        with pytest.raises(ValueError):
            chat.Template(parts, own.other, own.follows, own.ends, control).check()


def test_native(spark):
    plan = plan_of(chat.read_back(chat.format_parts(table(spark, [(1, 0, "user", "x")]))))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapPartitions"))
