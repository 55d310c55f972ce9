"""Operator 2 against a plain restatement of it."""

import hashlib
import random

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, state string, segments string, loss long"
ODD = ["</s>", "<\\/s>", "<\\\\/s>", "[INST]", "[/INST]", "<<SYS>>", "<", "[", "\\", "[ANS]", "[ROLE]x[/ROLE]", "[/TURN]", "<s>", "ok", "\n", "é漢", "<<<SYS>>>"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def expected(rows, template=chat.DEFAULT):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(t for _, r, x in turns for t, _ in template.segments(r, x))
        out[c] = (c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(said),
                  hashlib.sha256(said.encode()).hexdigest(), len(whole))
    return out


def run(spark, rows):
    return {r.conv_id: r for r in chat.read_back(chat.format_chat(table(spark, rows))).collect()}


def test_escaping_is_reversible_and_leaves_no_control():
    rng, t = random.Random(2), chat.DEFAULT
    for _ in range(5000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 8)))
        hidden = t.escape(text)
        assert t.unescape(hidden) == text
        assert not any(c in hidden for c in t.controls)


def test_random_conversations_come_back(spark):
    rng, rows = random.Random(4), []
    for c in range(120):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "</s>"]),
                         rng.choice([None, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 6)))])))
    got = run(spark, rows)
    assert {c: tuple(r)[:6] for c, r in got.items()} == expected(rows)


def test_order_of_turns(spark):
    good = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 1, "assistant", "a")]
    bad = [(3, 0, "assistant", "a"), (4, 0, "user", "u"), (4, 1, "user", "u"), (5, 0, "user", "u"), (5, 1, "assistant", "a"),
           (5, 2, "system", "late"), (6, 0, "system", "only")]
    got = run(spark, good + bad)
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False}
    assert [got[c].first_bad_turn for c in (3, 4, 5, 6)] == [0, 1, 2, None]


def test_edges(spark):
    rows = [(None, None, None, None), (None, 0, "user", "x"), (1, 5, "user", "z"), (1, 5, "user", "z"), (1, 5, "assistant", "a"),
            (2, 0, "user", "y" * 200_000), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = run(spark, rows)
    assert {c: tuple(r)[:6] for c, r in got.items()} == expected(rows)
    assert got[-7].loss_chars == 21
    assert run(spark, []) == {}


def test_segments_carry_the_loss_flags(spark):
    rows = chat.format_chat(table(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a</s>")])).orderBy("turn_no").collect()
    assert [[(s.text, s.loss) for s in r.segments] for r in rows] == [
        [("<s>[INST] ", False), ("q", False), (" [/INST]", False)], [("[ANS]", False), ("a<\\/s>", True), ("</s>", False)]]
