import random

from strata.llm.snapshots import collapse_and_render, maximal_conversations

TURNS = "conv_id long, turn long, role string, text string, n_turns int, rendered string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def brute(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        talks.setdefault(conv, {}).setdefault(turn, set()).add((role, text))
    states = {c: [(t, frozenset(turns[t])) for t in sorted(turns, key=lambda t: (t is not None, t))] for c, turns in talks.items()}
    out = {}
    for c, s in states.items():
        longer = any(o[:len(s)] == s and len(o) > len(s) for o in states.values())
        same = sorted((k for k, o in states.items() if o == s), key=lambda k: (k is None, k))
        if not longer and same[0] == c:
            out[c] = (len(s), len(same))
    return out


def test_against_brute_force(spark):
    for seed in range(4):
        draw = random.Random(seed)
        rows = []
        for base in range(12):
            talk = [(t, draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "c", None, ""])) for t in range(draw.randrange(1, 7))]
            for k in range(draw.randrange(1, 4)):
                cut = draw.randrange(1, len(talk) + 1)
                rows += [(base * 10 + k, *t) for t in talk[:cut]]
        rows += rows[:9]                                    # repeated rows
        rows += [(None, 0, "user", "a"), (500, None, "user", "z"), (501, 3, "user", "x"), (501, 3, "user", "y")]
        got = {r.conv_id: (r.n_turns, r.n_same) for r in maximal_conversations(frame(spark, rows)).collect()}
        assert got == brute(rows), seed


def test_long_talks_cross_blocks(spark):
    talk = [(t, "user", f"t{t}") for t in range(700)]
    rows = [(1, *t) for t in talk] + [(2, *t) for t in talk[:512]] + [(3, *t) for t in talk[:511]] + [(3, 511, "user", "else")]
    got = {r.conv_id: r.n_turns for r in maximal_conversations(frame(spark, rows)).collect()}
    assert got == {1: 700, 3: 512}


def test_rendering_and_empty(spark):
    rows = [(1, 1, "assistant", "yes"), (1, 0, "user", "no?"), (2, 0, "user", "no?"), (3, 0, None, None)]
    got = {r.conv_id: r.rendered for r in collapse_and_render(frame(spark, rows)).collect()}
    assert got == {1: "<|user|>\nno?\n<|assistant|>\nyes\n", 3: "<||>\n\n"}
    assert collapse_and_render(frame(spark, [])).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = collapse_and_render(frame(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
