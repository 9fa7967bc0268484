import hashlib
import random
import zlib

import numpy as np

from strata.llm.prefix_trie import (block_nodes, common_units, extents, prefix_trie, range_minimum, sparse_table, spliced, trie,
                                    turn_units)

TURNS = "conv_id long, turn long, role string, text string, place int, unit string, name binary, n int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x", b"y", 1) for r in rows], TURNS).repartition(parts)


def in_order(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in talks.items()}


def brute(talks):
    nodes = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    saved, leaves = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = children.get(p, [])
        saved[p] = (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[b] for b in below)
        leaves[p] = sum(leaves[b] for b in below) or 1
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(talks[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), leaves[p],
                    saved[p], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def digest(df):
    empty = hashlib.sha256().hexdigest()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                    r.ends.hex() if r.ends is not None else empty) for r in df.collect()), key=repr)


def rebuilt(talks, group=5, heads=9):
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % heads
        host = talks.get(c - c % group, [])
        out[c] = host[:h] + own[h:]
    return out


def random_rows(draw, convs, deep=7, words=("a", "b", "")):
    rows = []
    for c in range(convs):
        rows += [(c, t, draw.choice(["user", "bot", None]) if t % 3 else "user", draw.choice(words)) for t in range(draw.randrange(1, deep))]
    return rows


def test_extents_and_minima_against_scans():
    draw = np.random.default_rng(3)
    common = np.append(-1, draw.integers(0, 5, 60))
    row, depth = np.repeat(np.arange(61), 6), np.tile(np.arange(6), 61)
    left, right = extents(common, row, depth)
    for r, d, a, b in zip(row, depth, left, right):
        lo = hi = r
        while lo > 0 and common[lo] >= d:
            lo -= 1
        while hi < 60 and common[hi + 1] >= d:
            hi += 1
        assert (a, b) == (lo, hi)
    values = draw.integers(0, 1000, 61)
    assert (range_minimum(sparse_table(values), left, right) == [values[a:b + 1].min() for a, b in zip(left, right)]).all()
    assert common_units(b"a" * 32, b"a" * 16 + b"b" * 16) == 1 and common_units(b"", b"a" * 16) == 0
    nodes = block_nodes([b""], np.array([4]), np.array([3]), [b"e"])
    assert nodes["depth"].tolist() == [0] and nodes["n_convs"].tolist() == [3] and nodes["conv_id"].tolist() == [4]


def test_against_brute_force(spark):
    for seed, convs in ((1, 40), (2, 120)):
        draw = random.Random(seed)
        rows = random_rows(draw, convs)
        rows += rows[:5]                                                 # repeated rows are turns
        rows += [(None, 0, "user", "a"), (900, None, None, None), (900, 0, "user", "é"), (-7, 3, "user", "a")]
        rows += [(1000 + k, t, "user", "hot") for k in range(200) for t in range(3)]   # one conversation, many ids
        assert digest(prefix_trie(frame(spark, rows))) == brute(in_order(rows))


def test_small_blocks_long_talks_and_id_pieces(spark):
    draw = random.Random(5)
    rows = random_rows(draw, 60)
    talk = [(t, "user", f"t{t % 9}") for t in range(300)]
    rows += [(2000, *t) for t in talk] + [(2001, *t) for t in talk[:299]] + [(2002, *t) for t in talk[:140]] + [(2002, 500, "bot", "z")]
    rows += [(3000 + k, 0, "user", "hot") for k in range(150)]
    assert digest(trie(turn_units(frame(spark, rows), together=4), block=200, id_text=40)) == brute(in_order(rows))


def test_rebuilt_conversations(spark):
    draw = random.Random(8)
    rows = [r for r in random_rows(draw, 90, 10) if r[0] % 10 != 5]      # some hosts are absent
    rows += [(0, None, "user", "first")]
    talks = in_order(rows)
    assert any(not t for t in rebuilt(talks).values())                    # turnless ones are members of the root
    assert digest(trie(spliced(turn_units(frame(spark, rows))))) == brute(rebuilt(talks))


def test_empty_table(spark):
    assert prefix_trie(frame(spark, [], 1)).count() == 0
    assert trie(spliced(turn_units(frame(spark, [(None, 0, "user", "a")], 1)))).count() == 0
