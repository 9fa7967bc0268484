import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm.phrases import Words, collocations, frequent_phrases

DOCS = "doc_id long, text string, lang string, word string, n long, size int, rank int, score string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, "w", 1, 2, 3, "s") for i, (t, lang) in enumerate(rows)], DOCS).repartition(parts)


def brute(rows, threshold, top=2000):
    texts, out = defaultdict(list), []
    for text, lang in rows:
        texts["und" if lang is None else lang].append(text or "")
    for lang, own in texts.items():
        f, n = Counter(), 0
        for t in own:
            t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", t):
                w = re.findall("[^ \t]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        longer = {}
        for p, a in kept.items():
            for q in (p[:2], p[1:]) if len(p) == 3 else ():
                longer[q] = max(longer.get(q, 0), a)
        rows_ = []
        for p, a in kept.items():
            if 100 * longer.get(p, 0) < 50 * a:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def corpus(seed, n=150):
    draw = np.random.default_rng(seed)
    word = lambda: f"w{min(int(draw.zipf(1.5)), 60)}"
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!?", " ", "; "]
    rows = [("".join(x for _ in range(draw.integers(0, 60)) for x in (word(), gaps[draw.integers(0, len(gaps))])),
             ["en", "de", None][draw.integers(0, 3)]) for _ in range(n)]
    rows += [("New York City, the BIG one. É É É", "en")] * 12 + [(None, "en"), ("", None), (" \t.", "de"), ("a a a a a a a a a a a a a", "und")]
    return rows


@pytest.mark.parametrize("seed, shards, slots, size", [(1, 2, 1 << 23, 4 << 20), (2, 3, 1 << 15, 300), (3, 1, 1 << 16, 1), (4, 5, 1 << 10, 1000)])
def test_against_brute_force(spark, seed, shards, slots, size):
    rows = corpus(seed)
    got = sorted(tuple(r) for r in collocations(frame(spark, rows), threshold=6, shards=shards, slots=slots, size=size).collect())
    assert got == brute(rows, 6)


def test_top_and_ties(spark):
    rows = [(f"x{k} y{k} . " * 10, "en") for k in range(30)]
    got = sorted(tuple(r) for r in collocations(frame(spark, rows), top=7).collect())
    assert got == brute(rows, 10, 7) and [r[2] for r in got] == sorted(f"x{k} y{k}" for k in range(30))[:7]


def test_a_phrase_that_becomes_frequent_late_has_its_whole_count(spark):
    # the words of a late pair reach the threshold only in the last shard; its cycle then starts over
    rows = [("alpha beta gamma", "en") for _ in range(11)] + [("filler", "en")] * 300
    for shards in (2, 4):
        found, totals = frequent_phrases(frame(spark, rows, 1), 10, 3, shards)
        got = {(r.size, r.n) for r in found.collect()}
        assert got == {(1, 11), (1, 300), (2, 11), (3, 11)} and totals.first().n_words == 333


def test_long_text_and_long_words(spark):
    rows = [("so long a text " * 40000, "en"), ("z" * 300000 + " z", "en"), ("日本語の文章" * 2000, "ja")]
    got = sorted(tuple(r) for r in collocations(frame(spark, rows, 1)).collect())
    assert got == brute(rows, 10)


def test_words_of_a_slice():
    data = b"Ab,cd  ef\nEF"
    w = Words(np.frombuffer(data, np.uint8), np.array([0, 9, 9, 12]), np.zeros(3, np.uint64))
    assert [w.text(i) for i in range(4)] == [b"ab", b"cd", b"ef", b"ef"]
    assert w.joined.tolist() == [False, True, False] and w.row.tolist() == [0, 0, 0, 2] and w.hashes[2] == w.hashes[3]


def test_empty_table(spark):
    assert collocations(frame(spark, [], 1)).count() == 0
    assert collocations(frame(spark, [(None, None)], 1)).count() == 0
