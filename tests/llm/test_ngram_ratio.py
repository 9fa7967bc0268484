import random
import re
from collections import Counter

import numpy as np

from strata.llm import ngram_ratio as R
from strata.llm.words import hash_words

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORDS.findall(text)
    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def corpus():
    draw = random.Random(4)
    good = lambda n: [f"g{draw.randrange(60)}" for _ in range(n)]
    texts = [" ".join(good(draw.randrange(40, 300))) for _ in range(80)]
    bad = [" ".join(w if draw.random() < 0.9 else f"vile{draw.randrange(3)}" for w in good(120)) for _ in range(40)]
    odd = [None, "", " \n\t\x0b", "a a a a", "x\ny\nx\n \nx", "é|ß* 日本 &<>", "line one\nline one\n" * 30, "w " * 60]
    return texts, bad, odd


def score(text, table):
    data = np.frombuffer((text or "").encode(), np.uint8)
    words, _ = hash_words(data, np.array([0, len(data)]), fold=False)
    return float(table[R.gram_slots(words)].mean(dtype=np.float64)) if len(words) else 0.0


def test_rules_and_ratio_against_brute_force(spark, documents):
    good, bad, odd = corpus()
    texts = good + bad + odd
    docs = documents(texts)
    trusted = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    raw, target = np.zeros(R.SLOTS), np.zeros(R.SLOTS)
    for i, t in enumerate(texts):
        data = np.frombuffer((t or "").encode(), np.uint8)
        words, _ = hash_words(data, np.array([0, len(data)]), fold=False)
        for s in R.gram_slots(words) if len(words) else []:
            raw[s] += 1
            target[s] += i < 50
    share = target.sum() / raw.sum()
    expected = raw * share
    table = np.where((target - expected) ** 2 > R.SURE * expected * (1 - share),
                     np.log((target + R.PRIOR) / (expected + R.PRIOR)), 0).astype(np.float32)
    rows = {r.doc_id: r for r in R.score_documents(docs, trusted).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(t), (i, t)
        assert abs(r.score - score(t, table)) < 1e-6
        assert r.kept == (not r.base_failed and r.score >= R.THRESHOLD)
    assert not any(rows[80 + k].kept for k in range(40))
    long = [i for i, t in enumerate(good) if i >= 50 and not counts(t)[-1]]
    assert long and all(rows[i].kept for i in long)


def test_no_trusted_and_empty(spark, documents):
    nobody = spark.createDataFrame([], "doc_id long")
    rows = R.score_documents(documents([" ".join(f"a{i}" for i in range(60)), None], ids=[3, 3]), nobody).collect()
    assert sorted((r.score, r.kept) for r in rows) == [(0.0, False), (0.0, True)]
    assert R.score_documents(documents([]), nobody).count() == 0
