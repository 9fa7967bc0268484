import math
import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import site_quality as S


def judge(docs, known):
    return S.judge(docs, known, F.col("source"), F.col("lang"))


def keep_wanted(docs, known):
    return S.keep_wanted(docs, known, F.col("source"), F.col("lang"))


def corpus(n=600):
    draw = random.Random(5)
    texts, bad = [], []
    for i in range(n):
        words = [f"g{draw.randrange(400)}" for _ in range(draw.randrange(20, 200))]
        unwanted = i % 4 == 0
        if unwanted:
            for _ in range(1 + len(words) // 40):
                words.insert(draw.randrange(len(words)), draw.choice(["vile", "nasty"]) + draw.choice([",", "", "!"]))
        texts.append(" ".join(words))
        bad.append(int(unwanted))
    return texts, bad


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, unwanted int")


def test_held_out_accuracy(spark, documents):
    texts, bad = corpus()
    docs = documents(texts)
    known = labels(spark, [(i, b) for i, b in enumerate(bad) if i % 8 < 5])
    rows = {r.k0: r for r in judge(docs, known).collect()}
    held = [i for i in range(len(texts)) if i % 8 >= 5]
    right = sum(rows[i].kept != bool(bad[i]) for i in held) / len(held)
    assert right > 0.98
    left = keep_wanted(docs, known)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(len(texts)) if rows[i].kept]


def test_sites_shrink_as_the_formula_says(spark):
    draw = random.Random(1)
    rows = [("big", "a", draw.gauss(2, 1)) for _ in range(300)] + [("clean", "a", draw.gauss(-3, 1)) for _ in range(300)]
    rows += [("clean", "b", 1.0), (None, None, 0.5), ("tiny", "x", -1.0)]
    scored = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k0 long, host string, path string, log_odds double")
    got = {r.k0: r for r in S.combine(scored).collect()}
    q = [1 / (1 + math.exp(-r[2])) for r in rows]
    hosts = {}
    for (h, _, _), x in zip(rows, q):
        hosts.setdefault(h, []).append(x)
    mean = sum(q) / len(q)
    spread = sum(len(v) * (np.mean(v) - mean) ** 2 for v in hosts.values())
    noise = len(hosts) * mean * (1 - mean)
    s = max(1.0, mean * (1 - mean) / ((spread - noise) / len(q)) - 1)
    for i, (h, _, _) in enumerate(rows):
        want = (s * mean + sum(hosts[h]) - q[i]) / (s + len(hosts[h]) - 1)
        assert abs(got[i].host_rate - want) < 1e-9
    assert abs(got[602].host_rate - mean) < 1e-9                    # one document: the corpus rate
    assert got[600].path_rate < 0.2 and got[0].p_unwanted > 1 / (1 + math.exp(-rows[0][2]))


def test_without_labels_everything_stays(spark, documents):
    docs = documents(["a b", None, "", "a b"], ids=[1, 2, None, 1])
    assert keep_wanted(docs, labels(spark, [])).count() == 4
    assert keep_wanted(docs, labels(spark, [(1, 1), (None, 0), (9, None)])).count() == 4
    assert keep_wanted(documents([]), labels(spark, [(1, 1)])).count() == 0


def test_the_sample_is_bounded_and_stable(spark, documents):
    texts, bad = corpus(200)
    known = labels(spark, list(enumerate(bad)) + [(0, 0)])
    a = S.fit_sample(documents(texts), known, fit_rows=80)
    b = S.fit_sample(documents(texts).repartition(5), known.repartition(3), fit_rows=80)
    assert np.array_equal(a.feature, b.feature) and np.allclose(a.weights, b.weights)
