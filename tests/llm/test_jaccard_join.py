import random
import re
from collections import Counter

from strata.llm import jaccard_join
from strata.llm.jaccard_join import keep_one_of_each, similarity_components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts):
    sets = []
    for text in texts:
        w = WORDS.findall((text or "").translate(FOLD))
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed):
    """Chains of edits, a shared passage in many documents, copies, short and blank texts."""
    draw = random.Random(seed)
    fresh = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    passage, texts = fresh(40), []
    for _ in range(6):
        words = fresh(60)
        for _ in range(draw.randrange(2, 14)):
            texts.append(" ".join(words))
            words = list(words)
            words[draw.randrange(len(words))] = f"e{draw.randrange(9)}"
    texts += [" ".join(fresh(10) + passage + fresh(draw.randrange(5, 15))) for _ in range(20)]
    texts += texts[:4] + ["a b", "A  b", "a b c d", "", None, " \n\t", "a", "é 日 x y z w", "é z"]
    draw.shuffle(texts)
    return texts


def test_against_brute_force(spark, documents):
    for seed in range(3):
        texts = corpus(seed)
        rows = {r.doc_id: r for r in similarity_components(documents(texts)).collect()}
        assert [(rows[i].n_shingles, rows[i].component_id) for i in range(len(texts))] == brute(texts)


def test_one_of_each_group_stays(spark, documents):
    texts = corpus(9)
    docs = documents(texts)
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, (_, root) in enumerate(brute(texts)) if i == root)


def test_empty_null_and_repeated(spark, documents):
    assert similarity_components(documents([])).count() == 0 and keep_one_of_each(documents([])).count() == 0
    assert {tuple(r) for r in similarity_components(documents([None, ""])).select("doc_id", "n_shingles", "component_id").collect()} == {(0, 0, 0), (1, 0, 1)}
    rows = similarity_components(documents(["a b c d e f"] * 3, ids=[4, 4, None])).collect()
    assert sorted(str(r.component_id) for r in rows) == ["4", "4", "4"]


def edited_copies(seed, copies=500):
    """Copies of one text with so many edits that most pairs are just below the threshold, some above."""
    draw = random.Random(seed)
    base = [f"t{draw.randrange(5000)}" for _ in range(150)]
    texts = []
    while len(texts) < copies:
        words = list(base)
        for _ in range(draw.randrange(1, 6)):
            words[draw.randrange(len(words))] = f"e{draw.randrange(10 ** 9)}"
        texts.append(" ".join(words))
        if draw.random() < 0.2:
            words[draw.randrange(len(words))] = "again"
            texts.append(" ".join(words))
    return texts[:copies]


def test_group_of_heavily_edited_copies(spark, documents, monkeypatch):
    texts = edited_copies(4)
    expected = brute(texts)
    for postings in (50_000, 700):  # one task; many lists' tasks, and blocks of classes
        monkeypatch.setattr(jaccard_join, "OPEN_POSTINGS", postings)
        rows = {r.doc_id: r for r in similarity_components(documents(texts)).collect()}
        assert [(rows[i].n_shingles, rows[i].component_id) for i in range(len(texts))] == expected


def test_pairs_across_components_are_all_that_reach_the_count(spark, monkeypatch):
    """``across`` against counting every pair, with as many components as classes."""
    draw = random.Random(2)
    rows = []
    for c in range(1, 61):
        n = draw.choice([60, 64, 70])
        for rank, name in enumerate(sorted(draw.sample(range(20), 9))):
            rows.append((name, c, n, rank, c if c % 7 else 7))
    members = spark.createDataFrame(rows, "list long, class long, n int, rank int, root long")
    by_class = {}
    for name, c, n, rank, root in rows:
        by_class.setdefault((c, n, root), {})[name] = rank
    expected = set()
    for (a, n, root), x in by_class.items():
        for (b, k, other), y in by_class.items():
            if a > b and root != other and 5 * min(n, k) >= 4 * max(n, k):
                overlap, extra = -(-4 * (n + k) // 9), min(n, k) // 20
                met = sum(x[v] <= n - overlap + extra and y[v] <= k - overlap + extra for v in x.keys() & y.keys())
                if met >= 1 + extra:
                    expected.add((a, b))
    assert expected
    for postings in (50_000, 60):
        monkeypatch.setattr(jaccard_join, "OPEN_POSTINGS", postings)
        found = {(r.a, r.b) for r in jaccard_join.across(members, 4, 5).collect()}
        # one task holds all lists: exactly the pairs; several: none is lost, some come early
        assert found == expected if postings == 50_000 else found >= expected


def test_rows_without_an_id_link(spark, documents):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base + ["x"]), " ".join(base), " ".join(["y"] + base), None]
    rows = similarity_components(documents(texts, ids=[None, 1, 0, None])).collect()
    assert sorted(str((r.doc_id, r.component_id)) for r in rows) == ["(0, 0)", "(1, 0)", "(None, 0)", "(None, None)"]


def test_an_id_with_two_texts_loses_only_the_linked_one(spark, documents):
    base, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    docs = documents([base, base + " x", other, base + " y", ""], ids=[1, 5, 5, None, 5])
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        [(1, base), (5, other), (None, base + " y"), (5, "")])
