import random
import re

from strata.llm.decontaminate import find_leaks, remove_leaks

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, items, window=10):
    windows = {}
    for name, text in items:
        w = WORDS.findall((text or "").translate(FOLD))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add("null" if name is None else str(name))
    out = []
    for text in texts:
        w = WORDS.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k:k + n]))
                if names:
                    hit.update(range(k, k + n))
                    found |= names
        out.append((len(w), len(hit), sorted(found)))
    return out


def cases(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "c", "été", "X9"])
    items = [(draw.choice([1, 2, 3, None, 12]), " ".join(word() for _ in range(draw.choice([0, 1, 3, 10, 14])))) for _ in range(8)]
    texts = [" ".join(word() for _ in range(draw.choice([0, 1, 9, 30, 400]))) for _ in range(20)]
    return texts + [None, "", "...", items[0][1].upper() + "!" + items[1][1], *texts[:3]], items + [(7, None), (7, items[0][1])]


def test_against_brute_force(spark, documents):
    for seed in range(3):
        texts, items = cases(seed)
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        for words in (1_000_000, 5):  # one block, and several passes
            rows = {r.doc_id: r.leak for r in find_leaks(documents(texts), benchmark, keep=["doc_id"], block_words=words).collect()}
            got = [(rows[i].n_words, rows[i].n_hit, sorted(x.item for x in rows[i]["items"] or [])) for i in range(len(texts))]
            assert got == brute(texts, items)


def test_longest_match_and_place(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y " + " ".join(f"w{i}" for i in range(5, 27)) + " z"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    leak = find_leaks(documents([text]), benchmark).first().leak
    assert [(x.item, x.longest, x.first_word) for x in leak["items"]] == [("1", 22, 2)]


def test_removal_keeps_columns_and_clean_rows(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = documents(["clean", "ONE two, three four five six seven eight nine ten!", None])
    left = remove_leaks(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [0, 2]
    assert remove_leaks(docs, benchmark.limit(0)).count() == 3
    assert remove_leaks(documents([]), benchmark).count() == 0
