import random

import numpy as np

from pyspark.sql import functions as F

from strata.llm.passages import (_LINK, _WINDOW, SLACK, agreeing_runs, compact_windows, matched_places, near_links,
                                 repeated_passages, run_blocks, verbatim_passages, window_blocks)


def test_compact_windows_against_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        sizes = [draw.randrange(0, 14) for _ in range(draw.randrange(1, 4))]
        bounds = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        values = np.array([draw.randrange(1, 9) for _ in range(int(bounds[-1]))], np.uint64)
        width, want = draw.randrange(1, 6), set()
        for a, b in zip(bounds[:-1], bounds[1:]):
            for c in range(a, b):
                left = right = c
                while left > a and values[left - 1] > values[c]:
                    left -= 1
                while right + 1 < b and values[right + 1] >= values[c]:
                    right += 1
                if right - left + 1 >= width:
                    want.add((left, c, right))
        assert set(compact_windows(values, bounds, width)) == want


def test_agreeing_runs():
    equal = np.array([1] * 20 + [0] + [1] * 20 + [0] * 9 + [1] * 10, bool)
    assert agreeing_runs(np.where(equal, np.arange(60) + 7, -1), 10) == [(0, 41, 7, 48), (50, 60, 57, 67)]
    assert agreeing_runs(np.full(5, -1), 1) == [] and agreeing_runs(np.arange(5), 6) == []
    shifted = np.r_[np.arange(26), np.full(5, -1), np.arange(26, 52)]  # one word more in the middle
    assert agreeing_runs(shifted, 46) == [(0, 57, 0, 52)]
    assert agreeing_runs(np.r_[np.arange(30, 50), np.arange(20)], 30) == []  # out of order


def test_matched_places_against_brute_force():
    draw = random.Random(5)
    for _ in range(300):
        other = np.array([draw.randrange(40) for _ in range(draw.randrange(0, 60))], np.uint64)
        part = np.array([draw.randrange(40) for _ in range(draw.randrange(0, 30))], np.uint64)
        first = draw.randrange(0, 60)
        shifts = np.array([draw.randrange(-30, 31) for _ in range(draw.randrange(1, 12))], np.int64)
        got = matched_places(part, first, other, shifts)
        for i, v in enumerate(part):
            near = [q for q in range(len(other)) if other[q] == v
                    and shifts.min() - SLACK <= first + i - q <= shifts.max() + SLACK]
            assert (got[i] in near) if near else got[i] == -1
            straight = [first + i - s for s in shifts[:8] if 0 <= first + i - s < len(other) and other[first + i - s] == v]
            assert not straight or got[i] == straight[0]


def test_passages_with_inserted_and_deleted_words(spark, documents):
    draw = random.Random(12)
    fresh = lambda n: [f"w{draw.randrange(100_000)}" for _ in range(n)]
    texts = []
    for k in range(60):
        passage = fresh(200)
        other = list(passage)
        for at in range(160, 0, -40):
            if k % 2:
                other.insert(at, f"new{k}x{at}")
            else:
                del other[at]
        texts += [" ".join(fresh(60) + passage + fresh(60)), " ".join(fresh(70) + other + fresh(50))]
    rows = {r.doc_id: r for r in repeated_passages(documents(texts)).collect()}
    found = [r for r in rows.values() if r.n_dup_words >= 150]
    assert len(found) >= 0.9 * len(texts)
    assert all(rows[i].component_id == min(i, i ^ 1) for i in rows if rows[i].n_passages)


def verbatim(texts, size=50):
    words = [(t or "").lower().split() for t in texts]
    seen = {}
    for i, w in enumerate(words):
        for k in range(len(w) - size + 1):
            seen.setdefault(tuple(w[k:k + size]), []).append((i, k))
    out = {}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                out.setdefault(i, set()).update(range(k, k + size))
    return out


def test_planted_passages_are_found_and_clean_texts_are_not(spark, documents):
    draw = random.Random(8)
    fresh = lambda n: [f"w{draw.randrange(100_000)}" for _ in range(n)]
    passages = [fresh(n) for n in (50, 51, 60, 200)]
    texts = [" ".join(fresh(draw.randrange(0, 80)) + draw.choice(passages) + fresh(draw.randrange(0, 80))) for _ in range(40)]
    clean = [" ".join(fresh(120)) for _ in range(20)] + [" ".join(fresh(30) + passages[3][:44] + fresh(30))]
    near = list(passages[3])
    near[100] = "changed"
    texts += [" ".join(near)] + clean + [None, "", "a b", texts[0], " ".join(["same"] * 300)]
    rows = {r.doc_id: r for r in repeated_passages(documents(texts)).collect()}
    want = verbatim(texts)
    for i in range(len(texts)):
        covered = {k for s in rows[i].passages for k in range(s["first"], s["last"])}
        assert want.get(i, set()) <= covered, i
    for i in range(41, 41 + len(clean)):
        assert rows[i].n_passages == 0 and rows[i].component_id == i
    assert rows[40].n_dup_words == 200          # one word replaced: joined across it
    assert rows[len(texts) - 2].component_id == rows[0].component_id


def test_no_verbatim_passage_is_lost_among_partial_ones(spark, documents):
    draw = random.Random(31)
    fresh = lambda n: [f"w{draw.randrange(100_000)}" for _ in range(n)]
    texts = []
    for _ in range(10):
        whole = fresh(140)
        for _ in range(60):
            a = draw.randrange(0, 90)
            texts.append(" ".join(fresh(30) + whole[a:a + draw.randrange(50, 60)] + fresh(30)))
    rows = {r.doc_id: r for r in repeated_passages(documents(texts)).collect()}
    want = verbatim(texts)
    assert len(want) > 400
    for i in range(len(texts)):
        covered = {k for s in rows[i].passages for k in range(s["first"], s["last"])}
        assert want.get(i, set()) <= covered, i
    words, runs, least = [t.split() for t in texts], {}, list(range(len(texts)))
    for i, w in enumerate(words):
        for k in range(len(w) - 49):
            runs.setdefault(tuple(w[k:k + 50]), set()).add(i)
    for _ in texts:  # the least document that shared runs lead to
        before = list(least)
        for group in runs.values():
            low = min(least[i] for i in group)
            for i in group:
                least[i] = low
        if before == least:
            break
    assert all(rows[i].component_id <= least[i] for i in range(len(texts)))


def test_verbatim_passages_against_brute_force(spark, documents):
    draw = random.Random(4)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randrange(0, 60))) for _ in range(60)] + [None, "", "a b"]
    docs = documents(texts).select("doc_id", F.col("doc_id").alias("key"), "text")
    for size in (9, 12):
        want, got = verbatim(texts, size), {}
        for r in verbatim_passages(run_blocks(docs.repartition(3), 4, size), size).collect():
            for key, first, last in ((r.member, r.first, r.last), (r.leader, r.leader_first, r.leader_last)):
                got.setdefault(key, set()).update(range(first, last))
            member, leader = texts[r.member].split(), texts[r.leader].split()
            assert member[r.first:r.last] == leader[r.leader_first:r.leader_last] and r.last - r.first >= size
        assert got == want


def test_empty_and_repeated_rows(spark, documents):
    assert repeated_passages(documents([])).count() == 0
    text = " ".join(f"t{i}" for i in range(80))
    rows = repeated_passages(documents([text] * 2, ids=[7, 7])).collect()
    assert len(rows) == 2 and all(r.n_passages == 0 for r in rows)       # one document, its row repeated
    rows = repeated_passages(documents([text] * 3, ids=[7, 8, None])).collect()
    assert all(r.n_dup_words == 80 and r.component_id == 7 for r in rows)


def test_no_near_copy_is_lost_among_pieces_of_it(spark, documents):
    draw = random.Random(41)
    fresh = lambda n: [f"w{draw.randrange(100_000)}" for _ in range(n)]
    texts, pairs = [], []
    for _ in range(30):
        passage = fresh(64)
        other = list(passage)
        other[draw.randrange(20, 44)] = "changed"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(fresh(60) + p + fresh(60)) for p in (passage, other)]
        for p in (passage, other):  # shorter documents, so leaders, that hold too little of it
            texts += [" ".join(fresh(4) + p[a:a + 46] + fresh(4)) for a in range(0, 19, 2)]
    rows = {r.doc_id: r for r in repeated_passages(documents(texts)).collect()}
    found = [(a, b) for a, b in pairs if min(rows[a].n_dup_words, rows[b].n_dup_words) >= 60]
    assert len(found) >= 0.97 * len(pairs)
    assert all(rows[b].component_id == a for a, b in found)


def test_near_windows_are_linked_or_share_a_leader():
    draw = np.random.default_rng(3)
    runs = [[k for k in range(a, a + 9) if k] for a in range(-8, 1)]
    for _ in range(100):
        n = int(draw.integers(0, 50))
        windows, tiles = np.zeros(n, _WINDOW), draw.integers(1, 255, (3, 16))[draw.integers(0, 3, n)].astype(np.uint8)
        changed = draw.random((n, 16)) < 0.15
        tiles[changed] = draw.integers(1, 5, changed.sum())
        for i in range(n):  # documents' ends
            tiles[i, draw.integers(4, 9):8] = 0
        windows["value"], windows["key"] = draw.integers(1, 3, n).astype(np.uint64) << np.uint64(62), np.arange(n)
        windows["back"], windows["ahead"] = (np.ascontiguousarray(x).view("<u8").reshape(-1) for x in (tiles[:, :8], tiles[:, 8:]))
        tile = lambda i, k: int(tiles[i, k + 7 if k > 0 else -k - 1])  # noqa: E731, B023
        near = lambda i, j: windows["value"][i] == windows["value"][j] and any(
            sum(tile(i, k) != tile(j, k) or not tile(i, k) for k in run) < 2 for run in runs)  # noqa: B023
        linked = {}
        for x in near_links(windows):
            linked.setdefault(int(x["member"]), set()).add(int(x["leader"]))
            linked.setdefault(int(x["leader"]), set()).add(int(x["member"]))
        for i in range(n):
            for j in range(i):
                if near(i, j):
                    assert j in linked.get(i, ()) or linked.get(i, set()) & linked.get(j, set())


def test_links_of_one_alignment_leave_a_task_once(spark, documents):
    draw = random.Random(3)
    text = " ".join(f"w{draw.randrange(100_000)}" for _ in range(400))
    docs = documents([text] * 5).select(F.col("doc_id").alias("key"), "text").coalesce(1)
    blocks = window_blocks(docs, 4, 50).where("kind = 1").collect()
    links = [tuple(int(x[name]) for name in ("member", "leader", "shift")) for r in blocks for x in np.frombuffer(r.block, _LINK)]
    assert sorted(links) == [(i, 0, 0) for i in range(1, 5)]  # of many windows under all hash functions


def test_a_text_that_repeats_parts_of_itself(spark, documents):
    draw = random.Random(6)
    fresh = lambda n: [f"w{draw.randrange(100_000)}" for _ in range(n)]
    part, other = fresh(70), fresh(60)
    texts = [" ".join(fresh(20) + part + fresh(30) + part + fresh(10) + other), " ".join(other + fresh(40)), " ".join(fresh(90))]
    rows = {r.doc_id: r for r in repeated_passages(documents(texts)).collect()}
    assert [(s["first"], s["last"]) for s in rows[0].passages] == [(20, 90), (120, 190), (200, 260)]
    assert [(s["first"], s["last"]) for s in rows[1].passages] == [(0, 60)] and rows[2].n_passages == 0
    assert rows[0].component_id == rows[1].component_id == 0
