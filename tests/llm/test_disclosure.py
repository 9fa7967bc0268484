import math
import re

from pyspark.sql import functions as F

from strata.llm import disclosure as D

PATTERNS = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
            ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
            ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
            ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]
ODD = ["a@b.c_x@d.e.f x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 01.02.003.0255 1.2.3.256",
       "4111 1111-1111 1111 4111111111111111 4111111111111112 " + "1 " * 3000,
       "+1 (499) 555-6503 +12 +1" + " " * 3000 + "x +" + "1-" * 5000 + "1",
       "é😀a@b.co \u0001 4\u00011 a\u0001b@c.d a@b..c a@.-.- ..@a.b-c._", "a" * 20000 + "@" + ".a" * 20000, None, "",
       "a@b.c" * 3, "1.1.1.1" * 4, "12.12.12.12-1 2", "+12345678901+12345678901(2", "a@b.c", "a@b.c"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind, m.group()))
    return [(s, e, k, v) for s, _, e, k, v in sorted(out)]


def test_base_spans_against_brute_force(spark, documents):
    rows = {r.doc_id: r.s for r in documents(ODD).select("doc_id", D.base_spans(F.col("text")).alias("s")).collect()}
    for i, text in enumerate(ODD):
        assert [tuple(x) for x in rows[i]] == brute(text), i


def test_disclosing_terms_by_counting(spark, documents):
    texts = [f"note {i} from Zanzibar by post a@b.co {'common' * (i % 2)} word{i}" for i in range(4)]
    texts += [f"common words here number x{i} by" for i in range(40)] + [texts[0]]
    docs = documents(texts)
    found = D.mentions(docs)
    got = {(r.entity, r.term): r.disclosure for r in D.disclosing_terms(docs, found).collect()}
    # the term stands in the context of the entity in all five documents that hold either
    assert got["a@b.co", "zanzibar"] == 1.0 and got["a@b.co", "from"] == 1.0
    assert ("a@b.co", "by") not in got and ("a@b.co", "word1") not in got
    rows = {r.doc_id: r for r in D.personal_data(docs).collect()}
    start = texts[1].index("Zanzibar")
    assert (start, start + 8, "term", True) in [tuple(x) for x in rows[1].terms]
    assert rows[10].spans == [] and rows[10].terms == []


def test_values_that_all_differ_are_protected(spark, documents):
    texts = [f"ordinary words of every page user{i} wrote Surname{'abcdefghij'[i]}x hotline u{i}@corp{i % 2}.org ordinary words again" for i in range(10)]
    texts += [f"ordinary words of every page wrote again number{i}" for i in range(290)]
    docs = documents(texts)
    rows = {r.doc_id: r for r in D.personal_data(docs).collect()}
    for i in range(10):
        found = {texts[i][t["start"]:t["end"]]: t["remove"] for t in rows[i].terms}
        # the rare name about the value, by smoothed counts; the word that ten addresses share about their kind
        assert f"Surname{'abcdefghij'[i]}x" in found and found["hotline"] is True
        assert not set(found) & {"ordinary", "words", "again", "wrote", "page"}
    assert all(rows[i].terms == [] for i in range(10, 300))
    told = {(r.entity, r.term): r.disclosure for r in D.disclosing_terms(docs, D.mentions(docs)).collect()}
    share = 1 / 300
    want = math.log((1 + 2 * D.PRIOR * share) / (1 + 2 * D.PRIOR) / share) / -math.log(share)
    assert abs(told["u0@corp0.org", "surnameax"] - want) < 1e-8
    assert told["email", "hotline"] == 1.0


def test_levels(spark, documents):
    docs = documents(["A@B.co 10.1.2.3 y 4111 1111 1111 1111 x +1 (499) 555-6503"])
    spans = docs.select(F.explode(D.base_spans(F.col("text"))).alias("s"))
    got = [r.e for r in spans.select(D.levels(F.col("s.kind"), F.col("s.value")).alias("e")).collect()]
    assert got == [["a@b.co", "email b.co", "email"], ["10.1.2.3", "ip 10.1.2", "ip"],
                   ["4111 1111 1111 1111", "card 411111", "card"], ["+1 (499) 555-6503", "phone 1499", "phone"]]


def test_sanitise_rewrites_only_spans(spark, documents):
    docs = documents(["call +1 (499) 555-6503 or a@b.co now", None, "", "clean text", "clean text"])
    out = D.sanitise(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: "call [PHONE] or [EMAIL] now", 1: None, 2: "", 3: "clean text", 4: "clean text"}
    assert D.sanitise(documents([])).count() == 0 and D.personal_data(documents([])).count() == 0


def test_overlapping_spans_and_ties(spark, documents):
    text = "1.2.3.4@b.co x"                 # an address that begins with one
    assert [x[2] for x in brute(text)] == ["email", "ip"]
    got = D.sanitise(documents([text, text], ids=[1, 1])).collect()
    assert [r.text for r in got] == ["[EMAIL] x"] * 2


def test_no_python_on_the_main_path(spark, documents):
    plan = D.personal_data(documents(ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
