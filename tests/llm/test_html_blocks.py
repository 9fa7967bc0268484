import numpy as np
import pytest

from strata.llm import html_blocks as B

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def page(i, paragraphs=3):
    text = lambda k: " ".join(WORDS[(i * 7 + k * 3 + j) % 10] for j in range(20 + k))
    body = "".join(f"<p><b>{text(k)} &amp; more<br><p>" for k in range(paragraphs))
    return (f"<!DOCTYPE html><html><head><title>t {i}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
            f"<nav><ul><li><a href=/a>Menu {i}</a></li><li><a href=/b>Other</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy {i}</div>"
            f"<article><h1>Head {i}</h1>{body}</article><div id='comments'><p>I agree {i}</p></div><footer>&copy; site</footer>")


def wanted(source):
    return "\n".join(b.text for b in B.leaf_blocks(source) if B.structural_label(b))


def pages(spark, sources):
    return spark.createDataFrame([(i, f"http://x/{i}", s, "x") for i, s in enumerate(sources)],
                                 "page_id long, url string, html string, text string")


def test_leaf_blocks_of_broken_markup():
    texts = lambda s: [b.text for b in B.leaf_blocks(s)]
    assert texts("<p>a<b>b <!-- x") == ["ab"] and texts("<script>var a") == [] and texts("") == []
    assert texts('x &lt; y &#x41; <p>q"<b class=">">z') == ["x < y A", 'q"z']
    assert texts("one\n  two<br>three<div>four</div>five") == ["one two three", "four", "five"]
    assert texts("<title>no</title><body>yes") == ["yes"] and texts("a < b") == ["a < b"]


def test_gradients_match_differences():
    draw = np.random.default_rng(0)
    model = B.BlockLabeller(5, hidden=3)
    x, mask, y = B.padded([draw.normal(size=(n, 5)) for n in (4, 2)], [np.array([1, 0, 1, 0.]), np.array([0, 1.])])

    def loss():
        p = 1 / (1 + np.exp(-model.odds(x, mask)))
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for name, g in model.gradients(x, mask, y).items():
        w = model.weights[name]
        for at in [tuple(draw.integers(0, d) for d in w.shape) for _ in range(6)]:
            w[at] += 1e-5
            high = loss()
            w[at] -= 2e-5
            low = loss()
            w[at] += 1e-5
            assert (high - low) / 2e-5 == pytest.approx(g[at], abs=1e-6), name


def test_held_out_pages_and_odd_ones(spark):
    sources = [page(i, 1 + i % 5) for i in range(60)]
    odd = [None, "", "<script>x", "<p>", sources[0], "<div class=menu><a href=x>Home</a></div>"]
    got = {r.page_id: r for r in B.extract_main_text(pages(spark, sources + odd), fit_pages=40).collect()}
    assert [got[i].text for i in range(60)] == [wanted(s) for s in sources]
    assert [got[60 + i].text for i in range(4)] == [""] * 4 and got[64].text == got[0].text
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_a_long_page_is_read_whole(spark):
    sources = [page(i) for i in range(30)] + [page(99, paragraphs=600)]
    got = {r.page_id: r.text for r in B.extract_main_text(pages(spark, sources)).collect()}
    assert got[30] == wanted(sources[30]) and len(got[30].split("\n")) > 600


def test_no_pages_and_nothing_to_learn_from(spark):
    assert B.extract_main_text(pages(spark, [])).count() == 0
    rows = B.extract_main_text(pages(spark, ["<nav>m</nav><p>text</p>", None])).collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.page_id)] == ["text", ""]
