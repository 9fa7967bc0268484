import random

import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from strata.llm.token_counts import CountViterbi, count_tokens, vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "  ", "a", " a  b ", "é😀\n\n日本", "▁▁x", "<0x0A>", "\t", "x" * 3000, "a b", None, "the the", "the the"]


def exact(pieces, byte_fallback):
    tok = Tokenizer(models.Unigram(pieces, 0, byte_fallback))
    tok.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids) if text else 0


def test_counts_equal_the_tokenizers(spark, documents):
    want = exact(vocabulary(MODEL), True)
    draw = random.Random(3)
    texts = ODD + ["".join(draw.choice("the ing to  of ñé\nz9") for _ in range(200)) for _ in range(30)]
    rows = {r.doc_id: r.n_tokens for r in count_tokens(documents(texts), MODEL).collect()}
    assert [rows[i] for i in range(len(texts))] == [want(t) for t in texts]
    assert count_tokens(documents([]), MODEL).count() == 0


def test_ties_follow_the_tokenizer():
    draw = random.Random(1)
    for _ in range(400):
        names = {"".join(draw.choice("ab▁c") for _ in range(draw.randint(1, 3))) for _ in range(8)}
        pieces = [("<unk>", 0.0)] + [(p, -draw.randint(1, 4) * 0.5) for p in sorted(names)]
        text = "".join(draw.choice("abcd ") for _ in range(12)).strip() or "d"
        assert CountViterbi(pieces).text(text)[0] == exact(pieces, False)(text), (pieces, text)
