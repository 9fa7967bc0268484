import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm.packing import WordTokenizer, best_fit_decreasing, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["It's I'LL don'T naïve ŸÆ ſ ŉ İstanbul ΣΑΣ x\x1cy \xa0z ² ½ áb é 日本語 <|endoftext|> zz", "", "  \n", "\x7f\x01a",
       "'s's 's!'s 12ab3", "\u0085q", "ǅ ﬁ", "a" * 5000, "1 " * 3000, None, "It's", "It's"]


def test_word_ids_equal_the_tokenizers():
    full, own = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    texts = [t or "" for t in ODD]
    got = [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)]
    assert got == [full.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_texts_are_split_in_one_go():
    full, own = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    plain = "Foo foo, FOO!\tfoo\u0085Été\xa0été it's\r\nIT'S 12"
    texts = [plain, plain + " 日本 foo,", plain + " x\x1cy", "", " \n"]
    assert len(own.encode([plain])) == 1
    assert not own.words and own.pieces.keys() == {"foo", ",", "!", "été", "it", "'s", "1", "2"}  # no word of its own
    got = [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)]
    assert got == [full.encode(t, add_special_tokens=False).ids for t in texts]


def test_best_fit_takes_the_tightest_window():
    lengths = [7, 6, 5, 3, 2, 2, 1]
    sequences, offsets = best_fit_decreasing(lengths, 10)
    room, used = {}, 0
    for n, s, o in zip(lengths, sequences, offsets):
        fits = [c for c in room.values() if c >= n]
        if fits:
            assert room[s] == min(fits) and o == 10 - room[s]
        else:
            assert o == 0 and s == used
            used, room[s] = used + 1, 10
        room[s] -= n
    assert best_fit_decreasing([], 10) == ([], []) and best_fit_decreasing([10, 10], 10) == ([0, 1], [0, 0])


def test_pieces_cover_every_id_once(spark, documents):
    full = Tokenizer.from_file(PATH)
    rows = pack_documents(documents(ODD), PATH, window=64, group_pieces=4, with_ids=True).collect()
    for i, text in enumerate(ODD):
        ids = full.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.token_ids] == ids
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(ids))
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for a, b in zip(places, places[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    assert all(o + n <= 64 for _, o, n in places)


def test_empty_table_and_repeated_rows(spark, documents):
    assert pack_documents(documents([]), PATH).count() == 0
    rows = pack_documents(documents(["a b", "a b"], ids=[5, 5]), PATH).collect()
    assert len(rows) == 2 and len({(r.sequence_id, r.offset) for r in rows}) == 2
    assert pack_documents(documents(["a"], ids=[None]), PATH).first().doc_id is None
