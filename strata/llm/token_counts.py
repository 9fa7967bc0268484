"""Token counts of a unigram tokenizer without building tokens: Aho-Corasick and Viterbi.

A text's spaces become the word mark, one is put in front, and every word (a mark and
what follows it) is segmented on its own. One Aho-Corasick pass over the word finds all
vocabulary pieces; dynamic programming over end positions carries the best score and its
number of pieces. Ties follow the tokenizer: of equal scores at one end the earlier start
(the longer piece) wins; a character that is no piece itself may stand as unknown, at the
least vocabulary score minus 10, considered after all pieces; unknown characters count
one token per byte when the vocabulary has byte pieces, else one per run.

Words are remembered within a worker process (emptied when full, which changes nothing),
so a frequent word is segmented once. Every text is read whole. Defined cases: null and
empty texts are the lone word mark's own tokens counted as none, 0; repeated rows and
other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.words import column

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000
ROWS = 512


class CountViterbi:
    """Counts the best segmentation's pieces, for (piece, score) pairs; id ``unknown`` is no piece of text."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.words: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of one word; pyahocorasick gives the pieces of an end longest first."""
        n = len(word)
        score, count, lost = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        found = next(matches, None)
        for end in range(1, n + 1):
            best = single = None
            while found is not None and found[0] == end - 1:
                length, piece = found[1]
                got = piece + score[end - length]
                if best is None or got > best:
                    best, count[end] = got, count[end - length] + 1
                single = single or length == 1
                found = next(matches, None)
            if not single:
                got = self.unknown + score[end - 1]
                if best is None or got > best:
                    best, lost[end] = got, True
                    count[end] = count[end - 1] + (len(word[end - 1].encode()) if self.bytes else not lost[end - 1])
            score[end] = best
        return int(count[n]), score[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        words = text.replace(" ", MARK).split(MARK)
        if words[0] == "":  # the text begins with a mark
            words = words[1:]
        known, tokens, total = self.words, 0, 0.0
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            got = known.get(w)
            if got is None:
                got = known[w] = self.word(MARK + w)
            tokens += got[0]
            total += got[1]
        return tokens, total


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a public piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


_LOADED: dict[str, CountViterbi] = {}


def counter(path: str) -> CountViterbi:
    if path not in _LOADED:
        _LOADED[path] = CountViterbi(vocabulary(path))
    return _LOADED[path]


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, score) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = counter(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [viterbi.text(t or "") for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id").cast(pa.int64()), pa.array([n for n, _ in found], pa.int64()),
                     pa.array([s for _, s in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, score double")
