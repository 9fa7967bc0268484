"""Quality rules: hashed n-gram log-likelihood ratio of trusted against raw text.

Every word and every pair of neighbouring words falls by its hash into a slot (words
into the lower half of SLOTS, pairs into the upper). Two multinomials are counted in one
pass: the raw corpus over all documents, the target over the trusted ones, a share f of
all n-grams. A slot's log ratio compares its count c in the target with the count E that
the raw corpus leads to expect there: log((c + PRIOR) / (E + PRIOR)), and 0 where the
difference is within chance, (c - E)**2 <= SURE * E * (1 - f): a rare slot says nothing, a
frequent one that the target avoids weighs heavily. A document's score is the mean over
its n-grams, so length does not matter, and it is kept from THRESHOLD on. Fixed rules
come first.

What is broadcast is the table of log ratios (a fixed size); counters are summed by
Spark in two steps. The second pass scores every document. Defined cases: null and blank
texts have no words and fail the rules; without trusted documents all ratios are 0;
repeated documents count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.shared import counter_rows, flagged, summed, written
from strata.llm.words import column, hash_words, mix, text_buffer

SLOTS = 1 << 20
PRIOR = 1.0
SURE = 25.0
THRESHOLD = -0.006
ROWS = 1_000

# fixed values: the symbols of the rules, their limits
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
_SHIFT = np.uint64(64 - SLOTS.bit_length() + 2)
_PAIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def gram_slots(words: np.ndarray) -> np.ndarray:
    """The slots of all words, then of all pairs, of one document."""
    pairs = mix(words[:-1] * _PAIR[0] + words[1:] * _PAIR[1])
    return np.concatenate([(words >> _SHIFT).astype(np.int64), (pairs >> _SHIFT).astype(np.int64) + SLOTS // 2])


def count_grams(docs: DataFrame) -> DataFrame:
    """Rows of the counters 0 (raw) and 1 (target) of each task; ``docs`` has text and flag (trusted)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                words, bounds = hash_words(*text_buffer(column(batch, "text")), fold=False)
                for trusted, a, b in zip(column(batch, "flag").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    if b > a:
                        found = np.bincount(gram_slots(words[a:b]), minlength=SLOTS) if b - a > SLOTS // 4 else None
                        for counter in (raw, target)[:1 + bool(trusted)]:
                            if found is None:
                                np.add.at(counter, gram_slots(words[a:b]), 1)
                            else:
                                counter += found
        counter, piece, counts = counter_rows([raw, target])
        yield pa.RecordBatch.from_arrays([pa.array(counter, pa.int32()), pa.array(piece, pa.int32()), pa.array(counts, pa.binary())],
                                         names=["counter", "piece", "counts"])

    return docs.mapInArrow(run, "counter int, piece int, counts binary")


def log_ratios(docs: DataFrame, trusted: DataFrame, prior: float = PRIOR) -> np.ndarray:
    """The log ratio of every slot; ``trusted`` holds the doc_id of trusted documents."""
    counts = written(count_grams(flagged(docs, trusted, {"text": F.col("text")})), "grams")
    raw, target = summed(counts, 0, SLOTS), summed(counts, 1, SLOTS)
    if not target.sum():
        return np.zeros(SLOTS)
    share = target.sum() / raw.sum()
    expected = raw * share
    sure = (target - expected) ** 2 > SURE * expected * (1 - share)
    return np.where(sure, np.log((target + prior) / (expected + prior)), 0.0)


def repeated_words(words: np.ndarray) -> int:
    """Words inside any three-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    windows = mix(words[:-2] * _PAIR[0] + words[1:-1] * _PAIR[1] + words[2:] * np.uint64(0xA0761D6478BD642F))
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[j:len(words) - 2 + j] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


SCORE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, score double, kept boolean")


def score_documents(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """(doc_id, the rules' counts, base_failed, score, kept) of every document."""
    table = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted, prior).astype(np.float32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = table.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                data, offsets = text_buffer(column(batch, "text"))
                words, bounds = hash_words(data, offsets, fold=False)
                raw = data.tobytes()
                space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
                chars = np.r_[0, np.cumsum(((data & 0xC0) != 0x80) & ~space)]
                symbols = np.r_[0, np.cumsum(_SYMBOL[data])]
                rows = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own = words[a:b]
                    n, first, end = b - a, offsets[i], offsets[i + 1]
                    again = repeated_words(own)
                    failed = n < MIN_WORDS or 100 * again > MAX_REPEATED * n
                    score = float(ratio[gram_slots(own)].mean(dtype=np.float64)) if n else 0.0
                    rows.append((n, int(chars[end] - chars[first]), int(symbols[end] - symbols[first]),
                                 repeated_lines(raw[first:end]), again, failed, score, not failed and score >= threshold))
                types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id").cast(pa.int64())] + [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", *[c.split()[0] for c in SCORE.split(", ")]])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {SCORE}")
