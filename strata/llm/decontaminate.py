"""Benchmark decontamination with suffix arrays over the training text.

Every Arrow batch of documents is a shard. Its words are numbered by the benchmark's
vocabulary (any other word ends a match, as does a document's end), a suffix array is
sorted over the shard's words, and every benchmark suffix is searched in it by binary
search, one word deeper at a time: after ``window`` words the range holds all places
where that window occurs, and the search goes on to the suffix's longest verbatim
match. Places that lie in a run of benchmark words too short for any window cannot
start a match and are left out of the array. A document belongs to one shard, so its
result is made in one task: no text is shuffled and a hot document or passage costs
its own words only.

The benchmark reaches the tasks in blocks of at most ``BLOCK_WORDS`` words, each
collected and broadcast on its own (its size is counted first); a larger benchmark
passes over the shards once a block, adding its places to those already found.

Words: A-Z folded, maximal runs of digits, letters a-z and non-ASCII characters.
Defined cases: null or empty texts have no words and are clean; an item with fewer
than ``window`` words is one window, an item without words none; repeated items count
once by id, an item without an id as 'null'; repeated documents are judged one by one;
an empty benchmark leaves every document clean; other columns pass through untouched
(one named like the result is replaced).
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.words import column, text_buffer

WINDOW = 10
BLOCK_WORDS = 1_000_000
SHARD_ROWS = 2_000

# fixed values: digits, a-z and every byte of a non-ASCII character are word characters; A-Z are folded
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
               else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class TestBlock:
    """A block of the benchmark: numbered words, one sequence per item, window per item."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names, starts, seqs = [], [], []
        total = 0
        for name, text in items:
            words = split_words(text)
            if not words:
                continue
            self.names.append(name)
            starts.append(total)
            seqs.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
            total += len(words) + 1
        self.words = np.zeros(total, np.int32)  # 0 ends an item
        item, need = np.zeros(total, np.int32), np.zeros(total, np.int32)
        least = np.full(len(self.vocabulary) + 1, np.iinfo(np.int32).max, np.int32)
        for k, (start, seq) in enumerate(zip(starts, seqs)):
            span = slice(start, start + len(seq))
            self.words[span], item[span], need[span] = seq, k, min(window, len(seq))
            np.minimum.at(least, np.array(seq), min(window, len(seq)))
        # suffixes that begin a window: enough words left in the item
        left = np.zeros(total, np.int32)
        for start, seq in zip(starts, seqs):
            left[start:start + len(seq)] = np.arange(len(seq), 0, -1)
        self.suffixes = np.flatnonzero((left >= need) & (left > 0))
        self.need, self.left, self.item = need[self.suffixes], left[self.suffixes], item[self.suffixes]
        self.least = least  # by word: the shortest window it belongs to


def suffix_array(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places sorted by the suffixes that start there, to ``depth`` words at least.

    Prefix doubling: ranks of 1, 2, 4 ... words until all differ or the depth is reached
    (deeper words cannot change which places share a benchmark suffix). ``words`` ends
    with a 0, which ends every suffix.
    """
    rank = words.astype(np.int64)
    order, length = places, 1
    while len(places) and length < depth:
        second = rank[np.minimum(places + length, len(words) - 1)]
        second[rank[places] == 0] = 0
        key = rank[places] * (rank.max() + 1) + second
        sorter = np.argsort(key, kind="stable")
        order, key = places[sorter], key[sorter]
        new = np.cumsum(np.r_[1, key[1:] != key[:-1]])
        rank = np.zeros(len(words), np.int64)
        rank[order] = new
        if new[-1] == len(places):
            break
        length *= 2
    if length == 1 and len(places):
        order = places[np.argsort(rank[places], kind="stable")]
    return order


def search(words: np.ndarray, array: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every benchmark suffix: the range of places that share its window, and its longest match.

    Returns (suffix index, low, high, longest) of the suffixes whose window occurs.
    """
    n = len(array)
    low, high = np.zeros(len(block.suffixes), np.int64), np.full(len(block.suffixes), n, np.int64)
    alive = np.arange(len(block.suffixes))
    out_low, out_high = low.copy(), np.zeros_like(high)
    longest = np.zeros(len(block.suffixes), np.int64)
    depth = 0
    while len(alive):
        target = block.words[block.suffixes[alive] + depth]
        bounds = []
        for right in (False, True):
            a, b = low[alive].copy(), high[alive].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                middle = (a + b) // 2
                value = words[np.minimum(array[np.minimum(middle, n - 1)] + depth, len(words) - 1)]
                go = (value <= target) if right else (value < target)
                a = np.where(open_ & go, middle + 1, a)
                b = np.where(open_ & ~go, middle, b)
            bounds.append(a)
        low[alive], high[alive] = bounds
        depth += 1
        found = bounds[0] < bounds[1]
        alive = alive[found]
        longest[alive] = depth
        at_window = alive[block.need[alive] == depth]
        out_low[at_window], out_high[at_window] = low[at_window], high[at_window]
        alive = alive[block.left[alive] > depth]
    hit = np.flatnonzero(out_high > out_low)
    return hit, out_low[hit], out_high[hit], longest[hit]


def shard_places(data: np.ndarray, offsets: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shard's words as block numbers (0 between documents), document bounds, counts."""
    raw, number = data.tobytes(), block.vocabulary.get
    parts, counts = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        ws = raw[a:b].translate(_TABLE).split()
        counts.append(len(ws))
        parts.append(np.fromiter(map(number, ws, repeat(0)), np.int32, len(ws)))
        parts.append(np.zeros(1, np.int32))
    return np.concatenate(parts), np.cumsum([0] + [c + 1 for c in counts]), np.array(counts)


def candidate_places(words: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places in runs of benchmark words that are long enough for a window of their words."""
    known = words > 0
    edge = np.flatnonzero(np.diff(np.r_[0, known.astype(np.int8), 0]))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.empty(0, np.int64)
    need = np.minimum.reduceat(least[words[words > 0]], np.r_[0, np.cumsum(end - begin)[:-1]])
    keep = end - begin >= need
    begin, size = begin[keep], (end - begin)[keep]
    first = np.r_[0, np.cumsum(size)[:-1]]
    return np.repeat(begin - first, size) + np.arange(size.sum())


def block_hits(block: TestBlock, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int, int]], int]]:
    """Per document: its hits (first word, words of the window, longest match, item), its word count."""
    words, bounds, counts = shard_places(data, offsets, block)
    places = candidate_places(words, block.least)
    hits: dict[int, list[tuple[int, int, int, int]]] = {}
    if len(places):
        # to the depth of the longest item: a deeper order is never asked for
        array = suffix_array(words, places, int(block.left.max()))
        which, low, high, longest = search(words, array, block)
        for k, a, b, most in zip(which.tolist(), low.tolist(), high.tolist(), longest.tolist()):
            at = array[a:b]
            docs = np.searchsorted(bounds, at, side="right") - 1
            for d, p in zip(docs.tolist(), (at - bounds[docs]).tolist()):
                hits.setdefault(d, []).append((p, int(block.need[k]), most, int(block.item[k])))
    for d, n in enumerate(counts.tolist()):
        yield d, hits.get(d, []), n


def merge_spans(old: bytes | None, new: list[tuple[int, int]]) -> bytes:
    """The union of word spans, as packed pairs of 64-bit first and end."""
    merged: list[list[int]] = []
    for a, b in sorted(list(struct.iter_unpack("<qq", old or b"")) + new):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return b"".join(struct.pack("<qq", a, b) for a, b in merged)


def span_words(spans: bytes | None) -> int:
    return sum(b - a for a, b in struct.iter_unpack("<qq", spans or b""))


_ITEM = pa.struct([("item", pa.string()), ("longest", pa.int64()), ("first_word", pa.int64())])
_FOUND = "found_words long, found_spans binary, found_hit long, found_items array<struct<item:string,longest:long,first_word:long>>"


def search_shards(broadcast_block, text_at: int, keep: list[int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass over all shards for one block: the last four columns hold what is found so far."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = broadcast_block.value
        for whole in batches:
            for at in range(0, whole.num_rows, SHARD_ROWS):
                batch = whole.slice(at, SHARD_ROWS)
                spans = column(batch, "found_spans").to_pylist()
                items = [x or [] for x in column(batch, "found_items").to_pylist()]
                counts = [0] * batch.num_rows
                data, offsets = text_buffer(batch.column(text_at))
                for d, hits, n in block_hits(block, data, offsets):
                    counts[d] = n
                    if hits:
                        spans[d] = merge_spans(spans[d], [(p, p + w) for p, w, _, _ in hits])
                        best = {i["item"]: (i["longest"], -i["first_word"]) for i in items[d]}
                        for p, _, most, k in hits:
                            name = block.names[k]
                            best[name] = max(best.get(name, (0, 0)), (most, -p))
                        items[d] = [{"item": i, "longest": m, "first_word": -p} for i, (m, p) in sorted(best.items())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in keep]
                    + [pa.array(counts, pa.int64()), pa.array(spans, pa.binary()),
                       pa.array([span_words(s) for s in spans], pa.int64()), pa.array(items, pa.list_(_ITEM))],
                    names=[batch.schema.names[i] for i in keep] + ["found_words", "found_spans", "found_hit", "found_items"])

    return run


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of about ``block_words`` words, collected one at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"),
                             F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (5 * block_words)))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k)
        yield [(r["name"], r["text"].encode()) for r in part.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None,
               result: str = "leak", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The kept columns (default all) and a struct: ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (item, longest verbatim match in words, its first word)."""
    keep = docs.columns if keep is None else keep
    carried = [c for c in keep if c != result]
    texts = len(carried) if "text" not in carried else carried.index("text")
    source = carried + (["text"] if "text" not in carried else [])
    # internal names, so that no column of the documents can clash
    frame = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(source)],
                        F.lit(0).cast("long").alias("found_words"), F.lit(None).cast("binary").alias("found_spans"),
                        F.lit(0).cast("long").alias("found_hit"),
                        F.lit(None).cast("array<struct<item:string,longest:long,first_word:long>>").alias("found_items"))
    blocks = benchmark_blocks(benchmark, block_words)
    items = next(blocks)
    while items is not None:
        following = next(blocks, None)
        sent = range(len(carried) if following is None else len(source))  # the text, until the last pass
        schema = "".join(f"d{i} {docs.schema[source[i]].dataType.simpleString()}, " for i in sent)
        block = docs.sparkSession.sparkContext.broadcast(TestBlock(items, window))
        frame = frame.mapInArrow(search_shards(block, texts, list(sent)), schema + _FOUND)
        items = following
    return frame.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(carried)],
                        F.struct(F.col("found_words").alias("n_words"), F.col("found_hit").alias("n_hit"),
                                 F.col("found_items").alias("items")).alias(result))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their columns, in which no benchmark window occurs."""
    found = find_leaks(docs, benchmark, window, result="leak of this document")
    return found.where(F.col("`leak of this document`.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
