"""Byte-level BPE: whole texts to ids and ids back to bytes, by a two-tier lookup.

A text is split by the tokenizer's pattern; every match (pre-token) is encoded on its
own. Tier one: a minimal perfect hash over the vocabulary's tokens (hash, displace: one
slot a token, no empty ones) finds the pre-tokens that are tokens themselves, all
distinct ones of a slice of texts at once; the bytes in the slot are compared, so an
answer is never a guess. Tier two, for the misses: the bytes stand in a linked list, a
heap holds the neighbours whose bytes together are a token, and the lowest rank, of
equal ones the leftmost, is merged until none is left. That is the library's own rule.

The tables (a few bytes per token) are made once on the driver and broadcast; their size
is the vocabulary's, whatever the input. Tasks work on slices of ``SLICE`` characters,
a longer text match by match in blocks, so memory is bounded by a slice and one
document's ids. Misses of at most ``SHORT`` bytes are remembered within a task, emptied
at ``MEMORY`` bytes, which changes no result. No shuffle.

Some characters are letters or numbers to one regular-expression engine and not yet to
another of an older Unicode version; ``Splitter`` asks the tokenizer library's engine for
its classes once and takes a pattern without the others for texts that hold them.

Defined cases: a null text is empty; an empty text has no ids and decodes to no bytes;
strings that look like special tokens are ordinary text; repeated rows and other columns
do not matter; an empty table gives no rows. Null ids, and ids without a token, stand for
no bytes; null instead of an id list decodes to no bytes.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.words import column, mix

SLICE = 1 << 20
SHORT = 64
MEMORY = 96 << 20
LATIN = "latin-1"
MATCHES = 200_000
PER_BUCKET = 4
TRIES = 64

_PLACES = 4096
_PLACE = np.random.Generator(np.random.PCG64(131)).integers(0, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the spans (start, length), one span after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def span_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-empty byte strings that lie one after the other."""
    if len(lengths) == 0:
        return np.empty(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    value = (data.astype(np.uint64) + np.uint64(1)) * _PLACE[place & (_PLACES - 1)]
    if lengths.max() > _PLACES:
        value = mix(value + (place // _PLACES).astype(np.uint64))
    return mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * _GOLDEN)


class PerfectHash:
    """A minimal perfect hash: n distinct byte strings in n slots, found again by vector operations."""

    def __init__(self, keys: Sequence[bytes]):
        n = self.n = len(keys)
        self.buckets = n // PER_BUCKET + 1
        lengths = np.array([len(k) for k in keys], np.int64)
        data = np.frombuffer(b"".join(keys), np.uint8)
        hashes = span_hashes(data, lengths)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys have one hash")
        bucket = self._bucket(hashes)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        firsts = np.cumsum(sizes) - sizes
        slot_of, free = np.empty(n, np.int64), np.ones(n, bool)
        self.displace = np.zeros(self.buckets, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            members = order[firsts[b]:firsts[b] + sizes[b]]
            d = 1
            while True:  # the first displacement that sends the bucket to free, different slots
                slots = self._slot(hashes[members][None, :], np.arange(d, d + TRIES, dtype=np.uint64)[:, None])
                fits = free[slots].all(axis=1)
                if len(members) > 1:
                    fits &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if fits.any():
                    at = int(np.argmax(fits))
                    self.displace[b], slot_of[members] = d + at, slots[at]
                    free[slots[at]] = False
                    break
                d += TRIES
        single = np.flatnonzero(sizes == 1)
        slots = np.flatnonzero(free)
        self.displace[single] = -1 - slots  # a lone key gets one of the slots that are left
        slot_of[order[firsts[single]]] = slots
        self.key_at = np.empty(n, np.int64)
        self.key_at[slot_of] = np.arange(n)
        self.data, self.lengths, self.starts, self.hashes = data, lengths, np.cumsum(lengths) - lengths, hashes

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, hashes: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        return (mix(hashes + displacement * _GOLDEN) % np.uint64(self.n)).astype(np.int64)

    def find(self, strings: Sequence[bytes]) -> np.ndarray:
        """Each string's index among the keys, -1 where it is none."""
        if not self.n or not len(strings):
            return np.full(len(strings), -1, np.int64)
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        data = np.frombuffer(b"".join(strings), np.uint8)
        hashes = span_hashes(data, lengths)
        d = self.displace[self._bucket(hashes)]
        key = self.key_at[np.where(d < 0, -1 - d, self._slot(hashes, np.maximum(d, 0).astype(np.uint64)))]
        maybe = np.flatnonzero((self.hashes[key] == hashes) & (self.lengths[key] == lengths))
        out = np.full(len(strings), -1, np.int64)
        if len(maybe):  # compare the bytes themselves
            own = (np.cumsum(lengths) - lengths)[maybe]
            same = data[ragged(own, lengths[maybe])] == self.data[ragged(self.starts[key[maybe]], lengths[maybe])]
            bounds = np.cumsum(lengths[maybe]) - lengths[maybe]
            maybe = maybe[np.logical_and.reduceat(same, bounds)]
            out[maybe] = key[maybe]
        return out


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: lowest rank first, leftmost among equals, on linked bytes."""
    n = len(piece)
    after = list(range(1, n + 1))       # where the part that starts here ends
    before = list(range(-1, n - 1))     # where the part in front of this one starts
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    bits = n.bit_length()               # an entry is one number: rank, start, end
    mask = (1 << bits) - 1
    heap = []
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank << bits | i) << bits | i + 2)
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        end, i = entry & mask, entry >> bits & mask
        middle = after[i]
        if middle < 0 or middle >= n or after[middle] != end:
            continue                    # a part of it has been merged since
        after[i], after[middle] = end, -1
        if end < n:
            before[end] = i
            far = after[end]
            rank = get(piece[i:far])
            if rank is not None:
                push(heap, (rank << bits | i) << bits | far)
        left = before[i]
        if left >= 0:
            rank = get(piece[left:end])
            if rank is not None:
                push(heap, (rank << bits | left) << bits | end)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


def character_ranges(chars: Iterable[str]) -> str:
    """The inside of a regular expression's set: runs of characters as ranges."""
    points = np.array(sorted(map(ord, chars)))
    firsts = np.flatnonzero(np.append(True, np.diff(points) > 1))
    lasts = np.append(firsts[1:], len(points)) - 1
    return "".join(f"\\U{points[a]:08X}-\\U{points[b]:08X}" for a, b in zip(firsts, lasts))


class Splitter:
    """The matches of the tokenizer's pattern, with the letters and numbers of the tokenizer library's own engine."""

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        text = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        single = {bytes([b]): b for b in range(256)}
        self.other = ""
        own = pattern
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            engine = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
            theirs = set(bytes(engine.encode_ordinary(text)).decode())
            differ = set(regex.findall(name, text)) - theirs
            if theirs - set(regex.findall(name, text)) or any(ord(c) < 256 for c in differ):
                raise ValueError(f"the two engines differ otherwise than by later characters in {name}")
            if differ:
                chars = character_ranges(differ)
                self.other += chars
                # outside a set: the class without them; inside the negated set: their complement stays
                own = own.replace("[^\\s\\p{L}\\p{N}]", "\0").replace(name, f"(?:(?![{chars}]){name})").replace("\0", "[^\\s\\p{L}\\p{N}]")
        if self.other:
            own = own.replace("[^\\s\\p{L}\\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{self.other}])")
        self.pattern, self.own = pattern, own
        self._compile()

    def _compile(self) -> None:
        import regex

        self.plain, self.exact = regex.compile(self.pattern), regex.compile(self.own)
        self.rare = regex.compile(f"[{self.other}]") if self.other else None

    def __getstate__(self) -> tuple:
        return self.pattern, self.own, self.other

    def __setstate__(self, state: tuple) -> None:
        self.pattern, self.own, self.other = state
        self._compile()

    def _holds_rare(self, text: str) -> bool:
        try:
            text.encode(LATIN)  # the engines agree on these characters: a quick answer for most texts
            return False
        except UnicodeEncodeError:
            return self.rare is not None and self.rare.search(text) is not None

    def matches(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of one text in order, in blocks of at most MATCHES for a long one."""
        pattern = self.exact if self._holds_rare(text) else self.plain
        if len(text) <= SLICE:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while block := list(islice(found, MATCHES)):
            yield block


class ByteBPE:
    """Encoder and decoder of one vocabulary; made on the driver, sent to the tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        self.ranks = ranks
        tokens = list(ranks)
        self.index = PerfectHash(tokens)
        self.id_of = np.array([ranks[t] for t in tokens], np.int32)
        self.splitter = Splitter(pattern)
        self.size = int(self.id_of.max()) + 1
        by_id = dict(zip(self.id_of.tolist(), tokens))
        ordered = [by_id.get(i, b"") for i in range(self.size)]
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)
        self.length = np.array([len(t) for t in ordered], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.held = 0

    def _missed(self, piece: bytes) -> tuple[int, ...]:
        got = self.known.get(piece)
        if got is None:
            got = tuple(merge_bytes(piece, self.ranks))
            if len(piece) <= SHORT:
                if self.held > MEMORY:
                    self.known, self.held = {}, 0
                self.known[piece] = got
                self.held += 200 + len(piece) + 8 * len(got)
        return got

    def encode_matches(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, the number of ids of every match): distinct matches are looked up once."""
        index = dict.fromkeys(matches)
        pieces = [m.encode() for m in index]
        for k, m in enumerate(index):
            index[m] = k
        key = self.index.find(pieces)
        whole = key >= 0
        lengths = np.ones(len(pieces), np.int64)
        missed = np.flatnonzero(~whole)
        found = [self._missed(pieces[k]) for k in missed.tolist()]
        lengths[missed] = np.fromiter(map(len, found), np.int64, len(found))
        first = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int32)
        flat[first[whole]] = self.id_of[key[whole]]
        flat[ragged(first[missed], lengths[missed])] = np.fromiter(chain.from_iterable(found), np.int32)
        at = np.fromiter(map(index.__getitem__, matches), np.int64, len(matches))
        return flat[ragged(first[at], lengths[at])], lengths[at]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text; short texts are looked up together."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        waiting: list[tuple[int, list[str]]] = []

        def flush() -> None:
            ids, lengths = self.encode_matches(list(chain.from_iterable(m for _, m in waiting)))
            bounds = np.append(0, np.cumsum(lengths))[np.cumsum([0] + [len(m) for _, m in waiting])]
            for (i, _), a, b in zip(waiting, bounds, bounds[1:]):
                out[i] = ids[a:b]
            waiting.clear()

        chars = 0
        for i, text in enumerate(texts):
            blocks = self.splitter.matches(text)
            if len(text) > SLICE:
                out[i] = np.concatenate([self.encode_matches(block)[0] for block in blocks])
                continue
            waiting += ((i, block) for block in blocks)
            chars += len(text)
            if chars >= SLICE:
                flush()
                chars = 0
        if waiting:
            flush()
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, the number of bytes of every id)."""
        known = (ids >= 0) & (ids < self.size)
        at = np.where(known, ids, 0)
        lengths = np.where(known, self.length[at], 0)
        return self.blob[ragged(self.start[at], lengths)], lengths


def load(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, bpe: ByteBPE, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) of every document's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            at = 0
            sizes = np.cumsum(np.append(0, pa.compute.fill_null(pa.compute.binary_length(column(whole, "text")), 0).to_numpy(zero_copy_only=False)))
            while at < whole.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + SLICE, side="right")) - 1)
                batch = whole.slice(at, end - at)
                found = own.encode([t or "" for t in column(batch, "text").to_pylist()])
                offsets = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in keep], ids], names=[*keep, "ids"])
                at = end

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*fields, "ids array<int>"]))


def decode_documents(encoded: DataFrame, bpe: ByteBPE) -> DataFrame:
    """All columns and ``decoded``, the bytes of the column ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            lists = column(whole, "ids")
            counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.append(0, np.cumsum(counts))
            flat = lists.flatten().fill_null(-1)
            at = 0
            while at < whole.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
                ids = flat.slice(int(ends[at]), int(ends[end] - ends[at])).to_numpy()
                data, lengths = own.decode(ids)
                bounds = np.append(0, np.cumsum(lengths))[ends[at:end + 1] - ends[at]]
                decoded = pa.Array.from_buffers(pa.large_binary(), end - at, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
                part = whole.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in names], decoded.cast(pa.binary())], names=[*names, "decoded"])
                at = end

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema.fields]
    return encoded.select(*names).mapInArrow(run, ", ".join([*fields, "decoded binary"]))
