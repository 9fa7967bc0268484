"""Packing documents into fixed windows: best-fit decreasing on a segment tree.

``tokenize_pieces`` turns every whole text into token ids (a null text is empty),
appends the end id and cuts documents longer than a window into full windows, the
rest into one last piece. ``pack_pieces`` deals the pieces into groups by a hash
(their number follows the row count, so a group has a few thousand pieces at any
input size, and a hot source or a long document spreads over all groups) and packs
each group: pieces by decreasing length go into the open window with the least
sufficient room, found in a segment tree over remaining capacities. Only piece
metadata is shuffled, never text or ids.

Defined cases: a null or empty text is one piece holding the end id; repeated rows
are separate documents; ties in length are taken by (doc_id, start, crc), equal rows
being interchangeable; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.words import column

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 4096
CACHE_WORDS = 500_000

# fixed values: white space of the tokenizer's split, its contractions and its letters in Latin text
_FAST = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
_FAST_TEXT = re.compile("[!-~À-ÖØ-öø-įı-ſ\\s]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įı-ſ]+|[0-9]"
                    "|[^\\sa-z0-9ß-öø-įı-ſ]+")
_NOT_SPLIT = "\x1c\x1d\x1e\x1f"


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable bytes stand for themselves, the others follow from 256 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) if b in kept else chr(256 + others.index(b)) for b in range(256)}


class PieceIds(dict):
    """The ids of each piece as bytes; a piece that is not remembered goes to the model."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(text)]
        got = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return got


class WordTokenizer:
    """Whole-text token ids as little-endian bytes, remembered piece by piece.

    White space separates the tokenizer's pieces, so a text's ids are those of its
    words in order. A text of Latin letters, printable ASCII and white space is split
    here in one go and only its pieces go to the model. Other texts are taken word by
    word: such a word is split here, any other word, and any text with the file's special
    tokens or with separators that only Python splits at, goes to the tokenizer whole.
    The memories for pieces and words are emptied when full, which changes no result.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.pieces = PieceIds(self.model)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.full.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        piece = self.pieces.__getitem__
        plain = [not any(c in t for c in _NOT_SPLIT) and not any(s in t for s in self.special) for t in texts]
        fast = [ok and _FAST_TEXT.fullmatch(t) is not None for t, ok in zip(texts, plain)]
        split = [t.split() if ok and not quick else [] for t, ok, quick in zip(texts, plain, fast)]
        missing = {w for ws in split for w in ws} - self.words.keys()
        slow = []
        for word in missing:
            if _FAST.fullmatch(word):
                self.words[word] = b"".join(map(piece, _PIECE.findall(word.lower())))
            else:
                slow.append(word)
        self.words.update(zip(slow, self._whole(slow)))
        get = self.words.__getitem__
        ids = [b"".join(map(piece, _PIECE.findall(t.lower()))) if quick else b"".join(map(get, ws))
               for t, ws, quick in zip(texts, split, fast)]
        rest = [i for i, ok in enumerate(plain) if not ok]
        for i, whole in zip(rest, self._whole([texts[i] for i in rest])):
            ids[i] = whole
        return ids


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file; reused by its later tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def cut(ids: bytes, window: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of full windows and of the rest of one document's ids."""
    view, n = memoryview(ids), len(ids) // 4
    for start in range(0, n, window):
        length = min(window, n - start)
        yield start, length, zlib.crc32(view[4 * start:4 * (start + length)])


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
                    with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's ids as an int array."""
    end = int(end_id).to_bytes(4, "little")
    part = 256

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(tokenizer_path)
        for whole in batches:
            for at in range(0, whole.num_rows, part):
                batch = whole.slice(at, part)
                names = column(batch, "doc_id").to_pylist()
                texts = [t or "" for t in column(batch, "text").to_pylist()]
                rows, arrays = [], []
                for name, ids in zip(names, tok.encode(texts)):
                    ids += end
                    for piece in cut(ids, window):
                        rows.append((name, *piece, len(ids) // 4))
                        if with_ids:
                            arrays.append(np.frombuffer(ids, "<i4")[piece[0]:piece[0] + piece[1]])
                cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
                fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(arrays, pa.list_(pa.int32())))
                    fields.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names=fields)

    schema = PIECE_SCHEMA + (", token_ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of which capacities occur."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        if capacity <= 0:
            return
        self.open[capacity].append(sequence)
        node = self.size + capacity
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of at least ``length``."""
        node, tree = self.size + length, self.tree
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            tree[node] = 0
            node >>= 1
            while node and not (tree[2 * node] or tree[2 * node + 1]):
                tree[node] = 0
                node >>= 1
        return capacity, sequence


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length; the lengths come in decreasing order."""
    windows, sequences, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = windows.tightest(length) if length < window else None
        if found is None:
            capacity, sequence, used = window, used, used + 1
        else:
            capacity, sequence = found
        sequences.append(sequence)
        offsets.append(window - capacity)
        windows.put(capacity - length, sequence)
    return sequences, offsets


def pack_pieces(pieces: DataFrame, groups: int, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; a group's ids start at group * 2**32."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("start", "ascending"), ("ids_crc32", "ascending")])
        base = table.column("pack_group")[0].as_py() << 32
        sequences, offsets = best_fit_decreasing(table.column("length").to_pylist(), window)
        return (table.drop_columns(["pack_group"])
                .append_column("sequence_id", pa.array([base + s for s in sequences], pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("pack_group")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (pieces.select(*pieces.columns, group).groupBy("pack_group")
            .applyInArrow(run, f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
                   group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece."""
    groups = max(1, -(-docs.count() // group_pieces))
    return pack_pieces(tokenize_pieces(docs, tokenizer_path, window, end_id, with_ids), groups, window)
