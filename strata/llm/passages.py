"""Repeated passages by compact windows over word shingles.

HASHES hash functions give every five-word shingle of a document a value each. A compact
window (l, c, r) says: every run of shingles that holds place c and lies within [l, r] has
its minimum at c. Only windows at least ``words`` words wide matter; a place is the centre
of one exactly if it is the minimum of some run of that width, which two sliding passes
find for a whole batch at once, and the Cartesian tree over those few places gives l and r.

Passages that share signatures meet in groups of equal value. A window carries tiles: one byte
for each fifth shingle of the 40 places before and after its centre. A run of 50 words around the
centre holds nine tiles in a row, and a copy with one changed word has eight of them, so both agree in
one of 64 sets of tiles. All windows that agree in a set are near copies of each other and link to its
first one (the shortest document, then the least key): no pair is left out because its group's leader is unlike it,
and no group is expanded into pairs. Windows alike over 45 places on both sides go on as one.
For copies with words more or less, whose tiles shift, every member also links to a leader of
its group, and to a leader among the members that have the same 20 words before, and
after, the centre, or the same 35 words before, or after, or 20 on one and 35 on the other side; these
links are star-shaped, so such copies can still miss each other where their leaders hold too little of them.
A link carries its alignment and the common extent of both windows. Inserted and
deleted words change the alignment inside a passage, so links of one (member, leader) whose
alignments lie at most SLACK apart, one after another, are judged together and go on if
ENOUGH hash functions found them or their tiles agree. Verification matches the shingles of both whole texts
along these alignments: runs of equal shingles are joined in order while their Jaccard
similarity (matches against both spans) is 0.8 or more, and those as wide as asked for are
repeated passages. A passage that occurs verbatim in several documents has its minimum in a
window that covers it in each of them under every hash function. Near copies are found with the probability that
ENOUGH of the minima agree (over 0.97 at similarity 0.8 with 2 of 4).

Verbatim passages are also found exactly. Every run of ``words`` words has one centre (its least shingle, the first of
equal ones) and a name, a hash of all its shingles. The names travel with their window's value to
its group; there each run links to the first of equal value and name, and successive runs of one
alignment make one passage. Runs alike within a task link there and only the first goes on.

Words are those of ``words.hash_words`` (A-Z folded). Defined cases: null texts and texts
under ``words`` words have no passage; passages repeated inside one document count like
others; repeated rows (equal id and text) are one document whose row is repeated; a null
doc_id is a value; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.graph import components
from strata.llm.shared import BROADCAST_IDS, written
from strata.llm.words import SHINGLE, byte_slices, column, hash_words, mix, shingles, text_buffer

WORDS = 50
HASHES = 4
ENOUGH = 2
SLACK = 16
BUCKET_WINDOWS = 60_000
FLUSH_WINDOWS = 150_000
SLICE_BYTES = 1 << 20
PART = 8192

_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], np.uint64)
_WINDOW = np.dtype([("value", "<u8"), ("key", "<i8"), ("size", "<u4"), ("at", "<u4"), ("left", "<u4"), ("right", "<u4"),
                    ("back", "<u8"), ("ahead", "<u8"), ("whole", "<u2")])


def _tiles(places: Iterable[int]) -> tuple[int, int]:
    """Masks of ``back`` and ``ahead`` for tiles at these places: -1 is the tile before the centre, 1 the one after."""
    mask = [0, 0]
    for k in places:
        mask[k > 0] |= 0xFF << 8 * (abs(k) - 1)
    return tuple(mask)


_ALIKE = tuple(_tiles([*range(-b, 0), *range(1, a + 1)]) for b, a in ((0, 0), (3, 0), (0, 3), (3, 3), (6, 0), (0, 6), (3, 6), (6, 3)))
# the sets of seven tiles besides the centre's that leave one out of nine in a row, and a part of them that is four in a row
_NEARLY = {tuple(x for x in run if x != gone): tuple(run[4:] if gone in run[:4] else run[:4])
           for run in ([k for k in range(a, a + 9) if k] for a in range(-8, 1)) for gone in run}
_LINK = np.dtype([("member", "<i8"), ("leader", "<i8"), ("shift", "<i8"), ("first", "<i8"), ("last", "<i8"), ("hashes", "<i4")])


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` values; len - width + 1 results."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def centres(values: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Places that are the minimum of some run of ``width`` values within their document."""
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    least = _slide(values, width, np.minimum)
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    least = np.where(document[:n - width + 1] == document[width - 1:], least, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero((_slide(padded, width, np.maximum) == values) & (values > 0))


def _nearest(value: np.ndarray, other: np.ndarray, passed) -> np.ndarray:
    """For each place the nearest one to a side that is not ``passed`` (value there, own value); ``other`` are the neighbours.

    A place that looks past its neighbour goes on to where that one looks, all places at
    once; beyond a document's end stands len(value).
    """
    value, other = np.append(value, np.uint64(0)), np.append(other, len(value))
    open_ = np.flatnonzero(other < len(value) - 1)
    while len(open_):
        open_ = open_[passed(value[other[open_]], value[open_])]
        other[open_] = other[other[open_]]
        open_ = open_[other[open_] < len(value) - 1]
    return other[:-1]


def window_arrays(values: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays l, c, r (inclusive) of all compact windows of at least ``width`` places (ties: the first is the minimum)."""
    places = centres(values, bounds, width)
    if not len(places):
        return places, places, places
    document = np.searchsorted(bounds, places, side="right") - 1
    value, index, n = values[places], np.arange(len(places)), len(places)
    new = np.r_[True, document[1:] != document[:-1]]
    before = _nearest(value, np.where(new, n, index - 1), np.greater)
    after = _nearest(value, np.where(np.r_[new[1:], True], n, index + 1), np.greater_equal)
    ends = np.append(places, 0)
    left = np.where(before < n, ends[before] + 1, bounds[document])
    right = np.where(after < n, ends[after], bounds[document + 1]) - 1
    wide = right - left + 1 >= width
    return left[wide], places[wide], right[wide]


def compact_windows(values: np.ndarray, bounds: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """``window_arrays`` as a list of (l, c, r)."""
    return list(zip(*(x.tolist() for x in window_arrays(values, bounds, width))))


def _shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of all texts one after another, their number in each text and the bounds of the texts."""
    hashes, rows = hash_words(*text_buffer(texts))
    sizes = np.maximum(np.diff(rows) - SHINGLE + 1, 0)
    starts = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    inside = np.repeat(rows[:-1] - starts[:-1], sizes) + np.arange(starts[-1])
    return shingles(hashes)[inside], sizes, starts


def _planes(rows: np.ndarray) -> bytes:
    """Rows byte by byte: first bytes of all rows, then second ones; the zeros of small numbers lie together and compress."""
    return rows.view(np.uint8).reshape(len(rows), rows.dtype.itemsize).T.tobytes()


def _rows(planes: pa.Scalar, kind: np.dtype) -> np.ndarray:
    """The rows of ``_planes``."""
    columns = np.frombuffer(planes.as_buffer(), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(columns.T).reshape(-1).view(kind)


def _contexts(values: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte for each shingle 5, 10, .., 40 places before, and after (0 outside the document), and a name of all up to 45.

    Shingles five places apart tile the words, so one changed word changes one tile. A tile that
    the document's end cuts is the last shingle.
    """
    document = np.searchsorted(bounds, places, side="right") - 1
    low, high, name, codes = bounds[document], bounds[document + 1] - 1, np.zeros(len(places), np.uint64), []
    for sign in (-1, 1):
        side = np.empty((len(places), 8), np.uint8)
        for j in range(1, 10):
            other = places + sign * j * SHINGLE
            near = np.clip(other, low, high)
            tile = np.where(np.abs(other - near) < SHINGLE, mix(values[near]), np.uint64(0))
            name = mix(name + tile)
            if j < 9:
                side[:, j - 1] = np.where(tile > 0, tile % np.uint64(255) + np.uint64(1), np.uint64(0))
        codes.append(side.view("<u8").reshape(-1))
    return *codes, (name >> np.uint64(48)).astype(np.uint16)


def _grouped(windows: np.ndarray | dict[str, np.ndarray], alike: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows by equal value and equal tiles under the masks ``alike`` (None: all up to 45 places), and where each group starts.

    Groups go by a 64-bit code of these fields; windows of equal code that differ would only
    cost a link that fails.
    """
    code = windows["value"]
    if alike is None:
        code = mix(mix(mix(code + windows["whole"]) + windows["back"]) + windows["ahead"])
    elif any(alike):
        code = mix(mix(code + (windows["back"] & np.uint64(alike[0]))) + (windows["ahead"] & np.uint64(alike[1])))
    order = np.argsort(code)
    code = code[order]
    return order, np.flatnonzero(np.r_[True, code[1:] != code[:-1]][:len(code)])


def _linked(member: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """A link of each window to the other's, as wide as both."""
    links = np.empty(len(member), _LINK)
    links["member"], links["leader"] = member["key"], lead["key"]
    links["shift"] = member["at"].astype(np.int64) - lead["at"]
    links["first"] = member["at"].astype(np.int64) - np.minimum(member["left"], lead["left"])
    links["last"] = member["at"].astype(np.int64) + np.minimum(member["right"], lead["right"])
    links["hashes"] = np.left_shift(1, (member["value"] & np.uint64(3)).astype(np.int32))
    return links


def _leader_links(windows: np.ndarray, alike: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Links of all windows to the first of equal value and equal ``alike`` tiles, and those first ones.

    ``windows`` are ``ranked``, so the first of a group is its leader.
    """
    if not len(windows):
        return np.empty(0, _LINK), windows
    order, start = _grouped(windows, alike)
    first = np.minimum.reduceat(order, start)
    lead = np.repeat(first, np.diff(np.r_[start, len(order)]))
    other = lead != order
    return combined(_linked(windows[order[other]], windows[lead[other]])), windows[np.sort(first)]


def near_links(windows: np.ndarray) -> np.ndarray:
    """Links between all (ranked) windows of equal value that are alike but for one of nine tiles in a row around the centre.

    A run of 46 places around the centre holds nine tiles, and a near copy of it with one changed word
    has eight of them. So two such windows agree in all of some set of ``_NEARLY``; all windows that do are
    near copies of each other, and each is linked to the first of them. Nothing is left out: a pair that is
    near is linked itself, or both are linked to the same window that is as near to each. So many equal words
    need no second hash function and no common window: a link takes in ten tiles on both sides.
    """
    n, out = len(windows), [np.empty(0, np.uint64)]
    fields = {name: np.ascontiguousarray(windows[name]) for name in ("value", "back", "ahead")}
    back, ahead = ((fields[x].view(np.uint8).reshape(-1, 8) > 0).sum(1) for x in ("back", "ahead"))
    shared = {}
    for part in set(_NEARLY.values()):  # a window alone with its four tiles is alone with more of them
        order, start = _grouped(fields, _tiles(part))
        sizes = np.diff(np.r_[start, n])
        shared[part] = order[np.repeat(sizes > 1, sizes)]
    for tiles, part in _NEARLY.items():
        mine = shared[part]
        mine = mine[(back[mine] >= -tiles[0]) & (ahead[mine] >= tiles[-1])]
        if not len(mine):
            continue
        order, start = _grouped({name: x[mine] for name, x in fields.items()}, _tiles(tiles))
        order = mine[order]
        lead = np.repeat(np.minimum.reduceat(order, start), np.diff(np.r_[start, len(order)]))
        other = lead != order
        out.append(order[other].astype(np.uint64) * np.uint64(n) + lead[other].astype(np.uint64))
    member, lead = np.divmod(np.unique(np.concatenate(out)), np.uint64(max(1, n)))
    member, lead = windows[member], windows[lead]
    links = _linked(member, lead)
    links["first"] = np.maximum(np.minimum(links["first"], member["at"].astype(np.int64) - 10 * SHINGLE), 0)
    links["last"] = np.maximum(links["last"], member["at"].astype(np.int64) + 10 * SHINGLE)
    links["hashes"] = (1 << HASHES) - 1
    return combined(links)


def ranked(windows: np.ndarray) -> np.ndarray:
    """Windows in the order of leaders: shortest document, then least key, then first place."""
    return windows[np.lexsort([windows[name] for name in ("at", "key", "size")])]


def _linked_in_task(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of windows whose 45 places on both sides are alike; the first of them goes on.

    Such a window is inside a passage that repeats verbatim, which holds all that a run around its centre can share with others.
    """
    return _leader_links(ranked(windows), None)


def window_blocks(docs: DataFrame, buckets: int, words: int) -> DataFrame:
    """Blocks of windows by range of the values' hashes (kind 0), and of links made within a task (kind 1)."""
    width = words - SHINGLE + 1
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def flush(held: list[np.ndarray], turn: int) -> Iterator[pa.RecordBatch]:
        links, first = _linked_in_task(np.concatenate(held))
        spread = mix(first["value"])  # minima are small numbers: equal ranges of the values themselves would differ widely
        order = np.argsort(spread, kind="stable")
        first, spread = first[order], spread[order]
        first["value"] = (spread & ~np.uint64(3)) | (first["value"] & np.uint64(3))  # sorted numbers compress
        cuts = np.r_[0, np.searchsorted(spread, bounds), len(first)]
        full = np.flatnonzero(np.diff(cuts)).tolist()
        blocks = [_planes(first[cuts[k]:cuts[k + 1]]) for k in full]
        parts = [x.tobytes() for x in np.array_split(links, max(1, len(links) // BUCKET_WINDOWS))] if len(links) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(full + [(turn + k) % buckets for k in range(len(parts))], pa.int32()),
             pa.array([0] * len(full) + [1] * len(parts), pa.int32()), pa.array(blocks + parts, pa.binary())],
            names=["bucket", "kind", "block"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, turn = [], 0, 0
        for whole in batches:
            for batch in byte_slices(whole, "text", SLICE_BYTES):
                keys = column(batch, "key").to_numpy()
                every, sizes, starts = _shingled(column(batch, "text"))
                for j in range(HASHES):
                    value = (mix(every ^ _SEEDS[j]) & ~np.uint64(3)) | np.uint64(j)
                    left, centre, right = window_arrays(value, starts, width)
                    if not len(centre):
                        continue
                    document = np.searchsorted(starts, centre, side="right") - 1
                    block = np.empty(len(centre), _WINDOW)
                    block["value"], block["key"], block["size"] = value[centre], keys[document], sizes[document]
                    block["at"] = centre - starts[document]
                    block["back"], block["ahead"], block["whole"] = _contexts(every, starts, centre)
                    block["left"], block["right"] = centre - left, right - centre
                    held.append(block)
                    count += len(block)
                if count > FLUSH_WINDOWS:
                    yield from flush(held, turn)
                    held, count, turn = [], 0, turn + 1
        if count:
            yield from flush(held, turn)

    return docs.select("key", "text").mapInArrow(run, "bucket int, kind int, block binary")


def passage_links(blocks: DataFrame, words: int, enough: int) -> DataFrame:
    """(member, leader, shifts, first, last): neighbouring alignments that ``enough`` hash functions found, wide enough."""
    width = words - SHINGLE + 1

    def run(table: pa.Table) -> pa.Table:
        out = [np.empty(0, _LINK)]
        windows = [_rows(b, _WINDOW) for b, k in zip(table.column("block"), table.column("kind").to_pylist()) if k == 0]
        if windows:
            windows = np.concatenate(windows)
            order, start = _grouped(windows, _ALIKE[0])
            sizes = np.diff(np.r_[start, len(order)])
            windows = ranked(windows[order[np.repeat(sizes > 1, sizes)]])  # a value that no other window has links nothing
            out += [_leader_links(windows, alike)[0] for alike in _ALIKE]
            links, windows = _leader_links(windows, None)
            out += [links, near_links(windows)]
        out += [np.frombuffer(b.as_buffer(), _LINK) for b, k in zip(table.column("block"), table.column("kind").to_pylist()) if k == 1]
        links = combined(np.concatenate(out))
        links = links[np.argsort(links["member"])]  # equal numbers in a row compress
        return pa.table({name: pa.array(links[name]) for name in _LINK.names})

    ordered = Window.partitionBy("member", "leader").orderBy("shift")
    found = (blocks.groupBy("bucket").applyInArrow(run, "member long, leader long, shift long, first long, last long, hashes int")
             .repartition("member").groupBy("member", "leader", "shift")
             .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.bit_or("hashes").alias("hashes")))
    apart = F.coalesce((F.col("shift") - F.lag("shift").over(ordered) > SLACK).cast("int"), F.lit(0))
    return (found.withColumn("apart", apart).withColumn("place", F.sum("apart").over(ordered))
            .groupBy("member", "leader", "place")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.bit_or("hashes").alias("hashes"),
                 F.array_sort(F.collect_list(F.struct((-F.bit_count("hashes")).alias("less"), "shift"))).alias("shifts"))
            .where((F.bit_count("hashes") >= enough) & (F.col("last") - F.col("first") + 1 >= width))
            .select("member", "leader", F.col("shifts.shift").alias("shifts"), "first", "last"))


def combined(links: np.ndarray) -> np.ndarray:
    """One link for each member, leader and shift, as wide as all of them, without those of a place to itself."""
    links = links[(links["member"] != links["leader"]) | (links["shift"] != 0)]
    if not len(links):
        return links
    fields = "member", "leader", "shift"
    code = np.zeros(len(links), np.uint64)
    for name in fields:
        code = mix(code + links[name].astype(np.uint64))
    links = links[np.argsort(code)]
    start = np.flatnonzero(np.r_[True, np.logical_or.reduce([links[name][1:] != links[name][:-1] for name in fields])])
    out = links[start]
    for name, pick in (("first", np.minimum), ("last", np.maximum), ("hashes", np.bitwise_or)):
        out[name] = pick.reduceat(links[name], start)
    return out


_SEGMENT = np.dtype([("value", "<u8"), ("key", "<i8"), ("size", "<u4"), ("place", "<u4"), ("runs", "<u4")])
_SPAN = np.dtype([(name, "<i8") for name in ("member", "first", "last", "leader", "leader_first", "leader_last")])
_RUN = np.uint64(0x9E3779B97F4A7C15)


def run_names(values: np.ndarray, width: int) -> np.ndarray:
    """A 48-bit name of each run of ``width`` shingles; it is only compared among runs of one centre's value."""
    return _slide(values, width, lambda a, b: mix(a * _RUN + b)) >> np.uint64(16)


def run_links(segments: np.ndarray, names: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Passages that runs share with the first run of equal value and name, and a mask of those first runs.

    A segment is ``runs`` successive runs of one document from ``place`` on, whose centres have
    the value; ``names`` holds those of all segments in order. Of equal runs the one in the
    earlier segment is first.
    """
    segment = np.repeat(np.arange(len(segments)), segments["runs"])
    begin = np.cumsum(segments["runs"], dtype=np.int64) - segments["runs"]
    place = segments["place"][segment].astype(np.int64) + np.arange(len(names)) - begin[segment]
    whole = mix(names) ^ segments["value"][segment]
    order = np.argsort(whole, kind="stable")
    new = np.ones(len(names), bool)
    new[1:] = whole[order[1:]] != whole[order[:-1]]
    leader = np.empty(len(names), np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(names)), 0))]
    member = np.flatnonzero(leader != np.arange(len(names)))
    first, leader = np.ones(len(names), bool), leader[member]
    first[member] = False
    key, lead, shift = segments["key"][segment[member]], segments["key"][segment[leader]], place[member] - place[leader]
    other = (key != lead) | (shift != 0)  # a repeated row is no other place
    key, lead, shift, member = key[other], lead[other], shift[other], member[other]
    start = np.ones(len(member), bool)
    start[1:] = ((key[1:] != key[:-1]) | (lead[1:] != lead[:-1]) | (shift[1:] != shift[:-1])
                 | (place[member[1:]] != place[member[:-1]] + 1))
    end = np.r_[start[1:], True][:len(start)]
    spans = np.empty(int(start.sum()), _SPAN)
    spans["member"], spans["leader"] = key[start], lead[start]
    spans["first"], spans["last"] = place[member[start]], place[member[end]] + words
    spans["leader_first"], spans["leader_last"] = spans["first"] - shift[start], spans["last"] - shift[start]
    return spans, first


def linked_in_parts(segments: np.ndarray, names: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``run_links`` by parts of about PART segments that cut no value; segments of equal value follow each other."""
    new = np.flatnonzero(np.r_[True, segments["value"][1:] != segments["value"][:-1]]) if len(segments) else np.empty(0, np.int64)
    cuts = np.r_[new[np.flatnonzero(np.diff(new // PART, prepend=-1))], len(segments)].tolist()
    at = np.r_[0, np.cumsum(segments["runs"], dtype=np.int64)]
    found = [run_links(segments[a:b], names[at[a]:at[b]], words) for a, b in zip(cuts[:-1], cuts[1:])]
    spans, first = zip(*found) if found else ([np.empty(0, _SPAN)], [np.empty(0, bool)])
    return np.concatenate(spans), np.concatenate(first)


def _packed(names: np.ndarray) -> tuple[bytes, bytes]:
    """48-bit names as their low 32 and high 16 bits."""
    return names.astype("<u4").tobytes(), (names >> np.uint64(32)).astype("<u2").tobytes()


def run_blocks(docs: DataFrame, buckets: int, words: int) -> DataFrame:
    """Blocks of segments of runs by range of the values' hashes, and of passages found within a task (no names)."""
    width = words - SHINGLE + 1
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def flush(held: list[tuple[np.ndarray, np.ndarray]], turn: int) -> Iterator[pa.RecordBatch]:
        segments, names = (np.concatenate(x) for x in zip(*held))
        begin = np.cumsum(segments["runs"], dtype=np.int64) - segments["runs"]
        spread = mix(segments["value"])
        order = np.lexsort([segments["place"], segments["key"], segments["size"], spread])
        segments, spread = segments[order], spread[order]
        ends = np.cumsum(segments["runs"], dtype=np.int64)
        names = names[np.repeat(begin[order] - ends + segments["runs"], segments["runs"]) + np.arange(len(names))]
        spans, first = linked_in_parts(segments, names, words)
        left = np.flatnonzero(first)
        of = np.repeat(np.arange(len(segments)), segments["runs"])[left]
        starts = np.flatnonzero(np.r_[True, (np.diff(left) != 1) | (np.diff(of) != 0)])
        kept, names, of = segments[of[starts]], names[left], of[starts]
        kept["place"] += (left[starts] - (ends - segments["runs"])[of]).astype(np.uint32)
        kept["runs"] = np.diff(np.r_[starts, len(left)])
        cuts = np.r_[0, np.searchsorted(spread[of], bounds), len(kept)]
        at = np.r_[starts, len(left)][cuts]
        full = np.flatnonzero(np.diff(cuts)).tolist()
        blocks = [(_planes(kept[cuts[k]:cuts[k + 1]]), *_packed(names[at[k]:at[k + 1]])) for k in full]
        parts = [(x.tobytes(), None, None) for x in np.array_split(spans, max(1, len(spans) // BUCKET_WINDOWS))] if len(spans) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(full + [(turn + k) % buckets for k in range(len(parts))], pa.int32()),
             *[pa.array(x, pa.binary()) for x in zip(*blocks, *parts)]], names=["bucket", "block", "low", "high"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, turn = [], 0, 0
        for whole in batches:
            for batch in byte_slices(whole, "text", SLICE_BYTES):
                keys = column(batch, "key").to_numpy()
                every, sizes, starts = _shingled(column(batch, "text"))
                value = mix(every ^ _SEEDS[0]) | np.uint64(1)
                left, centre, right = window_arrays(value, starts, width)
                if not len(centre):
                    continue
                begin = np.maximum(left, centre - width + 1)
                runs = np.minimum(centre, right - width + 1) - begin + 1
                document = np.searchsorted(starts, centre, side="right") - 1
                block = np.empty(len(centre), _SEGMENT)
                block["value"], block["key"], block["size"] = value[centre], keys[document], sizes[document]
                block["place"], block["runs"] = begin - starts[document], runs
                ends = np.cumsum(runs)
                held.append((block, run_names(every, width)[np.repeat(begin - ends + runs, runs) + np.arange(ends[-1])]))
                count += len(block)
                if count > FLUSH_WINDOWS // HASHES:
                    yield from flush(held, turn)
                    held, count, turn = [], 0, turn + 1
        if count:
            yield from flush(held, turn)

    return docs.select("key", "text").mapInArrow(run, "bucket int, block binary, low binary, high binary")


def verbatim_passages(blocks: DataFrame, words: int) -> DataFrame:
    """(member, first, last, leader, leader_first, leader_last) in words, last exclusive: all runs of ``words`` words that repeat."""

    def run(table: pa.Table) -> pa.Table:
        read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in mine.column(name)]
        mine = table.filter(table.column("low").is_null())
        out = [np.empty(0, _SPAN), *read("block", _SPAN)]
        mine = table.filter(table.column("low").is_valid())
        if mine.num_rows:
            segments = np.concatenate([_rows(x, _SEGMENT) for x in mine.column("block")])
            names = np.concatenate(read("low", "<u4")) + (np.concatenate(read("high", "<u2")).astype(np.uint64) << np.uint64(32))
            begin = np.cumsum(segments["runs"], dtype=np.int64) - segments["runs"]
            _, name, times = np.unique(segments["value"], return_inverse=True, return_counts=True)
            again = np.flatnonzero(times[name] > 1)  # a value that no other segment has links nothing
            again = again[np.lexsort([*[segments[x][again] for x in ("place", "key", "size")], name[again]])]
            segments, begin = segments[again], begin[again]
            ends = np.cumsum(segments["runs"], dtype=np.int64)
            names = names[np.repeat(begin - ends + segments["runs"], segments["runs"]) + np.arange(ends[-1] if len(ends) else 0)]
            out.append(linked_in_parts(segments, names, words)[0])
        spans = np.concatenate(out)
        return pa.table({name: pa.array(spans[name]) for name in _SPAN.names})

    return blocks.groupBy("bucket").applyInArrow(run, ", ".join(f"{name} long" for name in _SPAN.names))


PREFERRED = 8


class Text:
    """The shingles of a text, and an index of their places that is made when it is first asked for."""

    def __init__(self, values: np.ndarray):
        self.values, self._index = values, None

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles, and all (rank of the shingle, place) in order as rank * (length + 1) + place."""
        if self._index is None:
            order = np.argsort(self.values, kind="stable")
            values = self.values[order]
            new = np.r_[True, values[1:] != values[:-1]][:len(values)]
            self._index = values[new], (np.cumsum(new) - 1) * (len(values) + 1) + order
        return self._index


def matched_places(part: np.ndarray, first: int, other: np.ndarray | Text, shifts: np.ndarray) -> np.ndarray:
    """For each shingle of ``part`` (from place ``first``) the place of an equal one in ``other``, or -1.

    The first alignments are tried as they are; what stays open takes the first equal
    shingle within SLACK of any alignment of the link.
    """
    text = other if isinstance(other, Text) else Text(other)
    other, n = text.values, len(text.values)
    out, missing = np.full(len(part), -1, np.int64), None
    for s in shifts[:PREFERRED].tolist():
        a, b = max(0, s - first), min(len(part), n + s - first)  # places whose partners lie in the text
        if a < b and missing is None:
            hit = np.flatnonzero(part[a:b] == other[first + a - s:first + b - s]) + a
        elif a < b:
            hit = missing[np.searchsorted(missing, a):np.searchsorted(missing, b)]
            hit = hit[part[hit] == other[hit + (first - s)]]
        else:
            continue
        out[hit] = hit + (first - s)
        missing = np.flatnonzero(out < 0)
        if not len(missing):
            return out
    if not n:
        return out
    if missing is None:
        missing = np.arange(len(part))
    low, high = int(shifts.min()) - SLACK, int(shifts.max()) + SLACK
    names, keys = text.index()
    name = np.minimum(np.searchsorted(names, part[missing]), len(names) - 1)
    known = names[name] == part[missing]
    missing, name = missing[known], name[known]
    start = np.clip(first + missing - high, 0, n)
    near = np.minimum(np.searchsorted(keys, name * (n + 1) + start), len(keys) - 1)
    at = keys[near] - name * (n + 1)
    good = (at >= start) & (at < n) & (at <= first + missing - low)
    out[missing[good]] = at[good]
    return out


def agreeing_runs(places: np.ndarray, width: int) -> list[tuple[int, int, int, int]]:
    """(a, b, c, d): [a, b) of at least ``width`` places and its match [c, d), of Jaccard similarity 0.8 or more.

    ``places`` are those of ``matched_places``; a run begins and ends with a match.
    """
    have = np.flatnonzero(places >= 0)
    if not len(have) or have[-1] - have[0] + 1 < width:
        return []
    at = places[have]
    cut = np.flatnonzero((have[1:] - have[:-1] != 1) | (at[1:] - at[:-1] != 1))
    starts, ends = have[cut + 1].tolist(), (have[cut] + 1).tolist()
    out, current = [], None
    for a, b, c in zip([int(have[0]), *starts], [*ends, int(have[-1]) + 1], [int(at[0]), *at[cut + 1].tolist()]):
        if current and c >= current[3] and 9 * (current[4] + b - a) >= 4 * (b - current[0] + c + b - a - current[2]):
            current = (current[0], b, current[2], c + b - a, current[4] + b - a)
        else:
            if current:
                out.append(current)
            current = (a, b, c, c + b - a, b - a)
    if current:
        out.append(current)
    return [x[:4] for x in out if x[1] - x[0] >= width]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """Small parts of each batch: a row holds a whole text."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


class LastText:
    """The text read last: a sorted join brings the rows of one text together."""

    def __init__(self):
        self.key, self.last = None, Text(np.empty(0, np.uint64))

    def text(self, batch: pa.RecordBatch, row: int, key: int) -> Text:
        if key != self.key:
            hashes, _ = hash_words(*text_buffer(column(batch, "text").slice(row, 1)))
            self.key, self.last = key, Text(shingles(hashes))
        return self.last


def verified_passages(links: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(member, first, last, leader, leader_first, leader_last) in words, last exclusive.

    A member's part goes to its leader's text; a text that repeats parts of itself is matched where it is read.
    """
    width = words - SHINGLE + 1

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = LastText()
        for batch in slices(batches):
            places = zip(column(batch, "member").to_pylist(), column(batch, "first").to_pylist(), column(batch, "last").to_pylist())
            parts = [read.text(batch, i, key).values[f:e + 1].tobytes() for i, (key, f, e) in enumerate(places)]
            yield pa.RecordBatch.from_arrays([*[column(batch, n) for n in ("member", "leader", "shifts", "first")],
                                              pa.array(parts, pa.binary())], names=["member", "leader", "shifts", "first", "part"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = LastText()
        for batch in slices(batches):
            out, same = [], "last" in batch.schema.names
            fixed = [column(batch, n).to_pylist() for n in ("member", "leader", "first", "last" if same else "first")]
            for i, (member, leader, first, last) in enumerate(zip(*fixed)):
                text = read.text(batch, i, leader)
                part = text.values[first:last + 1] if same else np.frombuffer(column(batch, "part")[i].as_buffer(), "<u8")
                shifts = column(batch, "shifts")[i].values.to_numpy()
                places = matched_places(part, first, text, shifts)
                if member == leader and shifts.min() <= SLACK and shifts.max() >= -SLACK:  # no place of a text is its own repeat
                    places = np.where(places == first + np.arange(len(part)), -1, places)
                for a, b, c, d in agreeing_runs(places, width):
                    out.append((member, first + a, first + b + SHINGLE - 1, leader, c, d + SHINGLE - 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 6)],
                                             names=["member", "first", "last", "leader", "leader_first", "leader_last"])

    schema = "member long, first long, last long, leader long, leader_first long, leader_last long"
    named = lambda name: texts.select(F.col("key").alias(name), "text")
    within = links.where(F.col("member") == F.col("leader")).join(named("leader"), "leader").mapInArrow(verify, schema)
    parts = links.where(F.col("member") != F.col("leader")).join(named("member"), "member").mapInArrow(
        cut, "member long, leader long, shifts array<long>, first long, part binary")
    return parts.join(named("leader"), "leader").mapInArrow(verify, schema).unionByName(within)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")


def repeated_passages(docs: DataFrame, words: int = WORDS, enough: int = ENOUGH) -> DataFrame:
    """(doc_id, n_passages, n_dup_words, passages, partners, component_id) of every document.

    ``passages`` are merged word spans [first, last) that occur elsewhere, ``partners`` the
    doc_ids of the leaders of its passages, ``component_id`` the least doc_id that shared
    passages lead to, its own included.
    """
    keyed = _keyed(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size / 6 * HASHES * 2 / (words - SHINGLE + 2)  # windows, at six bytes a word
    buckets = max(1, round(expected / BUCKET_WINDOWS))
    exact = written(verbatim_passages(run_blocks(keyed, buckets, words), words), "verbatim")
    links = written(passage_links(window_blocks(keyed, buckets, words), words, enough), "links")
    wanted = written(links.select("member").unionByName(links.select(F.col("leader").alias("member"))).distinct(), "keys")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted.hint("shuffle_hash")
    # dealt out by key once, here: the joins of the verification reuse that
    texts = keyed.join(side, F.col("key") == F.col("member"), "left_semi").select("key", "text").dropDuplicates(["key"])
    found = written(verified_passages(links, texts, words), "passages").unionByName(exact)
    roots = components(found.select(F.col("member").alias("a"), F.col("leader").alias("b")))
    # both sides of a passage repeat; the leader's spans are made distinct before they meet
    spans = (found.select(F.col("member").alias("key"), "first", "last")
             .unionByName(found.select(F.col("leader").alias("key"), F.col("leader_first").alias("first"), F.col("leader_last").alias("last")))
             .distinct())
    start = F.array().cast("array<struct<first:bigint,last:bigint>>")
    merged = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans")).select(
        "key", F.aggregate("spans", start, lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["first"] <= F.element_at(acc, -1)["last"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))))
            .otherwise(F.concat(acc, F.array(F.struct(s["first"].alias("first"), s["last"].alias("last")))))).alias("passages"))
    ids = written(keyed.select("doc_id", "key"), "ids")
    names = ids.distinct()
    partners = (found.select(F.col("member").alias("m"), F.col("leader").alias("key")).distinct().join(names, "key")
                .groupBy(F.col("m").alias("key")).agg(F.array_sort(F.collect_set("doc_id")).alias("partners")))
    rooted = roots.withColumnRenamed("node", "key").join(names, "key")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = rooted.join(least, "root").select("key", "component_id").distinct()
    return (ids.join(merged, "key", "left").join(partners, "key", "left").join(component, "key", "left")
            .select("doc_id", F.coalesce(F.size("passages"), F.lit(0)).cast("long").alias("n_passages"),
                    F.coalesce(F.aggregate("passages", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"]),
                               F.lit(0).cast("long")).alias("n_dup_words"),
                    F.coalesce("passages", start).alias("passages"),
                    F.coalesce("partners", F.array().cast("array<bigint>")).alias("partners"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
