"""The prefix trie of conversations, by range minima over sorted common-prefix lengths.

Every turn becomes a fixed-size unit (a 96-bit hash of role and text, and the text's
bytes), a conversation the string of its units. Equal conversations are one row with a
count. Rows are range-partitioned and sorted by these strings, so the conversations below
a node are neighbours. A task takes its rows in blocks; in a block, a sparse table over
the common-prefix lengths of neighbours answers range minima, and every candidate prefix
(conversation i, depth d) searches its left and its right extent on its own, in
logarithmic steps, all candidates at once and without a stack. An interval gives a
node's members, least id, children, leaves and savings by prefix sums.

A node that touches a block's edge (a prefix of its first or last row) may go on in the
next one: such nodes alone leave the block as parts that are added up by their prefix
hash; there are at most two paths of them a block, however many conversations share a
first turn. What lies below such a node across blocks is summed along the paths by pointer
doubling, in rounds logarithmic in the depth.

Ids of equal conversations are range-partitioned as well and written as pieces of text,
so the hash over the ids of a hot conversation streams over few rows.

Bounded memory: a block holds at most ``BLOCK`` bytes of units (one conversation, if that
has more: 16 bytes a turn). Defined cases: turns follow their numbers, null first, equal
numbers by their unit; a null role or text is empty; rows without conv_id belong to no
conversation and are left out; repeated rows are turns of their own; other columns do not
matter; an empty table gives no rows (not even a root).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.shared import written
from strata.llm.words import column

UNIT = 16          # bytes of a turn: 12 of the hash, 4 of the text's length
BLOCK = 4 << 20
TURNS = 256        # turn numbers counted together when places are given
ID_TEXT = 256 << 10
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends binary")


def turn_units(turns: DataFrame, together: int = TURNS) -> DataFrame:
    """(conv_id, place, unit): the turns of every conversation from place 0, each as hexadecimal text.

    ``together`` turn numbers of a conversation are put in order in one place.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0")
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.concat(F.substring(name, 1, 24), F.lower(size)).alias("unit"),
        F.coalesce(F.floor(F.col("turn") / together), F.lit(-1 << 60)).alias("block"))
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "unit")
    return (rows.withColumn("k", F.row_number().over(inside)).join(blocks, ["conv_id", "block"])
            .select("conv_id", (F.col("first") + F.col("k") - 1).alias("place"), "unit"))


def sequences(units: DataFrame, id_text: int = ID_TEXT) -> DataFrame:
    """(key, conv_id, n, ends): distinct unit strings, the least id, the number and the hashed ids of their conversations.

    ``units`` has (conv_id, place, unit); a row with a null unit only names its conversation.
    """
    key = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("unit").isNotNull(), F.struct("place", "unit")))), lambda u: u["unit"]), ""))
    talks = written(units.groupBy("conv_id").agg(key.alias("key")), "talks")
    whole = talks.select("conv_id", F.unhex(F.md5("key")).alias("name"), "key")
    kinds = whole.groupBy("name", "key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    ends = hashed_ids(whole.select("name", "conv_id"), id_text)
    return written(kinds.join(ends, "name").select("key", "conv_id", "n", "ends"), "sequences")


def hashed_ids(members: DataFrame, id_text: int = ID_TEXT) -> DataFrame:
    """(name, ends): the SHA-256 of every name's ids in decimal, ascending, joined by commas."""

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, parts, size = None, None, [], 0

        def row() -> pa.RecordBatch:
            return pa.record_batch({"name": pa.array([name], pa.binary()), "first": pa.array([first], pa.int64()),
                                    "ids": pa.array([",".join(parts)], pa.string())})

        for batch in batches:
            out = []
            for n, c in zip(column(batch, "name").to_pylist(), column(batch, "conv_id").to_pylist()):
                if n != name or size >= id_text:
                    if parts:
                        out.append(row())
                    name, first, parts, size = n, c, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if parts:
            yield row()

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            names, ends = [], []
            for n, ids in zip(column(batch, "name").to_pylist(), column(batch, "ids").to_pylist()):
                if state is None or n != name:
                    if state is not None:
                        names.append(name)
                        ends.append(state.digest())
                    name, state = n, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.record_batch({"name": pa.array(names, pa.binary()), "ends": pa.array(ends, pa.binary())})
        if state is not None:
            yield pa.record_batch({"name": pa.array([name], pa.binary()), "ends": pa.array([state.digest()], pa.binary())})

    pieces = (members.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
              .mapInArrow(texts, "name binary, first long, ids string"))
    return (pieces.repartition("name").sortWithinPartitions("name", "first")
            .mapInArrow(hashes, "name binary, ends binary"))


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of all runs of 2**k values."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def range_minimum(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The minimum of values[first..last], both inclusive, for many ranges."""
    level = np.int64(np.floor(np.log2(last - first + 1)))
    out = np.empty(len(first), levels[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(levels[k][first[at]], levels[k][last[at] - (1 << int(k)) + 1])
    return out


def extents(common: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last row that begin with ``depth`` units of ``row``; common[i] is shared by rows i - 1 and i."""
    levels, n = sparse_table(common), len(common)
    left, right = row.astype(np.int64).copy(), row.astype(np.int64).copy()
    for k in range(len(levels) - 1, -1, -1):
        step, table = 1 << k, levels[k]
        ok = np.flatnonzero(right + step < n)                   # rows right + 1 .. right + step
        ok = ok[table[right[ok] + 1] >= depth[ok]]
        right[ok] += step
        ok = np.flatnonzero(left - step >= 0)                   # rows left - step + 1 .. left
        ok = ok[table[left[ok] - step + 1] >= depth[ok]]
        left[ok] -= step
    return left, right


def common_units(a: bytes, b: bytes) -> int:
    """How many units two strings have in common at their beginning."""
    n = min(len(a), len(b)) // UNIT
    if a[:n * UNIT] == b[:n * UNIT]:
        return n
    one, two = (np.frombuffer(x, f"V{UNIT}", n) for x in (a, b))
    return int(np.argmax(one != two))


def block_nodes(keys: list[bytes], ids: np.ndarray, counts: np.ndarray, ends: list[bytes]) -> dict[str, np.ndarray]:
    """All nodes of a block of sorted, distinct unit strings, in the order of a walk from the root.

    ``open`` is -1 for a node that lies inside the block, else its place among the open
    ones; ``parent`` is a node's place in this list (-1: the root). For an open node,
    children and sums are those of the block's closed nodes only.
    """
    n = len(keys)
    length = np.array([len(k) // UNIT for k in keys], np.int64)
    common = np.array([-1, *(common_units(a, b) for a, b in zip(keys, keys[1:]))], np.int64)
    fresh = length - common                                    # nodes that begin at a row: depths common + 1 .. length
    offset = np.append(0, np.cumsum(fresh))
    row = np.repeat(np.arange(n), fresh)
    depth = np.arange(offset[-1]) - offset[row] + common[row] + 1
    _, right = extents(common, row, depth)
    parent_row, _ = extents(common, row, depth - 1)
    parent = np.where(depth > 0, offset[parent_row] + depth - 1 - (common[parent_row] + 1), -1)
    total = np.append(0, np.cumsum(counts))
    n_convs = total[right + 1] - total[row]
    least = range_minimum(sparse_table(ids), row, right)
    sizes = np.frombuffer(b"".join(keys), ">u4")[UNIT // 4 - 1::UNIT // 4].astype(np.int64)
    at = np.append(0, np.cumsum(length))[row] + depth - 1
    size = np.where(depth > 0, sizes[np.maximum(at, 0)] if len(sizes) else 0, 0)
    opened = (row == 0) | (right == n - 1)
    closed = ~opened
    children = np.bincount(parent[closed & (parent >= 0)], minlength=len(row))
    saved = np.where(closed, (n_convs - 1) * size, 0)
    leaf = closed & (children == 0)
    below = offset[right + 1]                                  # the subtree: nodes from this one up to here
    own = np.arange(len(row))

    def sums(values: np.ndarray) -> np.ndarray:
        run = np.append(0, np.cumsum(values))
        return run[below] - run[own]

    number = np.where(opened, np.cumsum(opened) - 1, -1)
    has_end = depth == length[row]
    return {"row": row, "depth": depth, "parent": parent, "open": number, "conv_id": least, "n_convs": n_convs, "size": size,
            "n_children": children, "n_leaves": sums(leaf), "saved_tokens": sums(saved),
            "ends": np.array([ends[r] if e else None for r, e in zip(row, has_end)], object)}


NODES = "block string, open int, parent_open int, name binary, parent_name binary, size long, " + NODE


def prefix_names(key: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of 0 .. depth units, by one running hash."""
    state, names = hashlib.md5(), []
    for d in range(depth + 1):
        if d:
            state.update(key[(d - 1) * UNIT:d * UNIT])
        names.append(state.copy().digest())
    return names


def block_parts(keys: list[bytes], ids: np.ndarray, counts: np.ndarray, ends: list[bytes], block: str) -> pa.RecordBatch:
    """The nodes of one block as rows of NODES: closed ones whole, open ones as named parts."""
    found = block_nodes(keys, ids, counts, ends)
    row, depth, number, parent = found["row"], found["depth"], found["open"], found["parent"]
    opened = np.flatnonzero(number >= 0)
    deepest: dict[int, int] = {}
    for r, d in zip(row[opened].tolist(), depth[opened].tolist()):
        deepest[r] = max(d, deepest.get(r, 0))
    paths = {r: prefix_names(keys[r], d) for r, d in deepest.items()}
    name, above = np.full(len(row), None, object), np.full(len(row), None, object)
    for x in opened.tolist():
        name[x] = paths[int(row[x])][int(depth[x])]
        above[x] = paths[int(row[x])][int(depth[x]) - 1] if depth[x] else None
    parent_open = np.where(parent >= 0, number[np.maximum(parent, 0)], -1)
    known = (parent >= 0) & (parent_open < 0)
    parent_id = pa.array(np.where(known, found["conv_id"][np.maximum(parent, 0)], 0), pa.int64(), mask=~known)
    columns = {"block": pa.array([block] * len(row), pa.string()), "open": pa.array(number, pa.int32()),
               "parent_open": pa.array(parent_open, pa.int32()), "name": pa.array(list(name), pa.binary()),
               "parent_name": pa.array(list(above), pa.binary()), "size": pa.array(found["size"], pa.int64()),
               "conv_id": pa.array(found["conv_id"], pa.int64()), "depth": pa.array(depth, pa.int64()), "parent_conv_id": parent_id}
    for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
        columns[c] = pa.array(found[c], pa.int64())
    columns["ends"] = pa.array(list(found["ends"]), pa.binary())
    return pa.record_batch(columns)


def node_parts(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of all blocks of the sorted sequences, as rows of NODES."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = TaskContext.get().partitionId(), 0
        for whole in batches:
            keys = column(whole, "key").to_pylist()
            ids, counts = (column(whole, c).to_numpy(zero_copy_only=False) for c in ("conv_id", "n"))
            ends = column(whole, "ends").to_pylist()
            sizes = np.append(0, np.cumsum([len(k) + UNIT for k in keys]))
            at = 0
            while at < len(keys):
                end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + block, side="right")) - 1)
                yield block_parts(keys[at:end], ids[at:end], counts[at:end], ends[at:end], f"{task}-{blocks}")
                at, blocks = end, blocks + 1

    return rows.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, NODES)


def path_sums(nodes: DataFrame) -> DataFrame:
    """(name, leaves, saved): the columns leaf and own summed over every node's subtree, by pointer doubling.

    ``nodes`` has (name, parent_name, leaf, own). After round k a row holds the sum over the
    nodes less than 2**k steps below it and a pointer 2**k steps up.
    """
    state = written(nodes.select("name", F.col("parent_name").alias("up"), F.col("leaf").alias("leaves"), F.col("own").alias("saved")), "sums")
    while not state.where(F.col("up").isNotNull()).isEmpty():
        below = (state.where(F.col("up").isNotNull()).groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
                 .withColumnRenamed("up", "name"))
        higher = state.select(F.col("name").alias("up"), F.col("up").alias("next"))
        state = written(state.join(below, "name", "left").join(higher, "up", "left").select(
            "name", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "sums")
    return state.select("name", "leaves", "saved")


def trie(units: DataFrame, block: int = BLOCK, id_text: int = ID_TEXT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends (binary, null: none)."""
    parts = written(node_parts(sequences(units, id_text), block), "parts")
    closed, edges = parts.where("open < 0"), parts.where("open >= 0")
    merged = edges.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_name").alias("parent_name"), F.min("size").alias("size"),
        F.max("ends").alias("ends"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    merged = written(merged, "edges")
    inner = merged.where(F.col("parent_name").isNotNull()).groupBy(F.col("parent_name").alias("name")).agg(F.count("*").alias("more"))
    merged = merged.join(inner, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    merged = written(merged.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
                     .withColumn("own", (F.col("n_convs") - 1) * F.col("size")), "edges")
    above = merged.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("above"))
    names = [f.split()[0] for f in NODE.split(", ")]
    whole = (merged.join(path_sums(merged), "name").join(above, "parent_name", "left")
             .withColumn("n_leaves", F.col("n_leaves") + F.col("leaves")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("saved"))
             .withColumn("parent_conv_id", F.col("above")).select(*names))
    # a closed node below an open one learns that one's id within its block
    ids = edges.select("block", F.col("open").alias("parent_open"), "name").join(
        merged.select("name", F.col("conv_id").alias("above")), "name").drop("name")
    under = (closed.where("parent_open >= 0").join(ids, ["block", "parent_open"])
             .withColumn("parent_conv_id", F.col("above")).select(*names))
    return closed.where("parent_open < 0").select(*names).unionByName(under).unionByName(whole)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations of a table of turns (conv_id, turn, role, text)."""
    return trie(turn_units(turns))


def spliced(units: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Units of conversations rebuilt to share beginnings: the first h turns of conversation c - c % group, then c's own after its first h.

    h is the CRC-32 of c in decimal, modulo ``heads``. A conversation left without turns keeps a row with a null unit.
    """
    units = written(units, "units")
    c = F.col("conv_id")
    own = units.withColumn("h", F.crc32(c.cast("string").cast("binary")) % heads)
    tails = own.where(F.col("place") >= F.col("h")).select("conv_id", "place", "unit")
    talks = own.select("conv_id", "h").distinct().withColumn("head", c - c % group)
    begun = units.where(F.col("place") < heads - 1).select(F.col("conv_id").alias("head"), "place", "unit")
    begun = talks.where("h > 0").join(begun, "head").where(F.col("place") < F.col("h")).select("conv_id", "place", "unit")
    bare = talks.select("conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("unit"))
    return tails.unionByName(begun).unionByName(bare)
