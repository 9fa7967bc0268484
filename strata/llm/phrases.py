"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

The documents are dealt into ``SHARDS`` shards, which are scanned in turn, again and
again. Phrases of all lengths are counted in the same scan: words from the first one on,
and a longer phrase from the scan after both its subphrases (all but its last word, all
but its first) have been counted ``threshold`` times, until it has seen every shard once
(one full cycle). A phrase whose cycle is complete keeps its exact count, or goes if that
is below the threshold; scans go on until no phrase is open.

Tasks learn of subphrases that reached the threshold through a table of fixed size (one
byte a hashed slot: the scan from which it is active). Two subphrases in one slot only
make a phrase be counted that would not have to be: counts stay exact and every phrase
that can reach the threshold is counted, whatever the size of the corpus. Phrases are
named by the 64-bit hashes of their words (seeded with the language); they are combined
within a slice of texts, within a task, and then by the shuffle, so a word or pair in a
third of all places is a few rows. Open counts are written after every scan and the table
before is deleted.

``collocations`` scores every phrase by its weakest cut, drops those that mostly occur
inside a longer one, and takes each language's best, first within salted groups. Words and
counts of parts come by joins, broadcast when the counted side is small enough.

Defined cases: a null text is empty, a null language ``und``; a text of any length counts
whole (a slice is at least one text); repeated rows count again; other columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.shared import written
from strata.llm.words import column, mix, text_buffer
from strata.session import scratch_path

SHARDS = 2
THRESHOLD = 10
LONGEST = 3
TOP = 2000
SLOTS = 1 << 23
NEVER = 255
SLICE = 4 << 20
SMALL = 400_000            # counted rows up to which a side is broadcast
SALTS = 32

#: the characters that end a piece, and those that part words
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
GAPS = ENDS.copy()
GAPS[[0x20, 0x09]] = True

_PLACES = 4096
_PLACE = np.random.Generator(np.random.PCG64(171)).integers(0, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
COUNTS = "size int, lang string, word string, h1 long, h2 long, h3 long, start int, n long"


class Words:
    """The words of a slice of texts: hashes, whether a word's successor is in its piece, and their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        data = LOWER[data]
        word = ~GAPS[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        rows = offsets[:-1][offsets[:-1] < len(data)]
        first[rows] |= word[rows]
        self.starts = np.flatnonzero(first)
        n = len(self.starts)
        at = np.flatnonzero(word)
        begin = np.searchsorted(at, self.starts)
        self.lengths = np.diff(np.append(begin, len(at)))
        self.data = data
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        if n:
            place = np.arange(len(at)) - np.repeat(begin, self.lengths)
            value = (data[at].astype(np.uint64) + np.uint64(1)) * _PLACE[place & (_PLACES - 1)]
            if self.lengths.max() > _PLACES:
                value = mix(value + (place // _PLACES).astype(np.uint64))
            h = np.add.reduceat(value, begin) + self.lengths.astype(np.uint64) * _GOLDEN
            self.hashes = mix(mix(h) ^ seeds[self.row])
        else:
            self.hashes = np.empty(0, np.uint64)
        ends = np.append(0, np.cumsum(ENDS[data]))[self.starts]
        self.joined = (ends[1:] == ends[:-1]) & (self.row[1:] == self.row[:-1])

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i] + self.lengths[i]].tobytes()


def pair_slots(h1: np.ndarray, h2: np.ndarray, slots: int) -> np.ndarray:
    return (mix(h1 * _GOLDEN + h2) & np.uint64(slots - 1)).astype(np.int64)


def word_slots(h: np.ndarray, slots: int) -> np.ndarray:
    return (mix(h + _GOLDEN) & np.uint64(slots - 1)).astype(np.int64)


def count_slice(words: Words, langs: list[str], scan: int, shards: int, active: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The distinct phrases of a slice that are open in this scan, with their numbers.

    ``active[k]`` holds, by slot, the scan from which phrases of k + 1 words may be parts of longer ones.
    """
    h = words.hashes
    if not len(h):
        return
    _, first, ids, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    distinct = h[first].view(np.int64)

    def rows(size: int, members: list[np.ndarray], start: np.ndarray, n: np.ndarray,
             lang: pa.Array | None = None, text: pa.Array | None = None) -> pa.RecordBatch:
        k = len(n)
        none = pa.nulls(k, pa.string())
        cols = [pa.array(m) if m is not None else pa.nulls(k, pa.int64()) for m in [*members, *[None] * (3 - len(members))]]
        return pa.RecordBatch.from_arrays([pa.array(np.full(k, size, np.int32)), none if lang is None else lang, none if text is None else text,
                                           *cols, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int64))],
                                          names=[f.split()[0] for f in COUNTS.split(", ")])

    if scan < shards:
        own = words.row[first]
        text = pa.array([words.text(i) for i in first.tolist()], pa.binary()).cast(pa.string())
        yield rows(1, [distinct], np.zeros(len(first)), counts, pa.array([langs[r] for r in own.tolist()], pa.string()), text)
    slot = active[0][word_slots(h[first], len(active[0]))].astype(np.int64)[ids]
    pairs = np.flatnonzero(words.joined)
    begun = np.maximum(slot[pairs], slot[pairs + 1])
    open_ = (begun <= scan) & (scan < begun + shards) & (begun < NEVER)
    several = int(len(first))
    at = pairs[open_]
    if len(at):
        key, place, n = np.unique(ids[at] * several + ids[at + 1], return_index=True, return_counts=True)
        yield rows(2, [distinct[key // several], distinct[key % several]], begun[open_][place], n)
    triples = np.flatnonzero(words.joined[:-1] & words.joined[1:])
    # the two words of a frequent pair are frequent: only such places are looked up
    seen = slot < NEVER
    triples = triples[seen[triples] & seen[triples + 1] & seen[triples + 2]]
    if len(triples):
        one = active[1][pair_slots(h[triples], h[triples + 1], len(active[1]))]
        two = active[1][pair_slots(h[triples + 1], h[triples + 2], len(active[1]))]
        begun = np.maximum(one, two).astype(np.int64)
        open_ = (begun <= scan) & (scan < begun + shards) & (begun < NEVER)
        at = triples[open_]
        if len(at):
            pair, pid = np.unique(ids[at] * several + ids[at + 1], return_inverse=True)
            key, place, n = np.unique(pid * several + ids[at + 2], return_index=True, return_counts=True)
            pair, last = pair[key // several], key % several
            yield rows(3, [distinct[pair // several], distinct[pair % several], distinct[last]], begun[open_][place], n)


def scan_shard(docs: DataFrame, scan: int, shards: int, active: list[np.ndarray], size: int = SLICE) -> DataFrame:
    """COUNTS rows of one shard's texts (lang, text), combined by slice."""
    sent = docs.sparkSession.sparkContext.broadcast(active)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, np.uint64] = {}
        for whole in batches:
            at = 0
            data, offsets = text_buffer(column(whole, "text"))
            langs = column(whole, "lang").to_pylist()
            for x in set(langs) - seeds.keys():
                seeds[x] = np.frombuffer(hashlib.blake2b(x.encode(), digest_size=8).digest(), np.uint64)[0]
            seed = np.array([seeds[x] for x in langs], np.uint64)
            while at < whole.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
                words = Words(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], seed[at:end])
                yield from count_slice(words, langs[at:end], scan, shards, sent.value)
                at = end

    return docs.select("lang", "text").mapInArrow(run, COUNTS)


def reached_slots(spark: SparkSession, hits: DataFrame, slots: int) -> np.ndarray:
    """Which slots the phrases hash to, as a fixed-size array: bitmaps are joined by the shuffle, the driver gets each piece once."""
    width = 8 * 4096                                            # bits of Spark's bitmap pieces

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one = column(b, "h1").to_numpy(zero_copy_only=False).view(np.uint64)
            pair = ~column(b, "h2").is_null().to_numpy(zero_copy_only=False)
            two = column(b, "h2").fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.record_batch({"slot": pa.array(np.where(pair, pair_slots(one, two, slots), word_slots(one, slots)), pa.int64())})

    pieces = (hits.select("h1", "h2").mapInArrow(numbers, "slot long")
              .select(F.floor(F.col("slot") / width).alias("piece"), (F.col("slot") % width).alias("bit"))
              .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(slots, bool)
    for r in pieces:
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        out[r["piece"] * width:(r["piece"] + 1) * width] = bits[:slots - r["piece"] * width]
    return out


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this operator's own intermediate rows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


KEY = ["size", "lang", "word", "h1", "h2", "h3", "start"]


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS,
                     size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): all phrases counted at least ``threshold`` times, and the number of words per language.

    Phrases have size, lang and word (for one word), h1, h2, h3 and n.
    """
    if not 1 <= longest <= 3:
        raise ValueError("phrases have 1 to 3 words")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                        (F.monotonically_increasing_id() % shards).alias("shard"))
    base = scratch_path(spark, "shards")
    texts.write.partitionBy("shard").parquet(base)
    texts = spark.read.schema("lang string, text string, shard long").parquet(base)
    active = [np.full(slots, NEVER, np.uint8) for _ in range(2)]
    finished, totals, waiting, old = [], None, None, []
    scan, last = 0, shards - 1                                   # the last scan that some phrase needs
    while scan <= last:
        fresh = scan_shard(texts.where(F.col("shard") == scan % shards), scan, shards, active, size).where(F.col("size") <= longest)
        if waiting is not None:
            fresh = waiting.unionByName(fresh)
        state, path = _written(fresh.groupBy(*KEY).agg(F.sum("n").alias("n")), "counts")
        complete = F.col("start") + (shards - 1) <= scan
        done, _ = _written(state.where(complete & (F.col("n") >= threshold)).drop("start"), "frequent")
        finished.append(done)
        if scan == shards - 1:
            totals = written(state.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n_words")), "totals")
        for k in range(longest - 1):
            if k > scan or (k == 0 and scan >= shards):
                continue                                         # no phrase of k + 1 words is counted in this scan
            # those that have reached the threshold open longer phrases from the next scan on
            hits = reached_slots(spark, state.where((F.col("size") == k + 1) & (F.col("n") >= threshold)), slots)
            new = hits & (active[k] == NEVER)
            if new.any():
                active[k][new] = scan + 1
                last = max(last, scan + shards)
        waiting = state.where(~complete)
        for p in old:
            _delete(spark, p)
        old, scan = [path], scan + 1
    for p in [*old, base]:
        _delete(spark, p)
    phrases = finished[0]
    for f in finished[1:]:
        phrases = phrases.unionByName(f)
    return phrases, totals


def _side(df: DataFrame) -> DataFrame:
    """The side of a join, broadcast when its counted rows are few; else both sides are dealt out."""
    return F.broadcast(df) if df.count() <= SMALL else df


def _floor(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exactly."""
    wide = lambda c: c.cast("decimal(16,0)")
    top = (wide(a) * wide(a) * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", top, (wide(l) * wide(r)).cast("decimal(38,0)")).cast("long")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS,
                 slots: int = SLOTS, size: int = SLICE, inside: int = 50) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if it lies in a longer one that has at least ``inside`` percent of its occurrences.
    """
    found, totals = frequent_phrases(docs, threshold, longest, shards, slots, size)
    words = found.where("size = 1").select("lang", "word", "h1", F.col("n"))
    words = _side(written(words, "words"))
    one = lambda k: words.select(F.col("h1").alias(f"h{k}"), F.col("lang").alias(f"lang{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"))
    pairs = written(found.where("size = 2").select("h1", "h2", F.col("n").alias("a"))
                    .join(one(1), "h1").join(one(2), "h2")
                    .select("h1", "h2", F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2").alias("phrase"), "a",
                            F.col("n1").alias("l"), F.col("n2").alias("r")), "pairs")
    triples = found.where("size = 3").select("h1", "h2", "h3", F.col("n").alias("a"))
    side = _side(pairs)
    front = side.select("h1", "h2", "lang", F.col("phrase").alias("p12"), F.col("a").alias("n12"), F.col("l").alias("n1"))
    back = side.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("n23"), F.col("r").alias("n3"))
    triples = written(triples.join(front, ["h1", "h2"]).join(back, ["h2", "h3"]).join(one(3).select("h3", "w3"), "h3"), "triples")
    longer = (triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
              .groupBy("h1", "h2").agg(F.max("a").alias("within")))
    pairs = (pairs.join(longer, ["h1", "h2"], "left").where(F.col("within").isNull() | (100 * F.col("within") < inside * F.col("a")))
             .select("lang", "phrase", "a", "l", "r").withColumn("score", _floor(F.col("a"), F.col("l"), F.col("r"))))
    early, late = _floor(F.col("a"), F.col("n1"), F.col("n23")), _floor(F.col("a"), F.col("n12"), F.col("n3"))
    triples = triples.withColumn("late", late < early).select(
        "lang", F.concat_ws(" ", "p12", "w3").alias("phrase"), "a", F.when(F.col("late"), F.col("n12")).otherwise(F.col("n1")).alias("l"),
        F.when(F.col("late"), F.col("n3")).otherwise(F.col("n23")).alias("r"), F.least(early, late).alias("score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    rows = pairs.unionByName(triples).withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return rows.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")
