"""Exact similarity self-join of documents on five-word shingles (T-occurrence search).

Two documents link when their shingle sets have a Jaccard similarity of at least
``num / den``. A partner of a set of n shingles shares T = ceil(num * n / den) of them
at least. The T - 1 - n // EXTRA longest inverted lists of each set are set aside, the
others stand in one common order (short lists first). Partners of sizes n and k share
o = num * (n + k) / (num + den) shingles or more, so with m = min(n, k) // EXTRA they
meet in m + 1 lists or more among the first n - o + 1 + m of the one and the first
k - o + 1 + m of the other; long lists are only probed for pairs that reach that count.
The join follows that split:

1. ``document_sets``: one pass hashes every whole text into its shingle set. Equal sets
   are one class (a copy never meets another copy again), and the lengths of all
   inverted lists are counted in a table of ``LENGTH_SLOTS`` counters, summed by Spark
   (a fixed size at any input; slots that several shingles share only blur the order).
2. ``short_postings``: each class posts its short lists (the shingles of least length, by
   the counters and then by hash) as compact blocks per hash range. One task per range
   merges the sorted postings; lists of one class vanish, and so do classes that stand
   in too few lists to reach the count with anyone (``promising``).
3. ``link_classes``: in ROUNDS rounds every class probes the leader of another component
   that most of its lists offer (a list's leader has the largest share of its short lists
   in common with others, as the text that others were copied from has), so that a large
   group of near copies links by one probe a member. Then ``across`` merges the lists that
   still hold several components, class by class inside a task (DivideSkip), and only the
   pairs that reach the count come out and are probed. Lists of one group of texts meet in
   one task (by the least component in them); a group beyond OPEN_POSTINGS is split into
   blocks of classes. The count is shared out over the tasks that hold a class's lists in
   proportion to them (a pair that reaches it reaches a share somewhere), so no link is
   lost: skipping a pair inside one component cannot change any component.
4. A probe fetches both sets (of candidate classes only) and binary-searches the
   smaller one's sorted shingles, short lists and long ones alike, in the larger one's.
5. Components are found by passing the smallest label along the links (``components``).

Words: A-Z folded, runs outside the six ASCII white-space characters; 64-bit hashes
stand for words and shingles (random weights; a false equality has odds of about
2**-64 a pair). Defined cases: null, empty and blank texts have no set and link with
nothing; fewer than five words are one shingle; repeated rows are rows of one class;
rows that repeat an id with other texts are judged by their own texts; rows without an
id link as any other (their own component_id is null if no linked row has an id); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.graph import components
from strata.llm.shared import by_ids, counter_rows, summed, written
from strata.session import ensure_checkpoint_dir
from strata.llm.words import SHINGLE, column, hash_words, mix, shingles, text_buffer

LENGTH_SLOTS = 1 << 21
BUCKET_POSTINGS = 200_000
NUM, DEN = 4, 5
ROUNDS = 1
EXTRA = 20
OPEN_POSTINGS = 50_000
ROWS = 250
_STEP_OF_SIZE = np.uint64(0x9E3779B97F4A7C15)


def needed(n: int, num: int = NUM, den: int = DEN) -> int:
    """T: the least overlap of a set of n shingles with any partner."""
    return -(-num * n // den)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words, bounds = hash_words(*text_buffer(column(batch, "text")))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.unique(shingles(words[a:b], size))


def class_of(found: np.ndarray) -> int:
    """A 63-bit name of a set: equal sets have equal names; the empty set is 0."""
    if not len(found):
        return 0
    total = mix(found).sum(keepdims=True) + np.array([len(found)], np.uint64) * _STEP_OF_SIZE
    return max(1, int(mix(total)[0] >> np.uint64(1)))


def slots(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - LENGTH_SLOTS.bit_length() + 1)).astype(np.int64)


def document_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, n_shingles, class) of all documents, and rows (slots, counts) of list lengths."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.zeros(LENGTH_SLOTS, np.int64)
        fields = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()),
                  ("counter", pa.int32()), ("piece", pa.int32()), ("counts", pa.binary())]

        def rows(**values) -> pa.RecordBatch:
            n = len(next(iter(values.values())))
            return pa.RecordBatch.from_arrays(
                [pa.array(values[name], t) if name in values else pa.nulls(n, t) for name, t in fields], names=[f for f, _ in fields])

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sizes, classes = [], []
                for found in _sets(batch, size):
                    sizes.append(len(found))
                    classes.append(class_of(found))
                    np.add.at(lengths, slots(found), 1)
                yield rows(doc_id=column(batch, "doc_id").to_pylist(), n_shingles=sizes, **{"class": classes})
        counter, piece, counts = counter_rows([lengths])
        yield rows(counter=counter, piece=piece, counts=counts)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, class long, counter int, piece int, counts binary")


_POSTING = np.dtype([("shingle", "<u8"), ("class", "<i8"), ("n", "<i4"), ("rank", "<i4")])


def short_postings(docs: DataFrame, lengths, buckets: int, size: int, num: int, den: int) -> DataFrame:
    """Blocks (bucket, postings) of every class's short lists; a bucket is a range of hashes."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def flush(shingle: list, cls: list, ns: list) -> Iterator[pa.RecordBatch]:
        post = np.empty(sum(map(len, shingle)), _POSTING)
        post["shingle"] = np.concatenate(shingle)
        repeats = [len(x) for x in shingle]
        post["class"], post["n"] = np.repeat(cls, repeats), np.repeat(ns, repeats)
        post["rank"] = np.concatenate([np.arange(n) for n in repeats])
        post = post[np.lexsort((post["class"], post["shingle"]))]
        same = (post["shingle"][1:] == post["shingle"][:-1]) & (post["class"][1:] == post["class"][:-1])
        post = post[np.r_[True, ~same]]
        cuts = np.r_[0, np.searchsorted(post["shingle"], bounds), len(post)]
        full = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([post[cuts[k]:cuts[k + 1]].tobytes() for k in full], pa.binary())],
            names=["bucket", "postings"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = lengths.value
        shingle, cls, ns, held, seen = [], [], [], 0, set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                for found in _sets(whole.slice(at, ROWS), size):
                    name = class_of(found)
                    if not name or name in seen:
                        continue
                    seen.add(name)
                    short = len(found) - needed(len(found), num, den) + 1 + len(found) // EXTRA
                    order = np.lexsort((found, length[slots(found)]))
                    shingle.append(found[order[:short]])
                    cls.append(name)
                    ns.append(len(found))
                    held += short
                    if held > 250_000:
                        yield from flush(shingle, cls, ns)
                        shingle, cls, ns, held, seen = [], [], [], 0, set()
        if held:
            yield from flush(shingle, cls, ns)

    return docs.select("text").mapInArrow(run, "bucket int, postings binary")


def merged_lists(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """(list, class, n, rank): the members of every short list that has classes of fitting sizes."""

    def merge(table: pa.Table) -> pa.Table:
        post = np.concatenate([np.frombuffer(x.as_py(), _POSTING) for x in table.column("postings")])
        post = post[np.lexsort((post["class"], post["shingle"]))]
        new_list = np.r_[True, post["shingle"][1:] != post["shingle"][:-1]]
        post = post[new_list | np.r_[True, post["class"][1:] != post["class"][:-1]]]
        # by size in each list: a member that fits neither neighbour's size fits no member's
        post = post[np.lexsort((post["n"], post["shingle"]))]
        n = post["n"].astype(np.int64)
        fits = (post["shingle"][1:] == post["shingle"][:-1]) & (den * n[:-1] >= num * n[1:])
        post = post[np.r_[False, fits] | np.r_[fits, False]]
        return pa.table({"list": pa.array(post["shingle"].astype(np.int64)), "class": pa.array(post["class"]),
                         "n": pa.array(post["n"].astype(np.int32)), "rank": pa.array(post["rank"].astype(np.int32))})

    return blocks.groupBy("bucket").applyInArrow(merge, "list long, class long, n int, rank int")


def _with_classes(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[int], list[np.ndarray]]]:
    """Slices of the batches, with every row's class and set."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            found = list(_sets(batch, size))
            yield batch, [class_of(x) for x in found], found


def candidate_sets(docs: DataFrame, sets: DataFrame, lists: DataFrame, size: int) -> DataFrame:
    """(class, shingles) of the classes in ``lists``: hashed anew from one document of each,
    or, for a class that only rows without an id have, from these rows."""
    wanted = (sets.join(lists.select("class").distinct(), "class", "left_semi")
              .groupBy("class").agg(F.min("doc_id").alias("doc_id")))
    wanted = written(wanted, "wanted")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, classes, found in _with_classes(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c in classes if c], pa.int64()),
                 pa.array([x.tobytes() for x in found if len(x)], pa.binary())], names=["class", "shingles"])

    schema = "class long, shingles binary"
    ids = wanted.where(F.col("doc_id").isNotNull()).select("doc_id")
    texts = by_ids(docs.select("doc_id", "text"), ids, "left_semi").select("text").mapInArrow(run, schema)
    nameless = wanted.where(F.col("doc_id").isNull()).select("class")
    texts = texts.unionByName(docs.where(F.col("doc_id").isNull()).select("text").mapInArrow(run, schema)
                              .join(nameless, "class", "left_semi"))
    # dealt out by class once: this, and both joins of every probe, need no further exchange of sets
    return (texts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "class")
            .dropDuplicates(["class"]))


def probe(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link: the smaller set's shingles are searched in the larger set.

    A leader b with very many members meets their bare names first; its set then goes to
    each member a, so no task gathers the sets of a hot leader's members.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(column(batch, "x"), column(batch, "y")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([column(batch, c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    leaders = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    members = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    return pairs.join(leaders, "b").join(members, "a").mapInArrow(run, "a long, b long")


def _meets(num: int, den: int) -> Column:
    """Whether a list is early enough for both its members to count towards their link."""
    overlap = F.ceil((F.col("n") + F.col("other.n")) * num / (num + den))
    extra = F.floor(F.least("n", "other.n") / EXTRA)
    return ((F.lit(den) * F.least("n", "other.n") >= F.lit(num) * F.greatest("n", "other.n"))
            & (F.col("rank") <= F.col("n") - overlap + extra) & (F.col("other.rank") <= F.col("other.n") - overlap + extra))


def _common_lists(met: DataFrame) -> DataFrame:
    """(a, b, class, lists) of the pairs that meet in as many lists as partners must; a > b."""
    counted = (met.groupBy("class", "n", F.col("other.class").alias("partner"), F.col("other.n").alias("k"))
               .agg(F.count("*").alias("lists")))
    return (counted.where(F.col("lists") >= 1 + F.floor(F.least("n", "k") / EXTRA))
            .select(F.greatest("class", "partner").alias("a"), F.least("class", "partner").alias("b"), "class", "lists"))


def _rooted(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return lists.withColumn("root", F.col("class"))
    return (lists.join(roots.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("root", F.coalesce("root", "class")))


def promising(lists: DataFrame, num: int, den: int) -> DataFrame:
    """The list members of classes that stand in enough lists for any partner (of num / den their size at least)."""
    able = (lists.groupBy("class", "n").agg(F.count("*").alias("lists"))
            .where(F.col("lists") >= 1 + F.floor(F.ceil(F.col("n") * num / den) / EXTRA)).select("class"))
    left = lists.join(able, "class", "left_semi")
    full = left.groupBy("list").agg(F.count("*").alias("members")).where("members > 1").select("list")
    return written(left.join(full, "list", "left_semi"), "lists")


def _one_probe_each(members: DataFrame, probed: DataFrame | None, num: int, den: int) -> DataFrame:
    """(a, b): for every class the leader, of another component and not probed yet, that most of its lists offer."""
    shares = members.groupBy("class").agg((F.count("*") / F.max("n")).alias("share"))
    side = F.struct("share", "root", "class", "n", "rank")
    ranked = members.join(shares, "class")
    first = ranked.groupBy("list").agg(F.max(side).alias("one"))
    # the best of another component than the first one's, for the members of that component
    second = (ranked.join(first, "list").where(F.col("root") != F.col("one.root"))
              .groupBy("list").agg(F.max(side).alias("two"), F.max("one").alias("one")))
    met = _common_lists(
        members.join(second, "list")
        .withColumn("other", F.when(F.col("root") != F.col("one.root"), F.col("one")).otherwise(F.col("two")))
        .where(_meets(num, den)))
    if probed is not None:
        met = met.join(probed, ["a", "b"], "left_anti")
    return (met.groupBy("class").agg(F.max(F.struct("lists", "a", "b")).alias("best"))
            .select("best.a", "best.b").distinct())


def _reaching(table: pa.Table, num: int, den: int) -> pa.Table:
    """(a, b) of the pairs of one task's list members that reach the class a's share of the count.

    Each class merges those of its lists that it needs not set aside (all but the longest
    t - 1, t being its least share of the count) and binary-searches what they offer in the others.
    """
    post = {c: table.column(c).to_numpy() for c in ("list", "class", "n", "rank", "root", "total", "side")}
    order = np.lexsort((post["class"], post["list"]))
    lists, cls, n, rank, root, total, side = (post[c][order].astype(np.int64) for c in post)
    first = np.r_[True, lists[1:] != lists[:-1]]
    start = np.flatnonzero(first)[np.cumsum(first) - 1]
    two_sides = len(np.unique(side)) > 1
    by_class = np.argsort(cls, kind="stable")
    cuts = np.r_[0, np.flatnonzero(np.diff(cls[by_class])) + 1, len(cls)]
    a, b = [], []
    for low, high in zip(cuts[:-1], cuts[1:]):
        own = by_class[low:high]
        x, w = own[0], high - low
        name, size = cls[x], n[x]
        share = lambda k: 1 + (np.minimum(size, k) // EXTRA) * w // total[x]  # noqa: B023,E731
        # partners of smaller names stand before the class in each of its lists
        own = own[np.argsort(own - start[own], kind="stable")]
        aside = int(share(-(-num * size // den))) - 1
        short, long = own[:w - aside], own[w - aside:]
        sizes = short - start[short]
        if not sizes.sum():
            continue

        def meets(at: np.ndarray, mine: np.ndarray) -> np.ndarray:
            k = n[at]
            overlap = -(-(size + k) * num // (num + den))  # noqa: B023
            extra = np.minimum(size, k) // EXTRA  # noqa: B023
            return ((den * np.minimum(size, k) >= num * np.maximum(size, k))  # noqa: B023
                    & (mine <= size - overlap + extra) & (rank[at] <= k - overlap + extra))  # noqa: B023

        at = np.arange(sizes.sum()) + np.repeat(start[short] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        good = (root[at] != root[x]) & meets(at, np.repeat(rank[short], sizes))
        if two_sides:
            good &= side[at] != side[x]
        at = at[good]
        partners, where, counts = np.unique(cls[at], return_index=True, return_counts=True)
        least = share(n[at[where]])
        left = counts + aside >= least
        partners, counts, least = partners[left], counts[left], least[left]
        for y in long if len(partners) else ():
            members = cls[start[y]:y]
            if len(members):
                place = np.minimum(np.searchsorted(members, partners), len(members) - 1)
                counts = counts + ((members[place] == partners) & meets(start[y] + place, rank[y]))
        partners = partners[counts >= least]
        a.append(np.full(len(partners), name))
        b.append(partners)
    none = [np.empty(0, np.int64)]
    return pa.table({"a": pa.array(np.concatenate(a or none)), "b": pa.array(np.concatenate(b or none))})


def across(members: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b), a > b: the pairs of classes in different components that meet in as many lists as partners must."""
    open_lists = (members.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                  .where("low != high").select("list", "low"))
    left = written(members.join(open_lists, "list"), "open")
    buckets = max(1, -(-left.count() // OPEN_POSTINGS))
    left = left.withColumn("bucket", F.pmod(F.xxhash64("low"), F.lit(buckets)))
    blocks = left.groupBy("bucket").agg(F.ceil(F.count("*") / OPEN_POSTINGS).alias("blocks"))
    totals = left.groupBy("class").agg(F.count("*").alias("total"))
    block = F.pmod(F.xxhash64(F.lit(1), "class"), F.col("blocks"))
    dealt = (left.join(totals, "class").join(blocks, "bucket")
             .select("bucket", "list", "class", "n", "rank", "root", "total", block.alias("side"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with")))
    return (dealt.withColumn("i", F.least("side", "with")).withColumn("j", F.greatest("side", "with"))
            .groupBy("bucket", "i", "j").applyInArrow(lambda t: _reaching(t, num, den), "a long, b long").distinct())


def link_classes(lists: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, root) of all classes that link with another class."""
    links = probed = roots = None
    for _ in range(ROUNDS):
        pairs = written(_one_probe_each(_rooted(lists, roots), probed, num, den), "pairs")
        found = written(probe(pairs, sets, num, den), "links")
        links = found if links is None else links.unionByName(found)
        probed = pairs if probed is None else probed.unionByName(pairs)
        roots = components(links)
    left = across(_rooted(lists, roots), num, den)
    found = written(probe(left.join(probed, ["a", "b"], "left_anti"), sets, num, den), "links")
    return components(links.unionByName(found))


def similarity_components(docs: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, class, component_id) of every row; component_id is the smallest
    doc_id that links lead to, the row's own included."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    parts = written(document_sets(docs, size), "sets")
    sets = parts.where(F.col("counts").isNull()).select("doc_id", "n_shingles", "class")
    lengths = spark.sparkContext.broadcast(summed(parts, 0, LENGTH_SLOTS))
    total = sets.agg(F.sum(F.col("n_shingles") - F.ceil(F.col("n_shingles") * num / den) + 1)).first()[0] or 0
    buckets = max(1, -(-int(total) // BUCKET_POSTINGS))
    lists = written(merged_lists(short_postings(docs, lengths, buckets, size, num, den), num, den), "lists")
    lists = promising(lists, num, den)
    known = candidate_sets(docs, sets, lists, size).checkpoint()
    roots = link_classes(lists, known, num, den)
    classes = (sets.where(F.col("class") != 0).groupBy("class").agg(F.min("doc_id").alias("first"))
               .join(roots.withColumnRenamed("node", "class"), "class", "left")
               .withColumn("root", F.coalesce("root", "class")))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    return (sets.join(classes.join(least, "root").select("class", "component_id"), "class", "left")
            .withColumn("component_id", F.when(F.col("class") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "class", "component_id"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """The documents, with their columns, less those that link (through others) to one with a
    smaller doc_id. Rows that repeat the kept id are that document and stay; of rows that share
    an id, only those whose own text links go; rows without an id or without a set stay."""
    found = similarity_components(docs, size, num, den)
    goes = F.coalesce((F.col("class") != 0) & (F.col("component_id") < F.col("doc_id")), F.lit(False))
    found = written(found.withColumn("goes", goes), "found")
    ids = found.groupBy("doc_id").agg(F.bool_or("goes").alias("any"), F.bool_and("goes").alias("all")).where("any")
    ids = written(ids, "linked")
    kept = by_ids(docs, ids.select("doc_id"), "left_anti")
    mixed = ids.where(~F.col("all")).select("doc_id")
    if mixed.isEmpty():
        return kept
    rows = by_ids(docs, mixed, "left_semi")
    schema = T.StructType([*rows.schema.fields, T.StructField("class of the row", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, classes, _ in _with_classes(batches, size):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.int64())],
                                             names=[*batch.schema.names, "class of the row"])

    stay = found.where(~F.col("goes")).select("doc_id", F.col("class").alias("class of the row")).distinct()
    rows = rows.mapInArrow(run, schema).join(stay, ["doc_id", "class of the row"], "left_semi")
    return kept.unionByName(rows.select(*docs.columns))
