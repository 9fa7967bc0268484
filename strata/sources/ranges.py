"""Records of large JSON documents, read in byte ranges.

``wholetext`` makes a document one row and one task. Here a document is read by the
splittable text source with ``}`` as line end, so a task reads one byte range
(``spark.sql.files.maxPartitionBytes``) and gets fragments that end with a closing brace.
Whether a brace closes a record depends on what lies before it: on the parity of quotes
(inside a string or not) and on the depth of brackets. Both are sums, so they are found as
a prefix sum in two levels: each range adds up its own fragments for either parity at its
start, one row per range is added up along the file, and every fragment then knows its
state. Consecutive fragments up to a record's end form the record; the pieces at the
edges of ranges are joined, so a record may cross any number of them.

Every record comes back as a document of its own in its payload's shape, so the
flattening functions of ``landing`` read them as they read whole documents:

* ``array``: ``[{...}, ...]`` (catalogues), a record is ``[{...}]``
* ``data``: ``{"data": [{...}, ...]}``; objects in other arrays are left out
* ``paged``: ``[{header}, [{...}, ...]]``; a file's first record keeps its header

Ranges of one document are shuffled by (file, range), so no task holds more than a range
and the records that cross its edges. A document without records comes back whole. What a
cut-off or otherwise unbalanced document holds beyond its last whole record is no record;
``cut_off_documents`` names such documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# depth of the brackets around a record; what makes a lone record a document again
SHAPES = {
    "array": (1, "[", "]"),
    "data": (2, '{"data":[', "]}"),
    "paged": (2, "[null,[", "]]"),
}


def _fragments(spark: SparkSession, path: str, range_bytes: int | None) -> DataFrame:
    """(source_file, range, id, fragment, file_size) and each fragment's quotes and bracket depths for either start."""
    if range_bytes:
        spark = spark.newSession()          # the size of a range is a session's setting
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    rows = (spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("range"),
                    F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("fragment")))
    between = F.split(F.regexp_replace("fragment", r"(?s)\\.", ""), '"', -1)      # escapes hide no quote

    def depth(first: int) -> Column:
        outside = F.array_join(F.filter("between", lambda x, i: i % 2 == first), "")
        gone = lambda chars: F.length(outside) - F.length(F.translate(outside, chars, ""))
        return gone("{[") - gone("]")

    rows = rows.withColumn("between", between).withColumn("quotes", F.size("between") - 1)
    return rows.withColumn("d0", depth(0)).withColumn("d1", depth(1)).drop("between")


def _in_ranges(fragments: DataFrame) -> DataFrame:
    """Sums within each range: ``c0`` and ``c1`` are the depth after a fragment, ``i0`` and ``i1`` whether its brace
    lies in a string, if the range starts outside or inside a string."""
    earlier = Window.partitionBy("source_file", "range").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("source_file", "range").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("source_file", "range").orderBy("id")
    rows = fragments.withColumn("before", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
    for s in (0, 1):
        begun = (F.col("before") + s) % 2
        rows = rows.withColumn(f"i{s}", (begun + F.col("quotes")) % 2 == 1)
        step = F.when(begun == 0, F.col("d0")).otherwise(F.col("d1")) - F.when(F.col(f"i{s}"), 0).otherwise(1)
        rows = rows.withColumn(f"step{s}", step).withColumn(f"c{s}", F.sum(f"step{s}").over(upto))
    return rows.withColumn("last", F.lead("id").over(order).isNull())


def _range_starts(local: DataFrame) -> DataFrame:
    """One row per range: its parity and depth at the start, whether it is its file's last, and the file's end."""
    sums = local.groupBy("source_file", "range").agg(
        F.sum("quotes").alias("quotes"), F.sum("step0").alias("t0"), F.sum("step1").alias("t1"), F.max("file_size").alias("file_size"),
        F.sum(F.octet_length("fragment") + 1).alias("bytes"))
    file = Window.partitionBy("source_file").orderBy("range")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    sums = sums.withColumn("own", F.when(F.col("parity") == 0, F.col("t0")).otherwise(F.col("t1")))
    return sums.select(
        "source_file", "range", "parity", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"),
        F.lead("range").over(file).isNull().alias("ends_file"), F.lag("range").over(file).isNull().alias("begins_file"),
        # a last fragment that no brace ended makes the sum one byte longer than the file
        (F.sum("bytes").over(Window.partitionBy("source_file")) > F.col("file_size")).alias("open_end"),
        ((F.col("parity") + F.col("quotes")) % 2).alias("parity_after"), (F.sum("own").over(file)).alias("depth_after"))


def _stated(spark: SparkSession, path: str, range_bytes: int | None) -> DataFrame:
    """Every fragment's text (with its brace), whether the brace lies in a string, and the depth after it."""
    local = _in_ranges(_fragments(spark, path, range_bytes))
    starts = _range_starts(local)
    inside = F.when(F.col("parity") == 0, F.col("i0")).otherwise(F.col("i1"))
    braced = ~(F.col("last") & F.col("ends_file") & F.col("open_end"))
    return (local.drop("file_size").join(starts, ["source_file", "range"])
            .select("source_file", "range", "id", inside.alias("inside"), braced.alias("braced"), "begins_file",
                    (F.col("base") + F.when(F.col("parity") == 0, F.col("c0")).otherwise(F.col("c1"))).alias("depth"),
                    F.when(braced, F.concat("fragment", F.lit("}"))).otherwise(F.col("fragment")).alias("text")))


def read_records(spark: SparkSession, path: str, shape: str, range_bytes: int | None = None) -> DataFrame:
    """(source_file, range, ordinal, payload): one row per record of the documents under ``path``.

    (range, ordinal) orders the records of a file. ``range_bytes`` sets the size of a byte range (default: the session's).
    """
    depth, opening, closing = SHAPES[shape]
    rows = _stated(spark, path, range_bytes)
    ends = F.col("braced") & ~F.col("inside") & (F.col("depth") == depth)
    earlier = Window.partitionBy("source_file", "range").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ends", ends).withColumn("ordinal", F.coalesce(F.sum(F.col("ends").cast("int")).over(earlier), F.lit(0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda x: x["text"]), "")
    pieces = rows.groupBy("source_file", "range", "ordinal").agg(text.alias("text"), F.max("ends").alias("ended"), F.max("begins_file").alias("begins_file"))
    # a range's first piece may go on from the range before, its last one into the next
    whole = pieces.filter(F.col("ended") & (F.col("ordinal") > 0)).withColumn("first", F.lit(False))
    edges = pieces.filter(~F.col("ended") | (F.col("ordinal") == 0))
    along = Window.partitionBy("source_file").orderBy("range", "ordinal")
    edges = edges.withColumn("record", F.coalesce(F.sum(F.col("ended").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("range", "ordinal", "text")))
    joined = edges.groupBy("source_file", "record").agg(
        parts.alias("parts"), F.max("ended").alias("ended"), F.max(F.col("begins_file") & (F.col("ordinal") == 0)).alias("first"))
    joined = joined.select("source_file", F.element_at("parts", -1)["range"].alias("range"), F.element_at("parts", -1)["ordinal"].alias("ordinal"),
                           F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"), "ended", "first")
    records = whole.select(*joined.columns).unionByName(joined.filter(F.col("ended") | F.col("first")))
    follows = F.col("text").rlike(r"^\s*,") & ~F.col("first")
    payload = (F.when(~F.col("ended"), F.col("text"))                                # a document without records
               .when(follows, F.concat(F.lit(opening), F.regexp_replace("text", r"^\s*,", ""), F.lit(closing)))
               .when(F.col("first"), F.concat("text", F.lit(closing)))
               .otherwise(F.concat(F.lit('{"":['), "text", F.lit(closing))))         # the first object of a later array
    records = records.select("source_file", "range", "ordinal", payload.alias("payload"), follows.alias("follows"))
    if shape == "data":
        # an array's first object tells whether the objects after it are wanted: a few arrays a file
        arrays = records.filter(~F.col("follows")).groupBy(F.col("source_file").alias("file")).agg(F.array_sort(F.collect_list(F.struct(
            "range", "ordinal", F.get_json_object("payload", "$.data").isNotNull().alias("wanted")))).alias("arrays"))
        before = F.filter("arrays", lambda a: F.struct(a["range"], a["ordinal"]) <= F.struct("range", "ordinal"))
        records = (records.join(arrays, F.col("source_file") == F.col("file"))
                   .filter(~F.col("follows") | F.element_at(before, -1)["wanted"]))
    return records.select("source_file", "range", "ordinal", "payload")


def cut_off_documents(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """(source_file, reason) of documents whose brackets or quotes do not close."""
    starts = _range_starts(_in_ranges(_fragments(spark, path, range_bytes)))
    # the sums take a last fragment without a brace as one that a brace ended
    depth = F.col("depth_after") + F.when(F.col("open_end") & (F.col("parity_after") == 0), 1).otherwise(0)
    return (starts.filter("ends_file").filter((F.col("parity_after") != 0) | (depth != 0))
            .select("source_file", F.when(F.col("parity_after") != 0, F.lit("open string")).otherwise(F.lit("open bracket")).alias("reason")))
