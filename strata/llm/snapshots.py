"""Chat formatting after collapsing cumulative snapshots, in DataFrame functions only.

Logs of a running chat often hold every state of it: each snapshot begins with the turns
of the one before. The prefix up to a turn is named by a rolling hash: the exclusive or
of two 64-bit hashes of (turn, role, text) over all turns so far, together with the
number of turns. A conversation whose last hash is the hash of some other conversation's
earlier turn is a prefix of a longer one and goes (anti-join on distinct hashes); of equal
conversations the one with the smallest conv_id stays. Only what is left is rendered.

The rolling hash is a prefix scan in two levels: blocks of BLOCK turn numbers are
combined first, a window runs over the blocks of a conversation, and a second one inside
each block, so the rows of one huge conversation are spread. Hashes are made distinct
before they meet, so a first turn or a conversation that a third of the log shares is one
row. Defined cases: turns are compared by their logged numbers; rows that repeat a turn
of a conversation word for word count once, different rows of one turn number form that
turn together; a null conv_id, turn, role or text is a value like any other (rows without
conv_id form one conversation); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.shared import written

BLOCK = 256
TEMPLATE = ("<|", "|>\n", "\n")  # around the role, after the text


def _hash(salt: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("turn", "role", "text")]
    absent = [F.col(c).isNull() for c in ("turn", "role", "text")]
    return F.xxhash64(F.lit(salt), *parts, *absent)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, n_turns): the rolling hash up to each turn, one row per turn number."""
    own = (turns.select("conv_id", "turn", _hash("a").alias("h1"), _hash("b").alias("h2")).distinct()
           .groupBy("conv_id", "turn").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
           .withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK)))
    blocks = own.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.count("*").alias("bn"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("k"),
                           *[F.coalesce(f(c).over(before), F.lit(0)).alias(c)
                             for f, c in ((F.bit_xor, "b1"), (F.bit_xor, "b2"), (F.sum, "bn"))])
    inside = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return (own.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k")))
            .select("conv_id", "turn", F.bit_xor("h1").over(inside).bitwiseXOR(F.col("b1")).alias("h1"),
                    F.bit_xor("h2").over(inside).bitwiseXOR(F.col("b2")).alias("h2"),
                    (F.count("*").over(inside) + F.col("bn")).alias("n_turns")))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_same): conversations that no longer one begins with; of equal ones the first id."""
    name = ["h1", "h2", "n_turns"]
    prefixes = written(prefix_hashes(turns), "prefixes")
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("n_turns", "h1", "h2")).alias("end"))
    finals = last.select("conv_id", "end.*").groupBy(*name).agg(
        F.min("conv_id").alias("first"), F.max(F.col("conv_id").isNull()).alias("only_null"), F.count("*").alias("n_same"))
    ends = last.select(F.col("conv_id").alias("c"), F.col("end.n_turns").alias("length"))
    earlier = (prefixes.join(ends, F.col("conv_id").eqNullSafe(F.col("c"))).where(F.col("n_turns") < F.col("length"))
               .select(*name).distinct())
    return finals.join(earlier, name, "left_anti").select(F.col("first").alias("conv_id"), "n_turns", "n_same")


def render(turns: DataFrame, kept: DataFrame, template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """The kept conversations with their turns in order as one ``rendered`` text."""
    open_, middle, close = map(F.lit, template)
    line = F.concat(open_, F.coalesce("role", F.lit("")), middle, F.coalesce("text", F.lit("")), close)
    keys = kept.select(F.col("conv_id").alias("c"), "n_turns", "n_same")
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    return (rows.join(keys, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "n_turns", "n_same", F.struct("turn", "role", "text", line.alias("line")).alias("t"))
            .groupBy("conv_id", "n_turns", "n_same")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"]), "").alias("rendered")))


def collapse_and_render(turns: DataFrame, template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    return render(turns, written(maximal_conversations(turns), "maximal"), template)
