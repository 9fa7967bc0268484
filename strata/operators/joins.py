"""Joins: left join on any of several equalities, lookups with precedence, stars.

Broadcast policy: an explicit broadcast hint is only put on data whose size is
proven: a single selected key, one-row-per-partition offsets, and the matches of
counted hot keys up to a row count (more take the shuffle). Every other
join is left to Catalyst / AQE, whose broadcast decision is itself size-checked
(``spark.sql.autoBroadcastJoinThreshold`` on runtime statistics) and falls
back to a shuffle join above it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def inline_table(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A literal relation (``UNNEST([STRUCT ...])``); its size is known to the planner."""
    return spark.createDataFrame(list(rows), schema)


#: rows of the right side up to which the matches of hot keys are broadcast
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """The keys that hold at least ``share`` of the rows, NULL among them (at most 1 / share of them).

    Counted with a map-side combine, so a hot key is one row per task.
    """
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r.key for r in counts.filter(F.col("n") >= F.lit(max(2.0, share * total))).collect()]


def _keyed_join(left: DataFrame, right: DataFrame, lc: str, rc: str, how: str, hot: Sequence) -> DataFrame:
    """``left JOIN right ON lc = rc``; rows of hot keys meet their matches by a broadcast, the others by a shuffle.

    The matches of the hot keys are counted first: beyond HOT_ROWS all rows take the shuffle,
    where the engine splits skewed partitions. Rows with a hot NULL key have no match and take no part in it.
    """
    on = F.col(lc) == F.col(rc)
    # NULL keys match nothing: they need not meet in one task
    null_too = None in hot
    values = [h for h in hot if h is not None]
    if not hot:
        return left.join(right, on, how)
    is_hot = F.coalesce(F.col(lc).isin(values), F.lit(False)) if values else F.lit(False)
    parts = []
    plain = left
    if null_too:
        alone = left.filter(F.col(lc).isNull())
        plain = left.filter(F.col(lc).isNotNull())
        if how == "left":
            parts.append(alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))
        elif how == "left_anti":
            parts.append(alone)
    if values:
        matches = right.filter(F.col(rc).isin(values))
        if matches.count() <= HOT_ROWS:
            parts.append(plain.filter(is_hot).join(F.broadcast(matches), on, how))
            plain = plain.filter(~is_hot)
            right = right.filter(~F.coalesce(F.col(rc).isin(values), F.lit(False)))
    return reduce(DataFrame.unionByName, [plain.join(right, on, how), *parts])


def left_any_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                   hot_share: float | None = None) -> DataFrame:
    """``left LEFT JOIN right ON l1 = r1 OR l2 = r2 OR ...`` by equi-joins only.

    A pair of rows counts for the first alternative that holds for it. The first
    alternative is a left join: its rows without a match are checked against the other
    alternatives' keys by anti-joins and come out with NULLs if none hits. The further
    alternatives are inner joins without the pairs that an earlier one has. No row of
    ``left`` is gathered with others, so a key or a row that many rows share meets no
    window; bag semantics (fan-out, repeated rows) are those of the OR join.
    ``hot_share`` counts each key first and joins keys with that share of the rows by a
    broadcast of their counted matches (see ``_keyed_join``).
    Column names of ``left`` and ``right`` must be disjoint.
    """
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"left and right share columns {sorted(overlap)}; rename first")
    cast = [F.col(rc).cast(left.schema[lc].dataType).alias(f"_right_{i}") for i, (lc, rc) in enumerate(pairs)]
    keyed = right.select("*", *cast, F.lit(True).alias("_hit"))
    keys = [f"_right_{i}" for i in range(len(pairs))]
    hot = [hot_keys(left, lc, hot_share) if hot_share else [] for lc, _ in pairs]
    first = _keyed_join(left, keyed, pairs[0][0], keys[0], "left", hot[0])
    out = [*left.columns, *right.columns]
    parts = [first.filter("_hit").select(*out)]
    rest = first.filter(F.col("_hit").isNull()).select(*out)
    for i in range(1, len(pairs)):
        lc = pairs[i][0]
        earlier = [F.coalesce(F.col(pairs[j][0]) == F.col(keys[j]), F.lit(False)) for j in range(i)]
        met = _keyed_join(left, keyed, lc, keys[i], "inner", hot[i])
        parts.append(met.filter(~reduce(lambda x, y: x | y, earlier)).select(*out))
        known = keyed.select(F.col(keys[i]).alias("_known")).filter(F.col("_known").isNotNull()).distinct()
        rest = _keyed_join(rest, known, lc, "_known", "left_anti", hot[i])
    return reduce(DataFrame.unionByName, [*parts, rest.select(*out)])


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, take: Sequence[str]) -> DataFrame:
    """Left join ``dim`` on ``on`` keeping only ``take`` from it."""
    on = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*on, *take), on, "left")


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str] | str, Sequence[str]]]) -> DataFrame:
    """Chain of left joins of a fact with its dimensions (each ``(dim, keys, columns)``)."""
    out = fact
    for dim, on, take in dims:
        out = lookup(out, dim, on, take)
    return out


def recode(df: DataFrame, crosswalk: DataFrame, col: str, source: str = "source_code",
           target: str = "target_code") -> DataFrame:
    """Translate codes of ``col`` through a crosswalk table (``source -> target``);
    codes without an entry are kept as they are. Used when two sources use
    different code systems for the same entity before they are joined."""
    cw = crosswalk.select(F.col(source).alias("_cw_source"), F.col(target).alias("_cw_target"))
    out = df.join(cw, df[col] == cw["_cw_source"], "left")
    return out.withColumn(col, F.coalesce(F.col("_cw_target"), F.col(col))).drop("_cw_source", "_cw_target")
