"""Effective-dated and equi lookups that keep every fact row and report how
many dimension rows matched (G01, G02).

Instead of joining and re-grouping the fact by row key, the dimension is cut
into elementary, non-overlapping date segments per equi key and calendar
month; each segment knows how many dimension rows cover it and which one is
the first.  The fact then meets at most one partner per row through an equi
join on (keys, month) with the segment's dates as a residual: no fan-out,
exact match count, any number of dimension rows.  A dimension whose planned
size fits the session's broadcast threshold is broadcast, so the fact is not
shuffled; a larger one is joined by shuffle (adaptive execution splits hot
keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTH = "_lk_month"


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether the planner's size of ``dim`` is within the session's broadcast
    threshold (statistics only, no job)."""
    limit = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= int(limit)


def joined_small(fact: DataFrame, side: DataFrame, dim: DataFrame, cond: Column, how: str = "left") -> DataFrame:
    """``fact`` joined to ``side`` (derived from ``dim``), broadcast if ``dim`` is small."""
    return fact.join(F.broadcast(side) if fits_broadcast(dim) else side, cond, how)


def month_pieces(dim: DataFrame, start: str, end: str) -> DataFrame:
    """Each window once for each month that it touches: MONTH, and the part of
    the window inside that month as _ps .. _pe."""
    m = F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")))
    return (dim.filter(F.col(start) <= F.col(end)).withColumn(MONTH, m)
            .withColumn("_ps", F.greatest(F.col(start), F.col(MONTH)))
            .withColumn("_pe", F.least(F.col(end), F.last_day(MONTH))))


def elementary_segments(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, month and seg_start .. seg_end between neighbouring window edges."""
    edges = (pieces.select(*keys, MONTH, F.col("_ps").alias("p"))
             .union(pieces.select(*keys, MONTH, F.date_add("_pe", 1))).distinct())
    w = Window.partitionBy(*keys, MONTH).orderBy("p")
    return (edges.withColumn("n", F.lead("p").over(w)).filter("n is not null")
            .select(*keys, MONTH, F.col("p").alias("seg_start"), F.date_sub("n", 1).alias("seg_end")))


def covered_segments(dim: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Every (segment, dimension row that covers it) pair; rows meet within a
    key and month only."""
    pieces = month_pieces(dim, start, end)
    segs = elementary_segments(pieces, keys)
    return segs.join(pieces, [*keys, MONTH]).filter((F.col("_ps") <= F.col("seg_start")) & (F.col("_pe") >= F.col("seg_end")))


def date_segments(dim: DataFrame, keys: list[str], start: str, end: str,
                  fields: list[str]) -> DataFrame:
    """Keys, month, seg_start, seg_end, match_count, and the fields of the
    first covering row (earliest start, then the fields themselves)."""
    first = F.min_by(F.struct(*[F.col(f) for f in fields]),
                     F.struct(F.col(start).alias("_s"), *[F.col(f).alias(f"_f_{f}") for f in fields]))
    out = (covered_segments(dim, keys, start, end).groupBy(*keys, MONTH, "seg_start", "seg_end")
           .agg(F.count(F.lit(1)).alias("match_count"), first.alias("_first")))
    return out.select(*keys, MONTH, "seg_start", "seg_end", "match_count",
                      *[F.col(f"_first.{f}").alias(f) for f in fields])


def _equal(fact: DataFrame, side: DataFrame, on: dict[str, str], tag: str) -> Column:
    cond = F.lit(True)
    for fcol, dcol in on.items():
        cond = cond & (fact[fcol] == side[tag + dcol])
    return cond


def effective_lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str],
                     date_col: str, start: str, end: str, fields: list[str],
                     count_col: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Left-join ``fact`` to the dim rows whose [start, end] contains
    ``fact[date_col]`` and whose equi keys match.

    ``on`` maps fact column -> dim column.  Adds ``count_col`` (0, 1 or more)
    and the first match's ``fields`` (renamed through ``rename``).
    """
    rename = rename or {}
    dkeys = list(on.values())
    tag = "_lk_"
    segs = date_segments(dim, dkeys, start, end, fields).select(
        *[F.col(k).alias(tag + k) for k in dkeys], F.col(MONTH).alias(tag + "m"),
        F.col("seg_start").alias(tag + "s"), F.col("seg_end").alias(tag + "e"), F.col("match_count").alias(count_col),
        *[F.col(f).alias(rename.get(f, f)) for f in fields])
    cond = (_equal(fact, segs, on, tag) & (F.trunc(fact[date_col], "MM") == segs[tag + "m"])
            & fact[date_col].between(segs[tag + "s"], segs[tag + "e"]))
    return (joined_small(fact, segs, dim, cond).drop(*[tag + k for k in dkeys], tag + "m", tag + "s", tag + "e")
            .withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("int")))


def lookup_with_count(fact: DataFrame, dim: DataFrame, on: dict[str, str],
                      fields: list[str], count_col: str) -> DataFrame:
    """Equi lookup keeping every fact row: match count + first match's fields.
    The dim is collapsed per key first, so the fact side is never re-grouped."""
    dkeys = list(on.values())
    tag = "_lk_"
    first = F.min(F.struct(*[F.col(f) for f in fields]))
    per_key = (dim.groupBy(*dkeys).agg(F.count(F.lit(1)).alias(count_col), first.alias("_first"))
               .select(*[F.col(k).alias(tag + k) for k in dkeys], count_col,
                       *[F.col(f"_first.{f}").alias(f) for f in fields]))
    return (joined_small(fact, per_key, dim, _equal(fact, per_key, on, tag)).drop(*[tag + k for k in dkeys])
            .withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("int")))
