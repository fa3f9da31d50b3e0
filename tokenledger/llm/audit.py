"""Filter interaction audit: what each of five filters removes, alone and in every order.

Four filters look at one text (length, distinct words, capitals, symbols).  The fifth, exact
duplication, needs the whole table, so a *counting Bloom filter* goes first: each task counts
the cells that its texts' hashes hit (saturating at two), the tasks' sketches are merged cell
by cell, and a text that hits a cell counted once is unique for certain.  Only the possible
repeats shuffle with their full text, to the least id of each text; a text in a third of all
rows is aggregated in each task first.  The sketch has ``CELLS`` cells a row but at most
``max_bytes`` bytes, which bounds what is broadcast; a fuller sketch clears fewer texts and
changes no result.

Flags become a bit mask a row, and additive counts by (part, mask) -- 32 masks at most -- give
every order: what a filter removes at a step are the masks with its bit and none of the bits
before it.

Defined cases: a null text is empty; a null language is the part ''; a null id never counts as
a duplicate nor as the smaller one, and has no label; rows that repeat an id and text are
neither's duplicate; several label rows of an id count once, each flag if any row has it; an
empty table gives an empty result.  Only id, text and language are read."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.chunks import pack_counts, unpack_counts
from tokenledger.llm.shared import sql_type, tidied, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
CELLS = 8
PROBES = 3
SHARD_BITS = 18  # cells of a shard: one packed row
MAX_BYTES = 1 << 26
PROBE_STEP = 0x9E3779B97F4A7C15


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at one text: A 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (n < 200, F.size(F.array_distinct(words)) * 100 < n * 50, capitals.cast("long") * 100 > chars.cast("long") * 3, text.rlike("[#$%&*|]"))
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))


def sketch_bits(rows: int, max_bytes: int = MAX_BYTES) -> int:
    """log2 of the number of cells (two bits each), at least one shard."""
    return max(SHARD_BITS, min(max(1, CELLS * rows - 1).bit_length(), (max_bytes * 4).bit_length() - 1))


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    """Cells of each hash, a row a probe; a cell that an earlier probe of the hash has is -1."""
    at = np.stack([(tk.mix(h + np.uint64((i * PROBE_STEP) % 2**64)) >> np.uint64(64 - bits)).astype(np.int64) for i in range(PROBES)])
    for i in range(1, PROBES):
        at[i, (at[:i] == at[i]).any(axis=0)] = -1
    return at


def _hashes(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _partial(bits: int):
    """A task's sketch: for each shard the cells it hit, and whether once or more often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts, held = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def settle() -> None:
            nonlocal cells, counts
            new, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            both = np.concatenate([cells, new])
            cells, place = np.unique(both, return_inverse=True)
            counts = np.minimum(np.bincount(place, np.concatenate([counts, times]), len(cells)), 2).astype(np.int64)
            held.clear()

        for batch in batches:
            at = probes(_hashes(batch.column(0)), bits).ravel()
            held.append(at[at >= 0])
            if sum(map(len, held)) > 1 << 21:
                settle()
        settle()
        shard = cells >> SHARD_BITS
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(cells))
        rows = [(int(shard[a]), tk.pack_sorted((cells[a:b] & ((1 << SHARD_BITS) - 1)).astype(np.uint64)), pack_counts(counts[a:b]))
                for a, b in zip(cuts, cuts[1:])]
        if rows:
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                   pa.array([r[2] for r in rows], pa.binary())], ["shard", "cells", "counts"])
    return run


def _merge(t: pa.Table) -> pa.Table:
    """The sum of a shard's sketches, two bits a cell."""
    total = np.zeros(1 << SHARD_BITS, np.uint8)
    for cells, counts in zip(t.column("cells").to_pylist(), t.column("counts").to_pylist()):
        at = tk.unpack_sorted(cells).astype(np.int64)
        total[at] = np.minimum(total[at] + unpack_counts(counts), 2)
    packed = (total.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    return pa.table({"shard": t.column("shard")[:1].cast(pa.int32()), "cells": pa.array([tk.pack(packed)], pa.binary())})


def counting_bloom(hashes: DataFrame, bits: int) -> np.ndarray:
    """The merged sketch of a one-column table of 64-bit hashes: two bits for each of 2**bits
    cells, so its size is known before it comes to the driver."""
    shards = (hashes.mapInArrow(_partial(bits), "shard int, cells binary, counts binary")
              .groupBy("shard").applyInArrow(tidied(_merge), "shard int, cells binary"))
    out = np.zeros((1 << bits) // 4, np.uint8)
    width = (1 << SHARD_BITS) // 4
    for row in shards.toLocalIterator():
        out[row["shard"] * width: (row["shard"] + 1) * width] = tk.unpack(bytes(row["cells"]), np.uint8)
    return out


def may_repeat(sketch: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False where a cell counted one text only: no other text has the same hash."""
    bits = len(sketch).bit_length() + 1
    out = np.ones(len(h), bool)
    for at in probes(h, bits):
        hit = at >= 0
        out[hit] &= (sketch[at[hit] >> 2] >> ((at[hit] & 3) * 2).astype(np.uint8)) & 3 != 1
    return out


def mark_repeats(rows: DataFrame, sketch, hash_col: str = "h", keep_all: bool = False) -> DataFrame:
    """The rows whose hash the broadcast sketch doesn't clear; with ``keep_all`` every row and
    a column ``may_repeat``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = pa.array(may_repeat(sketch.value, _hashes(batch.column(batch.schema.get_field_index(hash_col)))))
            yield batch.append_column("may_repeat", told) if keep_all else batch.filter(told)
    schema = ", ".join(f"{c} {sql_type(rows, c)}" for c in rows.columns) + ", may_repeat boolean" * keep_all
    return rows.mapInArrow(run, schema)


def filter_masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                 max_bytes: int = MAX_BYTES) -> DataFrame:
    """(part, mask, n, good, toxic): additive counts of rows by part and failed filters."""
    base = (docs.select(F.col(key).alias("id"), F.coalesce(F.col(lang), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text")))
    light = written(base.select("id", "part", "h", text_mask(F.col("text")).alias("mask")), "audit-flags")
    sketch = docs.sparkSession.sparkContext.broadcast(counting_bloom(light.select("h"), sketch_bits(light.count(), max_bytes)))
    # full texts of possible repeats alone shuffle, one row a text and task
    firsts = (mark_repeats(base.filter("id is not null").select("id", "h", "text"), sketch).groupBy("text", "h").agg(F.min("id").alias("id"))
              .select("id", "h").distinct().withColumn("first", F.lit(True)))
    rows = mark_repeats(light.groupBy("id", "part", "h", "mask").agg(F.count("*").alias("n")), sketch, keep_all=True)
    repeats = rows.filter("may_repeat and id is not null").join(firsts, ["id", "h"], "left")
    last = repeats.select("id", "part", "n", (F.col("mask") + F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))
    flagged = last.unionByName(rows.filter("not may_repeat and id is not null").select("id", "part", "n", "mask"))
    told = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"))
    named = flagged.join(told, "id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = rows.filter("id is null").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return (named.unionByName(nameless).groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def audit_orders(masks: DataFrame) -> DataFrame:
    """A row a part, order and step from the additive counts of ``filter_masks``."""
    def bit(letter: str) -> str:
        return f"shiftleft(1, instr('{FILTERS}', {letter}) - 1)"

    steps = (masks.withColumn("filter_order", F.explode(F.split(F.lit(",".join(ORDERS)), ",")))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .withColumn("own", F.expr(bit("substring(filter_order, step, 1)")))
             .withColumn("before", F.expr(f"aggregate(sequence(1, {len(FILTERS)}), 0, (s, i) -> s + if(i < step, {bit('substring(filter_order, i, 1)')}, 0))"))
             .withColumn("fails", F.expr("(mask & own) != 0")).withColumn("gone", F.expr("(mask & before) != 0")))

    def total(what: str, when: str) -> Column:
        return F.sum(F.expr(f"if({when}, {what}, 0)"))

    # over all orders, each filter of a mask comes first equally often
    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", "not fails and not gone").alias("kept"), total("n", "fails and not gone").alias("removed"),
        total("n", "fails and gone").alias("redundant"), total("n", "mask = own").alias("unique_fails"),
        total("good", "fails and not gone").alias("good_lost"), total("toxic", "fails and not gone").alias("toxic_lost"),
        total(f"n * ({len(ORDERS)} div greatest(bit_count(mask), 1))", "fails").alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley): what each filter does at its place in all 120 orders, by language."""
    return audit_orders(filter_masks(docs, labels, key, text, lang))


#: The same rows in DuckDB: every order is applied mask by mask, the shares are added up over all orders.
ORACLE = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
words as (
  select *, regexp_extract_all(t, '[^ 	-]+') as w, min(doc_id) over (partition by t) as first_id from texts),
told as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
flags as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    map {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
         'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
         'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(words.doc_id > first_id, false)} as f
  from words left join told on words.doc_id = told.doc_id),
masks as (
  select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from flags group by part, f),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a join letters b on b.x <> a.x join letters c on c.x not in (a.x, b.x)
  join letters d on d.x not in (a.x, b.x, c.x) join letters e on e.x not in (a.x, b.x, c.x, d.x)),
steps as (
  select part, filter_order, s.step, filter_order[s.step] as x, n, good, toxic,
    f[filter_order[s.step]] as fails,
    len(list_filter(range(1, s.step), lambda i: f[filter_order[i]])) > 0 as gone,
    len(list_filter(map_values(f), lambda v: v)) as failures
  from masks, orders, (select unnest(range(1, 6)) as step) s),
sums as (
  select part, filter_order, step, x,
    sum(case when not fails and not gone then n else 0 end) as kept, sum(case when fails and not gone then n else 0 end) as removed,
    sum(case when fails and gone then n else 0 end) as redundant, sum(case when fails and failures = 1 then n else 0 end) as unique_fails,
    sum(case when fails and not gone then good else 0 end) as good_lost, sum(case when fails and not gone then toxic else 0 end) as toxic_lost
  from steps group by part, filter_order, step, x)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, x) as bigint) as shapley
from sums"""
