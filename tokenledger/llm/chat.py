"""Chat formatting with budgeted windows.

A conversation becomes training windows of at most ``budget`` tokens (more only where a
single turn is longer): prefix sums of turn tokens choose spans of whole turns; every window
starts with the conversation's system turn and repeats up to ``history`` tokens of the turns
before its span.  Only assistant texts of the span itself are under the loss mask, so each is
a target once.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` (without the blanks).  Inside texts every
``<``, backslashes, ``|`` run gets one more backslash, so no text can form a mark, and taking
one backslash off restores it; line ends and backslashes of roles are escaped too.

Long conversations are cut into segments of ``SEGMENT`` budgets by the prefix sums, which come
from sums of turn ranges; a segment carries the history that it repeats.  So no task holds
more than a segment, even if one conversation holds a third of all rows.

Defined cases: null role or text is the empty text; turns are ordered by turn (nulls first),
then role, then text; repeated rows are repeated turns; a null conversation id is a
conversation of its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.llm.shared import sql_type, written

START, END = "<|im_start|>", "<|im_end|>"
SEGMENT = 64
RANGE = 4096  # turn numbers summed together
_guard, _unguard = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_encoders: dict = {}


def escape(text: str) -> str:
    return _guard.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _unguard.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    out = []
    for part in formatted.split(START)[1:]:
        role, text = part.removesuffix(END + "\n").split("\n", 1)
        out.append((unescape_role(role), unescape(text)))
    return out


def token_counter(path: str, pattern: str):
    """A count of byte-pair tokens by a public vocabulary file of ranks, read here and sent along."""
    data = open(path, "rb").read()

    def count(texts: list[str]) -> list[int]:
        key = hashlib.md5(data).digest()
        if key not in _encoders:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
            _encoders[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return [len(x) for x in _encoders[key].encode_ordinary_batch(texts, num_threads=1)]
    return count


def windows_of(turns: list[tuple[str, str]], sizes: list[int], before: list[tuple[str, str, int]],
               system: tuple[str, str, int] | None, opens: bool, budget: int, history: int):
    """Windows of one segment: (formatted, loss spans, context turns, turns, tokens).  ``before``:
    earlier turns (the system turn is not among them); ``opens``: turns[0] is the system turn."""
    every = [(r, x) for r, x, _ in before] + turns
    total = np.concatenate([[0], np.cumsum([s for _, _, s in before] + sizes)]).astype(np.int64)
    at = len(before)
    oldest = at + 1 if opens else 0  # the system turn is context already, never history
    while at < len(every):
        head = [system[:2]] if system is not None and not (opens and at == len(before)) else []
        own = system[2] if head else 0
        spare = budget - own - int(total[at + 1] - total[at])  # what the first turn leaves
        low = int(np.searchsorted(total, total[at] - min(history, max(0, spare)), "left"))
        low = min(max(low, min(oldest, at)), at)
        end = max(at + 1, int(np.searchsorted(total, total[low] + budget - own, "right")) - 1)
        context = head + every[low:at]
        parts = [turn_text(r, x) for r, x in context]
        place, spans = sum(map(len, parts)), []
        for role, text in every[at:end]:
            parts.append(turn_text(role, text))
            if role == "assistant":
                a = place + len(START) + len(escape_role(role)) + 1
                spans.append({"start": a, "end": a + len(escape(text))})
            place += len(parts[-1])
        yield "".join(parts), spans, len(context), end - at, own + int(total[end] - total[low])
        at = end


def format_conversations(chats: DataFrame, count, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", budget: int = 2048, history: int = 512) -> DataFrame:
    """One row a window: key, segment, window, formatted, loss (array of start, end in code
    points), n_context, n_turns, n_tokens; ``count``: tokens of a list of texts."""
    kind = sql_type(chats, key)

    def sized(batches):
        for b in batches:
            n = count([turn_text(r, x) for r, x in zip(b.column("role").to_pylist(), b.column("text").to_pylist())])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], [*b.schema.names, "n"])

    rows = chats.select(F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.mapInArrow(sized, f"conv {kind}, turn long, role string, text string, n long")
    rows = rows.withColumn("range", F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 62))))
    rows = written(rows, "turns")

    # tokens before each turn: sums of earlier ranges, then a running sum within the range
    ranges = rows.groupBy("conv", "range").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("conv").orderBy("range")
    ranges = ranges.select(F.col("conv").alias("c"), F.col("range").alias("r"), (F.sum("n").over(w) - F.col("n")).alias("base"),
                           (F.row_number().over(w) == 1).alias("opens"))
    inside = Window.partitionBy("conv", "range").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("upto", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("nr", F.row_number().over(inside))
    placed = placed.join(ranges, placed["conv"].eqNullSafe(ranges["c"]) & (placed["range"] == ranges["r"]))
    span = SEGMENT * budget
    placed = (placed.withColumn("before", F.col("base") + F.col("upto") - F.col("n"))
              .withColumn("segment", F.floor(F.col("before") / span))
              .withColumn("is_system", F.col("opens") & (F.col("nr") == 1) & (F.col("role") == "system"))
              .select("conv", "turn", "role", "text", "n", "nr", "before", "segment", "is_system"))
    placed = written(placed, "turns")
    new = placed.withColumn("kind", F.lit(2))
    # turns near a segment's end are history for the next one
    tail = (placed.filter(F.col("before") >= (F.col("segment") + 1) * span - history)
            .withColumn("segment", F.col("segment") + 1).withColumn("kind", F.lit(1)))
    later = placed.filter("segment > 0").select(F.col("conv").alias("c"), F.col("segment").alias("s")).distinct()
    system = placed.filter("is_system")
    heads = (system.join(later, system["conv"].eqNullSafe(later["c"])).withColumn("segment", F.col("s")).withColumn("kind", F.lit(0))
             .select(new.columns))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by([("kind", "ascending"), ("before", "ascending"), ("nr", "ascending")])
        r = t.to_pylist()
        own = [x for x in r if x["kind"] == 2]
        opens = bool(own) and own[0]["is_system"]
        head = next(((x["role"], x["text"], x["n"]) for x in (own if opens else r) if x["is_system"]), None)
        past = [(x["role"], x["text"], x["n"]) for x in r if x["kind"] == 1 and not x["is_system"]]
        out = list(windows_of([(x["role"], x["text"]) for x in own], [x["n"] for x in own], past, head, opens, budget, history))
        return pa.Table.from_arrays(
            [t.column("conv").slice(0, 1).take(pa.array([0] * len(out), pa.int64())), t.column("segment").slice(0, 1).take(pa.array([0] * len(out), pa.int64())),
             pa.array(range(len(out)), pa.int32()), pa.array([x[0] for x in out], pa.string()),
             pa.array([x[1] for x in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             *[pa.array([x[i] for x in out], k) for i, k in ((2, pa.int32()), (3, pa.int32()), (4, pa.int64()))]],
            ["conv", "segment", "window", "formatted", "loss", "n_context", "n_turns", "n_tokens"])

    out = (new.unionByName(tail).unionByName(heads).groupBy("conv", "segment").applyInArrow(
        build, f"conv {kind}, segment long, window int, formatted string, loss array<struct<start:int,end:int>>, n_context int, n_turns int, n_tokens long"))
    return out.withColumnRenamed("conv", key)


def read_back(windows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Digests of each conversation from its windows: turns, text under the loss mask, sizes.
    A digest runs over a conversation in order: its windows stream through one task, a batch
    of rows at a time."""
    def parts(batches):
        for b in batches:
            c, s, w, ctx = (b.column(x) for x in (key, "segment", "window", "n_context"))
            turns, loss, size, n = [], [], [], []
            for f, spans, k in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist(), ctx.to_pylist()):
                own = read_turns(f)[k:]
                turns.append("".join(f"{r}\n{x}\n" for r, x in own))
                loss.append("".join(unescape(f[x["start"]: x["end"]]) for x in spans))
                size.append(len(f))
                n.append(len(own))
            yield pa.RecordBatch.from_arrays([c, s, w, pa.array(turns, pa.string()), pa.array(loss, pa.string()), pa.array(size, pa.int64()), pa.array(n, pa.int64())],
                                             ["c", "segment", "window", "turns", "loss", "size", "n"])

    def digest(batches):
        now, state = None, None

        def row(k, x):
            return {"c": [k], "n_turns": [x[0]], "turns_sha256": [x[1].hexdigest()], "loss_chars": [x[2]], "loss_sha256": [x[3].hexdigest()], "formatted_chars": [x[4]]}

        for b in batches:
            schema = pa.schema([b.schema.field("c"), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for r in b.to_pylist():
                if state is None or r["c"] != now:
                    if state is not None:
                        yield pa.RecordBatch.from_pydict(row(now, state), schema)
                    now, state = r["c"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += r["n"]
                state[1].update(r["turns"].encode())
                state[2] += len(r["loss"])
                state[3].update(r["loss"].encode())
                state[4] += r["size"]
        if state is not None:
            yield pa.RecordBatch.from_pydict(row(now, state), schema)

    kind = sql_type(windows, key)
    rows = windows.mapInArrow(parts, f"c {kind}, segment long, window int, turns string, loss string, size long, n long")
    out = (rows.repartition("c").sortWithinPartitions(F.col("c").asc_nulls_first(), "segment", "window")
           .mapInArrow(digest, f"c {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
    return out.withColumnRenamed("c", key)
