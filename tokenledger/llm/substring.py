"""Substring dedup by level-wise doubling.

A window of ``window`` words that starts anywhere else too (same text included) loses all its
words.  Level by level: windows of ``base`` words are counted over the whole corpus; only
where a window is repeated at one length is it extended to twice that length (the last step
overlaps its two halves), until the full length is reached or no candidate survives.  A window
repeated at the full length has both its halves repeated, so no level loses one.

Levels before the last compare shortened hashes (a false match costs work, not results, since
the next level looks again); the last level compares 64-bit hashes, so among n candidate
windows about n**2 / 2**65 are taken for repeated in error.  Counts travel as distinct keys of
a chunk (``chunks``): a passage in a third of all texts is one entry a chunk.

Defined cases: null text has no words and stays null; empty or short texts are kept; repeated
rows remove each other when they have a full window; a null key is a key like any other;
an empty table gives an empty result.  All columns are kept; ``n_words`` and ``n_removed`` are
added (input columns of these names are replaced).  Input columns named like the inner ones
(``_chunk``, ``_text_hash``) pass through unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tokenledger.llm import tokens as tk
from tokenledger.llm.chunks import bucket_bits, by_bucket, chunk_count, chunk_of, text_bytes
from tokenledger.llm.shared import set_aside, tidied

CHUNK, HASH = "_chunk", "_text_hash"


def level_lengths(window: int, base: int) -> list[int]:
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _bits(flags: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [np.packbits(flags[a:b]).tobytes() for a, b in zip(first, first[1:])]


def _flags(bits: list[bytes], first: np.ndarray) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=b - a).view(bool) for x, a, b in zip(bits, first, first[1:])]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _extended(rep: np.ndarray, first: np.ndarray, have: int, length: int) -> np.ndarray:
    """Starts where both halves of a window of ``length`` words are repeated at ``have`` words."""
    step = length - have
    both = rep.copy()
    both[: len(rep) - step] &= rep[step:]
    both[max(0, len(rep) - step):] = False
    return both & tk.whole_windows(first, length)


def _keys(t: pa.Table, text: str, lengths: list[int], level: int, shift: int):
    """Index of first words, candidate starts, their keys."""
    w, first = tk.words_hashed(*tk.text_block(t.column(text)))
    g = tk.ngrams(w, lengths[0])
    for have, length in zip(lengths[:level], lengths[1: level + 1]):
        g = tk.double(g, have, length - have)
    if level:
        cand = _extended(_flags(t.column("rep").to_pylist(), first), first, lengths[level - 1], lengths[level])
    else:
        cand = tk.whole_windows(first, lengths[0])
    at = np.flatnonzero(cand)
    return first, at, tk.mix(g[at]) >> tk.U64(shift)


def _level(rows: DataFrame, text: str, lengths: list[int], level: int, shift: int, bits: int) -> DataFrame:
    """(chunk, text hash, text, rep) of the texts that go on, or (..., removed words) at the last level."""
    last = level == len(lengths) - 1

    def ask(t: pa.Table) -> pa.Table:
        _, _, k = _keys(t, text, lengths, level, shift)
        u, n = np.unique(k, return_counts=True)
        out = [(b, t.column(CHUNK)[0].as_py(), tk.pack_sorted(u[lo:hi]), np.packbits(n[lo:hi] > 1).tobytes())
               for b, lo, hi in by_bucket(u << tk.U64(shift), bits)]
        return pa.Table.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                    ["bucket", "chunk", "keys", "many"])

    def merge(t: pa.Table) -> pa.Table:
        keys = [tk.unpack_sorted(x) for x in t.column("keys").to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(t.column("many").to_pylist(), keys)]
        cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        twice = np.bincount(at, weights=1 + np.concatenate(many)) > 1
        rep = twice[at]
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "rep": pa.array(_bits(rep, cuts), pa.binary())})

    def fill(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows or not answers.num_rows:
            return empty
        first, at, k = _keys(t, text, lengths, level, shift)
        u, inv = np.unique(k, return_inverse=True)
        answers = answers.sort_by("bucket")
        found = [(b, lo, hi) for b, lo, hi in by_bucket(u << tk.U64(shift), bits)]
        flags = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=hi - lo).view(bool)
                                for x, (_, lo, hi) in zip(answers.column("rep").to_pylist(), found)])
        rep = np.zeros(int(first[-1]), bool)
        rep[at[flags[inv]]] = True
        if last:
            edge = np.zeros(len(rep) + lengths[-1], np.int32)  # +1 where a window opens, -1 behind its end
            edge[: len(rep)] += rep
            edge[lengths[-1]:] -= rep
            state = np.cumsum(edge)[: len(rep)] > 0
            live = tk.segment_sums(state, first) > 0
        else:
            state = rep
            live = tk.segment_sums(_extended(rep, first, lengths[level], lengths[level + 1]), first) > 0
        pick = np.flatnonzero(live)
        own = t.take(pa.array(pick))
        every = _bits(state, first)
        return pa.table({CHUNK: own.column(CHUNK), HASH: own.column(HASH),
                         "t": own.column(text) if not last else pa.nulls(len(pick), pa.string()),
                         "rep": pa.array([every[i] for i in pick], pa.binary())}, empty.schema)

    empty = pa.schema([(CHUNK, pa.int32()), (HASH, pa.int64()), ("t", pa.string()), ("rep", pa.binary())]).empty_table()
    answers = (rows.groupBy(CHUNK).applyInArrow(tidied(ask), "bucket int, chunk int, keys binary, many binary")
               .groupBy("bucket").applyInArrow(tidied(merge), "chunk int, bucket int, rep binary"))
    return rows.groupBy(CHUNK).cogroup(answers.groupBy("chunk")).applyInArrow(
        tidied(fill), f"{CHUNK} int, {HASH} long, t string, rep binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35, base: int = 9,
                   join_all: bool = False) -> DataFrame:
    """``docs`` with every word of a repeated window removed: ``text`` becomes the kept words
    joined by one space where words were removed (everywhere with ``join_all``)."""
    docs, back = set_aside(docs, CHUNK, HASH)
    key, text = ({v: k for k, v in back.items()}.get(c, c) for c in (key, text))
    total = text_bytes(docs, text)
    n, bits = chunk_count(total), bucket_bits(total)
    keep = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], chunk_of(n, key, text).alias(CHUNK),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(HASH))
    lengths = level_lengths(window, base)
    loose = 64 - min(64, bits + 20, math.ceil(math.log2(max(2, total))) + 8)
    found, own = rows, text
    for level in range(len(lengths)):
        found = _level(found, own, lengths, level, 0 if level == len(lengths) - 1 else loose, bits)
        own = "t"

    schema = StructType([docs.schema[c] for c in keep] + [StructField("n_words", LongType()), StructField("n_removed", LongType())])

    def cut(t: pa.Table, marks: pa.Table) -> pa.Table:
        mask = dict(zip(marks.column(HASH).to_pylist(), marks.column("rep").to_pylist()))
        n_words, n_removed, texts = [], [], []
        for h, x in zip(t.column(HASH).to_pylist(), t.column(text).to_pylist()):
            words = (x or "").encode().split()
            n_words.append(len(words))
            gone = mask.get(h)
            if gone is not None and x is not None:
                flags = np.unpackbits(np.frombuffer(gone, np.uint8), count=len(words))
                kept = [w for w, f in zip(words, flags.tolist()) if not f]
                n_removed.append(len(words) - len(kept))
                x = b" ".join(kept).decode()
            else:
                n_removed.append(0)
                x = b" ".join(words).decode() if join_all and x is not None else x
            texts.append(x)
        out = t.select(keep)
        out = out.set_column(keep.index(text), text, pa.array(texts, pa.string()))
        return out.append_column("n_words", pa.array(n_words, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))

    marks = found.select(CHUNK, HASH, "rep")
    return rows.groupBy(CHUNK).cogroup(marks.groupBy(CHUNK)).applyInArrow(tidied(cut), schema).withColumnsRenamed(back)
