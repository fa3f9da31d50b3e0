"""Benchmark decontamination by spaced-seed hashing.

Every benchmark item is hashed at every position under fixed masks (``1`` = the word counts,
``0`` = any word).  Training texts are hashed the same way; equal hashes give a diagonal of
(text, item), along which all words are compared and the best stretch with substitutions
(+1 a match, ``mismatch_cost`` off for another word) is taken.  A stretch with at least
``min(min_match, ceil(item_share * words of the item))`` equal words is a leak, and so is a
diagonal whose equal words over the whole item reach ``item_share`` (a changed word near an end
costs no more than itself).

Words are case-folded runs of ASCII letters, digits and non-ASCII characters (all of Unicode:
``É`` equals ``é``, ``STRASSE`` equals ``straße``).  The hashed
benchmark travels to the tasks in parts of at most about ``part_words`` words (a documented
bound); every part meets all texts, so a large benchmark takes more passes and loses nothing.

Items of under ``SHORT_ITEM`` words have masks of their own besides: an item that may differ in
k words is cut into k + 2 parts of nearly equal length, each pair of parts is a mask, and k
changed words leave at least one pair whole, so none is missed.  Items of one to four words may
differ in none and are found where all their words stand.

Defined cases: null or empty texts match nothing; items under ``min_item_words`` words match
nothing (``find_leaks`` reports all; ``remove_leaks`` leaves those of under five, which clean
texts hold by chance, unless told otherwise); items with equal words count once, under their
smallest id, which may be of any type that sorts; a null id is no item; repeated documents give
repeated rows; empty tables give empty results; other columns are not read (``find_leaks``) or
kept as they are (``remove_leaks``).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tokenledger.llm import tokens as tk
from tokenledger.llm.shared import per_block, sql_type

#: The masks.  The shortest has span 5, so items of five words have a seed.
MASKS = ("11111", "1101011011", "111010110011", "1011001110101")
SPREAD = 20  # most bits of the first-look table of seed hashes
SHORT_ITEM = 16

GAP = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    GAP[_a:_b] = False
VALUE = np.where(GAP, tk.U64(0), tk.BYTE_LOWER)


def folded(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The texts with their case folded beyond ASCII; ``VALUE`` folds A-Z.  Bytes that are no
    UTF-8 stay as they are."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw = texts.cast(pa.binary()).to_pylist()
    return pa.array([x if x is None or x.isascii() else x.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
                     for x in raw], pa.binary())


def item_words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the case-folded words of each text and the index of each text's first word."""
    buf, offs = tk.text_block(folded(texts))
    starts, ends, first = tk.word_spans(buf, offs, GAP)
    return tk.span_hash(buf, starts, ends, VALUE), first


def seed_hashes(w: np.ndarray, mask: str) -> np.ndarray:
    """Spaced hash at each position where the whole mask fits into w."""
    m = len(w) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, tk.U64)
    g = np.zeros(m, tk.U64)
    for j, x in enumerate(mask):
        if x == "1":
            g += w[j: j + m] * tk.U64(pow(tk.GRAM_BASE, j + 1, 2**64))
    return tk.mix(g)


def needed(n: int, item_share: float) -> int:
    """Equal words that an item of n words needs."""
    return int(np.ceil(item_share * n))


def short_masks(n: int, changes: int) -> list[tuple[str, int]]:
    """(mask, its place in the item): each pair of ``changes + 2`` parts of n words."""
    cuts = [n * j // (changes + 2) for j in range(changes + 3)]
    out = set()
    for pair in itertools.combinations(range(changes + 2), 2):
        ones = [p for j in pair for p in range(cuts[j], cuts[j + 1])]
        out.add(("".join("1" if p in ones else "0" for p in range(ones[0], ones[-1] + 1)), ones[0]))
    return sorted(out)


class Seeds:
    """The hashed items of one part: for each mask, ascending hashes with (item, position)."""

    def __init__(self, ids: list, texts: list[str | None], min_item_words: int, item_share: float = 0.8):
        w, first = item_words(pa.array(texts, pa.string()))
        kept: dict[bytes, tuple[object, np.ndarray]] = {}
        for i, x in enumerate(ids):
            own = w[first[i]: first[i + 1]]
            if len(own) >= max(1, min_item_words) and (own.tobytes() not in kept or kept[own.tobytes()][0] > x):
                kept[own.tobytes()] = (x, own)
        items = sorted(kept.values(), key=lambda p: p[0])
        self.ids = [p[0] for p in items]
        self.words = np.concatenate([p[1] for p in items]) if items else np.zeros(0, tk.U64)
        self.first = np.concatenate([[0], np.cumsum([len(p[1]) for p in items])]).astype(np.int64)
        who, sizes = tk.owner(self.first), np.diff(self.first)
        self.whole = np.array([needed(n, item_share) == n for n in sizes.tolist()], bool)  # no word may differ
        places: dict[str, list[np.ndarray]] = {m: [np.flatnonzero(tk.whole_windows(self.first, len(m)))] for m in MASKS}
        for n in sorted(set(sizes[sizes < SHORT_ITEM].tolist())):
            for mask, offset in short_masks(n, n - needed(n, item_share)):
                places.setdefault(mask, []).append(self.first[:-1][sizes == n] + offset)
        self.tables = []
        for mask, at in places.items():
            g = seed_hashes(self.words, mask)
            at = np.unique(np.concatenate(at))
            at = at[np.argsort(g[at], kind="stable")]
            spread = min(SPREAD, 8 + len(at).bit_length())
            seen = np.zeros(1 << spread, bool)
            seen[g[at] >> tk.U64(64 - spread)] = True
            self.tables.append((mask, g[at], who[at], at - self.first[who[at]], seen, spread))

    def hits(self, w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, item, diagonal) with a seed in common; diagonal: text place - item place."""
        found = []
        for mask, table, item, place, seen, spread in self.tables:
            g = seed_hashes(w, mask)
            at = np.flatnonzero(seen[g >> tk.U64(64 - spread)]) if len(table) else np.zeros(0, np.int64)
            lo, hi = np.searchsorted(table, g[at], "left"), np.searchsorted(table, g[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            doc = np.searchsorted(first, at, "right") - 1
            inside = at + len(mask) <= first[doc + 1]
            at, lo, hi, doc = at[inside], lo[inside], hi[inside], doc[inside]
            times = hi - lo
            row = np.repeat(np.arange(len(at)), times)
            k = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            found.append(np.stack([doc[row], item[k], at[row] - first[doc[row]] - place[k]], axis=1))
        text, item, diagonal = np.unique(np.concatenate(found), axis=0).T
        # one place of an item that must stand whole is as good as any other
        again = np.zeros(len(text), bool)
        again[1:] = (text[1:] == text[:-1]) & (item[1:] == item[:-1])
        first_look = ~(again & self.whole[item]) if len(self.ids) else again
        return text[first_look], item[first_look], diagonal[first_look]

    def verified(self, w: np.ndarray, first: np.ndarray, min_match: int, item_share: float, mismatch_cost: int):
        """Leaks as (text, item, matched, stretch words, text start, item start), best per text and item."""
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for d, i, diag in zip(*self.hits(w, first)):
            text, item = w[first[d]: first[d + 1]], self.words[self.first[i]: self.first[i + 1]]
            a, b = max(0, -diag), min(len(item), len(text) - diag)
            same = item[a:b] == text[a + diag: b + diag]
            run = np.concatenate([[0], np.cumsum(np.where(same, 1, -mismatch_cost))])
            low = np.minimum.accumulate(run)
            end = int((run - low).argmax())
            start = int(run[: end + 1].argmin())
            matched = int(same[start:end].sum())
            share = needed(len(item), item_share)
            if matched < min(min_match, share) and same.sum() >= share:
                equal = np.flatnonzero(same)
                start, end, matched = int(equal[0]), int(equal[-1]) + 1, len(equal)
            if matched >= min(min_match, share):
                got = (matched, end - start, a + start + diag, a + start)
                if best.get((d, i), (0,))[0] < matched:
                    best[d, i] = got
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def _parts(benchmark: DataFrame, item: str, text: str, part_words: int, min_item_words: int, item_share: float):
    """Seeds of each part; a part is collected only when its turn comes."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).filter("i is not null and t is not null")
    total = rows.agg(F.sum(F.length("t") - F.length(F.regexp_replace("t", "[^\\s]+", "")))).first()[0] or 0
    n = max(1, -(-(total // 4) // part_words))  # about four characters or more a word
    part = F.pmod(F.xxhash64("t"), F.lit(n))
    for p in range(n):
        own = rows.filter(part == p).groupBy("t").agg(F.min("i").alias("i")).orderBy("i").collect()
        yield Seeds([r["i"] for r in own], [r["t"] for r in own], min_item_words, item_share)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", min_match: int = 13, item_share: float = 0.8, mismatch_cost: int = 3,
               min_item_words: int = 1, part_words: int = 500_000) -> DataFrame:
    """(key, item_id, n_match, n_span, similarity, doc_start, item_start): the best verified
    stretch of each document and item, in words."""
    out, id_type = None, to_arrow_type(benchmark.schema[item].dataType)
    for seeds in _parts(benchmark, item, item_text, part_words, min_item_words, item_share):
        def run(t: pa.Table, seeds=seeds) -> pa.Table | None:
            rows = seeds.verified(*item_words(t.column("_t")), min_match, item_share, mismatch_cost)
            if not rows:
                return None
            x = np.array(rows, np.int64)
            return pa.table({"k": t.column("_k").take(pa.array(x[:, 0])), "item_id": pa.array([seeds.ids[i] for i in x[:, 1].tolist()], id_type),
                             "n_match": x[:, 2],
                             "n_span": x[:, 3], "similarity": x[:, 2] / x[:, 3], "doc_start": x[:, 4], "item_start": x[:, 5]})

        part = per_block(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")), "_t", run,
                         f"k {sql_type(docs, key)}, item_id {sql_type(benchmark, item)}, n_match long, n_span long, similarity double, "
                         "doc_start long, item_start long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("k", key)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                 min_match: int = 13, item_share: float = 0.8, mismatch_cost: int = 3, min_item_words: int = 5,
                 part_words: int = 500_000) -> DataFrame:
    """The documents without any leak, with all their columns."""
    out = docs
    for seeds in _parts(benchmark, item, item_text, part_words, min_item_words, item_share):
        def run(t: pa.Table, seeds=seeds) -> pa.Table:
            bad = {r[0] for r in seeds.verified(*item_words(t.column(text)), min_match, item_share, mismatch_cost)}
            return t.filter(pa.array([i not in bad for i in range(t.num_rows)], pa.bool_()))

        out = per_block(out, text, run, ", ".join(f"`{c}` {sql_type(docs, c)}" for c in docs.columns))
    return out
