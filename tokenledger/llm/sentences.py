"""SentencePiece sampling and decoding: Gumbel top-k segmentations without replacement.

The pieces of a public model span a lattice over each text; a segmentation's weight is the
product of its pieces' weights (Zipf weight of the piece's rank in the model, to the power
``alpha``).  Perturbed A-star search draws k distinct segmentations: a queue holds regions of
the lattice (all segmentations that leave a drawn one within a stretch of it), each with its
perturbed maximum, a Gumbel variable at the region's log mass, truncated at the value of the
region it was cut from.  The best region gives the next segmentation and is cut around it.
Values fall from draw to draw, all draws are distinct, and a row's draws depend on its key,
its text and the seed alone.

Pieces never cross the start of a blank run, so equal words share one lattice: a task builds it
once and keeps it for its later blocks, and backward sums give every piece's conditional weight.  Characters
without a piece of their own fall back to byte pieces; blanks become the piece mark and one
blank is put in front, as the model does.

Defined cases: null or empty text has one segmentation, without pieces (null decodes to the
empty text); a text with fewer than k segmentations gives all of them, each with inclusion
1.0; a null key is a key; repeated rows give equal draws; an empty table gives an empty
result.  Only key and text are read.
"""

from __future__ import annotations

import heapq
import math
import random
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.shared import per_block, sql_type

BLOCK = 200_000  # characters: the arrays of a block are what a worker holds beside its kept lattices
LOOK = 22  # bits of the first-look tables
KEEP_BYTES = 128_000_000  # of lattices that a task keeps from block to block
EDGE_BYTES = 28
WEIGHT = 1 << 31  # of an edge that every segmentation takes


@dataclass
class Pieces:
    """Bytes (blank instead of the piece mark) and log weight of each piece; id of each byte piece."""
    text: list[bytes]
    usable: np.ndarray
    logp: np.ndarray
    byte_ids: np.ndarray
    hashes: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    whole: np.ndarray = field(init=False)
    begin: np.ndarray = field(init=False)
    size: np.ndarray = field(init=False)
    data: np.ndarray = field(init=False)
    at: np.ndarray = field(init=False)

    def __post_init__(self):
        self.size = np.array([len(x) for x in self.text])
        self.data = np.frombuffer(b"".join(self.text), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        use = np.flatnonzero(self.usable)
        size, data, at = self.size[use], self.data, self.at[use]
        g, full = np.zeros(len(use), tk.U64), np.zeros(len(use), tk.U64)
        self.begin, self.whole = np.zeros(1 << LOOK, bool), np.zeros(1 << LOOK, bool)
        for j in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > j)
            g[on] += tk.BYTE_ALL[data[at[on] + j]] * tk.U64(pow(tk.GRAM_BASE, j, 2**64))
            m = tk.mix(g[on])
            self.begin[(m + tk.U64(j)) >> tk.U64(64 - LOOK)] = True
            full[on] = m
        order = np.argsort(full)
        self.hashes, self.ids = full[order], use[order]
        self.whole[self.hashes >> tk.U64(64 - LOOK)] = True

    @property
    def width(self):
        return np.uint16 if len(self.text) <= 65536 else np.uint32


def load_pieces(path: str, alpha: float = 1.0) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    text, usable, byte_ids = [], np.zeros(n, bool), np.full(256, -1)
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            text.append(bytes([int(p[3:5], 16)]))
        else:
            usable[i] = not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and bool(p)
            text.append(p.replace("▁", " ").encode() if usable[i] else b"")
    rank = np.where(usable, np.clip([-sp.get_score(i) for i in range(n)], 0, n), 4 * n)
    logp = -alpha * np.log(rank + 10)
    return Pieces(text, usable, logp - np.log(np.exp(logp[usable]).sum()), byte_ids)


def units(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts (each with a blank in front), starts of the units that no piece
    crosses, first unit of each text (+ total).  Null and empty texts have no unit."""
    raw = [b" " + x.encode() if x else b"" for x in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    blank = buf == 32
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    line = np.flatnonzero(buf == 10)
    start[line] = True
    start[line[line + 1 < len(buf)] + 1] = True
    start[offs[:-1][offs[:-1] < len(buf)]] = True
    at = np.flatnonzero(start)
    return buf, at, np.searchsorted(at, offs)


def build(p: Pieces, buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """The lattices of units: first place of each (+ total); start, next place (-1: the unit ends),
    piece and conditional log weight of each edge, ascending by start."""
    first = np.concatenate([[0], np.cumsum(size)])
    total = int(first[-1])
    own = np.repeat(np.arange(len(size)), size)
    chars = buf[starts[own] + np.arange(total) - first[own]]
    end_of = first[1:][own]
    value = tk.BYTE_ALL[chars]
    # pieces that start at each place, one more byte at a time while some piece goes on
    place, g, length = np.arange(total), np.zeros(total, tk.U64), 0
    place = place[(chars & 0xC0) != 0x80]
    g = g[place]
    e_start, e_end, e_piece = [], [], []
    while len(place):
        g = g + value[place + length] * tk.U64(pow(tk.GRAM_BASE, length, 2**64))
        length += 1
        m = tk.mix(g)
        maybe = np.flatnonzero(p.whole[m >> tk.U64(64 - LOOK)])
        spot = np.searchsorted(p.hashes, m[maybe])
        spot[spot == len(p.hashes)] = 0
        hit = p.hashes[spot] == m[maybe]
        e_start.append(place[maybe[hit]])
        e_end.append(place[maybe[hit]] + length)
        e_piece.append(p.ids[spot[hit]])
        on = p.begin[(m + tk.U64(length - 1)) >> tk.U64(64 - LOOK)] & (place + length < end_of[place])
        place, g = place[on], g[on]
    start, end, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (e_start, e_end, e_piece))
    # byte pieces for characters without a piece
    lead = np.flatnonzero((chars & 0xC0) != 0x80)
    stop = np.append(lead[1:], total)
    single = np.zeros(total + 1, bool)
    width = np.zeros(total + 1, np.int64)
    width[lead] = stop - lead
    single[start[end - start == width[start]]] = True
    bare = ~single[lead]
    raw = np.repeat(bare, stop - lead)
    raw_at = np.flatnonzero(raw)
    start = np.concatenate([start, raw_at])
    end = np.concatenate([end, raw_at + 1])
    piece = np.concatenate([piece, p.byte_ids[chars[raw_at]]])
    order = np.lexsort((piece, start))
    start, end, piece = start[order], end[order], piece[order]
    # backward sums, from the ends of all units at once
    lp = p.logp[piece]
    beta = np.full(total + 1, -np.inf)
    far = end_of[start] - start
    by_far = np.argsort(far.astype(np.uint16) if far.max(initial=0) < 65536 else far, kind="stable")  # short: a radix sort
    cut = np.flatnonzero(np.diff(far[by_far], prepend=-1))
    after = np.where(end == end_of[start], -1, end)  # -1: the unit ends here
    for a, b in zip(cut, np.append(cut[1:], len(by_far))):
        e = by_far[a:b]
        v = lp[e] + np.where(after[e] < 0, 0.0, beta[after[e]])
        s = start[e]
        head = np.flatnonzero(np.diff(s, prepend=-1))
        beta[s[head]] = np.logaddexp.reduceat(v, head)
    with np.errstate(invalid="ignore"):
        cond = lp + np.where(after < 0, 0.0, beta[after]) - beta[start]
    return first, start, after, piece, np.where(np.isfinite(cond), cond, -np.inf)


def grown(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``a`` with ``more`` behind its first ``used`` entries; in place while there is room."""
    if used + len(more) > len(a):
        a = np.concatenate([a[:used], np.empty(max(used, len(more)), a.dtype)])
    a[used: used + len(more)] = more
    return a


def found(among: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of h are in the ascending ``among``, where they are or would be)."""
    spot = np.searchsorted(among, h)
    inside = np.flatnonzero(spot < len(among))
    known = np.zeros(len(h), bool)
    known[inside] = among[spot[inside]] == h[inside]
    return known, spot


class Lattices:
    """Lattices of distinct units: edges by start, conditional weights, cumulative weights.

    A unit that an earlier block of the task had too is kept, so that frequent units are built
    twice at most; units beyond ``keep`` bytes and those met for the first time go with the block.
    Weights are summed as integers, so what is drawn does not depend on which units are kept."""

    def __init__(self, p: Pieces, keep: int = KEEP_BYTES):
        self.p, self.keep = p, keep
        self.met = np.zeros(0, tk.U64)  # hashes of units of earlier blocks, ascending; none once there is no room
        self.hashes, self.spots = np.zeros(0, tk.U64), np.zeros(0, np.int64)  # of kept units: hash (ascending), first place
        self.places = self.edges = 0
        self._piece, self._after, self._cond = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
        self._from, self._cum = np.zeros(1, np.int64), np.zeros(1, tk.U64)

    def units(self, buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """First place of the lattice of each unit of a block; lattices of the last block go."""
        ends = np.append(starts[1:], len(buf))
        h, example, kind = np.unique(tk.span_hash(buf, starts, ends, tk.BYTE_ALL), return_index=True, return_inverse=True)
        known, spot = found(self.hashes, h)
        place = np.empty(len(h), np.int64)
        place[known] = self.spots[spot[known]]
        new = np.flatnonzero(~known)
        room = EDGE_BYTES * self.edges + 8 * (self.places + 2 * len(self.hashes) + len(self.met)) < self.keep
        met, at = found(self.met, h[new])
        again = met & room
        kept, once = new[again], new[~again]
        place[kept] = self.append(buf, starts[example[kept]], ends[example[kept]])
        own = self.places, self.edges
        place[once] = self.append(buf, starts[example[once]], ends[example[once]])
        self.piece, self.after, self.cond = (x[: self.edges] for x in (self._piece, self._after, self._cond))
        self.edge_from, self.cum = self._from[: self.places + 1], self._cum[: self.edges + 1]
        self.places, self.edges = own
        self.hashes, self.spots = np.insert(self.hashes, spot[kept], h[kept]), np.insert(self.spots, spot[kept], place[kept])
        self.met = np.insert(self.met, at[~met], h[new[~met]]) if room else np.zeros(0, tk.U64)
        return place[kind]

    def append(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Builds the lattices of units; their first places."""
        if not len(starts):
            return np.zeros(0, np.int64)
        first, start, after, piece, cond = build(self.p, buf, starts, ends - starts)
        weight = np.rint(np.exp(cond) * WEIGHT).astype(tk.U64)
        weight[(weight == 0) & (cond > -np.inf)] = 1
        self._piece = grown(self._piece, self.edges, piece.astype(np.int32))
        self._after = grown(self._after, self.edges, np.where(after < 0, -1, after + self.places))
        self._cond = grown(self._cond, self.edges, cond)
        self._from = grown(self._from, self.places, self.edges + np.searchsorted(start, np.arange(int(first[-1]) + 1)))
        self._cum = grown(self._cum, self.edges + 1, self._cum[self.edges] + np.cumsum(weight, dtype=tk.U64))
        place = first[:-1] + self.places
        self.places, self.edges = self.places + int(first[-1]), self.edges + len(start)
        return place

    def walk(self, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled edges from each place to the end of its unit: (edges in lane order, cuts)."""
        steps, edges, lanes = np.zeros(len(place), np.int64), [], []
        lane = np.argsort(place, kind="stable")  # neighbours look up neighbouring sums
        place, seed = place[lane], seed[lane]
        step = 0
        while len(place):
            u = tk.mix(seed + tk.U64(step * 0x9E3779B97F4A7C15 % 2**64)) >> tk.U64(32)
            e, stop = self.edge_from[place], self.edge_from[place + 1]
            low = self.cum[e]
            goal, span = low + (u * (self.cum[stop] - low) >> tk.U64(32)), stop - e
            on = np.flatnonzero(span > 1)
            while len(on):  # halving: the last edge of the place with a sum before it of at most the goal
                half = span[on] >> 1
                mid = e[on] + half
                above = self.cum[mid] <= goal[on]
                e[on[above]] = mid[above]
                span[on] = np.where(above, span[on] - half, half)
                on = on[span[on] > 1]
            edges.append(e)
            lanes.append(lane)
            steps[lane] += 1
            on = self.after[e] >= 0
            place, lane, seed = self.after[e][on], lane[on], seed[on]
            step += 1
        cuts = np.concatenate([[0], np.cumsum(steps)])
        out = np.empty(int(cuts[-1]), np.int64)
        for k, (e, x) in enumerate(zip(edges, lanes)):
            out[cuts[x] + k] = e
        return out, cuts


class Draw:
    """One drawn segmentation: edges, unit of each edge, mass of each prefix."""

    def __init__(self, lat: Lattices, edges: np.ndarray, unit: np.ndarray, value: float):
        self.edges, self.unit, self.value = edges, unit, value
        self.logs = np.concatenate([[0.0], np.cumsum(lat.cond[edges])])
        self.mass = np.exp(self.logs)


class Search:
    """The queue of one row."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.queue: list = []
        self.count = 0
        self.draws: list[Draw] = []

    def value(self, mass: float, top: float) -> float:
        mu = math.log(mass)
        return mu - math.log(math.exp(min(mu - top, 700.0)) + self.rng.expovariate(1.0))

    def push(self, mass: float, top: float, region: tuple) -> None:
        if mass > 1e-300:
            self.count += 1
            heapq.heappush(self.queue, (-self.value(mass, top), self.count, region))

    def fan(self, d: Draw, a: int, b: int, top: float) -> None:
        """All that leaves d at an edge of [a, b)."""
        if a < b:
            self.push(float(d.mass[a] - d.mass[b]), top, ("fan", d, a, b))

    def add(self, d: Draw, since: int) -> None:
        self.draws.append(d)
        self.fan(d, since, len(d.edges), d.value)

    def next(self, lat: Lattices) -> tuple[float, Draw, int, int] | None:
        """(value, draw it leaves, edge number, other edge) of the best region, which is cut up."""
        if not self.queue:
            return None
        neg, _, region = heapq.heappop(self.queue)
        top = -neg
        if region[0] == "fan":
            _, d, a, b = region
            t = d.mass[a] - self.rng.random() * (d.mass[a] - d.mass[b])
            j = int(min(max(np.searchsorted(-d.mass[a + 1: b + 1], -t, "left"), 0), b - a - 1)) + a
            while b - a > 1 and lat.cond[d.edges[j]] >= 0.0:  # rounding: an edge without a rival
                j = a + (j - a + 1) % (b - a)
            self.fan(d, a, j, top)
            self.fan(d, j + 1, b, top)
            gone = {int(d.edges[j])}
        else:
            _, d, j, gone = region
        place = int(d.edges[j])
        at = int(np.searchsorted(lat.edge_from, place, "right")) - 1
        rivals = [e for e in range(int(lat.edge_from[at]), int(lat.edge_from[at + 1])) if e not in gone and lat.cond[e] > -math.inf]
        if not rivals:
            return self.next(lat)
        w = [math.exp(lat.cond[e]) for e in rivals]
        e = self.rng.choices(rivals, w)[0]
        left = sum(w) - math.exp(lat.cond[e])
        if len(rivals) > 1:
            self.push(float(d.mass[j]) * left, top, ("node", d, j, gone | {e}))
        return top, d, j, e


def sample_block(lat: Lattices, texts: list[str | None], seeds: np.ndarray, k: int):
    """For each text its draws (ids, log weight, value) and the value of the best one not drawn."""
    buf, starts, first = units(texts)
    out: list[list] = [[] for _ in texts]
    rest = [-math.inf] * len(texts)
    if not len(starts):
        return out, rest
    unit_place = lat.units(buf, starts)
    who = tk.owner(first)
    searches = {}
    number = np.arange(len(starts)) - first[who]

    def unit_seed(i, unit, draw):
        return tk.mix(seeds[i] + (unit + 1).astype(tk.U64) * tk.U64(0xD1342543DE82EF95)) + tk.U64(draw + 1)

    edges, cuts = lat.walk(unit_place, unit_seed(who, number, 0))
    unit_of = np.repeat(np.arange(len(starts)), np.diff(cuts))
    for i in np.flatnonzero(np.diff(first)).tolist():
        s = searches[i] = Search(int(seeds[i]))
        a, b = cuts[first[i]], cuts[first[i + 1]]
        s.add(Draw(lat, edges[a:b], unit_of[a:b], -math.log(s.rng.expovariate(1.0))), 0)
    for draw in range(1, k + 1):
        found = {i: x for i, s in searches.items() if len(s.draws) == draw and (x := s.next(lat)) is not None}
        for i, x in found.items():
            rest[i] = x[0]
        if draw == k or not found:
            break
        # the rest of the unit that was left, then all later units, for all texts at once
        lanes, where, rows = [], [], []
        for i, (_, d, j, e) in found.items():
            u = int(d.unit[j])
            later = np.arange(u + 1, first[i + 1])
            if lat.after[e] >= 0:
                lanes.append(np.array([u]))
                where.append(np.array([lat.after[e]]))
                rows.append(np.array([i]))
            lanes.append(later)
            where.append(unit_place[later])
            rows.append(np.full(len(later), i))
        lane, place, row = (np.concatenate(x).astype(np.int64) for x in (lanes, where, rows))
        edges, cuts = lat.walk(place, unit_seed(row, number[lane], draw))
        unit_of = np.repeat(lane, np.diff(cuts))
        at = 0
        sizes = np.bincount(row, minlength=len(texts))
        for i, (value, d, j, e) in found.items():
            a, b = cuts[at], cuts[at + sizes[i]]
            at += int(sizes[i])
            new = Draw(lat, np.concatenate([d.edges[:j], [e], edges[a:b]]), np.concatenate([d.unit[: j + 1], unit_of[a:b]]), value)
            searches[i].add(new, j + 1)
    for i, s in searches.items():
        if len(s.draws) < k:
            rest[i] = -math.inf
        out[i] = [(lat.piece[d.edges], float(d.logs[-1]), d.value) for d in s.draws]
    return out, rest


def round_trips(p: Pieces, texts: list[str | None], draws: list[tuple[int, np.ndarray]]) -> list[bool]:
    """Whether the bytes of the pieces of each (text number, ids) are a blank and that text."""
    ids = np.concatenate([np.zeros(0, np.int64), *[x for _, x in draws]])
    size = p.size[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    data = p.data[np.repeat(p.at[ids] - ends[:-1], size) + np.arange(int(ends[-1]))].tobytes()
    cuts = ends[np.concatenate([[0], np.cumsum([len(x) for _, x in draws])]).astype(np.int64)].tolist()
    raw = [b" " + x.encode() if x else b"" for x in texts]
    return [data[a:b] == raw[i] for (i, _), a, b in zip(draws, cuts, cuts[1:])]


def decode(p: Pieces, ids) -> str:
    """The text of a sequence of piece ids; the blank in front is taken off."""
    return b"".join(map(p.text.__getitem__, ids))[1:].decode()


def sample_segmentations(docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", k: int = 2,
                         seed: int = 0) -> DataFrame:
    """One row a drawn segmentation: key, draw (0..k-1, by falling perturbed value), n_pieces,
    log_weight, perturbed, inclusion (probability of being drawn given the value of the best one
    that was not), ids (binary, little-endian ``Pieces.width``), round_trip."""
    schema = f"k {sql_type(docs, key)}, draw int, n_pieces long, log_weight double, perturbed double, inclusion double, ids binary, round_trip boolean"

    lat: list[Lattices] = []  # of the task

    def run(t: pa.Table) -> pa.Table:
        if not lat:
            lat.append(Lattices(pieces))
        texts = t.column("t").to_pylist()
        seeds = tk.mix(t.column("s").to_numpy().view(tk.U64))
        found, rest = sample_block(lat[0], texts, seeds, k)
        rows = []
        for i, draws in enumerate(found):
            for r, (ids, logw, value) in enumerate(draws or [(np.zeros(0, np.int64), 0.0, 0.0)]):
                chance = 1.0 if rest[i] == -math.inf else -math.expm1(-math.exp(min(logw - rest[i], 700.0)))
                rows.append((i, r, len(ids), logw, value, chance, ids.astype(pieces.width).tobytes(), ids))
        cols = list(zip(*rows))
        cols[7] = round_trips(pieces, texts, list(zip(cols[0], cols[7])))
        return pa.Table.from_arrays([t.column("k").take(pa.array(cols[0], pa.int64())),
                                     *[pa.array(c, kind) for c, kind in zip(cols[1:], (pa.int32(), pa.int64(), pa.float64(), pa.float64(),
                                                                                       pa.float64(), pa.binary(), pa.bool_()))]],
                                    ["k", "draw", "n_pieces", "log_weight", "perturbed", "inclusion", "ids", "round_trip"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"),
                       F.xxhash64(F.col(key).cast("string"), F.col(text), F.lit(seed)).alias("s"))
    return per_block(rows, "t", run, schema, BLOCK).withColumnRenamed("k", key)


def decode_segmentations(rows: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the decoded text (an input column of that name is replaced);
    null ids decode to null."""
    keep = [c for c in rows.columns if c != out]

    def run(batches):
        for batch in batches:
            texts = [None if x is None else decode(pieces, np.frombuffer(x, pieces.width).tolist()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    schema = ", ".join([*(f"`{c}` {sql_type(rows, c)}" for c in keep), f"`{out}` string"])
    return rows.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
