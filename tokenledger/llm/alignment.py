"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often
each pair of ids does so in the whole corpus.

Texts are encoded once, a block of some MB at a time.  Neither tokenizer joins a blank to a
character before it, so a text is cut before each blank that follows a solid character; equal
units of a block are encoded and aligned once.  Where tokens of both sides end at the same byte
a group ends; two tokens are linked if their byte ranges overlap.

Corpus-wide counts by *external spill counting*.  A block's pair-document records (pair, place
of the document in the block, links) are radix-partitioned by the B id and spilled as runs,
sorted by (B id, A id) and packed with zstd, into a written table.  The runs' heads (pairs and
their links in the block, without documents) meet in their radix, where a k-way heap merge
counts each pair: at most ``fan_in`` runs at a time, level by level, so that a pair in every
block stays one entry a block and no task sees more than ``fan_in`` of them.  The last merge
reads a B id's pairs in one stretch (side-major order), which gives its maximum.  The counts
stream back against the spilled runs, and each document gets its sums.

Defined cases: null or empty texts, and texts whose joined token bytes differ from blank + text
on either side (such as those with U+2581), have no tokens: zeros and an empty digest, and they
count nowhere.  Strings of special tokens inside texts are plain text.  A null key is a key;
repeated rows are documents of their own; ties for a B id's maximum all count; an empty table
gives an empty result.  Only key and text are read, so other columns may have any name.  One
text is never split, so its memory follows its length."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.chunks import pack_counts, unpack_counts
from tokenledger.llm.shared import per_block, sql_type, tidied, written

BLOCK = 4_000_000
RADIX_BITS = 5
FAN_IN = 64
#: Characters that are encoded by one call on the A side; a longer unit goes alone.
CALL_CHARS = 50_000
#: A worker forgets its units when they hold more characters.
KEPT_CHARS = 3_000_000
#: From a blank after a solid character to the next one.
UNIT = re.compile(r" [^ ]*+(?:(?<=\s) [^ ]*+)*+")
#: Fixed value: the public split pattern of the A vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"

_loaded: dict[str, tuple] = {}


@dataclass
class Pair:
    """Both vocabularies, ready to be sent to tasks: bytes of each A id (the id is the merge
    rank), the B model file as it is."""
    a: list[bytes]
    b: bytes

    def name(self) -> str:
        return hashlib.sha256(b"\0".join([*self.a, self.b])).hexdigest()


def byte_of_char() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for
    themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}


def load_tokenizers(a_path: str, b_path: str) -> Pair:
    """Reads a byte-level BPE file (A) and a SentencePiece BPE model (B) on the driver.  A's
    merges must make its ids in order, so that an id is its merge's rank; else ValueError."""
    with open(a_path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    of = byte_of_char()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    if any(vocab[x + y] != 256 + i for i, (x, y) in enumerate(merges)):
        raise ValueError("the merges of the A vocabulary do not make its ids in order")
    by_id = sorted((i, t) for t, i in vocab.items() if i < 256 + len(merges))
    with open(b_path, "rb") as f:
        return Pair([bytes(of[c] for c in t) for _, t in by_id], f.read())


def _load(pair: Pair, name: str) -> tuple:
    """(both encoders, bytes of A and B ids, their lengths, texts of ids, kept units), once a worker."""
    if name not in _loaded:
        import sentencepiece
        import tiktoken

        a = tiktoken.Encoding("a-side", pat_str=SPLIT, mergeable_ranks={t: i for i, t in enumerate(pair.a)}, special_tokens={})
        b = sentencepiece.SentencePieceProcessor(model_proto=pair.b)
        b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(MARK, " ").encode()
                   for i in range(b.get_piece_size())]
        size = [np.fromiter(map(len, t), np.int64, len(t)) for t in (pair.a, b_bytes)]
        # what an id is written as in the digest: followed by , inside its side of a group, else | (A) or ; (B)
        top = max(len(pair.a), len(b_bytes))
        shown = np.array([[f"{i},", f"{i}|", f"{i};"] for i in range(top)], object)
        _loaded.clear()
        _loaded[name] = a, b, pair.a, b_bytes, *size, shown, {"ids": {}, "chars": 0, "units": None}
    return _loaded[name]


def _encode_a(enc, units: list[str], size: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all units and how many each has.  Units that end in a solid character are
    joined for a call: the next one's blank ends the last token.  ``ends`` are the units' end
    bytes in their concatenation."""
    calls = [np.zeros(0, np.uint32)]
    start = 0
    while start < len(units):
        stop, chars = start, 0
        while stop < len(units) and (stop == start or chars + len(units[stop]) <= CALL_CHARS):
            chars += len(units[stop])
            stop += 1
            if units[stop - 1][-1].isspace():
                break
        calls.append(enc.encode_to_numpy("".join(units[start:stop]), disallowed_special=()))
        start = stop
    flat = np.concatenate(calls).astype(np.int64)
    return flat, np.diff(np.searchsorted(np.cumsum(size[flat]), ends, "left") + 1, prepend=0)


@dataclass
class Units:
    """Alignments of distinct units: group text; numbers of A tokens, B tokens, groups and
    links; whether the tokens' bytes are the unit's; the links' pairs (unit u:
    pairs[of[cuts[u]:cuts[u + 1]]], B id in the upper half; ``pairs`` ascend)."""
    text: list[str]
    n: np.ndarray
    ok: np.ndarray
    pairs: np.ndarray
    of: np.ndarray
    cuts: np.ndarray

    def __add__(self, more: Units) -> Units:
        pairs = np.union1d(self.pairs, more.pairs)
        of = np.append(np.searchsorted(pairs, self.pairs)[self.of], np.searchsorted(pairs, more.pairs)[more.of])
        return Units(self.text + more.text, np.concatenate([self.n, more.n], axis=1), np.append(self.ok, more.ok),
                     pairs, of, np.append(self.cuts, more.cuts[1:] + self.cuts[-1]))


def _true_units(units: list[str], a: np.ndarray, n_a: np.ndarray, b: list[list[int]], a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """Which units the joined token bytes of both sides spell."""
    cuts, ids = np.append(0, np.cumsum(n_a)).tolist(), a.tolist()
    return np.fromiter((b"".join([a_bytes[i] for i in ids[s:e]]) == u.encode() == b"".join([b_bytes[i] for i in y])
                        for u, s, e, y in zip(units, cuts, cuts[1:], b)), bool, len(units))


def align_units(units: list[str], pair: Pair, name: str) -> Units:
    """Encodes and aligns each unit (which starts with a blank)."""
    enc_a, enc_b, a_bytes, b_bytes, a_size, b_size, shown = _load(pair, name)[:7]
    raw = [u.encode() for u in units]
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    a, n_a = _encode_a(enc_a, units, a_size, ends)
    ids_b = enc_b.encode([u[1:] for u in units], num_threads=1)  # B puts the blank in front itself, but to nothing
    ids_b = [y or [enc_b.piece_to_id(MARK)] for y in ids_b]
    n_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
    b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
    end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    whole = b"".join(raw)
    if not (whole == b"".join(map(a_bytes.__getitem__, a.tolist())) == b"".join(map(b_bytes.__getitem__, b.tolist()))
            and all(len(c) and np.array_equal(e[np.cumsum(c) - 1], ends) for e, c in ((end_a, n_a), (end_b, n_b)))) and len(units):
        ok = _true_units(units, a, n_a, ids_b, a_bytes, b_bytes)
        part = align_units([u for u, o in zip(units, ok.tolist()) if o], pair, name)
        at = np.cumsum(ok) - 1
        n = np.zeros((4, len(units)), np.int64)
        n[:, ok] = part.n
        return Units([part.text[i] if o else "" for i, o in zip(at.tolist(), ok.tolist())], n, ok, part.pairs, part.of, np.append(0, np.cumsum(n[3])))
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    # links: the A tokens from the one that covers a B token's first byte to that of its last one
    first = np.searchsorted(end_a, end_b - b_size[b], "right")
    links = np.searchsorted(end_a, end_b, "left") - first + 1
    at = np.repeat(first - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))
    keys = (np.repeat(b, links).astype(np.uint64) << np.uint64(32)) | a[at].astype(np.uint64)
    b_cuts = np.append(0, np.cumsum(n_b))
    cuts = np.append(0, np.cumsum(links))[b_cuts]
    # digest text: the tokens by (group, side), each with the sign after it
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
    parts = np.empty(len(a) + len(b), object)
    parts[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = shown[a, last_a.astype(np.int64)]
    parts[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = shown[b, last_b * 2]
    parts = parts.tolist()
    token_cuts = np.append(0, np.cumsum(n_a + n_b)).tolist()
    text = ["".join(parts[x:y]) for x, y in zip(token_cuts, token_cuts[1:])]
    n_groups = np.diff(np.append(0, np.cumsum(last_b))[b_cuts])
    pairs, of = np.unique(keys, return_inverse=True)
    return Units(text, np.stack([n_a, n_b, n_groups, np.diff(cuts)]), np.ones(len(units), bool), pairs, of, cuts)


def known_units(flat: list[str], pair: Pair, name: str) -> tuple[Units, np.ndarray]:
    """Alignments that hold all units of ``flat``, and each unit's place among them.  A worker
    keeps them for later blocks, up to ``KEPT_CHARS`` characters; results do not depend on it."""
    kept = _load(pair, name)[7]
    distinct = dict.fromkeys(flat)
    if kept["chars"] > KEPT_CHARS:
        kept.update(ids={}, chars=0, units=None)
    ids = kept["ids"]
    new = [u for u in distinct if u not in ids]
    more = align_units(new, pair, name)
    kept["units"] = more if kept["units"] is None else kept["units"] + more
    ids.update(zip(new, range(len(ids), len(ids) + len(new))))
    kept["chars"] += sum(map(len, new))
    return kept["units"], np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))


def radix_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (tk.mix(keys >> np.uint64(32)) >> np.uint64(64 - bits)).astype(np.int64)


def _block_rows(t: pa.Table, key: str, text: str, pair: Pair, name: str, bits: int) -> pa.Table:
    """The rows of a block: one a document (radix -1), one a radix with its run."""
    texts = t.column(text).to_pylist()
    per_doc = [UNIT.findall(" " + x) if x else [] for x in texts]
    n_units = np.fromiter(map(len, per_doc), np.int64, len(per_doc))
    al, flat = known_units(list(chain.from_iterable(per_doc)), pair, name)
    unit_cuts = np.append(0, np.cumsum(n_units))
    places = flat.tolist()
    doc_of = np.repeat(np.arange(len(texts)), n_units)
    good = np.bincount(doc_of[~al.ok[flat]], minlength=len(texts)) == 0
    sums = {col: np.diff(np.append(0, np.cumsum(x[flat]))[unit_cuts]) * good for col, x in zip(("n_a", "n_b", "n_groups", "n_links"), al.n)}
    digests = []
    for s, e, o in zip(unit_cuts.tolist(), unit_cuts[1:].tolist(), good.tolist()):
        digest = hashlib.sha256()
        for i in range(s, e - 10_000, 10_000):  # a long text's groups are not held as one string
            digest.update("".join([al.text[u] for u in places[i: i + 10_000]]).encode())
            s = i + 10_000
        digest.update("".join([al.text[u] for u in places[s:e]])[:-1].encode())
        digests.append(digest.hexdigest() if o and e > s else "")
    # pair-document records: links of a document's units, by pair in (radix, B, A) order
    use = good[doc_of]
    flat, doc_of = flat[use], doc_of[use]
    lens = al.n[3][flat]
    at = np.repeat(al.cuts[flat] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
    pair_of = al.of[at]
    in_links = np.bincount(pair_of, minlength=len(al.pairs))
    used = np.flatnonzero(in_links)
    radix = radix_of(al.pairs[used], bits)
    order = np.argsort(radix, kind="stable")
    used, radix = used[order], radix[order]
    pairs, in_links = al.pairs[used], in_links[used]
    rank = np.zeros(len(al.pairs), np.int64)
    rank[used] = np.arange(len(used))
    records, links = np.unique(rank[pair_of] * len(texts) + np.repeat(doc_of, lens), return_counts=True)
    of_pair, of_doc = records // max(1, len(texts)), records % max(1, len(texts))
    in_docs = np.bincount(of_pair, minlength=len(pairs))
    block = uuid.uuid4().hex
    runs = []
    p_cuts = np.searchsorted(radix, np.arange((1 << bits) + 1))
    r_cuts = np.searchsorted(of_pair, p_cuts)
    for r in np.flatnonzero(np.diff(p_cuts)).tolist():
        p, q = slice(p_cuts[r], p_cuts[r + 1]), slice(r_cuts[r], r_cuts[r + 1])
        runs.append((r, tk.pack_sorted(pairs[p]), pack_counts(in_links[p]), pack_counts(in_docs[p]), pack_counts(of_doc[q]), pack_counts(links[q])))
    n, m = len(texts), len(runs)
    cols = {"block": pa.array([block] * (n + m)), "radix": pa.array([-1] * n + [r[0] for r in runs], pa.int32()),
            "place": pa.array([*range(n), *[None] * m], pa.int32()),
            key: pa.concat_arrays([*pa.chunked_array(t.column(key)).chunks, pa.nulls(m, t.schema.field(key).type)])}
    for col, x in sums.items():
        cols[col] = pa.array([*x.tolist(), *[None] * m], pa.int64())
    cols["groups_sha256"] = pa.array(digests + [None] * m, pa.string())
    for i, col in enumerate(("pairs", "in_links", "in_docs", "docs", "links"), 1):
        cols[col] = pa.array([None] * n + [r[i] for r in runs], pa.binary())
    return pa.table(cols)


def _entries(pairs: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
    return zip(tk.unpack_sorted(pairs).tolist(), unpack_counts(counts).tolist())


def heap_merge(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, links) of packed sorted runs, equal pairs added up, by a k-way heap merge."""
    pairs, links = [], []
    last = -1
    for key, n in heapq.merge(*(_entries(*r) for r in runs)):
        if key == last:
            links[-1] += n
        else:
            pairs.append(key)
            links.append(n)
            last = key
    return np.array(pairs, np.uint64), np.array(links, np.int64)


def _merge(t: pa.Table) -> pa.Table:
    pairs, links = heap_merge(list(zip(t.column("pairs").to_pylist(), t.column("in_links").to_pylist())))
    return pa.table({"radix": t.column("radix")[:1].cast(pa.int32()), "part": t.column("part")[:1].cast(pa.int32()),
                     "pairs": pa.array([tk.pack_sorted(pairs)], pa.binary()), "in_links": pa.array([pack_counts(links)], pa.binary())})


def _rank(t: pa.Table) -> pa.Table:
    """The radix' pairs with their counts and whether a count is the highest of its B id."""
    pairs, links = heap_merge(list(zip(t.column("pairs").to_pylist(), t.column("in_links").to_pylist())))
    side = pairs >> np.uint64(32)
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    most = np.repeat(np.maximum.reduceat(links, first), np.diff(np.append(first, len(side))))
    return pa.table({"radix": t.column("radix")[:1].cast(pa.int32()), "pairs": pa.array([tk.pack_sorted(pairs)], pa.binary()),
                     "counts": pa.array([pack_counts(links)], pa.binary()),
                     "best": pa.array([pack_counts((links == most).astype(np.int64))], pa.binary())})


def _give_back(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """What each run's records add to its documents, as packed (place, best links, count sum)."""
    out = {"block": [], "docs": [], "n_best": [], "count_sum": []}
    if runs.num_rows:
        known = tk.unpack_sorted(counts.column("pairs")[0].as_py())
        total, best = (unpack_counts(counts.column(c)[0].as_py()) for c in ("counts", "best"))
        for row in runs.to_pylist():
            at = np.searchsorted(known, tk.unpack_sorted(row["pairs"]))
            at = np.repeat(at, unpack_counts(row["in_docs"]))
            links = unpack_counts(row["links"])
            docs, place = np.unique(unpack_counts(row["docs"]), return_inverse=True)
            sums = np.zeros((2, len(docs)), np.int64)
            np.add.at(sums[0], place, links * best[at])
            np.add.at(sums[1], place, links * total[at])
            for col, x in zip(out, (row["block"], pack_counts(docs), pack_counts(sums[0]), pack_counts(sums[1]))):
                out[col].append(x)
    return pa.table(out, pa.schema([("block", pa.string()), ("docs", pa.binary()), ("n_best", pa.binary()), ("count_sum", pa.binary())]))


def align_tokenizers(docs: DataFrame, pair: Pair, key: str = "doc_id", text: str = "text", block: int = BLOCK,
                     radix_bits: int = RADIX_BITS, fan_in: int = FAN_IN) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row a document.

    ``n_best`` links have the highest corpus-wide count of their B id, ``count_sum`` adds the
    counts of all links.  See the module for the defined cases."""
    name, key_type = pair.name(), sql_type(docs, key)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spilled = written(per_block(source, "text", lambda t: _block_rows(t, "key", "text", pair, name, radix_bits),
                                f"block string, radix int, place int, key {key_type}, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, pairs binary, in_links binary, in_docs binary, docs binary, links binary", limit=block),
                      "alignment-runs")
    parts = max(1, -(-spilled.select("block").distinct().count() // fan_in))
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    runs = spilled.filter("radix >= 0").withColumn("part", part)
    heads, left = runs.select("radix", "part", "pairs", "in_links"), parts
    while left > 1:
        heads = heads.groupBy("radix", "part").applyInArrow(tidied(_merge), "radix int, part int, pairs binary, in_links binary")
        left = -(-left // fan_in)
        heads = heads.withColumn("part", F.col("part") % left)
    counts = written(heads.groupBy("radix").applyInArrow(tidied(_rank), "radix int, pairs binary, counts binary, best binary"), "alignment-counts")
    copies = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    back = (runs.select("radix", "part", "block", "pairs", "in_docs", "docs", "links").groupBy("radix", "part")
            .cogroup(copies.groupBy("radix", "part"))
            .applyInArrow(tidied(_give_back), "block string, docs binary, n_best binary, count_sum binary"))
    own = spilled.filter("radix = -1").select("block", "place", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def gather(mine: pa.Table, adds: pa.Table) -> pa.Table:
        place = mine.column("place").to_numpy()
        sums = np.zeros((2, int(place.max()) + 1 if len(place) else 0), np.int64)
        for row in adds.to_pylist():
            at = unpack_counts(row["docs"])
            sums[0][at] += unpack_counts(row["n_best"])
            sums[1][at] += unpack_counts(row["count_sum"])
        return pa.table({"key": mine.column("key"), **{c: mine.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": pa.array(sums[0][place], pa.int64()), "count_sum": pa.array(sums[1][place], pa.int64()),
                         "groups_sha256": mine.column("groups_sha256")})

    out = own.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        tidied(gather), f"key {key_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("key", key)
