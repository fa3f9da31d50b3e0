"""Byte-level tokens and rolling hashes over Arrow string columns, in numpy.

A *block* of texts is one ``uint8`` buffer plus document offsets (a zero-copy view of an
Arrow string array).  Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8
keeps those bytes for ASCII alone, so byte runs equal the code-point runs.
Hashes are 64-bit polynomials (mod 2**64, odd random base) behind a splitmix64 finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Texts of a block are processed together up to this many bytes (a longer text alone).
BLOCK_BYTES = 1_000_000
#: Bytes hashed at a time; the tables of powers stay this small.
HASH_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Random value of each byte; the separators count as zero inside word hashes.
BYTE_ALL = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BYTE_WORD = np.where(SPACE, U64(0), BYTE_ALL)
BYTE_LOWER = BYTE_WORD.copy()
BYTE_LOWER[65:91] = BYTE_WORD[97:123]
BASE = int(_rng.integers(1, 2**62)) * 2 + 1
GRAM_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_pow: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection on 64-bit values); makes a new array."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept for later calls."""
    have = _pow.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), U64(base % 2**64))
        p[0] = U64(1)
        have = np.multiply.accumulate(p)
        if n <= 2 * HASH_BYTES:  # longer ones (a very long word or line) are not kept
            _pow[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def text_block(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    offs = np.frombuffer(arr.buffers()[1], kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def blocks(table: pa.Table | pa.RecordBatch, col: str, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Consecutive slices of whole rows of about ``limit`` text bytes; none is left out."""
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    if not table.num_rows:
        return
    size = pc.fill_null(pc.binary_length(table.column(col)), 0).to_numpy().astype(np.int64)
    group = np.cumsum(size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield table.slice(a, b - a)


def word_spans(buf: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word and, for each text, the index of its first word (+ total)."""
    n = len(buf)
    solid = ~gap[buf]
    edge = offs[:-1][offs[:-1] < n]
    first = solid.copy()
    if n:
        first[1:] &= ~solid[:-1]
        first[edge] = solid[edge]
    starts = np.flatnonzero(first)
    last = solid
    if n:
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        tail = offs[1:][offs[1:] > 0] - 1
        last[tail] = solid[tail]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTE_WORD) -> np.ndarray:
    """64-bit hash of each (start, end) run.  Runs are disjoint and in order; bytes between
    runs must have value zero in ``table`` or runs must touch."""
    out = np.empty(len(starts), U64)
    inv = inverse(BASE)
    a = 0
    while a < len(starts):
        lo = int(starts[a])
        b = max(a + 1, int(np.searchsorted(starts, lo + HASH_BYTES)))
        hi = int(ends[b - 1])
        x = table[buf[lo:hi]]
        x *= powers(BASE, hi - lo)
        h = np.add.reduceat(x, starts[a:b] - lo)
        h *= powers(inv, hi - lo)[starts[a:b] - lo]
        h += (ends[a:b] - starts[a:b]).astype(U64) * U64(0x9E3779B97F4A7C15)
        out[a:b] = h
        a = b
    return mix(out)


def words_hashed(buf: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block and the index of each text's first word (+ total)."""
    starts, ends, first = word_spans(buf, offs)
    return span_hash(buf, starts, ends, BYTE_LOWER if lower else BYTE_WORD), first


def double(g: np.ndarray, have: int, step: int) -> np.ndarray:
    """Raw hashes of windows of ``have + step`` words from those of ``have`` words
    (``step <= have`` overlaps the two halves; the last ``step`` words are added once more)."""
    if len(g) <= step:
        return np.zeros(0, U64)
    return g[:-step] + g[step:] * U64(pow(GRAM_BASE, have + step, 2**64))


def ngrams(w: np.ndarray, n: int) -> np.ndarray:
    """Raw polynomial hash of each run of n consecutive words (unfinished; see ``mix``)."""
    m = len(w) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    g = w[:m].copy()
    for j in range(1, n):
        g += w[j: j + m] * U64(pow(GRAM_BASE, j, 2**64))
    return g


def owner(first: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, n: int) -> np.ndarray:
    """Mask over the words: a window of n words starting here stays inside its text."""
    total = int(first[-1])
    ok = np.ones(total, bool)
    for k in range(1, n):
        at = first[1:] - k
        at = at[at >= first[:-1]]
        ok[at] = False
    return ok


def segment_sums(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of x over [cuts[i], cuts[i+1])."""
    c = np.zeros(len(x) + 1, np.int64 if x.dtype.kind in "bui" else np.float64)
    np.cumsum(x, out=c[1:])
    return c[cuts[1:]] - c[cuts[:-1]]


# ---- packed blocks -----------------------------------------------------------------------

def pack(arr: np.ndarray) -> bytes:
    """An array as bytes: planes of equal significance together, zstd."""
    raw = np.ascontiguousarray(arr)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    return len(raw).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(blob: bytes, dtype) -> np.ndarray:
    n, item = int.from_bytes(blob[:4], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = pa.decompress(blob[4:], decompressed_size=n * item, codec="zstd", asbytes=True)
    return np.frombuffer(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(item, n).T), dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys as differences."""
    return pack(np.diff(keys, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, U64), dtype=U64)
