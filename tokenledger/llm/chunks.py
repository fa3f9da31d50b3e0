"""Chunks of texts and key buckets: how corpus counts meet whole texts without a row a word.

Texts are dealt out into chunks of a few MB (by a hash of the row).  Each chunk sends its
*distinct* 64-bit keys with counts, packed and split by the keys' leading bits, to key
buckets; each bucket merges what all chunks sent.  A key that fills a third of the corpus is
one entry a chunk, so no bucket is hot.  Chunk and bucket numbers follow the bytes of the
corpus, so memory a task stays the same at any size (one text is never split).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8_000_000
BUCKET_BYTES = 4_000_000


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def chunk_count(total: int, size: int = CHUNK_BYTES) -> int:
    return max(1, -(-total // size))


def chunk_of(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def bucket_bits(total: int, size: int = BUCKET_BYTES) -> int:
    return max(6, math.ceil(math.log2(max(1, total / size))))


def by_bucket(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending keys; empty buckets are left out."""
    cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.append(cuts, len(keys))
    return [(b, int(cuts[b]), int(cuts[b + 1])) for b in np.flatnonzero(np.diff(cuts)).tolist()]


def small_uint(a: np.ndarray) -> np.ndarray:
    """The counts in the narrowest unsigned type that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32 if top < 2**32 else np.uint64)


def pack_counts(a: np.ndarray) -> bytes:
    from tokenledger.llm.tokens import pack

    a = small_uint(a)
    return bytes([a.itemsize]) + pack(a)


def unpack_counts(blob: bytes) -> np.ndarray:
    from tokenledger.llm.tokens import unpack

    return unpack(blob[1:], f"u{blob[0]}").astype(np.int64)
