"""Quality rules by distribution divergence.

A document's character-class histogram and its common-word histogram are compared with the
reference of its language by Jensen-Shannon distance (base 2, 0..1).  A reference is the mean
relative histogram over ALL documents of a language that pass the base rules with at most 2 %
symbols (plus one over all languages, for documents without a usable one): each document weighs the same, so one
long text cannot bend it, and it grows with nothing but the number of languages.

Defined cases: null text counts as empty (no words, ``base_failed``); a null or unlisted
language uses the overall reference; a histogram without mass has distance 0 (the base rules
decide alone); documents shorter than the length guards are judged by the base rules only;
repeated rows give repeated results; an empty table gives an empty result.  Columns other
than the named id, text and language are not read, so clashing names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.shared import per_block, sql_type

# Function words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to in a is that for it as was with be by on not he his at but are from or had an "
    "they which this have you were their there been has when who will more if out so "
    "le la les de des du et en un une est que qui dans pour sur pas par au avec ce il sont plus se "
    "der die das den dem und in zu von mit ist nicht ein eine im für auf sich des es auch an als bei "
    "el los las y del que en un una es por con para su al lo como más pero sus no se"
)

_words = sorted(set(COMMON_WORDS.split()))
_joined = " ".join(_words).encode()
_hash, _ = tk.words_hashed(np.frombuffer(_joined, np.uint8), np.array([0, len(_joined)]), lower=True)
_order = np.argsort(_hash)
COMMON_SORTED = _hash[_order]
N_COMMON = len(_words)

#: Classes: lower, upper, digit, blank, line end, sentence mark, other ASCII, beyond ASCII; 8 = continuation byte.
N_CLASSES = 8
CLASS = np.full(256, 6, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 0, 1, 2
CLASS[[32, 9, 11, 12, 13]], CLASS[10] = 3, 4
CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 5
CLASS[0x80:0xC0], CLASS[0xC0:] = 8, 7
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def histograms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x classes, texts x common words + the rest) counts."""
    cls = CLASS[buf]
    chars = np.stack([tk.segment_sums(cls == k, offs) for k in range(N_CLASSES)], axis=1)
    h, first = tk.words_hashed(buf, offs, lower=True)
    at = np.searchsorted(COMMON_SORTED, h)
    at[at == N_COMMON] = 0
    at = np.where(COMMON_SORTED[at] == h, at, N_COMMON)
    n = len(offs) - 1
    words = np.bincount(tk.owner(first) * (N_COMMON + 1) + at, minlength=n * (N_COMMON + 1))
    return chars, words.reshape(n, N_COMMON + 1)


def base_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the plain rules, per text."""
    starts, ends, first = tk.word_spans(buf, offs)
    w = tk.span_hash(buf, starts, ends)
    solid = ~tk.SPACE[buf]
    out = {
        "n_words": np.diff(first),
        "word_chars": tk.segment_sums(solid & ((buf & 0xC0) != 0x80), offs),
        "n_symbols": tk.segment_sums(SYMBOL[buf], offs),
    }
    whole = np.flatnonzero(tk.whole_windows(first, 3)[: max(len(w) - 2, 0)])
    who = tk.owner(first)
    key = tk.mix(tk.ngrams(w, 3)[whole] + who[whole].astype(tk.U64) * tk.U64(0xD1342543DE82EF95))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(w) + 2, bool)
    for j in range(3):
        covered[whole[twice] + j] = True
    out["n_repeat_words"] = tk.segment_sums(covered[: len(w)], first)

    # lines: cut after each line end and at each text's start
    n = len(buf)
    begin = np.unique(np.concatenate([offs[:-1][offs[:-1] < n], np.flatnonzero(buf == 10) + 1]))
    begin = begin[begin < n]
    end = np.append(begin[1:], n)[: len(begin)]
    used = tk.segment_sums(solid, np.append(begin, n)) > 0 if len(begin) else np.zeros(0, bool)
    stop = end - ((buf[end - 1] == 10) if n else 0)
    text = np.searchsorted(offs, begin, side="right") - 1
    # the line end itself must not tell a last line from an equal inner one
    line = tk.span_hash(buf, begin, np.maximum(stop, begin), LINE_BYTES)[used]
    text = text[used]
    key = tk.mix(line + text.astype(tk.U64) * tk.U64(0xD1342543DE82EF95))
    _, at = np.unique(key, return_index=True)
    lines = np.bincount(text, minlength=len(offs) - 1)
    out["n_dup_lines"] = lines - np.bincount(text[at], minlength=len(offs) - 1)
    return out


LINE_BYTES = tk.BYTE_ALL.copy()
LINE_BYTES[10] = 0


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance of counts; 0 where either side has no mass."""
    ps, qs = p.sum(axis=1, keepdims=True), q.sum(axis=1, keepdims=True)
    ok = (ps[:, 0] > 0) & (qs[:, 0] > 0)
    p, q = p / np.maximum(ps, 1), q / np.maximum(qs, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.where(ok, np.sqrt(np.clip((a + b) / 2, 0, 1)), 0.0)


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang",
                        max_languages: int = 20_000) -> dict[str | None, np.ndarray]:
    """Summed relative histograms (in millionths) by language over all documents that pass the
    base rules; key None: all of them.  One row a language and block is shuffled; the driver
    gets one a language, in one pass.  Every language has its own; a table with more than
    ``max_languages`` of them is refused with an error."""
    def sums(t: pa.Table) -> pa.Table:
        buf, offs = tk.text_block(t.column("_t"))
        c = base_counts(buf, offs)
        good = ~base_failed(c) & (50 * c["n_symbols"] <= c["word_chars"])
        parts = [x[good] / np.maximum(x[good].sum(axis=1, keepdims=True), 1) for x in histograms(buf, offs)]
        both = np.rint(1e6 * np.hstack(parts)).astype(np.int64)
        code = t.column("_l").combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(code, pa.ChunkedArray):
            code = code.combine_chunks()
        at, names = code.indices.to_numpy(zero_copy_only=False)[good], code.dictionary.to_pylist()
        total = np.zeros((len(names), both.shape[1]), np.int64)
        np.add.at(total, at, both)
        return pa.table({"l": pa.array(names, pa.string()), "n": np.bincount(at, minlength=len(names)),
                         "h": pa.array(list(total), pa.list_(pa.int64()))})

    rows = per_block(docs.select(F.col(text).alias("_t"), F.col(lang).cast("string").alias("_l")), "_t", sums,
                     "l string, n long, h array<long>")
    sums_of = (rows.select("l", "n", F.posexplode("h").alias("i", "v"))
               .groupBy("l", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")))
    by_lang = (sums_of.groupBy("l").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "v"))).alias("h"))
               .select("l", "n", F.transform("h", lambda x: x["v"]).alias("h")))  # one short row a language
    out: dict[str | None, np.ndarray] = {None: np.zeros(N_CLASSES + N_COMMON + 1)}
    every = by_lang.orderBy("l").limit(max_languages + 2).collect()
    if sum(r["l"] is not None for r in every) > max_languages:
        raise ValueError(f"more than max_languages = {max_languages} languages")
    for r in every:
        own = np.array(r["h"], float)
        out[None] += own
        if r["l"] is not None:
            out[r["l"]] = own
    return out


def quality_rules(docs: DataFrame, references: dict[str | None, np.ndarray], key: str = "doc_id",
                  text: str = "text", lang: str = "lang", max_char_distance: float = 0.12,
                  max_word_distance: float = 0.08, min_chars: int = 200, min_words: int = 100) -> DataFrame:
    """Per document: the base counts, the two distances and the verdict ``kept``.

    The thresholds are widened by the sampling noise of short texts, each by its own number of
    observations: ``1 / sqrt(characters)`` and ``2.5 / sqrt(n_words)``."""
    names = [x for x in references if x is not None]
    refs = np.stack([references[x] for x in names] + [references[None]])

    def judge(t: pa.Table) -> pa.Table:
        buf, offs = tk.text_block(t.column("_t"))
        c = base_counts(buf, offs)
        chars, words = histograms(buf, offs)
        place = {x: i for i, x in enumerate(names)}
        ref = refs[[place.get(x, len(names)) for x in t.column("_l").to_pylist()]]
        dc = js_distance(chars.astype(float), ref[:, :N_CLASSES])
        dw = js_distance(words.astype(float), ref[:, N_CLASSES:])
        n = c["n_words"]
        base = base_failed(c)
        n_chars = chars.sum(axis=1)
        far = (n_chars >= min_chars) & (dc > max_char_distance + 1 / np.sqrt(np.maximum(n_chars, 1)))
        far |= (n >= min_words) & (dw > max_word_distance + 2.5 / np.sqrt(np.maximum(n, 1)))
        return pa.table({"k": t.column("_k"), **{x: c[x].astype(np.int64) for x in COUNTS}, "base_failed": base,
                         "char_distance": dc, "word_distance": dw, "kept": ~base & ~far})

    out = per_block(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).cast("string").alias("_l")),
                    "_t", judge, f"k {sql_type(docs, key)}, {', '.join(f'{x} long' for x in COUNTS)}, base_failed boolean, "
                    "char_distance double, word_distance double, kept boolean")
    return out.withColumnRenamed("k", key)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
