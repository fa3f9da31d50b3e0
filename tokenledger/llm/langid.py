"""Language ID by word-first backoff.

Known words score with their per-language log frequency; an unseen word falls back, position
by position, to the longest known character n-gram there (``MAX_GRAM`` down to single
characters) with that n-gram's per-language log frequency.

The model is fitted on a bounded sample of labelled rows (``docs_per_language``, chosen by a
hash of the row key) and keeps the ``max_words`` / ``max_grams`` most frequent entries, so its
size is bounded by these parameters.  Every label is learned; a table with more than
``max_languages`` of them is refused with an error, none is left out in silence.  Prediction
covers every row and every whole text.

Words are runs of ASCII letters and non-ASCII characters (lower-cased), without the common
non-ASCII marks and blanks.  Defined cases: null text or text without any letter gives
``und`` with score 0; rows with a null label are not learned from; with no labelled row at
all every text is ``und``; equal scores go to the alphabetically first language; repeated
rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.shared import per_block, sql_type, written

MAX_GRAM = 4
UND = "und"

GAP = np.ones(256, bool)
GAP[97:123] = GAP[65:91] = False
GAP[0x80:] = False

LETTERS = np.array([c for c in (*range(0x2000, 0x2080), *range(0x3000, 0x3040)) if chr(c).isalpha()])


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts; non-ASCII marks (U+0080-00BF but the letters there,
    U+2000-207F, U+3000-303F, letters excepted) become blanks."""
    import pyarrow.compute as pc

    buf, offs = tk.text_block(pc.utf8_lower(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts))
    buf = buf.copy()
    lead = np.flatnonzero((buf == 0xC2) | (buf == 0xE2) | (buf == 0xE3))
    if len(lead):
        n = len(buf)
        two = lead[(buf[lead] == 0xC2) & (lead + 1 < n)]
        two = two[~np.isin(buf[two + 1], (0xAA, 0xB5, 0xBA))]
        three = lead[(buf[lead] != 0xC2) & (lead + 2 < n)]
        b = buf[three + 1]
        three = three[((buf[three] == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((buf[three] == 0xE3) & (b == 0x80))]
        code = (buf[three].astype(np.int64) & 15) << 12 | (buf[three + 1].astype(np.int64) & 63) << 6 | buf[three + 2] & 63
        for at, k in ((two, 2), (three[~np.isin(code, LETTERS)], 3)):
            for j in range(k):
                buf[at + j] = 32
    return buf, offs


def distinct_words(buf, starts, ends):
    """Hash of each word, the distinct hashes, the word's place among them, one example of each."""
    table = np.where(GAP, tk.U64(0), tk.BYTE_ALL)
    h = tk.span_hash(buf, starts, ends, table)
    u, first, inv = np.unique(h, return_index=True, return_inverse=True)
    return h, u, inv, first


def padded_chars(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each between two blanks, on one line; and their offsets."""
    size = ends - starts + 2
    offs = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(offs[-1]), 32, np.uint8)
    place = np.arange(int((ends - starts).sum()))
    who = np.repeat(np.arange(len(starts)), ends - starts)
    before = np.concatenate([[0], np.cumsum(ends - starts)])[:-1]
    local = place - before[who]
    out[offs[:-1][who] + 1 + local] = buf[starts[who] + local]
    # code points: drop continuation bytes, keep a hash-like value of each character
    lead = (out & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    code = np.add.reduceat(tk.BYTE_ALL[out] * tk.powers(tk.BASE, 8)[np.minimum(np.arange(len(out)) - at[np.cumsum(lead) - 1], 7)], at)
    return code, np.searchsorted(at, offs)


def grams_of(code: np.ndarray, cuts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n characters that start at each place and whether they stay in one word."""
    m = len(code)
    g = np.zeros(m, tk.U64)
    if m >= n:
        g[: m - n + 1] = tk.ngrams(code, n)
    return tk.mix(g + tk.U64(n)), tk.whole_windows(cuts, n)


@dataclass
class LanguageModel:
    languages: list[str]
    words: np.ndarray          # ascending hashes
    word_scores: np.ndarray    # words x languages, log frequency
    grams: list[np.ndarray]    # for n = 1..MAX_GRAM, ascending hashes
    gram_scores: list[np.ndarray]
    floor: np.ndarray          # score of a character that was never seen


def _sample(docs: DataFrame, text: str, lang: str, key: str, per_language: int, max_languages: int) -> DataFrame:
    """About ``per_language`` labelled rows of each language, by a hash of their key: a fixed
    rate for each language, so nothing is sorted, joined or gathered."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = labelled.groupBy(F.col(lang).alias("l")).count().orderBy("l").limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than max_languages = {max_languages} labels")
    if not sizes:
        return labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_t")).limit(0)
    rates = F.create_map(*[F.lit(x) for r in sizes for x in (r["l"], min(1.0, per_language / r["count"]))])
    u = F.pmod(F.xxhash64(F.col(key), F.length(text)), F.lit(1_000_000)) / 1_000_000
    return (labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_t"), u.alias("_u"))
            .filter(F.col("_u") < F.element_at(rates, F.col("_lang"))).select("_lang", "_t"))


def fit_language_model(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                       docs_per_language: int = 3000, max_words: int = 60_000, max_grams: int = 60_000,
                       max_languages: int = 1024) -> LanguageModel:
    """Counts of words and character n-grams by language over the bounded sample; the driver
    receives the kept entries only (at most ``max_words + MAX_GRAM * max_grams``)."""
    def counts(t: pa.Table) -> pa.Table:
        names = t.column("_lang").to_pylist()
        code = {x: i for i, x in enumerate(sorted(set(names)))}
        buf, offs = lowered(t.column("_t"))
        starts, ends, first = tk.word_spans(buf, offs, GAP)
        if not len(starts):
            return None
        h, u, inv, example = distinct_words(buf, starts, ends)
        who = np.array([code[x] for x in names])[tk.owner(first)]
        parts = []
        chars, cuts = padded_chars(buf, starts[example], ends[example])
        for i, x in enumerate(sorted(code)):
            n = np.bincount(inv[who == i], minlength=len(u))
            parts.append((x, 0, u[n > 0], n[n > 0]))
            weight = np.repeat(n, np.diff(cuts))
            for k in range(1, MAX_GRAM + 1):
                g, ok = grams_of(chars, cuts, k)
                ok &= weight > 0
                gu, gi = np.unique(g[ok], return_inverse=True)
                parts.append((x, k, gu, np.bincount(gi, weights=weight[ok], minlength=len(gu)).astype(np.int64)))
        return pa.table({
            "lang": pa.array(np.repeat([p[0] for p in parts], [len(p[2]) for p in parts]), pa.string()),
            "n": np.repeat([p[1] for p in parts], [len(p[2]) for p in parts]),
            "h": np.concatenate([p[2] for p in parts]).view(np.int64),
            "c": np.concatenate([p[3] for p in parts]).astype(np.int64),
        })

    rows = per_block(_sample(docs, text, lang, key, docs_per_language, max_languages), "_t", counts, "lang string, n long, h long, c long")
    total = rows.groupBy("n", "h", "lang").agg(F.sum("c").alias("c"))
    kept = written(total.groupBy("n", "h").agg(F.sum("c").alias("all"), F.collect_list(F.struct("lang", "c")).alias("by"))
                   .filter("all >= 2"), "langid-counts")
    found = [kept.filter(F.col("n") == k).orderBy(F.desc("all"), "h").limit(max_words if k == 0 else max_grams).collect()
             for k in range(MAX_GRAM + 1)]
    languages = sorted({b["lang"] for rs in found for r in rs for b in r["by"]})
    place = {x: i for i, x in enumerate(languages)}

    def scored(rs) -> tuple[np.ndarray, np.ndarray]:
        h = np.array([r["h"] for r in rs], np.int64).view(tk.U64)
        c = np.zeros((len(rs), len(languages)))
        for i, r in enumerate(rs):
            for b in r["by"]:
                c[i, place[b["lang"]]] = b["c"]
        order = np.argsort(h)
        h, c = h[order], c[order]
        size = c.sum(axis=0)
        return h, np.log((c + 0.5) / (size + 0.5 * (len(rs) + 1)))

    all_scored = [scored(rs) for rs in found]
    return LanguageModel(languages, *all_scored[0], [a[0] for a in all_scored[1:]], [a[1] for a in all_scored[1:]],
                         np.full(len(languages), -12.0))


def _find(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return at, table[at] == h


def word_scores(m: LanguageModel, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Score of each distinct word in each language (words x languages)."""
    out = np.zeros((len(u), len(m.languages)))
    at, known = _find(m.words, u)
    out[known] = m.word_scores[at[known]]
    new = np.flatnonzero(~known)
    if len(new):
        code, cuts = padded_chars(buf, starts[new], ends[new])
        left = np.ones(len(code), bool)
        score = np.zeros((len(code), len(m.languages)))
        for k in range(MAX_GRAM, 0, -1):
            g, ok = grams_of(code, cuts, k)
            ask = np.flatnonzero(left & ok)
            at, hit = _find(m.grams[k - 1], g[ask])
            score[ask[hit]] = m.gram_scores[k - 1][at[hit]]
            left[ask[hit]] = False
        score[left] = m.floor
        total = np.add.reduceat(score, cuts[:-1], axis=0)
        out[new] = total / np.diff(cuts)[:, None]  # one word weighs as one observation
    return out


def predict_block(m: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(language index or -1, posterior) of each text."""
    n = len(texts)
    buf, offs = lowered(texts)
    starts, ends, first = tk.word_spans(buf, offs, GAP)
    best, score = np.full(n, -1), np.zeros(n)
    if not len(starts) or not m.languages:
        return best, score
    ascii_letter = tk.segment_sums(~GAP[buf] & (buf < 0x80), offs) > 0
    for i in np.flatnonzero(~ascii_letter & (np.diff(first) > 0)):
        ascii_letter[i] = any(map(str.isalpha, texts[int(i)].as_py() or ""))
    _, u, inv, example = distinct_words(buf, starts, ends)
    per_word = word_scores(m, buf, starts[example], ends[example], u)
    used = np.flatnonzero(ascii_letter & (np.diff(first) > 0))
    total = np.stack([tk.segment_sums(per_word[:, j][inv], first) for j in range(len(m.languages))], axis=1)[used]
    best[used] = total.argmax(axis=1)
    total -= total.max(axis=1, keepdims=True)
    score[used] = 1 / np.exp(total).sum(axis=1)
    return best, score


def identify_language(docs: DataFrame, model: LanguageModel, text: str = "text",
                      lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the predicted language and its posterior (0..1).  An input
    column with one of the output names is replaced."""
    keep = [c for c in docs.columns if c not in (lang_out, score_out)]
    names = np.array([*model.languages, UND], object)

    def run(t: pa.Table) -> pa.Table:
        best, score = predict_block(model, t.column(text).combine_chunks())
        out = t.append_column(lang_out, pa.array(names[best], pa.string()))
        return out.append_column(score_out, pa.array(score))

    schema = ", ".join([*(f"`{c}` {sql_type(docs, c)}" for c in keep), f"`{lang_out}` string", f"`{score_out}` double"])
    return per_block(docs.select(*[F.col(f"`{c}`") for c in keep]), text, run, schema)
