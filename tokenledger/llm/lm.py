"""LM scoring by deleted interpolation (bigram, unigram, uniform).

    p(w | v) = l2[b] * c(v, w) / c(v) + l1[b] * c(w) / N + l0[b] / (V + 1),   b = bucket of c(v)

Counts cover all training texts.  The mixture weights of each context-frequency bucket are
learned by expectation-maximisation on one training fold whose own counts are taken away
from the estimates ("deleted").  For that the driver receives a histogram over
(bucket, quantised log2 of the two estimates), bounded by its grid and not by the corpus.

Texts are lower-cased (A-Z), split at ASCII white space, and closed by one end token; the
first word's context is a start mark seen once a training text.  Counts meet texts through
``chunks`` (distinct keys of a chunk to key buckets and back), without a row a token and
without any broadcast vocabulary.

Defined cases: null or empty text is its end token alone; a null key belongs to the fold of
the empty text; without training texts all counts are 0 and the model is uniform; repeated
rows are scored (and learned from) each time; an empty table gives an empty result.  Only key
and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.chunks import bucket_bits, by_bucket, chunk_count, chunk_of, pack_counts, text_bytes, unpack_counts
from tokenledger.llm.shared import fold, sql_type, tidied, tidy, written

END = tk.U64(0x51ED270B35A1F2C7)
START = tk.U64(0xB7C94E1D02F86A35)
N_BUCKETS = 24        # context counts 0, 1, 2-3, 4-7, ...
GRID = 4              # histogram cells per factor of two
LOWEST = 160          # cells below are one


def token_stream(texts) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes (words, then the end of each text) and the index of each text's first token."""
    buf, offs = tk.text_block(texts)
    w, first = tk.words_hashed(buf, offs, lower=True)
    n = len(first) - 1
    cuts = first + np.arange(n + 1)
    out = np.full(int(cuts[-1]), END, tk.U64)
    out[np.arange(len(w)) + tk.owner(first)] = w
    return out, cuts


def bigram_keys(w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    prev = np.empty_like(w)
    prev[1:] = w[:-1]
    prev[cuts[:-1]] = START
    return tk.mix(prev * tk.U64(tk.GRAM_BASE) + w)


def _asked(t: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Tokens, cuts, and (distinct keys, place of each token's key) for words and bigrams."""
    w, cuts = token_stream(t.column("t"))
    return w, cuts, [np.unique(k, return_inverse=True) for k in (w, bigram_keys(w, cuts))]


def count_features(docs: DataFrame, key: str, text: str, em_fold: int) -> DataFrame:
    """One row a chunk: keys, folds and token numbers of its texts, and per token the training
    counts of the word (c1) and bigram (c2) and, in the EM fold, that fold's own (h1, h2);
    ``v`` sums up to the number of distinct training tokens over all rows."""
    total = text_bytes(docs, text)
    n, bits = chunk_count(total), bucket_bits(total)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), fold(key, 10).cast("int").alias("f"),
                       chunk_of(n, key, text).alias("chunk"))

    def ask(t: pa.Table) -> pa.Table:
        w, cuts, keyed = _asked(t)
        f = t.column("f").to_numpy()[tk.owner(cuts)]
        out = {x: [] for x in ("bucket", "chunk", "kind", "keys", "c", "h")}
        for kind, (u, at) in enumerate(keyed):
            c = np.bincount(at[f != 0], minlength=len(u))
            h = np.bincount(at[f == em_fold], minlength=len(u))
            for b, lo, hi in by_bucket(u, bits):
                for x, v in zip(out, (b, t.column("chunk")[0].as_py(), kind, tk.pack_sorted(u[lo:hi]), pack_counts(c[lo:hi]), pack_counts(h[lo:hi]))):
                    out[x].append(v)
        return pa.table(out, pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()),
                                        ("keys", pa.binary()), ("c", pa.binary()), ("h", pa.binary())]))

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by([("kind", "ascending"), ("chunk", "ascending")])
        kinds = t.column("kind").to_numpy()
        c_out, h_out, v_out = [], [], []
        for kind in np.unique(kinds):
            part = t.filter(pa.array(kinds == kind))
            keys = [tk.unpack_sorted(x) for x in part.column("keys").to_pylist()]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
            u, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            sums = []
            for col in ("c", "h"):
                own = np.concatenate([unpack_counts(x) for x in part.column(col).to_pylist()])
                sums.append(np.bincount(at, weights=own, minlength=len(u)).astype(np.int64))
            owned = np.searchsorted(cuts, first, "right") - 1
            v = np.bincount(owned[sums[0] > 0], minlength=len(keys)) if kind == 0 else np.zeros(len(keys), np.int64)
            for i in range(len(keys)):
                own = at[cuts[i]: cuts[i + 1]]
                c_out.append(pack_counts(sums[0][own]))
                h_out.append(pack_counts(sums[1][own]))
                v_out.append(int(v[i]))
        return pa.table({"bucket": t.column("bucket"), "chunk": t.column("chunk"), "kind": t.column("kind"),
                         "c": pa.array(c_out, pa.binary()), "h": pa.array(h_out, pa.binary()), "v": pa.array(v_out, pa.int64())})

    def fill(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return schema.empty_table()
        w, cuts, keyed = _asked(t)
        answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds = answers.column("kind").to_numpy()
        f = t.column("f").to_numpy()
        em = (f == em_fold)[tk.owner(cuts)]
        got = {}
        for kind, (u, at) in enumerate(keyed):
            part = answers.filter(pa.array(kinds == kind))
            for x in "ch":
                sums = np.concatenate([unpack_counts(b) for b in part.column(x).to_pylist()])
                got[f"{x}{kind + 1}"] = sums[at] if x == "c" else sums[at][em]
        return pa.table({"ids": pa.array([t.column("k").to_pylist()], schema.field("ids").type),
                         "folds": pa.array([f.tolist()], pa.list_(pa.int32())),
                         "sizes": pa.array([np.diff(cuts).tolist()], pa.list_(pa.int64())),
                         **{x: pa.array([pack_counts(got[x])], pa.binary()) for x in ("c1", "c2", "h1", "h2")},
                         "v": pa.array([sum(answers.column("v").to_pylist())], pa.int64())}, schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"ids array<{sql_type(docs, key)}>, folds array<int>, sizes array<bigint>, c1 binary, c2 binary, h1 binary, h2 binary, v bigint"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    answers = (rows.groupBy("chunk").applyInArrow(tidied(ask), "bucket int, chunk int, kind int, keys binary, c binary, h binary")
               .groupBy("bucket").applyInArrow(tidied(merge), "bucket int, chunk int, kind int, c binary, h binary, v long"))
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(tidied(fill), ddl)


def _each(rows: pa.RecordBatch):
    """The arrays of each chunk row of a batch."""
    for r in rows.to_pylist():
        sizes = np.array(r["sizes"], np.int64)
        yield r, np.concatenate([[0], np.cumsum(sizes)]), np.array(r["folds"], np.int64), {x: unpack_counts(r[x]) for x in ("c1", "c2", "h1", "h2") if x in r}


def _context(c1: np.ndarray, cuts: np.ndarray, starts: int) -> np.ndarray:
    """Count of each token's context."""
    ctx = np.empty_like(c1)
    ctx[1:] = c1[:-1]
    ctx[cuts[:-1]] = starts
    return ctx


def context_bucket(ctx: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(ctx > 0, np.floor(np.log2(np.maximum(ctx, 1))).astype(np.int64) + 1, 0), N_BUCKETS - 1)


def _cell(p: np.ndarray) -> np.ndarray:
    """Quantised -log2 of an estimate; LOWEST for zero."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.minimum(np.rint(-np.log2(np.where(p > 0, p, 1)) * GRID), LOWEST - 1), LOWEST).astype(np.int64)


def learn_weights(hist: np.ndarray, p0: float, rounds: int = 40) -> np.ndarray:
    """EM for the weights (bigram, unigram, uniform) of each bucket.  ``hist`` rows:
    bucket, cell of the bigram estimate, cell of the unigram estimate, tokens."""
    weights = np.tile([0.5, 0.4, 0.1], (N_BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]  # an unseen context has no bigram estimate
    if not len(hist):
        return weights
    b, n = hist[:, 0], hist[:, 3].astype(float)
    p = np.stack([np.where(hist[:, k] == LOWEST, 0.0, 2.0 ** (-hist[:, k] / GRID)) for k in (1, 2)] + [np.full(len(hist), p0)], axis=1)
    p[b == 0, 0] = 0
    for _ in range(rounds):
        share = weights[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.stack([np.bincount(b, weights=share[:, k], minlength=N_BUCKETS) for k in range(3)], axis=1)
        seen = total.sum(axis=1) > 0
        weights[seen] = np.maximum(total[seen] / total[seen].sum(axis=1, keepdims=True), 1e-6 * np.array([1, 1, 1]))
        weights[0, 0] = 0
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", em_fold: int = 1) -> DataFrame:
    """Per text: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).
    Fold 0 of ten (crc32 of the key) is not learned from; ``em_fold`` learns the weights."""
    features = written(count_features(docs, key, text, em_fold), "lm-counts")
    pairs = features.select(F.explode(F.arrays_zip("folds", "sizes")).alias("x"))
    s = pairs.agg(F.sum(F.when(F.col("x.folds") != 0, F.col("x.sizes"))).alias("n"), F.count_if(F.col("x.folds") != 0).alias("d"),
                  F.sum(F.when(F.col("x.folds") == em_fold, F.col("x.sizes"))).alias("hn"), F.count_if(F.col("x.folds") == em_fold).alias("hd")).first()
    n, texts, held_n, held_texts = s["n"] or 0, s["d"], s["hn"] or 0, s["hd"]
    vocabulary = features.agg(F.sum("v")).first()[0] or 0
    p0 = 1.0 / (vocabulary + 1)

    def histogram(batches):
        for batch in batches:
            for _, cuts, folds, a in _each(batch):
                em = (folds == em_fold)[tk.owner(cuts)]
                if not em.any():
                    continue
                own = np.concatenate([[0], np.cumsum(np.diff(cuts)[folds == em_fold])])
                left = a["c1"][em] - a["h1"]
                ctx = _context(left, own, texts - held_texts)
                p2 = np.where(ctx > 0, (a["c2"][em] - a["h2"]) / np.maximum(ctx, 1), 0.0)
                p1 = left / max(1, n - held_n)
                side = LOWEST + 1
                cell, many = np.unique((context_bucket(ctx) * side + _cell(p2)) * side + _cell(p1), return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": cell, "n": many.astype(np.int64)})
            tidy()

    cells = (features.select("folds", "sizes", "c1", "c2", "h1", "h2").mapInArrow(histogram, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most N_BUCKETS * (LOWEST + 1)**2 cells
    side = LOWEST + 1
    hist = np.array([(c // (side * side), c // side % side, c % side, m) for c, m in cells], np.int64).reshape(-1, 4)
    weights = learn_weights(hist, p0)

    def score(batches):
        for batch in batches:
            for r, cuts, folds, a in _each(batch):
                c1 = a["c1"]
                ctx = _context(c1, cuts, texts)
                lam = weights[context_bucket(ctx)]
                p = lam[:, 0] * a["c2"] / np.maximum(ctx, 1) + lam[:, 1] * c1 / max(1, n) + lam[:, 2] * p0
                base = np.log10((c1 + 0.1) / (n + 0.1 * (vocabulary + 1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["ids"], batch.schema.field("ids").type.value_type), pa.array(folds == 0), pa.array(np.diff(cuts)),
                    pa.array(np.add.reduceat((c1 > 0).astype(np.int64), cuts[:-1])), pa.array(np.full(len(folds), n, np.int64)),
                    pa.array(np.add.reduceat(base, cuts[:-1])), pa.array(np.add.reduceat(np.log10(p), cuts[:-1]))],
                    ["k", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
            tidy()

    out = features.select("ids", "folds", "sizes", "c1", "c2").mapInArrow(
        score, f"k {sql_type(docs, key)}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("k", key)
