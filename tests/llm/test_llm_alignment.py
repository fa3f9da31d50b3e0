import collections
import hashlib
import re

import pytest
from tokenizers import Tokenizer
import sentencepiece

from tokenledger.llm import alignment as al
from tokenledger.llm.queries import BYTE_MODEL, SENTENCE_MODEL, op11_tokenizer_alignment

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    return al.load_tokenizers(BYTE_MODEL, SENTENCE_MODEL)


def brute(rows):
    """Whole texts through both public libraries, links by comparing ranges, counts in a dict."""
    a = Tokenizer.from_file(BYTE_MODEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=SENTENCE_MODEL)
    of = al.byte_of_char()
    counts, docs = collections.Counter(), []
    for key, text in rows:
        ids_a = ids_b = []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
        spell_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        spell_b = [bytes([int(p[1:-1], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) and b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or not (b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode()):
            docs.append((key, 0, 0, [], []))
            continue
        ranges = []
        for spell in (spell_a, spell_b):
            ends, at = [], 0
            for s in spell:
                ends.append((at, at + len(s)))
                at += len(s)
            ranges.append(ends)
        links = [(i, j) for i, x in enumerate(ranges[0]) for j, y in enumerate(ranges[1]) if x[0] < y[1] and y[0] < x[1]] \
            if len(text) < 3000 else [(i, j) for j, y in enumerate(ranges[1]) for i, x in
                                      enumerate(ranges[0][:], 0) if x[0] < y[1] and y[0] < x[1]]
        groups, ga, gb = [], [], []
        stops = {e for _, e in ranges[0]} & {e for _, e in ranges[1]}
        ia = ib = 0
        for stop in sorted(stops):
            ga, gb = [], []
            while ia < len(ids_a) and ranges[0][ia][1] <= stop:
                ga.append(ids_a[ia])
                ia += 1
            while ib < len(ids_b) and ranges[1][ib][1] <= stop:
                gb.append(ids_b[ib])
                ib += 1
            groups.append((ga, gb))
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        counts.update(pairs)
        docs.append((key, len(ids_a), len(ids_b), groups, pairs))
    top = collections.Counter()
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for key, n_a, n_b, groups, pairs in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, n_a, n_b, len(groups), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "tab\t x\n\n y \n"), (6, "with ▁ mark"), (7, "<|endoftext|> <s></s> <0x41> <unk>"),
       (8, "naïve café 漢字 🙂🙂 é     x\u0000y"), (9, "don't we'll I'M 123,456.789 ###$$$"), (9, "don't we'll I'M 123,456.789 ###$$$"),
       (None, "a null key"), (11, "▁"), (12, "\n"), (13, "x" * 700), (14, "x  "), (15, "\x1c a\x85 b"), (16, "the the the the")]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=repr)


def test_alignment_of_odd_texts(spark, pair):
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    want = sorted(brute(ODD), key=repr)
    assert rows_of(al.align_tokenizers(df, pair)) == want
    # many small blocks, several levels of the merge tree
    assert rows_of(al.align_tokenizers(df, pair, block=10, fan_in=2, radix_bits=2)) == want


def test_alignment_of_the_corpus(spark, corpus, pair):
    docs = corpus.select("doc_id", "text").limit(60).collect()
    small = [tuple(r) for r in docs if len(r[1] or "") < 1500]
    df = spark.createDataFrame(small, "doc_id long, text string")
    assert rows_of(al.align_tokenizers(df, pair, block=20_000, fan_in=4)) == sorted(brute(small), key=repr)


def test_clashing_names_and_empty_table(spark, pair):
    df = spark.createDataFrame([("k", "some text", 1, 2, 3)], "doc_id string, text string, block int, key int, radix int")
    got = rows_of(al.align_tokenizers(df, pair))
    assert got == brute([("k", "some text")])
    assert al.align_tokenizers(df.limit(0), pair).collect() == []


def test_very_long_text(spark, pair):
    text = "word and " * 200_000
    got = al.align_tokenizers(spark.createDataFrame([(1, text)], "doc_id long, text string"), pair).first()
    assert got["n_a"] == len(Tokenizer.from_file(BYTE_MODEL).encode(" " + text).ids)
    assert got["count_sum"] >= got["n_links"] >= got["n_a"]


def test_heap_merge_adds_equal_pairs():
    import numpy as np

    from tokenledger.llm import tokens as tk
    from tokenledger.llm.chunks import pack_counts
    runs = [(tk.pack_sorted(np.array(k, np.uint64)), pack_counts(np.array(n))) for k, n in (([1, 5, 9], [1, 2, 3]), ([5], [10]), ([], []), ([1, 9], [4, 300]))]
    pairs, links = al.heap_merge(runs)
    assert pairs.tolist() == [1, 5, 9] and links.tolist() == [5, 12, 303]


def test_registered_query(spark):
    got = op11_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
