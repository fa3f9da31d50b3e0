import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenledger.llm import tokens as tk
from tokenledger.llm.chunks import by_bucket, pack_counts, unpack_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0caAbé漢 ,", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_the_code_point_runs(rows):
    buf, offs = tk.text_block(pa.array(rows, pa.string()))
    starts, ends, first = tk.word_spans(buf, offs)
    got = [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)]
    want = [WORD.findall(t or "") for t in rows]
    assert got == [w for ws in want for w in ws]
    assert np.diff(first).tolist() == [len(w) for w in want]
    h = tk.span_hash(buf, starts, ends)
    assert (h[:, None] == h[None, :]).tolist() == [[a == b for b in got] for a in got]


@settings(max_examples=40, deadline=None)
@given(texts, st.integers(1, 5))
def test_windows_stay_in_their_text(rows, n):
    w, first = tk.words_hashed(*tk.text_block(pa.array(rows, pa.string())))
    ok = tk.whole_windows(first, n)
    sizes = np.diff(first)
    assert ok.tolist() == [i + n <= s for s in sizes for i in range(s)]


def test_doubling_is_a_function_of_the_window():
    w = tk.mix(np.array([1, 2, 3, 4, 1, 2, 3, 4, 9], tk.U64))
    g = tk.double(tk.ngrams(w, 2), 2, 2)
    assert g[0] == g[4] and len(set(g.tolist())) == len(g) - 1


def test_packing_round_trips():
    r = np.random.default_rng(1)
    k = np.unique(r.integers(0, 2**63, 500).astype(tk.U64))
    assert (tk.unpack_sorted(tk.pack_sorted(k)) == k).all() and len(tk.unpack_sorted(tk.pack_sorted(k[:0]))) == 0
    for top in (3, 300, 70_000, 2**40):
        c = r.integers(0, top, 50)
        assert (unpack_counts(pack_counts(c)) == c).all()
    assert [x for b, lo, hi in by_bucket(k, 4) for x in k[lo:hi]] == k.tolist()


def test_blocks_hold_every_row_once():
    t = pa.table({"t": ["a" * n for n in (0, 10, 500, 3, 0, 70)] + [None]})
    parts = list(tk.blocks(t, "t", 50))
    assert pa.concat_tables(parts).equals(t) and len(parts) > 1
