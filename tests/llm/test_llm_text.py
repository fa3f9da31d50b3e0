"""Chat formatting, HTML extraction, SentencePiece sampling, the corpus pipeline."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenledger.llm import chat, htmltext, sentences
from tokenledger.llm import tokens as tk
from tokenledger.llm.queries import PATTERN, RANKS, SENTENCE_MODEL


# -- chat

@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab\\\n<|>", max_size=6), st.text(alphabet="a<|\\>im_startend\n", max_size=20)), max_size=5))
def test_chat_template_is_reversible(turns):
    assert chat.read_turns("".join(chat.turn_text(r, x) for r, x in turns)) == turns


def chat_digest(turns):
    loss = "".join(x for r, x in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)


@pytest.mark.parametrize("budget, history", [(2048, 512), (60, 20), (1, 0)])
def test_chat_windows(spark, budget, history):
    data = [(1, 0, "system", "be kind"), *[(1, i, "user" if i % 2 else "assistant", f"word {i} <|im_end|> " * (i % 7)) for i in range(1, 300)],
            (2, 1, "assistant", None), (2, 0, None, "x"), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie"), (3, None, "user", ""),
            (None, 5, "assistant", "alone"), (4, 0, "user", "long " * 3000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df, chat.token_counter(RANKS, PATTERN), budget=budget, history=history)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(out).collect()}
    want = {}
    for c in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == c), key=lambda d: (-1 if d[1] is None else d[1], d[2] or "", d[3] or ""))
        want[c] = chat_digest([(d[2] or "", d[3] or "") for d in own])
    assert got == want
    for w in out.collect():
        assert w["n_tokens"] <= budget or w["n_turns"] == 1
        if w["conv_id"] == 1 and (w["segment"], w["window"]) != (0, 0):
            assert chat.read_turns(w["formatted"])[0] == ("system", "be kind") and w["n_context"] >= 1


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df, chat.token_counter(RANKS, PATTERN))
    assert out.count() == 0 and chat.read_back(out).count() == 0


# -- HTML

@pytest.fixture(scope="module")
def model():
    return htmltext.train_field(pages=500, rounds=80)


def test_field_on_held_out_pages(model):
    right = total = 0
    for page in htmltext.labelled_pages(150, 1234):
        y, feats, _ = htmltext.labels_and_clean(page)
        right += sum(a == b for a, b in zip(y, model.decode(feats)))
        total += len(y)
    assert right > 0.99 * total


def test_html_text_rules(model):
    page = ("<html><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><!-- <p>no</p> -->"
            "<div class=\"ad\">Buy &amp; save</div><article><h1>A &lt;title&gt;</h1><p>One\n  two<br>three&nbsp;&eacute;<p><b>Four <i>five</i>"
            "<script>var x='<p>no</p>';</script><div class='sidebar'><p>More</p></div></article><footer>&copy; me</footer>")
    assert htmltext.main_text(page, model) == "A <title>\n\nOne two three é\n\nFour five"
    assert htmltext.main_text(None, model) == htmltext.main_text("", model) == htmltext.main_text("<p></p>", model) == ""
    assert [b.text for b in htmltext.page_blocks("a < b <p title='x>y'>c</p></div> d <style>")] == ["a < b", "c", "d"]


def test_unclosed_media_and_formulas_lose_no_text():
    def texts(page):
        return [b.text for b in htmltext.page_blocks(page)]

    assert texts("<p>First.</p><video src=a><p>Second.</p>") == ["First.", "Second."]
    for tag in sorted(htmltext.HIDDEN_TAGS):
        assert texts(f"<p>One <{tag}><p>gone</p></{tag}> two</p><p>Three</p>") == ["One two", "Three"]
        assert texts(f"<div><p>One</p><{tag} a=b><p>two</p></div><p>Three <{tag}>gone</{tag}></p>") == ["One", "two", "Three"]
        assert texts(f"<{tag}><{tag}>gone</{tag}>gone</{tag}>kept</{tag}>") == ["kept"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> be</p>") == ["Let x=2 be"]
    assert texts("<p>&lt<b>; b</b> &am<i>p;</i> &amp;</p>") == ["<; b &amp; &"]
    assert texts("a<script>b<p>c") == ["a"] and texts("<p>a<title/>b") == ["ab"]


def test_deeply_nested_page_is_read_in_linear_time():
    import time

    page = "<article>" + "<span>x " * 60_000 + "</em>" * 60_000 + "<video>" * 60_000 + "<p>end</p></article>"
    began = time.perf_counter()
    blocks = htmltext.page_blocks(page)
    assert time.perf_counter() - began < 20
    assert [len(b.text) for b in blocks] == [119_999, 3]


def brute_decode(model, feats):
    import itertools

    def score(y):
        return sum(model.emission(*f) for f, k in zip(feats, y) if k) + sum(model.step[a, b] for a, b in zip(y, y[1:]))
    return max(map(score, itertools.product((0, 1), repeat=len(feats)))), score(model.decode(feats))


def test_viterbi_against_all_labellings(model):
    for page in htmltext.labelled_pages(20, 99):
        _, feats, _ = htmltext.labels_and_clean(page)
        best, got = brute_decode(model, feats[:11])
        assert abs(best - got) < 1e-9


def test_html_extraction(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = htmltext.extract_main_text(pages, model).collect()
    import html as entities
    import re

    by_id = {p["page_id"]: p for p in pages.collect()}
    for r in out:
        inner = re.sub(r"<br>|</?b>", " ", by_id[r["page_id"]]["html"].split("<article>")[1].split("</article>")[0])
        parts = [" ".join(entities.unescape(x).split()) for x in re.split(r"<[^>]*>", inner)]
        assert r["text"] == "\n\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "x" * 50000)], "page_id long, url string, html string")
    assert htmltext.extract_main_text(odd, model).count() == 3
    assert htmltext.extract_main_text(odd.limit(0), model).count() == 0


# -- SentencePiece

@pytest.fixture(scope="module")
def pieces():
    return sentences.load_pieces(SENTENCE_MODEL)


def all_segmentations(p, text):
    by_text = {p.text[i]: i for i in np.flatnonzero(p.usable)}
    data = b" " + text.encode()

    def go(rest):
        if not rest:
            yield ()
        for n in range(1, len(rest) + 1):
            if rest[:n] in by_text and not (b" " in rest[1:n] and rest[:n].strip(b" ")):
                for tail in go(rest[n:]):
                    yield (by_text[rest[:n]], *tail)
    found = list(go(data))
    w = np.exp([p.logp[list(s)].sum() for s in found])
    return dict(zip(found, w / w.sum()))


def test_draws_follow_the_lattice(pieces):
    text, n = "thing a", 6000
    chance = all_segmentations(pieces, text)
    out, _ = sentences.sample_block(sentences.Lattices(pieces), [text] * n, tk.mix(np.arange(n).astype(tk.U64)), 2)
    first = Counter(tuple(int(x) for x in d[0][0]) for d in out)
    both = Counter(tuple(int(x) for x in y[0]) for d in out for y in d)
    for s, q in chance.items():
        assert abs(first[s] / n - q) < 4 * math.sqrt(q / n) + 2e-3
        second = q + sum(x * q / (1 - x) for t, x in chance.items() if t != s)
        assert abs(both[s] / n - second) < 4 * math.sqrt(second / n) + 4e-3
    for d in out[:50]:
        for ids, logw, _ in d:
            assert abs(math.exp(logw) - chance[tuple(int(x) for x in ids)]) < 1e-6


def test_draws_are_all_segmentations_of_a_short_text(pieces):
    chance = all_segmentations(pieces, "cat")
    out, rest = sentences.sample_block(sentences.Lattices(pieces), ["cat"], np.array([5], tk.U64), 50)
    assert {tuple(int(x) for x in d[0]) for d in out[0]} == set(chance) and rest[0] == -math.inf
    assert [d[2] for d in out[0]] == sorted((d[2] for d in out[0]), reverse=True)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=" a\tthe\n▁漢é\U0001F600\x00", max_size=25), min_size=1, max_size=4))
def test_round_trip(rows):
    p = _pieces()
    out, _ = sentences.sample_block(sentences.Lattices(p), rows, tk.mix(np.arange(len(rows)).astype(tk.U64)), 3)
    for t, draws in zip(rows, out):
        assert all(sentences.decode(p, d[0].tolist()) == t for d in draws)
        assert len({tuple(d[0]) for d in draws}) == len(draws)


_kept = []


def _pieces():
    if not _kept:
        _kept.append(sentences.load_pieces(SENTENCE_MODEL))
    return _kept[0]


def test_draws_do_not_depend_on_kept_lattices(pieces):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé日 \n"), 9)) for _ in range(300)]
    blocks = [[" ".join(rng.choice(words, 40)) for _ in range(5)] + ["", None] for _ in range(6)]
    seeds = tk.mix(np.arange(7).astype(tk.U64))

    def drawn(lattices):
        return [[[(d[0].tolist(), d[1], d[2]) for d in found] for found in sentences.sample_block(lat, b, seeds, 3)[0]] for lat, b in zip(lattices, blocks)]

    one = sentences.Lattices(pieces)
    kept = drawn([one] * len(blocks))
    assert len(one.hashes) > 50  # recurring units stayed
    some = sentences.Lattices(pieces, keep=20_000)
    assert drawn([some] * len(blocks)) == drawn([sentences.Lattices(pieces) for _ in blocks]) == kept
    assert 0 < len(some.hashes) < len(one.hashes)


def test_round_trips_are_read_from_the_pieces(pieces):
    texts = ["a cat", None, "", "日本 x"]
    out, _ = sentences.sample_block(sentences.Lattices(pieces), texts, tk.mix(np.arange(4).astype(tk.U64)), 1)
    draws = [(i, d[0][0] if d else np.zeros(0, np.int64)) for i, d in enumerate(out)]
    assert sentences.round_trips(pieces, texts, draws) == [True] * 4
    assert sentences.round_trips(pieces, texts, [(0, draws[3][1]), (1, draws[0][1]), (0, draws[0][1][:-1]), (2, draws[2][1])]) == [False, False, False, True]


def test_sample_segmentations(corpus, nothing, pieces):
    out = sentences.sample_segmentations(corpus.repartition(3), pieces, k=2)
    got = sorted(map(repr, sentences.decode_segmentations(out, pieces).collect()))
    again = sorted(map(repr, sentences.decode_segmentations(sentences.sample_segmentations(corpus, pieces, k=2), pieces).collect()))
    assert got == again  # a row's draws depend on the row alone
    assert out.filter("not round_trip").count() == 0
    assert out.filter("draw = 0").count() == corpus.count()
    assert sentences.sample_segmentations(nothing, pieces).count() == 0


# -- pipeline

def test_pipeline_stages(spark, corpus, nothing, monkeypatch):
    import corpus_pipeline as cp

    from tests_llm_brute import stage_checks

    sf_dir = "/root/testdata/sf0.001"
    docs = corpus
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        if name != cp.STAGES[-1][0]:
            assert out.columns == corpus.columns
            assert stage(spark, nothing, sf_dir).count() == 0
        stage_checks[name](docs, out, sf_dir)
        docs = out
    assert cp.run(spark, sf_dir).columns == docs.columns


def test_pipeline_keeps_rows_and_columns_that_only_look_alike(spark):
    import corpus_pipeline as cp

    one, two = "the first text of its own with several words in it", "quite another text that shares none of them at all"
    docs = spark.createDataFrame(
        [(1, one, "en", "s", 50, "u", 3, 0.5), (1, two, "en", "s", 50, "v", 4, 0.6), (2, one, "en", "s", 50, "w", 5, 0.7), (1, one, "en", "s", 50, "u", 3, 0.5),
         (None, two, "en", "s", 50, "x", 6, 0.8), (None, None, None, None, None, "y", 7, 0.9)],
        "doc_id long, text string, lang string, source string, n_chars long, _key string, n_removed int, _lang_score double")
    out = cp.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["_key"], r["n_removed"]) for r in out.collect()) == [(0, "", "y", 7), (1, two, "v", 4), (1, one, "u", 3)]
    told = cp.language_id(spark, docs, "")
    assert told.columns == docs.columns and told.schema == docs.schema
    assert sorted(r["_lang_score"] for r in told.collect()) == [0.5, 0.5, 0.6, 0.7, 0.8]
    cut = cp.substring_dedup(spark, docs, "")
    assert cut.columns == docs.columns and sorted(r["n_removed"] for r in cut.collect()) == [3, 3, 4, 5, 6, 7]


def test_memory_of_a_block_of_segmentations():
    r = random.Random(5)
    text = " ".join("".join(r.choices("abcdefghilmnoprstu", k=r.randint(3, 11))) for _ in range(sentences.BLOCK // 8))  # hardly a word twice
    lat = sentences.Lattices(sentences.load_pieces(SENTENCE_MODEL))
    tracemalloc.start()
    try:
        sentences.sample_block(lat, [text], tk.mix(np.arange(1).astype(np.uint64)), 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 110_000_000, peak
