"""Document operators against brute force, with nulls, blanks, ties, repeated rows and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tokenledger.llm.components import connected_components
from tokenledger.llm.decontam import Seeds, find_leaks, item_words, remove_leaks
from tokenledger.llm.jaccard import jaccard_components
from tokenledger.llm.langid import fit_language_model, identify_language
from tokenledger.llm.licenses import TEMPLATES, patience, scan_licenses
from tokenledger.llm.lm import learn_weights, lm_scores
from tokenledger.llm.quality import language_references, quality_rules
from tokenledger.llm.substring import level_lengths, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return [r.asDict() for r in df.collect()]


# -- language ID

def test_language_id(corpus, nothing):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = fit_language_model(corpus.filter(~held))
    got = rows(identify_language(corpus.withColumn("held", held), model))
    assert len(got) == corpus.count()
    real = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900000]
    for part in (True, False):
        own = [r for r in real if r["held"] == part]
        assert sum(r["lang"] == r["lang_pred"] for r in own) > 0.95 * len(own)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (900001, 900002, 900003, 900004))
    assert all(0 <= r["score"] <= 1 for r in got) and by_id[900006]["lang_pred"] != "und"
    assert identify_language(nothing, model).count() == 0
    blank = fit_language_model(nothing)
    assert {r["lang_pred"] for r in rows(identify_language(corpus.limit(5), blank))} == {"und"}


def test_language_id_keeps_columns(corpus):
    model = fit_language_model(corpus)
    odd = corpus.withColumn("score", F.lit("clash")).withColumn("extra", F.lit(1)).limit(3)
    out = identify_language(odd, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "lang_pred", "score"]
    assert dict(out.dtypes)["score"] == "double"


# -- substring dedup

def brute_repeats(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


def check_repeats(df, window, base):
    data = rows(df.select("doc_id", "text"))
    want = Counter((d["doc_id"], n, k, hashlib.sha256(" ".join(kept).encode()).hexdigest())
                   for d, (n, k, kept) in zip(data, brute_repeats([d["text"] for d in data], window)))
    got = remove_repeats(df, window=window, base=base, join_all=True)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in got.collect()) == want


def test_substring_dedup(corpus, spark, nothing):
    check_repeats(corpus, 35, 9)
    a = "a b c d e f g"
    tiny = spark.createDataFrame([(1, a + " x"), (2, "y " + a), (3, "a b c"), (4, "q q q q q q q q"), (5, None), (6, ""), (None, a)], "doc_id long, text string")
    for window, base in ((3, 9), (4, 2), (5, 2), (7, 2), (1, 1)):
        check_repeats(tiny, window, base)
    assert remove_repeats(nothing).count() == 0
    assert level_lengths(35, 9) == [9, 18, 35] and level_lengths(4, 9) == [4]


def test_substring_dedup_leaves_clean_texts_as_they_are(spark):
    df = spark.createDataFrame([(1, "one  two\nthree", 7), (2, None, 7)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: r for r in rows(remove_repeats(df, window=2))}
    assert got[1]["text"] == "one  two\nthree" and got[1]["n_words"] == 3 and got[2]["text"] is None and got[2]["n_words"] == 0


# -- LM scoring

def test_lm_scores(corpus, nothing):
    data = rows(corpus.select("doc_id", "text"))
    tokens = [WORD.findall((d["text"] or "").translate(LOWER)) + [None] for d in data]
    fold = [zlib.crc32(("" if d["doc_id"] is None else str(d["doc_id"])).encode()) % 10 for d in data]
    uni, bi, em_uni, em_bi = Counter(), Counter(), Counter(), Counter()
    for w, f in zip(tokens, fold):
        for c1, c2, on in ((uni, bi, f != 0), (em_uni, em_bi, f == 1)):
            if on:
                c1.update(w)
                c2.update(zip(["<s>"] + w, w))
                c1["<s>"] += 1
    n, v = sum(uni.values()) - uni["<s>"], len(uni) - 1
    held_n = sum(em_uni.values()) - em_uni["<s>"]
    # weights by EM on the same quantities, unquantised
    grid = Counter()
    for w, f in zip(tokens, fold):
        if f == 1:
            for a, b in zip(["<s>"] + w, w):
                ctx = uni[a] - em_uni[a]
                p2 = (bi[a, b] - em_bi[a, b]) / ctx if ctx else 0.0
                p1 = (uni[b] - em_uni[b]) / (n - held_n)
                cell = [0 if not ctx else min(23, int(math.log2(ctx)) + 1)]
                for p in (p2, p1):
                    cell.append(min(159, round(-math.log2(p) * 4)) if p > 0 else 160)
                grid[tuple(cell)] += 1
    import numpy as np

    weights = learn_weights(np.array([(*c, m) for c, m in sorted(grid.items())]), 1 / (v + 1))
    want = Counter()
    for d, w, f in zip(data, tokens, fold):
        score = base = 0.0
        for a, b in zip(["<s>"] + w, w):
            k = 0 if not uni[a] else min(23, int(math.log2(uni[a])) + 1)
            p2 = bi[a, b] / uni[a] if uni[a] else 0.0
            score += math.log10(weights[k][0] * p2 + weights[k][1] * uni[b] / n + weights[k][2] / (v + 1))
            base += math.log10((uni[b] + 0.1) / (n + 0.1 * (v + 1)))
        want[d["doc_id"], f == 0, len(w), sum(uni[b] > 0 for b in w), n, round(base, 4), round(score, 3)] += 1
    got = rows(lm_scores(corpus))
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 3)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm_scores(nothing).count() == 0


# -- quality rules

def test_quality_rules(corpus, nothing):
    refs = language_references(corpus)
    got = rows(quality_rules(corpus, refs))
    assert len(got) == corpus.count()
    want = Counter()
    for d in rows(corpus):
        t = d["text"] or ""
        w = WORD.findall(t)
        grams = list(zip(w, w[1:], w[2:]))
        seen = Counter(grams)
        cover = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        base = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want[d["doc_id"], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), base] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    clean = [r for r in got if not r["base_failed"] and r["n_symbols"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean)
    assert quality_rules(nothing, language_references(nothing)).count() == 0


def test_quality_distances_and_verdict_by_brute_force(corpus):
    from tokenledger.llm.quality import COMMON_WORDS

    common = sorted(set(COMMON_WORDS.split()))

    def classes(t):
        out = [0] * 8
        for ch in t:
            c = ord(ch)
            k = (0 if "a" <= ch <= "z" else 1 if "A" <= ch <= "Z" else 2 if "0" <= ch <= "9" else 4 if c == 10 else 3 if c in (32, 9, 11, 12, 13)
                 else 5 if ch in ".,;:!?'\"()-" else 6 if c < 128 else 7)
            out[k] += 1
        return out

    def bag(t):
        n = Counter(w.translate(LOWER) for w in WORD.findall(t))
        known = [n[w] for w in common]
        return known + [sum(n.values()) - sum(known)]

    def share(h):
        return [x / sum(h) for x in h] if sum(h) else h

    def distance(p, q):
        if not sum(p) or not sum(q):
            return 0.0
        p, q = share(p), share(q)
        both = sum(x * math.log2(2 * x / (x + y)) for x, y in zip(p, q) if x) + sum(y * math.log2(2 * y / (x + y)) for x, y in zip(p, q) if y)
        return math.sqrt(max(0.0, both / 2))

    data = rows(corpus)
    own = {r["doc_id"]: r for r in rows(quality_rules(corpus, language_references(corpus)))}
    refs = {}
    for d in data:
        t, r = d["text"] or "", own[d["doc_id"]]
        if r["base_failed"] or 50 * r["n_symbols"] > r["word_chars"]:
            continue
        for k in {d["lang"], "*"} - {None}:
            ref = refs.setdefault(k, ([0] * 8, [0] * (len(common) + 1)))
            for total, h in zip(ref, (classes(t), bag(t))):
                for i, x in enumerate(share(h)):
                    total[i] += round(1e6 * x)
    for d in data:
        t, r = d["text"] or "", own[d["doc_id"]]
        ref = refs.get(d["lang"], refs["*"])
        dc, dw = distance(classes(t), ref[0]), distance(bag(t), ref[1])
        assert abs(dc - r["char_distance"]) < 1e-6 and abs(dw - r["word_distance"]) < 1e-6
        far = len(t) >= 200 and dc > 0.12 + 1 / math.sqrt(len(t)) or r["n_words"] >= 100 and dw > 0.08 + 2.5 / math.sqrt(r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not far)


def test_quality_rules_reject_short_symbol_junk(corpus, spark):
    refs = language_references(corpus)
    clean = [r for r in corpus.filter("lang = 'en' and doc_id < 900000").collect()
             if 55 <= len(WORD.findall(r["text"])) <= 130 and not re.search(r"[#*$%&|<>0-9@]", r["text"])]
    assert len(clean) >= 5
    junk = [(r["doc_id"] + 10**6, re.sub(r"(\S+)\s+(\S+)\s+", r"\1\2 | ", r["text"]), "en") for r in clean]
    plain = [(r["doc_id"], r["text"], "en") for r in clean]
    got = rows(quality_rules(spark.createDataFrame(junk + plain, "doc_id long, text string, lang string"), refs))
    passed = [r for r in got if not r["base_failed"]]
    assert all(r["kept"] for r in passed if r["doc_id"] < 10**6)
    assert not any(r["kept"] for r in passed if r["doc_id"] >= 10**6)


# -- decontamination

def test_decontamination(corpus, spark, nothing):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    docs = rows(corpus.select("doc_id", "text"))
    planted = []
    for n, (i, t) in enumerate(sorted(items.items())[:10]):
        w = t.split()
        for k in range(4, len(w), 9):
            w[k] = "changed"
        planted.append((800000 + n, "before it " + " ".join(w).upper() + " after"))
    more = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(more, bench).collect()}
    exact = {(d["doc_id"], i) for d in docs for i, t in items.items() if t in (d["text"] or "")}
    assert exact <= got
    assert {(800000 + n, i) for n, i in enumerate(sorted(items)[:10])} <= got
    assert len(got) <= len(exact) + 10 + 3
    left = {r["doc_id"] for r in remove_leaks(more, bench).select("doc_id").collect()}
    assert left == {r["doc_id"] for r in more.select("doc_id").collect()} - {d for d, _ in got}
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(more, bench, part_words=300).collect()} == got
    assert find_leaks(nothing, bench).count() == 0 and find_leaks(corpus, bench.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "x y z"), (7, None), (8, ""), (9, "a b")], "item_id long, text string")
    assert find_leaks(corpus, odd).count() == 0


def test_decontamination_folds_case_beyond_ascii(spark):
    item = "été où élève naïf garçon forêt crème brûlée déjà Noël hôtel straße Ωμέγας știință"
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "LA. " + item.upper() + " ÉON"), (2, "avant " + item + " après"), (3, item.title()), (4, "tout autre chose " * 9), (5, None)],
                                 "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_match"]) for r in find_leaks(docs, bench).collect()}
    assert got == {(1, 5, 14), (2, 5, 14), (3, 5, 14)}
    assert {r["doc_id"] for r in remove_leaks(docs, bench).select("doc_id").collect()} == {4, 5}


def test_decontamination_one_changed_word_anywhere():
    import pyarrow as pa

    for n in range(10, 21):
        words = [f"w{i}" for i in range(n)]
        seeds = Seeds([3], [" ".join(words)], 5)
        texts = [" ".join(["before", *words[:i], "changed", *words[i + 1:], "after"]) for i in range(n)]
        got = seeds.verified(*item_words(pa.array(texts)), 13, 0.8, 3)
        assert [r[0] for r in got] == list(range(n))


def test_decontamination_short_items_with_changes():
    """Every choice of changed words that the share allows is found, at the edge of a text too."""
    import itertools

    import pyarrow as pa

    from tokenledger.llm.decontam import SHORT_ITEM, needed

    for n in range(1, SHORT_ITEM):
        words, k = [f"w{i}" for i in range(n)], n - needed(n, 0.8)
        seeds = Seeds([3], [" ".join(words)], 1)
        picks = list(itertools.combinations(range(n), k))
        texts = [" ".join("changed" if i in p else x for i, x in enumerate(words)) for p in picks]
        texts += ["before " + t + " after" for t in texts] + [" ".join(words[k:]) + " after", "before " + " ".join(words[: n - k])]
        got = seeds.verified(*item_words(pa.array(texts)), 13, 0.8, 3)
        assert [r[0] for r in got] == list(range(len(texts)))
        far = [" ".join("changed" if i in p else x for i, x in enumerate(words)) for p in itertools.combinations(range(n), k + 1)]
        assert seeds.verified(*item_words(pa.array(far)), 13, 0.8, 3) == []


def test_decontamination_against_all_diagonals():
    """Every text, item and diagonal by brute force, over items of 1 to 40 words with changed words."""
    import pyarrow as pa

    rnd = random.Random(5)
    items = [[f"v{rnd.randrange(400)}" for _ in range(rnd.randint(1, 40))] for _ in range(60)]
    texts = []
    for _ in range(400):
        w = [f"v{rnd.randrange(400)}" for _ in range(rnd.randint(0, 30))]
        item = list(rnd.choice(items))
        for _ in range(rnd.randint(0, 1 + len(item) // 5)):
            item[rnd.randrange(len(item))] = "other"
        at = rnd.randint(0, len(w))
        texts.append(w[:at] + item + w[at:])
    want = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            need = math.ceil(0.8 * len(x))
            for diag in range(-len(x) + 1, len(t)):
                same = [0 <= p + diag < len(t) and t[p + diag] == w for p, w in enumerate(x)]
                if sum(same) < min(13, need):
                    continue
                # the best stretch (equal words count 1, others -3; the first of several)
                _, end, start = max((sum(1 if x else -3 for x in same[a:b]), -b, -a) for b in range(len(same) + 1) for a in range(b + 1))
                if sum(same) >= need or sum(same[-start:-end]) >= min(13, need):
                    want.add((d, i))
    seeds = Seeds(list(range(len(items))), [" ".join(x) for x in items], 1)
    got = {(r[0], seeds.ids[r[1]]) for r in seeds.verified(*item_words(pa.array([" ".join(t) for t in texts])), 13, 0.8, 3)}
    short = {i for i, x in enumerate(items) if len(x) < 16}
    assert {p for p in want if p[1] in short} <= got  # short items: all
    assert len(want & got) >= 0.99 * len(want)  # longer ones: by the fixed masks
    assert got <= want


def test_decontamination_item_ids_keep_their_type(spark):
    bench = spark.createDataFrame([("b-1", "one two three four five six"), ("a-1", "one two three four five six"), ("c", "zz yy"), (None, "ten")],
                                  "item_id string, text string")
    docs = spark.createDataFrame([(1, "x one two 3 four five six y"), (2, "zz zz yy yy"), (3, "ten yy zz")], "doc_id long, text string")
    found = find_leaks(docs, bench)
    assert dict(found.dtypes)["item_id"] == "string"
    assert {(r["doc_id"], r["item_id"], r["n_match"]) for r in found.collect()} == {(1, "a-1", 5), (2, "c", 2)}
    assert {r["doc_id"] for r in remove_leaks(docs, bench).collect()} == {2, 3}
    assert {r["doc_id"] for r in remove_leaks(docs, bench, min_item_words=1).collect()} == {3}


# -- names and labels

def test_every_label_is_learned_or_refused(spark):
    import pytest

    texts = [(i, f"{a}{b}{c} " * 20, f"{a}{b}{c}") for i, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "ijklmnop" for c in "qrstu")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = rows(identify_language(docs, fit_language_model(docs)))
    assert len(texts) == 320 and all(r["lang_pred"] == r["lang"] for r in got)
    assert len(language_references(docs)) == 321
    for call in (lambda: fit_language_model(docs, max_languages=319), lambda: language_references(docs, max_languages=319)):
        with pytest.raises(ValueError):
            call()


def test_language_id_of_lone_letters(corpus, spark):
    model = fit_language_model(corpus)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["々", "〆", "ⁿ", "ⁱ", "ª", "\u3031", "、", "\u2014", "\u3000", "¿"])], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in identify_language(docs, model).collect()}
    assert [got[i] != "und" for i in range(10)] == [True] * 6 + [False] * 4


def test_substring_dedup_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 7), (2, "z a b c d y", "y", 8), (3, None, None, 9)], "doc_id long, text string, _chunk string, _TEXT_HASH int")
    out = remove_repeats(docs, window=4, base=2)
    assert out.columns == ["doc_id", "text", "_chunk", "_TEXT_HASH", "n_words", "n_removed"]
    assert sorted(map(tuple, out.collect())) == [(1, "e f", "x", 7, 6, 4), (2, "z y", "y", 8, 6, 4), (3, None, None, 9, 0, 0)]


# -- Jaccard join

def brute_components(data, n, percent):
    sets = []
    for d in data:
        w = WORD.findall((d["text"] or "").translate(LOWER))
        sets.append({tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    group = list(range(len(data)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                group[root(i)] = root(j)
    least = {}
    for i, d in enumerate(data):
        if d["doc_id"] is not None:
            least[root(i)] = min(least.get(root(i), d["doc_id"]), d["doc_id"])
    return Counter((d["doc_id"], len(sets[i]), least.get(root(i)) if sets[i] else d["doc_id"]) for i, d in enumerate(data))


def check_components(df, n=5, percent=75):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df, n=n, percent=percent).collect())
    assert got == brute_components(rows(df.select("doc_id", "text")), n, percent)


def test_jaccard_join(corpus, nothing):
    check_components(corpus)
    assert jaccard_components(nothing).count() == 0


def test_jaccard_join_near_copies_and_chains(spark):
    import random

    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    data, at = [], 0
    for _ in range(8):
        base = r.choices(vocabulary, k=r.choice([6, 12, 60, 90]))
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            data.append((at, " ".join(w)))
            at += 1
            base = w if r.random() < 0.4 else base  # chains drift away from their start
    shared = " ".join(r.choices(vocabulary, k=30))
    data += [(1000 + i, shared + " " + " ".join(r.choices(vocabulary, k=r.choice([3, 8, 12])))) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    check_components(df)
    check_components(df, 3, 50)


def test_jaccard_join_deals_a_hot_group_over_parts(spark):
    import random

    from tokenledger.llm.chunks import unpack_counts
    from tokenledger.llm.jaccard import mixed_entries, shared_sets, with_components

    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    data = []
    for i in range(120):  # texts of one group, a quarter of the words differs from text to text
        w = list(words)
        for j in range(i % 3 * 4):
            w[39 - j] = f"x{r.randrange(60)}"
        data.append((i, " ".join(w)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = brute_components(rows(df), 3, 60)
    for most in (40, 10**6):
        got = jaccard_components(df, n=3, percent=60, part_entries=most)
        assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got.collect()) == want
    lead = shared_sets(df, "doc_id", "text", 3, 60).filter("members is not null").dropDuplicates(["class"])
    classes = spark.createDataFrame(lead.collect(), lead.schema)
    parted = mixed_entries(with_components(classes, None), 3, 4, 80).collect()
    held, at_once = Counter(), Counter()
    for x in parted:
        n = len(unpack_counts(bytes(x["who"])))
        held[x["bucket"], x["x"], x["y"]] += n
        at_once[x["bucket"]] += n if x["x"] == x["y"] else 0
    assert max(at_once.values()) > 200 and max(held.values()) <= 120  # no task holds the hot bucket
    one = with_components(classes, None).withColumn("component", F.lit(7).cast("long"))
    assert mixed_entries(one, 3, 4, 80).count() == 0  # groups in one component are not gathered


def test_connected_components(spark):
    edges = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (6, 5), (1, 2), (3, 3), (None, 4), (20, 30), (30, 20)], "a long, b long")
    got = {(r["node"], r["label"]) for r in connected_components(edges).collect()}
    assert got == {(9, 5), (8, 5), (7, 5), (6, 5), (5, 5), (1, 1), (2, 1), (20, 20), (30, 20)}
    assert connected_components(edges.limit(0)).count() == 0


# -- license scans

def test_patience():
    a, b = "x the quick brown fox y".split(), "the quick red fox".split()
    assert patience(a, b) == [(1, 0), (2, 1), (4, 3)]
    assert patience([], b) == [] and patience(["a", "a"], ["a", "a"]) == [(0, 0), (1, 1)]


def test_license_scan(corpus, spark, nothing):
    mit = TEMPLATES["mit"]
    words = mit.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 15)
    df = spark.createDataFrame([(1, "Copyright me\n\n" + mit.upper()), (2, changed), (3, " ".join(words[: len(words) // 2])), (4, None), (5, ""),
                                (6, "Released under the MIT License. blah " * 2), (None, TEMPLATES["gpl-3"])], "doc_id long, text string")
    got = Counter((r["doc_id"], r["license"]) for r in scan_licenses(df).collect())
    assert got == {(1, "mit"): 1, (2, "mit"): 1, (6, "mit-notice"): 2, (None, "gpl-3"): 1}
    plain = {r["doc_id"] for r in corpus.filter("text rlike 'icensed under|Released under the'").collect()}
    assert {r["doc_id"] for r in scan_licenses(corpus).collect()} == plain
    assert scan_licenses(nothing).count() == 0


def near_copies(n, changes, words=120, seed=3):
    """Copies of one text, each with a few words of its own."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for d in range(n):
        t = list(base)
        for k in rng.sample(range(words), rng.choice(changes)):
            t[k] = f"c{d}x{k}"
        out.append(t)
    return out


def shingles(t):
    return {tuple(t[i: i + 5]) for i in range(len(t) - 4)}


def test_tree_candidates_of_near_copies_that_do_not_link():
    """The bound on the overlap leaves few of all pairs and loses no link."""
    import pyarrow as pa

    from tokenledger.llm import jaccard as j
    from tokenledger.llm import tokens as tk
    from tokenledger.llm.chunks import pack_counts
    n = 400
    docs = near_copies(n, (3, 4))
    sets = [np.unique(np.array([hash(x) & (2**64 - 1) for x in shingles(t)], tk.U64)) for t in docs]
    size = np.array([len(s) for s in sets])
    one = np.ones((n, j.WORDS), tk.U64)  # all share a prefix bit
    levels = j.build_tree(one, np.stack([j.folded(j.sign_of(s), j.TREE_BITS) for s in sets]), size, np.arange(n), np.full(n, -1))
    got = {(x, y) for a, b in j.dual_traversal(levels, 75) for x, y in zip(a.tolist(), b.tolist())}
    links = {(a, b) for a in range(n) for b in range(a + 1, n) if 175 * j.overlap(sets[a], sets[b]) >= 75 * (size[a] + size[b])}
    assert links <= got and len(got) < 0.05 * n * (n - 1) / 2
    common = np.unique(np.concatenate([s[:30] for s in sets]))
    own = [np.intersect1d(s, common) for s in sets]
    keys, who = np.concatenate(own), np.repeat(np.arange(n), [len(x) for x in own])
    order, cls = np.argsort(keys, kind="stable"), np.arange(n, dtype=np.int64) + 10
    t = pa.table({"bucket": [0], "x": [0], "y": [0], "part": [0], "keys": [tk.pack_sorted(keys[order])], "who": [pack_counts(who[order])],
                  "class": [cls.tobytes()], "size": [pack_counts(size)], "component": [cls.tobytes()], "sets": [j.pack_sets([j.narrow(s, 0) for s in sets])]})
    found = [(a - 10, b - 10) for a, b in zip(*[j.tree_links(t, 75).column(c).to_pylist() for c in "ab"])]
    assert set(found) <= links and len(found) < n  # a forest, and the same components as all links

    def components(edges):
        label = list(range(n))
        for _ in range(n):
            before = list(label)
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                return label

    assert components(found) == components(links)


def test_wide_bitmaps_bound_large_sets():
    from tokenledger.llm import jaccard as j
    from tokenledger.llm import tokens as tk
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2**63, 6000).astype(tk.U64))
    b = np.concatenate([a[:4000], np.unique(rng.integers(0, 2**63, 2000).astype(tk.U64))])
    c = np.concatenate([a[:5600], b[4000:4300]])
    sets = [a, b, c, a[:100]]
    signs, size = [j.sign_of(np.sort(s)) for s in sets], np.array([len(s) for s in sets])
    i, k = np.array([0, 0, 1, 3]), np.array([1, 2, 2, 3])
    assert j.within_reach(i, k, size, signs, 75).tolist() == [False, True, False, True]
    assert (j.folded(signs[0], 1024) == j.folded(j.sign_of(a[:1]), 1024)).sum() < 16  # a fold keeps every bit
    assert j.sign_bits([1, 512, 513]).tolist() == [1024, 1024, 2048]


def test_jaccard_join_of_many_near_copies(spark):
    docs = [(i, " ".join(t)) for i, t in enumerate(near_copies(150, (2, 3, 4), seed=8))]
    check_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))


def test_narrow_sets_lose_no_overlap():
    from tokenledger.llm import jaccard as j
    from tokenledger.llm import tokens as tk
    rng = np.random.default_rng(9)
    a, b = (np.unique(rng.integers(0, 2**63, n).astype(tk.U64) * tk.U64(2)) for n in (900, 700))
    b = np.union1d(b, a[:300])
    for turn, width in ((0, 32), (0, 7), (1, 32)):
        short = [j.narrow(x, turn, width) for x in (a, b, a[:0])]
        again = j.unpack_sets(j.pack_sets(short), np.array([len(x) for x in short]))
        assert [x.tolist() for x in again] == [x.tolist() for x in short]
        assert j.overlap(again[0], again[1]) >= j.overlap(a, b) == 300
    assert j.overlap(*[j.narrow(x, 0) for x in (a, b)]) == 300


def test_jaccard_join_when_narrow_hashes_collide(spark):
    docs = [(i, " ".join(t)) for i, t in enumerate(near_copies(60, (2, 3, 4), seed=4))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for width in (3, 8):  # nearly all first pairs are no links
        got = jaccard_components(df, width=width).collect()
        assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == brute_components(rows(df), 5, 75)
