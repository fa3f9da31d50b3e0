"""What each pipeline stage must have done, by brute force on a small table."""

from test_llm_documents import brute_components, brute_repeats


def _rows(df):
    return [r.asDict() for r in df.collect()]


def language_id(before, after, sf_dir):
    letters = [d for d in _rows(before) if any(c.isalpha() for c in d["text"] or "")]
    assert sorted(map(repr, letters)) == sorted(map(repr, _rows(after)))


def near_duplicates(before, after, sf_dir):
    data = _rows(before)
    stand_in = [{**d, "doc_id": 10**12 if d["doc_id"] is None else d["doc_id"]} for d in data]
    keep = {k for k, _, c in brute_components(stand_in, 5, 75) if k == c}
    got = [10**12 if d["doc_id"] is None else d["doc_id"] for d in _rows(after)]
    assert len(got) == len(set(got)) and set(got) == keep


def substring_dedup(before, after, sf_dir):
    data = _rows(before)
    want = {}
    for d, (n, gone, kept) in zip(data, brute_repeats([d["text"] for d in data], 35)):
        if gone < n:
            want[d["doc_id"]] = " ".join(kept) if gone else d["text"]
    got = {d["doc_id"]: d for d in _rows(after)}
    assert {k: d["text"] for k, d in got.items()} == want
    was = {d["doc_id"]: d["text"] for d in data}
    assert all(d["n_chars"] == len(d["text"]) for k, d in got.items() if d["text"] != was[k])


def decontamination(before, after, sf_dir):
    bench = [r["text"] for r in before.sparkSession.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {d["doc_id"] for d in _rows(after)}
    gone = [d for d in _rows(before) if d["doc_id"] not in got]
    assert not any(b in d["text"] for d in _rows(after) for b in bench)
    words = [set(b.lower().split()) for b in bench]
    for d in gone:  # nothing clean leaves
        own = set(d["text"].lower().split())
        assert max(len(own & w) / len(w) for w in words) > 0.6 or any(len(own & w) >= 13 for w in words)


def segmentations(before, after, sf_dir):
    drawn = _rows(after)
    assert all(r["round_trip"] for r in drawn)
    assert {r["doc_id"] for r in drawn} == {d["doc_id"] for d in _rows(before)}
    assert len({(r["doc_id"], r["ids"]) for r in drawn}) == len(drawn)


stage_checks = {f.__name__: f for f in (language_id, near_duplicates, substring_dedup, decontamination, segmentations)}
