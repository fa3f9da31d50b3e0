import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenledger.llm import audit, pii
from tokenledger.llm.audit import audit_filters
from tokenledger.llm.pii import personal_data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The base patterns as the contract states them, with plain searches.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    digits = [int(c) for c in s if c.isdigit()][::-1]
    return 13 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


TEST = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": luhn,
        "phone": lambda s: 9 <= sum(c.isdigit() for c in s) <= 15}


def base(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if TEST[k](m.group())] for k, p in PLAIN.items()}


def check(text):
    found = pii.find_spans(text)
    assert {k: found.spans[k] for k in pii.BASE_KINDS} == base(text)
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ 0159()_é%", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    check(text)


@pytest.mark.parametrize("text", [
    None, "", "a.b@c.d_x@y.z", "@a.b", "a@b", "a@b.c@d.e", "a@b.c.d.", "1.2.3.4.5.6.7.8", "999.1.1.1 0000255.1.1.1 256.0.0.0",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111111111", "+1 (361) 555-8283", "+12 3.", "+1(((((((((", "x" * 5000 + "@",
    "4111111111111111 4111111111111111", "1" * 6000, "1." * 3000, "+" * 4000])
def test_base_spans_of_odd_texts(text):
    check(text)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    assert pii.routing_sum("021000021") and not pii.routing_sum("021000022")
    spans = lambda t: {k: v for k, v in pii.find_spans(t).spans.items() if k in pii.MORE_KINDS and v}
    iban = "Konto DE89 3704 0044 0532 0130 00 BIC"
    assert spans(iban) == {"iban": [(6, 33)]}
    assert spans("DE88 3704 0044 0532 0130 00") == {}
    assert spans("routing 021000021") == {"routing": [(8, 17)]} and spans("about 021000021 rows") == {}
    assert spans("SSN 123-45-6789") == {"ssn": [(4, 15)]} and spans("SSN 666-45-6789") == {} and spans("order 123-45-6789") == {}
    assert spans("call 361-555-8283 now") == {"local_phone": [(5, 17)]} and spans("sum 361-555-8283 now") == {}
    assert spans("call +1 361-555-8283") == {}  # inside a base span
    assert spans('token = "ffc3105535f423f352535e4ac53b5fefe076ac6d"') == {"secret": [(9, 49)]}
    assert spans("commit ffc3105535f423f352535e4ac53b5fefe076ac6d") == {}


def test_table_columns_and_cases(spark, corpus, nothing):
    rows = {(r.doc_id, r.text): r for r in personal_data(corpus.withColumn("text2", corpus.text).select("doc_id", "text")).join(
        corpus.select("doc_id", "text").distinct(), "doc_id").collect()}
    for (_, text), r in rows.items():
        b = base(text)
        listed = ",".join(f"{k}:{s}:{e}" for k in pii.BASE_KINDS for s, e in b[k])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(b[k]) for k in pii.BASE_KINDS]
        assert len(r.scores.split(",")) * bool(r.scores) == sum(map(len, b.values())) + r.n_added
    assert personal_data(corpus).count() == corpus.count()
    assert personal_data(nothing).collect() == []
    odd = spark.createDataFrame([(None, "x@y.z", 1, 2), ("k", None, 3, 4)], "doc_id string, text string, key int, spans int")
    assert sorted((r.doc_id or "", r.spans) for r in personal_data(odd).collect()) == [("", "email:0:5"), ("k", "")]


def test_long_text_is_linear(spark):
    text = "a" * 3_000_000 + " 1" * 1_000_000 + "@" + "b." * 500_000
    found = check(text[:20_000])
    assert found.spans["email"] == []
    assert personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_card == 0


# ---- audit -------------------------------------------------------------------------------

def brute(docs, labels):
    """Every order applied filter by filter to a list of rows."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows = []
    for key, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)),
                 "E": key is not None and any(k is not None and k < key and (o or "") == t for k, o, _ in docs)}
        rows.append((lang or "", key, fails))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shares = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left, out_of = own, []
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[2][f]]
                out[part, order, step] = [len(left) - len(gone), len(gone), sum(r[2][f] for r in out_of),
                                          sum(r[2][f] and sum(r[2].values()) == 1 for r in own),
                                          sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone)]
                shares[f] += len(gone)
                left = [r for r in left if not r[2][f]]
                out_of = out_of + gone
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shares[f])
    return out


def result(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


def fixture_rows():
    long = " ".join(f"w{i}" for i in range(220))
    docs = [(1, long, "en"), (2, long, "en"), (3, long, "de"), (3, long, "de"), (4, None, None), (5, "", ""), (6, "ABC #", "en"), (None, long, "en"),
            (7, "a " * 300, "en"), (8, "a " * 300, "fr"), (None, None, "fr"), (9, long.upper(), "en"), (10, long + " |", "en"), (2, "other", "en")]
    docs += [(100 + i, f"text {i % 7}", "en") for i in range(60)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (6, 1, 1), (None, 1, 1), (7, 1, 0), (100, 1, 1), (107, 1, 0), (999, 1, 1)]
    return docs, labels


def test_audit_against_every_order(spark):
    docs, labels = fixture_rows()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    told = spark.createDataFrame(labels, LABELS)
    assert result(audit_filters(df, told)) == brute(docs, labels)


def test_audit_does_not_depend_on_the_sketch(spark, monkeypatch):
    docs, labels = fixture_rows()
    docs = [*docs, *((1000 + i, f"unique {i}", "en") for i in range(300))]
    df, told = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3), spark.createDataFrame(labels, LABELS)
    want = result(audit_filters(df, told))
    monkeypatch.setattr(audit, "sketch_bits", lambda rows, max_bytes: 18)
    monkeypatch.setattr(audit, "may_repeat", lambda sketch, h: np.ones(len(h), bool))  # a full sketch
    assert result(audit_filters(df, told)) == want


def test_sketch_clears_unique_texts_only(spark):
    h = [*range(1000, 3000), *[7] * 50, *range(1000, 1100), -5]
    df = spark.createDataFrame([(x,) for x in h], "h long").repartition(5)
    for bits in (18, 20):
        sketch = audit.counting_bloom(df, bits)
        told = audit.may_repeat(sketch, np.array(h, np.int64).view(np.uint64))
        times = collections.Counter(h)
        assert all(told[i] for i, x in enumerate(h) if times[x] > 1)
        assert sum(t for t, x in zip(told, h) if times[x] == 1) < 20
    assert audit.sketch_bits(10**12) == 28 and audit.sketch_bits(0) == 18 and audit.sketch_bits(10**6) == 23


def test_audit_of_empty_and_extra_columns(spark, nothing):
    told = spark.createDataFrame([], LABELS)
    assert audit_filters(nothing, told).collect() == []
    odd = spark.createDataFrame([("b", "x", "en", 1, 2), ("a", "x", "en", 1, 2)], "doc_id string, text string, lang string, id int, mask int")
    got = result(audit_filters(odd, spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")))
    assert got["en", "EABCD", 1] == [1, 1, 0, 0, 1, 0, 60]


def test_audit_matches_its_sql(spark):
    import duckdb

    from tokenledger.llm.queries import op13_filter_audit, oracle_sql
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    res = con.execute(oracle_sql()["op13_filter_audit"])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall())
    assert sorted(map(tuple, op13_filter_audit(spark, "/root/testdata/sf0.001").select(*names).collect())) == want
