"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust
the score.

The four base kinds (email, ip, card, phone) are reported wherever their pattern and test say
so.  Further kinds are reported when their score reaches the threshold: a kind starts at the
score that its pattern earns, a checksum that holds (mod 97 of an IBAN, the weighted digits of
a routing number) adds to it, words of the kind's subject near the span add and words of other
numbering (order, version, serial ...) take away.  Base spans carry the same score, so a
reader can rank them, but stay whatever it is.  A further span that overlaps a base span or a
kind listed before it is left out.

Every search is linear in the text: a run of pattern characters is entered at its start only.

Defined cases: null and empty texts have no spans (zeros, the digest of the empty string, empty
lists); offsets are code points, the end exclusive; spans come by kind as listed, then start;
null keys, repeated rows and extra columns of any name are fine (only key and text are read);
an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.shared import per_block, sql_type

Span = tuple[int, int]

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "routing", "ssn", "local_phone", "secret")
THRESHOLD = 0.6
CONTEXT_CHARS = 60
NEAR, FAR = 0.3, -0.3

#: Score of a kind's pattern alone, and what a passed checksum adds.
PATTERN_SCORE = {"email": 0.9, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.3, "routing": 0.1, "ssn": 0.4, "local_phone": 0.4, "secret": 0.3}
CHECKED = {"card": 0.4, "iban": 0.5, "routing": 0.3}
#: Words that speak for a kind, in the four languages of the corpus, and against any.
SUBJECT = {
    "email": {"email", "mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login", "adresse", "servidor"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "karte", "carte", "tarjeta", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell", "telefon", "telefono", "teléfono", "téléphone", "handy"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta", "bic", "swift"},
    "routing": {"routing", "aba", "rtn", "bank", "transit"},
    "ssn": {"ssn", "social", "security"},
    "local_phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell", "telefon", "telefono", "teléfono", "téléphone", "handy"},
    "secret": {"token", "key", "secret", "password", "passwd", "apikey", "api", "bearer", "credential", "auth"},
}
AGAINST = {"version", "order", "invoice", "isbn", "issn", "serial", "part", "sku", "release", "build", "commit", "checksum", "sha1", "sha256", "md5"}
#: Length of an IBAN by country.
IBAN_LENGTH = {"AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
               "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
               "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26, "UA": 29}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
ROUTING = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 of an IBAN without blanks: country and check digits go to the end,
    letters count from 10 on."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def routing_sum(digits: str) -> bool:
    return sum(w * int(c) for w, c in zip((3, 7, 1) * 3, digits)) % 10 == 0 and digits != "0" * 9


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches: the name before an @ reaches back to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        done = host.end() if host else at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := "".join(DIGITS.findall(m.group()))) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 9 <= len(DIGITS.findall(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[Span]:
    for m in IBAN.finditer(text):
        need, end = IBAN_LENGTH.get(m.group()[:2], 0), m.start()
        while need and end < m.end():
            need -= text[end] != " "
            end += 1
        if not need and m.group()[:2] in IBAN_LENGTH and not text[end: end + 1].isalnum() and mod97(text[m.start(): end].replace(" ", "")):
            yield m.start(), end


def routings(text: str) -> Iterator[Span]:
    return (m.span() for m in ROUTING.finditer(text) if routing_sum(m.group()))


def ssns(text: str) -> Iterator[Span]:
    return (m.span() for m in SSN.finditer(text)
            if m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000")


def local_phones(text: str) -> Iterator[Span]:
    return (m.span() for m in LOCAL_PHONE.finditer(text))


def secrets(text: str) -> Iterator[Span]:
    """Runs that mix letters and digits with many different characters."""
    return (m.span() for m in SECRET.finditer(text)
            if len(set(m.group())) >= 10 and re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group()))


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "routing": routings, "ssn": ssns,
           "local_phone": local_phones, "secret": secrets}


def score(text: str, kind: str, span: Span, context: int = CONTEXT_CHARS) -> float:
    """Pattern, checksum (only spans that pass it get here), then the words nearby."""
    s, e = span
    near = {w.lower() for w in WORD.findall(text[max(0, s - context): s]) + WORD.findall(text[e: e + context])}
    total = PATTERN_SCORE[kind] + CHECKED.get(kind, 0.0) + NEAR * bool(near & SUBJECT[kind]) + FAR * bool(near & AGAINST)
    return min(1.0, max(0.0, total))


@dataclass
class Found:
    """Spans by kind, in listed order, with their scores."""
    spans: dict[str, list[Span]]
    scores: dict[str, list[float]]

    def listed(self, kinds: tuple[str, ...]) -> str:
        return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in self.spans[k])


def find_spans(text: str | None, threshold: float = THRESHOLD, context: int = CONTEXT_CHARS) -> Found:
    text = text or ""
    out = Found({}, {})
    taken: list[Span] = []
    for kind in BASE_KINDS:
        out.spans[kind] = list(FINDERS[kind](text))
        out.scores[kind] = [score(text, kind, x, context) for x in out.spans[kind]]
        taken += out.spans[kind]
    for kind in MORE_KINDS:
        found = [(x, score(text, kind, x, context)) for x in FINDERS[kind](text)]
        good = free([x for x, p in found if p >= threshold], taken)
        scores = dict(found)
        out.spans[kind], out.scores[kind] = good, [scores[x] for x in good]
        taken += good
    return out


def free(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans (ascending, apart from each other) that overlap none of ``taken``."""
    if not spans or not taken:
        return spans
    out, ends, i = [], 0, 0
    order = sorted(taken)
    for s, e in spans:
        while i < len(order) and order[i][0] < e:
            ends = max(ends, order[i][1])
            i += 1
        if ends <= s:
            out.append((s, e))
    return out


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                  context: int = CONTEXT_CHARS) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, scores), a row a
    document; the counts and the digest are of the base kinds, ``scores`` follows ``spans``."""
    def run(t: pa.Table) -> pa.Table:
        found = [find_spans(x, threshold, context) for x in t.column("text").to_pylist()]
        cols: dict = {"key": t.column("key")}
        for kind in BASE_KINDS:
            cols[f"n_{kind}"] = pa.array([len(f.spans[kind]) for f in found], pa.int64())
        cols["base_sha256"] = [hashlib.sha256(f.listed(BASE_KINDS).encode()).hexdigest() for f in found]
        cols["spans"] = [f.listed(BASE_KINDS + MORE_KINDS) for f in found]
        cols["n_added"] = pa.array([sum(len(f.spans[k]) for k in MORE_KINDS) for f in found], pa.int64())
        cols["scores"] = [",".join(f"{p:.2f}" for k in BASE_KINDS + MORE_KINDS for p in f.scores[k]) for f in found]
        return pa.table(cols)

    out = per_block(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", run,
                    f"key {sql_type(docs, key)}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                    "spans string, n_added long, scores string")
    return out.withColumnRenamed("key", key)
