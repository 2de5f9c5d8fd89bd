"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id")
#: Characters on each side in which context words count.
NEAR = 40
#: A span of a kind that the method adds is kept from this score on.
LEAST = 0.5

#: An address from its sign on; [A-Za-z0-9._%+-]+ stands before it.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Begins where a run of digits begins and gives none back, so that a long run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: By kind: score of a confirmed match, and words that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "national_id": 0.4}
CONTEXT = {
    "email": (("mail", "contact", "write", "reach", "send"), ("example", "noreply")),
    "ip": (("ip", "address", "server", "host", "router", "login", "subnet"), ("version", "section", "release", "chapter")),
    "card": (("card", "visa", "credit", "payment", "mastercard", "amex", "expir"), ("order", "isbn", "serial", "tracking")),
    "phone": (("phone", "call", "tel", "mobile", "fax", "whatsapp", "cell"), ("order", "serial", "score")),
    "iban": (("iban", "bank", "account", "transfer", "bic"), ()),
    "national_id": (("ssn", "social", "security", "id", "taxpayer", "born"), ("part", "serial", "order", "model")),
}


def luhn(digits: str) -> bool:
    """Whether the digits pass the check sum that doubles every second one from the right."""
    odd = sum(int(c) for c in digits[-1::-2])
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number, its first four characters put last, leaves 1."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each @ instead of from each character."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1].isascii() and (text[first - 1].isalnum() or text[first - 1] in "._%+-"):
            first -= 1
        found = _DOMAIN.match(text, at) if first < at else None
        if found:
            yield first, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for s, e in _emails(text):
        yield "email", s, e
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        if 15 <= len(c := m[0].replace(" ", "")) <= 34 and mod97(c):
            yield "iban", m.start(), m.end()
    for m in _NATIONAL.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "national_id", m.start(), m.end()


_WORDS = {k: tuple(re.compile(r"(?<![a-z])(?:" + "|".join(w) + r")", re.A) if w else None for w in pair) for k, pair in CONTEXT.items()}


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) by start, then kind as listed. Base kinds are kept at any
    score, the others from LEAST on. Missing texts have none."""
    found = []
    for kind, s, e in _proposed(text or ""):
        near = (text[max(0, s - NEAR) : s] + " " + text[e : e + NEAR]).lower()
        more, less = _WORDS[kind]
        score = SCORES[kind] + (0.2 if more and more.search(near) else 0) - (0.3 if less and less.search(near) else 0)
        score = min(1.0, max(0.0, score))
        if kind in BASE or score >= LEAST:
            found.append((kind, s, e, round(score, 3)))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_pii(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """Add the spans of personal data in the whole text: array<struct<kind,start,end,score>>.

    Places are code points, ends exclusive. A null or empty text has no spans. Other columns pass
    through, one of the same name is replaced; repeated rows get the same spans each.
    """

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in find(t if isinstance(t, str) else None)] for t in texts], dtype=object)

    return docs.withColumn(name, run(F.col(text)))
