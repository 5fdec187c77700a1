"""Personal data in texts: patterns propose, checksums confirm, nearby words weigh."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import prepare

BASE = ("email", "ip", "card", "phone")
LEAST = 0.5  # score a span of another kind must reach
NEAR = 48  # characters before and after a span in which context counts

# Characters of an address's first part, and the patterns of kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")

# Score of a proposed span, and words nearby that raise it.
_SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "secret": 0.3}
_CONTEXT = {
    "email": re.compile(r"mail|contact|write to", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login", re.I),
    "card": re.compile(r"card|visa|credit|debit|pay", re.I),
    "phone": re.compile(r"phone|call|tel\b|mobile|fax", re.I),
    "iban": re.compile(r"iban|bank|account|konto|transfer", re.I),
    "ssn": re.compile(r"\bssn\b|social security|tax", re.I),
    "secret": re.compile(r"token|secret|passw|api.?key|credential", re.I),
}
_RAISE = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number, its first four signs put last, leaves 1 (letters are 10 to 35)."""
    rest = 0
    for c in text[4:] + text[:4]:
        value = int(c, 36)
        rest = (rest * (10 if value < 10 else 100) + value) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        # A run before the next sign cannot start earlier.
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    found = _IBAN.search(text)
    while found:
        start, end = found.span()
        # The last groups may be words behind the number.
        while not mod97(text[start:end].replace(" ", "")):
            end = text.rfind(" ", start, end)
            if end < 0 or not _IBAN.fullmatch(text, start, end):
                break
        else:
            yield start, end
            start = end - 1
        found = _IBAN.search(text, start + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _in_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start; code points, end exclusive."""
    text = text or ""
    found: dict[str, list[tuple[int, int]]] = {"email": list(_emails(text)) if "@" in text else []}
    if _DIGIT.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_in_byte, m[0].split(".")))]
        found["card"] = [m.span() for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15] if "+" in text else []
        found["iban"] = list(_ibans(text))
        found["ssn"] = [m.span() for m in _SSN.finditer(text)]
        found["secret"] = [m.span() for m in _SECRET.finditer(text)]
    out = []
    for kind, places in found.items():
        for start, end in places:
            near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
            score = min(1.0, _SCORES[kind] + _RAISE * bool(_CONTEXT[kind].search(near)))
            if kind in BASE or score >= LEAST:
                out.append((kind, start, end, score))
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All personal data of every document.

    One row per input row: the id and ``spans`` (kind, start, end, score), by kind
    and start. Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are kept
    whatever their score; ``iban`` (mod 97), ``ssn`` and ``secret`` if they reach
    ``LEAST`` by checksum or context. Spans of a kind never overlap, those of
    different kinds may. Null and empty texts have none; every row is looked at by
    itself, whole; no other columns are read.
    """
    prepare(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def search(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "score")
        return pa.array([[dict(zip(names, s)) for s in spans(t)] for t in texts.to_pylist()], kind)

    return docs.select(F.col(id_col), search(F.col(text_col)).alias("spans"))
