"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Kinds, in order: email, ip, card (Luhn), phone, iban (mod 97), ssn.  The first
four are the base kinds: a match that passes its check is a span whatever its
score.  The last two are proposed more loosely and stay only if they score
``MIN_SCORE`` or more, so a bare nine-digit number without a telling word nearby
is left alone.

Offsets are code points, ends exclusive.  Patterns are applied leftmost and
non-overlapping per kind; a match that fails its check is dropped without a
retry, but for codes of iban, which are looked for again from the next word, and
after a confirmed one from its end.  All scans take time linear in the text: the local part of an address is
read backwards from its ``@``, and digit patterns start only at the start of a
run, so a text without spaces costs no more than any other.

Defined results: a null text counts as empty and has no spans; a null id is
passed through; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in their order, their scores without and with support, and words that support them.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host", "client"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "móvil"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "insurance"),
}
CONTEXT_BONUS = 0.25
CONTEXT_CHARS = 40
MIN_SCORE = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", free if domain else at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() < 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        # The pattern may run on into the next words: try the ends of its groups, longest first.
        ends = [m.end(), *(k for k in range(m.end() - 1, m.start() + 14, -1) if text[k] == " ")]
        free = m.start() + 1  # after a failed match the next word may start a code
        for end in ends:
            code = text[m.start() : end].replace(" ", "")
            if 15 <= len(code) <= 34 and mod97(code):
                yield m.start(), end
                free = end
                break
        m = _IBAN.search(text, free)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}
_DIGIT = re.compile("[0-9]")


def score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS]}".lower()
    support = not set(CONTEXT[kind]).isdisjoint(_WORD.findall(near))
    return min(1.0, SCORES[kind] + CONTEXT_BONUS * support)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind."""
    if not text:
        return []
    digits = _DIGIT.search(text)
    found = []
    for order, kind in enumerate(KINDS):
        if kind == "email" or digits:
            for start, end in _FINDERS[kind](text):
                points = score(text, kind, start, end)
                if order < len(BASE_KINDS) or points >= MIN_SCORE:
                    found.append((start, order, end, points))
    return [(KINDS[order], start, end, points) for start, order, end, points in sorted(found)]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find_pii(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, score>>), a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in spans(text.as_py())] for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN)], ["id", "spans"])

    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = docs.mapInArrow(run, "id long, spans array<struct<kind:string,start:int,end:int,score:double>>")
    return out.withColumnRenamed("id", id_col)


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")


def summary(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, all spans, and the best score of each row of ``find_pii``."""
    count = {f"n_{k}": _of_kind(k) for k in KINDS}
    base = F.filter("spans", lambda x: x.kind.isin(*BASE_KINDS))
    out = found.withColumns(count | {"base_sha256": F.sha2(joined(base), 256), "max_score": F.array_max(F.transform("spans", lambda x: x.score))})
    names = [c for c in found.columns if c != "spans"]
    return out.select(*names, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", joined(F.col("spans")).alias("spans"), "n_iban", "n_ssn", "max_score")


def redacted(text: str | None) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    found = spans(text)
    if not found:
        return text
    out, done = [], 0
    for kind, start, end, _ in found:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their spans replaced; other columns and null texts stay as they are."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py()) for t in texts], pa.string())

    return documents.withColumn(text_col, cleaned(F.col(text_col).cast("string")))
