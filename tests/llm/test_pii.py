import hashlib
import re

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import pii

TEXTS = [
    "Mail me at joe.doe+x@mail.example.com, or a@b.c@d.e and @x.y; also a@b and A-1@x-y.z.",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 0001.02.3.255 and 12.34.56",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 or 41111111111111110000000",
    "tel +49 (0)30 123.456-78 and +1 2 and +4930123456789012345 and ++49 30 1234567",
    "x" * 50_000, "1" * 50_000, "1.2." * 10_000, "a@" * 20_000, "", None,
    "IBAN DE89 3704 0044 0532 0130 00 ON and GB82WEST12345698765432 or DE89370400440532013001",
    "é𝄞 ü@ex.org √4111111111111111",
    "ssn 123-45-6789 but 123-45-6789",
]


def luhn(d):
    return sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """The contract, by plain patterns (for texts on which those end in time)."""
    found = []
    for order, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                     r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (order == 0 or order == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or order == 2 and 12 <= len(digits) <= 19 and luhn(digits) or order == 3 and 9 <= len(digits) <= 15):
                found.append((m.start(), order, m.end()))
    return [(pii.KINDS[o], s, e) for s, o, e in sorted(found)]


def test_base_spans_are_the_contracts(spark, small_docs):
    texts = [t for t in TEXTS if len(t or "") < 1000] + [r.text for r in small_docs.collect()]
    for t in texts:
        assert [x[:3] for x in pii.spans(t) if x[0] in pii.BASE_KINDS] == base(t)


def test_long_runs_take_little_time():
    for t in TEXTS:
        pii.spans(t)


def test_checksums_and_context():
    assert [x[:3] for x in pii.spans(TEXTS[10]) if x[0] == "iban"] == [("iban", 5, 32), ("iban", 40, 62)]
    assert [x[0] for x in pii.spans("number 123-45-6789")] == []
    assert [x[0] for x in pii.spans("my SSN 123-45-6789")] == ["ssn"]
    assert pii.score("call +49 30 1234567", "phone", 5, 19) > pii.score("it is +49 30 1234567", "phone", 6, 20)


def test_query_columns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.summary(pii.find_pii(df)).collect()}
    for i, t in enumerate(TEXTS):
        if len(t or "") < 1000:
            want = base(t)
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
            assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [rows[i][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in want) for k in pii.BASE_KINDS]
    assert rows[10].spans.count("iban") == 2


def test_redaction(spark, edge_docs, no_docs):
    assert pii.redacted("write joe@x.org, now") == "write [EMAIL], now"
    assert pii.redacted(None) is None and pii.redacted("") == ""
    clean = pii.redact(edge_docs)
    assert clean.columns == edge_docs.columns and clean.exceptAll(edge_docs).count() == 0
    assert pii.redact(no_docs).count() == 0 and pii.find_pii(no_docs).count() == 0
    assert pii.find_pii(edge_docs).count() == edge_docs.count()


def test_ibans_in_a_row():
    one, two = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for text in (f"{one} {two}", f"{two} {one}", f"{one} {two} {one}", f"AB12 CDEF GHIJ {one}", f"DE88 3704 0044 0532 0130 00 {two}"):
        want = sorted((text.find(code, at), text.find(code, at) + len(code)) for code in (one, two) for at in range(len(text)) if text.startswith(code, at))
        assert [x[1:3] for x in pii.spans(text) if x[0] == "iban"] == want
    assert pii.redacted(f"{one} {two}") == "[IBAN] [IBAN]"
    assert len(pii.spans("AB12 " * 20_000)) == 0
