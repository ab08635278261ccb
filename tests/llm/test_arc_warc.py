import gzip
import hashlib

import pytest

from repotrend.llm import arc_warc as aw
from repotrend.llm.scratch import Scratch


def expected(pages):
    out, first = [], {}
    for i, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, i), i)
    for i, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first[raw] != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
    return sorted(out)


def test_round_trip(spark):
    long = "payload with é and\r\n\r\nempty lines\n" * 10
    rows = [(k, f"http://x.org/{k}", [long, long + "x", "short", "short", None, "", "WARC/1.1\r\n\r\n" * 20, "x" * 99, "y" * 100][k % 9]) for k in range(60)]
    df = spark.createDataFrame([(i, u, h, "z", 1) for i, u, h in rows], "page_id long, url string, html string, type string, first int").repartition(4)
    folder = aw.convert_pages(df)
    got = sorted(map(tuple, aw.page_records(spark, folder).collect()), key=lambda r: r[0])
    assert got == expected([(i, h) for i, _, h in rows])
    full = aw.read_warc(spark, folder).collect()
    payload = {r.page_id: bytes(r.payload) for r in full if r.record_type == "response"}
    assert all(payload[i] == (h or "").encode() for i, _, h in rows if i in payload) and len({r.record_id for r in full}) == 60


def test_both_versions_and_kinds():
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\n<p>\n\n2000 hello</p>"
    for version in (1, 2):
        text = aw.version_block(version) + "\n"
        text += f"{aw.arc_header(version, 'http://a b.org/x y', '199612312359', 'text/html', body)}\n{body.decode()}\n"
        text += f"{aw.arc_header(version, 'dns:a.org', '19961231', 'text/dns', b'1.2.3.4')}\n1.2.3.4\n"
        for data in (text.encode(), gzip.compress(text[:40].encode()) + gzip.compress(text[40:].encode())):
            made = [aw.convert("a.arc", r) for r in aw.read_arc(data)]
            assert [m[3] for m in made] == ["warcinfo", "response", "resource"]
            assert made[1][1] == "http://a b.org/x y" and made[1][2] == "1996-12-31T23:59:00Z" and made[1][5] == 5
            assert made[1][7] == body.partition(b"\r\n\r\n")[2] and made[2][2] == "1996-12-31T00:00:00Z" and made[2][7] == b"1.2.3.4"
            assert made == [aw.convert("a.arc", r) for r in aw.read_arc(data)]


def test_broken_archives_are_errors():
    text = aw.version_block(1) + "\n" + aw.arc_header(1, "http://a", "19961231", "text/html", b"12345") + "\n12"
    with pytest.raises(ValueError, match="within a record"):
        list(aw.read_arc(text.encode()))
    with pytest.raises(ValueError, match="not an ARC"):
        list(aw.read_arc(b"hello\n"))


def test_edge_rows(spark):
    rows = [(None, None, None), (1, " ", "same " * 40), (1, "u", "same " * 40), (None, "u", "same " * 40), (2, "a\nb", "same " * 40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = aw.page_records(spark, aw.convert_pages(df)).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.payload_bytes)
    assert len(got) == 5 and [k for k in kinds if k[1] == "response"] == [(1, "response", None)] and all(k[2] in (None, 1) for k in kinds)
    assert aw.page_records(spark, aw.convert_pages(df.limit(0))).count() == 0
    aw.write_arc(df, Scratch(spark).path("arc"))
