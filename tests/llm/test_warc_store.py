import hashlib

import pytest

from star_marts.llm import warc_store as m
from star_marts.session import scratch_path

LONG = "<p>é" + "x" * 2000


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"http://a/{i}", LONG) for i in range(10)] + [(20, "http://b\r\nWARC-Type: revisit", "short"), (21, None, "short")]
    out += [(30, "u", None), (31, "u", ""), (40, "v", "y" * 999), (41, "v", "y" * 999), (50, "w", "z" * 1000), (51, "w", "z" * 1000)]
    return out + [(60, "r", "q" * 1500), (60, "r", "q" * 1500), (61, "r", "k" * 1500), (61, "r", "other"), (None, "n", LONG), (None, "n", "m" * 1200), (-5, "neg", "m" * 1200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS payload", "1 AS copies", "2 AS header", "3 AS sha1"
    )


def plain(rows):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = i is not None and len(body) >= 1000 and i < last[h or ""]
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last[h or ""] if revisit else None))
    return sorted(map(str, out))


def test_round_trip(spark, rows):
    assert sorted(str(tuple(r)) for r in m.archive_round_trip(frame(spark, rows)).collect()) == plain(rows)
    assert m.archive_round_trip(frame(spark, rows).limit(0)).count() == 0


def test_payloads_are_stored_once_and_records_are_exact(spark, rows):
    path = scratch_path(spark, "warc-test")
    m.write_archive(frame(spark, rows), path)
    assert spark.read.parquet(f"{path}/blobs").count() == len({h or "" for _, _, h in rows})
    found = m.records(spark, path).collect()
    assert len(found) == len(rows)
    for r in found:
        header, payload = bytes(r.header), bytes(r.payload)
        assert bytes(r.record) == header + payload + b"\r\n\r\n"
        assert header.startswith(b"WARC/1.1\r\n") and header.endswith(b"\r\n\r\n") and header.count(b"\r\n\r\n") == 1
        assert f"Content-Length: {len(payload)}\r\n".encode() in header
        assert hashlib.sha1(payload).hexdigest().encode() in header


def test_a_changed_payload_is_an_error(spark):
    path = scratch_path(spark, "warc-test")
    m.write_archive(frame(spark, [(1, "u", "some text")]), path)
    found = m.records(spark, path)
    assert m.parse(found).count() == 1
    for record, sha256 in (
        ("CAST(replace(string(record), 'some text', 'Some text') AS binary) AS record", "sha256"),
        ("CAST(replace(string(record), 'some text', 'some') AS binary) AS record", "sha256"),
        ("record", "sha2('other', 256) AS sha256"),
    ):
        with pytest.raises(Exception, match="differs from its header"):
            m.parse(found.selectExpr(record, sha256)).collect()


@pytest.mark.parametrize("end", ["\x85", "\u2028", "\u2029", "\x0b", "\x0c", "\n", "\r", "\r\n"])
def test_a_url_cannot_add_header_lines(spark, end):
    lie = f"http://a{end}WARC-Refers-To: <urn:page:77>{end}WARC-Payload-Digest: sha1:{'0' * 40}{end}Content-Length: 3"
    rows = [(1, lie, "short"), (2, lie, LONG), (3, "u", LONG), (4, "u", "a\r\n\r\nWARC-Type: revisit" + LONG)]
    assert sorted(str(tuple(r)) for r in m.archive_round_trip(frame(spark, rows)).collect()) == plain(rows)


def test_revisits_name_their_profile(spark):
    path = scratch_path(spark, "warc-test")
    m.write_archive(frame(spark, [(1, "u", LONG), (2, "v", LONG)]), path)
    headers = {bytes(r.header).decode() for r in m.records(spark, path).collect()}
    assert {("WARC-Type: revisit" in h, f"WARC-Profile: {m.PROFILE}" in h) for h in headers} == {(True, True), (False, False)}
