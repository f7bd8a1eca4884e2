"""WARC: exact round trips over small chunks and many files, and damaged archives."""
import gzip
import hashlib
import io

import pytest

from eventide.llm import op5_warc as op5

LONG = "<p>" + "é<b>text</b>\r\n\r\nWARC/1.1\r\n" * 400
ROWS = [(5, "http://a/1", LONG), (2, "http://a/2\r\nx", LONG), (9, None, LONG), (None, "http://n", LONG), (2, "http://a/2", LONG), (11, "http://a/3%0A", LONG + "!"),
        (1, "u", None), (3, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", "x" * 100), (8, "u", "x" * 100), (10, "u", "x" * 99), (12, "u", "x" * 99)]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "d") for i, u, h in rows], "page_id long, url string, html string, rid long, digest string")


def brute(rows):
    out, first = [], {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    for k in order:
        i, _, h = rows[k]
        raw = (h or "").encode()
        again = len(raw) >= 100 and raw in first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None, True))
        first.setdefault(raw, i)
    return sorted(out, key=repr)


def test_round_trip_against_brute_force(spark):
    got = op5.round_trip(frame(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)
    assert op5.round_trip(frame(spark, [])).collect() == []


def test_chunks_give_back_the_payloads(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    pages = frame(spark, ROWS)
    manifest = op5.write_archives(pages, folder, chunk_bytes=64, file_bytes=300)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == len(ROWS)
    rows = op5.read_archives(manifest, folder, chunk_bytes=50).collect()
    records = {}
    for r in rows:
        records.setdefault(r.record_id, []).append(r)
    assert len(records) == len(ROWS)
    payloads = []
    for own in records.values():
        own.sort(key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in own] == list(range(len(own))) and [r.is_last for r in own].index(True) == len(own) - 1
        seen = b""
        for r in own:
            assert len(r.chunk) <= 50
            seen += bytes(r.chunk)
            assert r.bytes_so_far == len(seen) and r.sha256_so_far == hashlib.sha256(seen).hexdigest()
        if own[0].record_type == "response":
            payloads.append((own[0].page_id, own[0].url, seen))
    want = {(i, u, (h or "").encode()) for i, u, h in ROWS}
    assert set(payloads) <= want and {p[2] for p in payloads} == {w[2] for w in want}


def test_files_are_plain_warc(spark, tmp_path):
    op5.write_archives(frame(spark, ROWS[:2] + ROWS[8:9]).coalesce(1), f"file://{tmp_path}/w")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").iterdir())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and text.endswith(b"\r\n\r\n")


@pytest.mark.parametrize("harm", [lambda b: b[:-3], lambda b: b[:len(b) // 2], lambda b: b"x" + b])
def test_a_damaged_archive_is_an_error(spark, tmp_path, harm):
    op5.write_archives(frame(spark, ROWS[:1]).coalesce(1), f"file://{tmp_path}/w")
    raw = next(p for p in (tmp_path / "w").iterdir()).read_bytes()
    assert len(list(op5.records(io.BytesIO(raw), 1000))) > 3
    with pytest.raises(Exception):
        list(op5.records(io.BytesIO(harm(raw)), 1000))
