import gzip
import hashlib
import os

from tillcast.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, offset int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def brute(rows):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = max(same) if same else None
        revisit = len(raw) >= 1000 and first is not None and i != first and len(same) + (i is None) > 1
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "x" * 1000),
    (2, "http://a/2", "x" * 1000),
    (3, None, "x" * 999),
    (4, "http://a/4\r\nX: y", "x" * 999),
    (5, "", None),
    (6, "u", ""),
    (7, "u", "WARC/1.1\r\n\r\n body \r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "é\U0001f642" * 900),
    (8, "u", "y" * 3_000_000),
    (9, "u", "y" * 3_000_000),
    (10, "u", "z" * 2000),
    (10, "u", "z" * 2000),
    (None, "u", "q" * 1500),
]


def test_round_trip_equals_brute_force(spark):
    got = warc.archive_round_trip(pages(spark, ROWS))
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == brute(ROWS)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_members_stand_alone(spark, tmp_path):
    planned = warc.plan_records(pages(spark, ROWS)).repartition(2)
    warc.write_monolithic(warc.record_text(planned), str(tmp_path / "raw"))
    index = warc.normalise(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    lines = index.collect()
    assert len(lines) == len(ROWS)
    for r in lines:
        path = r.archive.removeprefix("file://")
        with open(path, "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(warc.END) and r.record_id.encode() in raw
    # the archive as a whole still reads as one stream
    for name in os.listdir(tmp_path / "out"):
        if name.endswith(".warc.gz"):
            whole = gzip.open(tmp_path / "out" / name).read()
            assert sum(1 for _ in warc.parse_records(iter([whole]))) > 0
    assert all(r.body_ok for r in warc.read_records(index).collect())


def test_inflate_takes_any_cut():
    data = os.urandom(300_000) + b"a" * 300_000
    stream = gzip.compress(data[:1000]) + gzip.compress(data[1000:])
    for step in (1, 977, 1 << 20):
        pieces = (stream[i : i + step] for i in range(0, len(stream), step))
        if step == 1:
            pieces = iter([stream[:5000][i : i + 1] for i in range(5000)] + [stream[5000:]])
        assert b"".join(warc.inflate(pieces)) == data
