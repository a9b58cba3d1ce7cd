"""WARC archives: files as other tools see them, and records against a plain computation."""

import glob
import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tapewright.llm import warc  # noqa: E402

SCHEMA = "page_id long, url string, html string"


def brute(rows, least=1000):
    kept, counts = {}, {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            counts[body] = counts.get(body, 0) + 1
            kept[body] = max((i for i in (kept.get(body), page_id) if i is not None), default=None)
    out = []
    for page_id, url, html in rows:
        body = (html or "").encode()
        main = kept.get(body)
        again = main is not None and main != page_id
        shown = (url or "").replace("\r", "%0D").replace("\n", "%0A") or None
        out.append((page_id, shown, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", main if again else None))
    return sorted(out, key=repr)


def pages():
    draw = random.Random(4)
    same = "<p>" + "same page " * 200
    rows = [(i, f"http://a/{i}", draw.choice([same, same, "short", same[:999], same[:1000], "é" * 600, f"own {i}\r\n\r\n" * 90])) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://b/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", same), (None, "u", "odd" * 500)]
    rows += [rows[3], (103, "http://long", "0123456789" * 300_000), (-5, "n", same), (104, "nul", "a\x00b퟿\U0001f600")]
    return rows + [(105, "u", "odd" * 500), (106, "only ids", "twin" * 400), (106, "only ids", "twin" * 400)]


def test_archives_give_back_every_page(spark, tmp_path, monkeypatch):
    rows = pages()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 20)
    monkeypatch.setattr(warc, "CHUNK", 7)
    monkeypatch.setattr(warc, "LINES", 5)
    made = warc.archived(frame, str(tmp_path))
    want = brute(rows)
    assert sorted(map(tuple, made.collect()), key=repr) == want
    assert {r[4] for r in want} == {"response", "revisit"}

    whole = sorted(glob.glob(f"{tmp_path}/monolithic/*.gz"))
    assert len(whole) > 3
    for name in whole:  # one stream each
        stream = zlib.decompressobj(31)
        assert stream.decompress(open(name, "rb").read()) is not None and stream.eof and not stream.unused_data
    text = b"".join(gzip.open(n).read() for n in whole)
    count = 0
    for name in glob.glob(f"{tmp_path}/members/*.warc.gz"):
        raw, at = open(name, "rb").read(), 0
        assert gzip.decompress(raw) in text
        for line in open(name + ".idx"):
            offset, length, record_id, kind, size = line.rstrip("\n").split("\t")
            assert int(offset) == at
            record = gzip.decompress(raw[at : at + int(length)])
            head, _, block = record.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n") and record_id.encode() in head and f"WARC-Type: {kind}".encode() in head
            assert len(block) == int(size) + 4 and block.endswith(b"\r\n\r\n")
            at += int(length)
            count += 1
        assert at == len(raw)
    assert count == len(rows)


def test_odd_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "x" * 2000), (2, "u", "x" * 2000)], SCHEMA)
    assert warc.archived(frame.where("false")).count() == 0
    clash = frame.select("*", F.lit(1).alias("HTML"), F.lit("z").alias("body"), F.lit("z").alias("digest"), F.lit(3).alias("page.id"))
    assert sorted(map(tuple, warc.archived(clash).collect()), key=repr) == brute([tuple(r) for r in frame.collect()])
    nobody = spark.createDataFrame([(None, None, "x" * 2000)] * 2, SCHEMA)
    assert [r["record_type"] for r in warc.archived(nobody).collect()] == ["response"] * 2


def record(body, says=None):
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {len(body) if says is None else says}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_foreign_streams_are_cut_at_records():
    bodies = [b"", b"a\r\n\r\nb", bytes(range(256)) * 5000, b"end"]
    one = gzip.compress(b"".join(map(record, bodies)))
    several = b"".join(gzip.compress(record(b)) for b in bodies)
    for source in (one, several, gzip.compress(b"".join(map(record, bodies[:2]))) + gzip.compress(b"".join(map(record, bodies[2:])))):
        sink = io.BytesIO()
        lines = list(warc.rewrite(io.BytesIO(source), sink))
        assert [gzip.decompress(sink.getvalue()[o : o + n]) for o, n, *_ in lines] == list(map(record, bodies))
    assert list(warc.rewrite(io.BytesIO(b""), io.BytesIO())) == []
    for broken in (one[:-40], gzip.compress(record(b"abc", 9)), gzip.compress(record(b"abc", 1)), gzip.compress(b"no record\r\n\r\n"), b"plain"):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.rewrite(io.BytesIO(broken), io.BytesIO()))


def test_a_record_that_was_changed_is_refused(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "good text")], SCHEMA).coalesce(1)
    warc.write_monolithic(frame, f"{tmp_path}/one")
    (name,) = glob.glob(f"{tmp_path}/one/*.gz")
    raw = gzip.open(name).read().replace(b"good text", b"evil text")
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "changed.warc.gz").write_bytes(gzip.compress(raw))
    index = warc.normalise(spark, f"{tmp_path}/two", f"{tmp_path}/out")
    with pytest.raises(Exception, match="does not hold what its head says"):
        warc.read_back(index).collect()
