"""WARC: round trips, any split, false magic numbers, revisits and damaged files."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roomgrid.llm import warc as W
from roomgrid.session import shared_dir

SCHEMA = "page_id long, url string, html string, digest string, payload string, first string, n long"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", 1) for r in rows], SCHEMA)


def _trip(spark, rows, split, **more):
    folder = shared_dir(spark, "warc")
    manifest = W.write_warc(_frame(spark, rows).repartition(3), folder, **more)
    return manifest, W.read_warc(spark, folder, manifest, split).collect()


def test_round_trip_under_any_split(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 5}/ä\r\nX: {i}%0A", "".join(rng.choice("abc <>\n\r漢é") for _ in range(rng.choice([0, 3, 99, 100, 4000])))) for i in range(60)]
    rows += [(100 + i, None, "same " * 50) for i in range(9)] + [(200 + i, "u", "short") for i in range(3)]
    rows += [(300, "u", None), (301, "u", ""), (None, "u", "same " * 50), (50_000, "u", "long " * 200_000), (100, None, "same " * 50)]
    for split in (97, 1000, 1 << 20):
        manifest, got = _trip(spark, rows, split, file_bytes=3000)
        assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
        want = []
        for page, url, html in rows:
            data = (html or "").encode()
            later = html == "same " * 50 and page != 100
            want.append((page, url, "revisit" if later else "response", 100 if later else None, len(data), hashlib.sha256(data).hexdigest(), None if later else data))
        assert sorted(map(str, want)) == sorted(str(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)) for r in got)


def test_every_range_owns_what_starts_in_it():
    rng = random.Random(2)
    inner = gzip.compress(b"not a record " * 3)
    raws = [W.render_record(i, "u", bytes(rng.randrange(256) for _ in range(rng.choice([1, 50, 700]))) + inner, "00", "revisit" if i % 3 == 0 else "response", i) for i in range(20)]
    stored = lambda raw: (lambda c: c.compress(raw) + c.flush())(zlib.compressobj(0, zlib.DEFLATED, 31))
    data = b"".join(map(stored, raws))  # not compressed: the inner magic numbers stand in the file
    assert data.count(W._MAGIC) > len(raws)
    source = W._Source(pa.BufferReader(data), len(data))
    for split in (1, 7, 100, 5000, len(data)):
        got = [m for a in range(0, len(data), split) for m in W.members(source, a, min(a + split, len(data)))]
        assert got == raws


def test_damage_is_an_error():
    raw = W.render_record(1, "u", b"x" * 300, hashlib.sha256(b"x" * 300).hexdigest(), "response", None)
    assert W.parse_record(raw)["payload_bytes"] == 300
    for bad in (raw[:-5], raw.replace(b"xxx", b"xyx", 1), b"HTTP/1.1 200 OK\r\n\r\n"):
        with pytest.raises(ValueError):
            W.parse_record(bad)
    cut = gzip.compress(raw)[:-20]
    with pytest.raises(ValueError):
        list(W.members(W._Source(pa.BufferReader(cut), len(cut)), 0, len(cut)))


def test_empty_table(spark):
    manifest, got = _trip(spark, [], 100)
    assert manifest.count() == 0 and got == []


def test_ranges_are_read_by_many_tasks(spark):
    folder = shared_dir(spark, "warc")
    rng = random.Random(3)
    manifest = W.write_warc(_frame(spark, [(i, "u", rng.randbytes(500).hex()) for i in range(400)]).repartition(2), folder)
    per_task = W.read_warc(spark, folder, manifest, 4000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 400
    assert len(per_task) > 20 and max(r["count"] for r in per_task) < 100
