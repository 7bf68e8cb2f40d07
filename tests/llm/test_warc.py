import gzip
import io
import random

import pytest

from beaconlake.llm import warc

SCHEMA = "page_id long, url string, html string"


def slow(rows):
    groups = {}
    for p, _, h in rows:
        groups.setdefault(h or "", []).append(p)
    out = []
    for p, _, h in rows:
        raw, top = (h or "").encode(), max(groups[h or ""])
        out.append((p, len(raw), warc.digest(raw), "revisit" if p < top else "response", top if p < top else None))
    return sorted(out)


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(i * 3, f"http://h/{i}", rng.choice(["", None, "same", "é\r\n\r\nWARC/1.1", "x" * rng.randrange(5000)])) for i in range(300)]
    rows.append((9999, None, "漢" * 1_500_000))
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == slow(rows)


def test_members_stand_alone_and_streams_may_have_several():
    records = [warc.record(i, f"u {i}", b"b" * n, "response", warc.digest(b"b" * n), None) for i, n in enumerate([0, 5, 3_000_000])]
    for stream in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        out = io.BytesIO()
        index = list(warc.normalise(io.BytesIO(stream), out))
        assert [gzip.decompress(out.getvalue()[o : o + n]) for _, o, n in index] == records
    for broken in (gzip.compress(b"".join(records))[:-20], gzip.compress(b"".join(records)[:-9]), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.normalise(io.BytesIO(broken), io.BytesIO()))


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    got = {r.page_id: r.record_type for r in warc.typed(pages, 3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_nulls_repeats_extra_columns_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "a", "r"), (1, "u", "a", "s"), (None, None, "a", "t"), (0, None, None, None)], SCHEMA + ", record_type string")
    got = sorted((r.page_id, r.record_type) for r in warc.round_trip(pages).collect())
    assert got == [(0, "response"), (1, "response"), (1, "response")]
    assert warc.round_trip(pages.limit(0)).collect() == []
