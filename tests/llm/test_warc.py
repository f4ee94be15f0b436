"""Operator 6: round trip, reader checks, SQL."""

import glob
import gzip
import random
import zlib

import pytest

from llm_helpers import duck, rows_of
from peerscope.llm import warc as W

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _archive(payloads):
    return b"".join(W.member(k, f"http://x/{k}", p, W.sha1_base32(p)) for k, p in enumerate(payloads))


@pytest.mark.parametrize("step", [1, 7, 1 << 16, 1 << 30])
def test_reader_over_pieces_of_any_size(step):
    r = random.Random(2)
    payloads = [b"", b"\r\n\r\n", b"a" * 300_000, r.randbytes(70_000), b"WARC/1.0\r\n\r\n" * 9, b"z"]
    if step == 1:
        payloads[2] = b"a" * 3000
        payloads[3] = r.randbytes(2000)
    raw = _archive(payloads) + b"\0\0"
    got = list(W.WarcReader((raw[k:k + step] for k in range(0, len(raw), step)), keep=True))
    assert [x["payload"] for x in got] == payloads and [x["payload_bytes"] for x in got] == [len(p) for p in payloads]


def _spoiled(change):
    raw = zlib.decompress(_archive([b"hello world"]), 31)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(change(raw)) + z.flush()


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"hello", b"jello"), lambda r: r[:-2], lambda r: r.replace(b"WARC/1.0", b"WORC/1.0"), lambda r: r[:40],
    lambda r: r + b"x"])
def test_damage_is_found(change):
    with pytest.raises(W.WarcError):
        list(W.WarcReader([_spoiled(change)]))
    with pytest.raises(W.WarcError):
        list(W.WarcReader([_archive([b"hello"])[:-9]]))


def _pages(spark):
    rows = [(1, "http://a/ b\nc", "same"), (2, None, "same"), (9, "http://é", "same"), (3, "u", None), (4, "u", ""), (5, "u", "only"),
            (6, "u", "tie"), (6, "u", "tie"), (7, "u", "x" * 2_000_000), (8, "", "é😀")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as payload", "3 as last")


def test_round_trip_and_sql(spark, tmp_path):
    pages = _pages(spark)
    path = str(tmp_path / "w")
    got = W.round_trip(pages, path, records_per_archive=3)
    assert rows_of(got.select(*COLUMNS)) == duck(W.ORACLE_SQL, pages=pages.select("page_id", "html").toPandas())
    url = {r.page_id: r.url for r in got.collect()}
    assert url[1] == "http://a/%20b%0Ac" and url[2] is None and url[9] == "http://%C3%A9"
    raw = b"".join(gzip.open(f).read() for f in glob.glob(path + "/part-*"))
    assert raw.count(b"WARC/1.0\r\n") == pages.count()
    kept = {r.page_id: bytes(r.payload) for r in W.read_archives(spark, path, keep_payload=True).where("record_type = 'response'").collect()}
    assert kept[7] == b"x" * 2_000_000 and kept[8] == "é😀".encode()


def test_null_ids_small_payloads_and_long_records(spark):
    rows = [(None, "u", "q"), (None, "u", "q"), (1, "u", "p"), (None, "u", "p"), (2, "u", "z" * (17 << 20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in W.round_trip(pages).collect()), key=str)
    assert got == sorted([(None, 1, "response", None), (None, 1, "response", None), (1, 1, "response", None), (None, 1, "revisit", 1),
                          (2, 17 << 20, "response", None)], key=str)
    assert W.round_trip(pages, min_revisit_bytes=2).where("record_type = 'revisit'").count() == 0


def test_empty_table_and_table(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert rows_of(W.round_trip(pages).select(*COLUMNS)) == duck(W.ORACLE_SQL, pages=pages.toPandas())


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    """Pages that do not compress: no file of several records is larger than the bound, and all records come back."""
    r = random.Random(5)
    sizes = [100] * 300 + [20_000] * 60 + [300_000] * 20 + [1_500_000] * 3 + [5_000_000]
    texts = ["".join(map(chr, r.choices(range(33, 127), k=min(n, 200_000)))) * max(1, n // 200_000) for n in sizes] + [None, "é" * 60_000] + ["same"] * 9
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("*", "'u' as url").repartition(2)
    path, bound = str(tmp_path / "w"), 2_000_000
    got = W.round_trip(pages, path, records_per_archive=100, archive_bytes=bound)
    assert rows_of(got.select(*COLUMNS)) == duck(W.ORACLE_SQL, pages=pages.select("page_id", "html").toPandas())
    per = {}
    for x in got.collect():
        per.setdefault(x.archive, []).append(0 if x.record_type == "revisit" else x.payload_bytes)
    assert all(len(v) <= 100 and (len(v) == 1 or sum(v) <= bound) for v in per.values()) and len(per) > 10
    assert W.size_classes(2000, 256 << 20)[-1] == ((256 << 20) // 3, 3)
    raw = [gzip.open(f).read().count(b"WARC/1.0\r\n") for f in glob.glob(path + "/part-*")]
    assert sum(raw) >= len(texts)
