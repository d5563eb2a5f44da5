"""Archives: written, indexed, looked up and read back exactly."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from circulation.llm import warc


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = [(i, f"http://h{i % 4}.example.org/p{i % 9}?q={i}", f"<p>{i % 23}</p>" * (i % 5)) for i in range(120)] + [
    (500, None, "x"), (501, "", None), (502, "http://e.org/a b\r\n\t%", ""), (503, "http://e.org/é", "ü" * 30_000),
    (None, "http://n.org/", "<p>only</p>"), (None, "http://n.org/", "x"), (7, "http://h3.example.org/p7?q=7", "<p>7</p>" * 2),
    (504, "http://h3.example.org/p7?q=7", "WARC/1.1\r\n\r\nnot a header")]


def expected(rows, min_bytes=0):
    first = {}
    for k, _, html in rows:
        p = (html or "").encode()
        if k is not None and len(p) >= min_bytes:
            first[p] = min(k, first.get(p, k))
    out = []
    for k, url, html in rows:
        p = (html or "").encode()
        revisit = len(p) >= min_bytes and p in first and first[p] != k
        safe = (url or "").replace("\r", "%0D").replace("\n", "%0A")
        out.append((k, safe, len(p), digest(p), "revisit" if revisit else "response", first[p] if revisit else None, None if revisit else p))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes,at_once", [(0, 200_000), (9, 3)])
def test_round_trip_through_the_index(cluster, min_bytes, at_once):
    pages = cluster.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string").repartition(3)
    captures = warc.write_archives(pages, min_bytes=min_bytes)
    directory = warc.build_index(captures, block_lines=7)
    assert directory.count() > 15
    places = warc.look_up(captures, directory, rows_at_once=at_once)
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read_records(places).collect()]
    assert sorted(got, key=repr) == expected(PAGES, min_bytes)


def test_files_are_gzipped_warc_and_lookups_miss(cluster):
    pages = cluster.createDataFrame(PAGES[:30], "page_id long, url string, html string").coalesce(1)
    captures = warc.write_archives(pages)
    place = captures.orderBy("start").collect()
    system, path = warc.storage(place[0]["file"])
    with system.open_input_file(path) as f:
        data = f.read()
    whole = gzip.decompress(data)
    assert whole.count(b"WARC-Type: ") == 30 and whole.startswith(b"WARC/1.1\r\n")
    assert sum(r["length"] for r in place) == len(data)
    directory = warc.build_index(captures, block_lines=4)
    missing = cluster.createDataFrame([("zz) 1",), ("aa) 1",), (place[0]["key"],)], "key string")
    assert [r["key"] for r in warc.look_up(missing, directory).collect()] == [place[0]["key"]]


def test_no_pages_and_damage(cluster):
    empty = cluster.createDataFrame([], "page_id long, url string, html string")
    captures = warc.write_archives(empty)
    assert warc.read_records(warc.look_up(captures, warc.build_index(captures))).collect() == []
    good = warc.record(1, "http://a/", b"abc", digest(b"abc"), None)
    assert warc.parse(good)[0] == 1
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"))
