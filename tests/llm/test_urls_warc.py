import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from pagesieve.llm import url_rules, warc
from pagesieve.llm.queries import URL_RULES


def judged_by_hand(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = rest[:end].translate(str.maketrans(url_rules.UPPER, url_rules.SMALL))
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"))
    return host, path, best[0] + best[1], best[2]


def test_urls_against_each_rule(spark):
    draw = random.Random(3)
    labels, parts = ["org", "com", "a", "b", "example", "aa"], ["", "/", "/es/", "/en/1", "/en/", "/en/12", "/x?y=/es/", "#/es/", "/é"]
    hosts = [".".join(draw.choices(labels, k=draw.randint(1, 4))) for _ in range(60)]
    urls = [draw.choice(["http://", "https://", "://", "", "x://y://"]) + draw.choice(hosts).upper() + draw.choice(parts) for _ in range(600)]
    urls += [None, "", "://", "http://", "http:///en/1", "http://org/", "http://ORG:80/", "http://org./", "http://xorg/", "http://.org/"] + ["http://hot.example.org/es/"] * 400
    rules = {(draw.choice(hosts), draw.choice(["", "/", "/e", "/en/", "/en/1"])): draw.choice(["allow", "block"]) for _ in range(40)}
    rules = [(*key, verdict) for key, verdict in rules.items()] + list(URL_RULES)
    rules = [r for at, r in enumerate(rules) if r[:2] not in {x[:2] for x in rules[:at]}]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("other"))
    found = url_rules.judge_urls(table, spark.createDataFrame(rules, url_rules.RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = {row[0]: tuple(row)[1:] for row in found.collect()}
    assert len(rows) == len(urls)
    for at, url in enumerate(urls):
        assert rows[at] == judged_by_hand(url, rules), url


def test_equal_rules_block_and_empty_tables(spark):
    rules = spark.createDataFrame([("a.org", "/", "allow"), ("a.org", "/", "block"), ("", "/", "block"), (None, "/", "block"), ("b.org", None, "block")], url_rules.RULES)
    table = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, "http://x.b.org")], "page_id long, url string")
    rows = sorted(url_rules.judge_urls(table, rules).collect(), key=repr)
    assert sorted((row.rule, row.verdict) for row in rows) == [("a.org/", "block"), ("a.org/", "block"), ("b.org", "block")]
    assert url_rules.judge_urls(table.limit(0), rules).count() == 0
    assert [row.verdict for row in url_rules.judge_urls(table, rules.limit(0)).collect()] == ["allow"] * 3


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own"))


def test_archives_round_trip(spark):
    same, small, long = "é" * 600, "s" * 999, "long ß\r\n\r\n" * 30_000
    rows = [(1, "http://a/", same), (2, "http://b/\r\nX: y", same), (3, None, same), (4, "u", small), (5, "u", small), (6, "u", None), (7, "u", ""), (8, "u", long), (9, "u", "x" * 1000)]
    rows += [(at, f"http://c/{at}", f"<html>page {at} of many</html>" * 20) for at in range(20, 400)]
    archives = warc.archive_pages(pages_of(spark, rows))
    found = {row.page_id: row for row in warc.read_archives(archives).collect()}
    assert sorted(found) == sorted(row[0] for row in rows)
    for page_id, _, html in rows:
        payload, row = (html or "").encode(), found[page_id]
        target = 3 if page_id in (1, 2) else None
        assert (row.record_type, row.refers_to) == (("revisit", target) if target else ("response", None))
        assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert row.payload is None if target else bytes(row.payload) == payload
    assert archives.agg(F.sum("records")).first()[0] == len(rows)
    assert warc.read_archives(archives, with_payload=False).where("payload is not null").count() == 0


def test_no_pages_no_archives(spark):
    archives = warc.archive_pages(pages_of(spark, []))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def archive_of(records, dictionary=None, checksum=True):
    out = b""
    packed = {}
    if dictionary:
        head = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        out += struct.pack("<II", warc.SKIPPABLE, len(head)) + head
        packed = {"dict_data": dictionary}
    return out + b"".join(zstandard.ZstdCompressor(write_checksum=checksum, **packed).compress(record) for record in records)


def test_frames_and_damage():
    records = [warc.encode_record(at, "u", b"p%d" % at * 50, hashlib.sha1(b"p%d" % at * 50).hexdigest(), None) for at in range(300)]
    dictionary = warc.learned_dictionary(records)
    data = archive_of(records, dictionary)
    assert len(data) < len(archive_of(records))
    assert list(warc.read_frames(io.BytesIO(data))) == records
    assert list(warc.read_frames(io.BytesIO(archive_of(records) + struct.pack("<II", 0x184D2A50, 3) + b"abc"))) == records
    assert list(warc.read_frames(io.BytesIO(b""))) == []
    plain = struct.pack("<II", warc.SKIPPABLE, len(dictionary.as_bytes())) + dictionary.as_bytes()
    assert list(warc.read_frames(io.BytesIO(plain + data[8 + struct.unpack_from("<I", data, 4)[0] :]))) == records
    for bad in (data[:-3], data[:20], b"no frame at all", data[:-9] + b"x" + data[-8:], struct.pack("<II", warc.SKIPPABLE, 4) + b"abcd" + data):
        with pytest.raises(warc.BadArchive):
            list(warc.read_frames(io.BytesIO(bad)))


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1"),
        lambda r: r.replace(b"Content-Length: ", b"Content-Length: x"),
        lambda r: r.replace(b"X-Payload-Length", b"X-Other"),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
        lambda r: r.replace(b"payload", b"paYload"),
        lambda r: r.replace(b"WARC-Date", b"WARC-Type"),
        lambda r: r[:-2],
        lambda r: b"",
    ],
)
def test_bad_records(change):
    record = warc.encode_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.decode_record(record)[0] == 1
    with pytest.raises(warc.BadArchive):
        warc.decode_record(change(record))


def test_archives_with_repeated_and_missing_ids(spark):
    big, other = "x" * 1200, "other" * 300
    rows = [(1, "u", big), (1, "u", big), (None, "u", big), (None, "v", "small"), (2, "u", other), (2, "u", other), (3, "u", big)]
    found = warc.read_archives(warc.archive_pages(pages_of(spark, rows)), with_payload=False).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=repr)
    assert got == sorted(
        [(1, 1200, "revisit", 3), (1, 1200, "revisit", 3), (None, 1200, "revisit", 3), (None, 5, "response", None),
         (2, 1500, "response", None), (2, 1500, "response", None), (3, 1200, "response", None)],
        key=repr,
    )


def test_a_very_long_url(spark):
    url = "http://a.b.example.org/es/" + "x/" * 200_000 + "?q=#f"
    table = spark.createDataFrame([(1, url), (2, "HTTP://ORG" + "/y" * 100_000)], "page_id long, url string")
    rules = spark.createDataFrame(list(URL_RULES), url_rules.RULES)
    rows = {row.page_id: row for row in url_rules.judge_urls(table, rules).collect()}
    assert (rows[1].host, rows[1].rule, rows[1].verdict) == ("a.b.example.org", "example.org/es/", "block")
    assert len(rows[1].path) == len(url) - len("http://a.b.example.org") - len("?q=#f")
    assert (rows[2].rule, rows[2].verdict) == ("org/", "allow")
