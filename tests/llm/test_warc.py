"""Archives: round trips, framing, and damage."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from tallyboard.llm import warc


def test_query_equals_sql(equals_sql):
    equals_sql("op9_warc")


def written(spark, pages, tmp_path, **more):
    archives = warc.write_archives(pages, f"file://{tmp_path}/w", **more)
    return archives, [tuple(r) for r in warc.read_archives(archives).collect()]


def test_round_trip(spark, make, tmp_path):
    big = "".join(random.Random(1).choices("abc <>\r\n\r\néß🙂", k=900_000))
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/ c\r\nInjected: 1", "<p>x</p>"), (9, None, "<p>x</p>"), (4, "u", None), (5, "u", ""),
            (6, "é", big), (7, "v", "WARC/1.1\r\n\r\n"), (8, "w", "\r\n\r\n"), (8, "w", "\r\n\r\n"), (None, "n", "<p>x</p>"), (None, "m", "only")]
    pages = make([(*r, "t", b"p") for r in rows], "page_id bigint, url string, html string, record_type string, payload binary")
    archives, got = written(spark, pages, tmp_path)
    assert sum(r.records for r in archives.collect()) == len(rows)
    by_id = {(r[0], r[4]): r for r in got}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        r = by_id[i, len(data)]
        assert r[5] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r[6] == (None if r[2] == "revisit" else data)
    assert {i: by_id[i, 8][2:4] for i in (1, 2, 9, None)} == {
        1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), None: ("revisit", 9)}
    assert by_id[4, 0][2:4] == ("revisit", 5) and by_id[8, 4][2] == "response" and by_id[None, 4][2] == "response"
    assert by_id[2, 8][1] == "http://b/%20c%0D%0AInjected:%201" and by_id[9, 8][1] is None


def test_small_payloads_can_all_be_responses(spark, make, tmp_path):
    pages = make([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    _, got = written(spark, pages, tmp_path, least_bytes=4)
    assert {r[0]: r[2] for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_many_files_and_empty_table(spark, make, tmp_path):
    pages = spark.range(500).selectExpr("id AS page_id", "'u' AS url", "sha2(string(id), 512) AS html").repartition(4)
    archives, got = written(spark, pages, tmp_path, file_bytes=5_000)
    assert archives.count() > 20 and sorted(r[0] for r in got) == list(range(500))
    assert all(r.path.endswith(".warc.gz") for r in archives.collect())
    assert written(spark, make([], "page_id bigint, url string, html string"), tmp_path)[1] == []


def sample():
    return [warc.record("1", "http://a/", b"x" * 400_000, None, False, "2000-01-01T00:00:00Z"),
            warc.record("2", None, b"x" * 400_000, "1", True, "2000-01-01T00:00:00Z"),
            warc.record(None, None, b"", None, False, "2000-01-01T00:00:00Z")]


def test_one_member_per_record():
    for member, kind in zip(sample(), ["response", "revisit", "response"]):
        plain = gzip.decompress(member)
        head, _, rest = plain.partition(b"\r\n\r\n")
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and rest[length:] == b"\r\n\r\n"
    assert [r[0] for r in warc.records(io.BytesIO(b"".join(sample())))] == ["1", "2", None]


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7))


def test_pieces_of_any_size():
    small = b"".join([warc.record(str(i), "u", b"payload %d" % i, None, False, "d") for i in range(30)])
    assert [r[6] for r in warc.records(Trickle(small))] == [b"payload %d" % i for i in range(30)]


@pytest.mark.parametrize("size", [0, warc.PIECE - 200, warc.PIECE, 3 << 20])
def test_addresses_of_any_length(size):
    url = "http://x/" + "y" * size
    archive = b"".join([warc.record("1", url, b"some payload", None, False, "d"), warc.record("2", url, b"", "1", True, "d")])
    assert [(r[0], r[1], r[6]) for r in warc.records(io.BytesIO(archive))] == [("1", url, b"some payload"), ("2", url, None)]


def test_a_member_without_header_raises():
    with pytest.raises(ValueError, match="no end of header"):
        list(warc.records(io.BytesIO(gzip.compress(b"WARC/1.1\r\n" + b"z" * (2 << 20)))))


@pytest.mark.parametrize("damage", ["cut", "payload", "length", "extra"])
def test_damage_raises(damage):
    member = warc.record("1", "u", b"some payload", None, False, "d")
    plain = gzip.decompress(member)
    data = {"cut": member[:-12], "payload": gzip.compress(plain.replace(b"some payload", b"same payload")),
            "length": gzip.compress(plain.replace(b"WARC-Payload", b"X-Payload").replace(b"Content-Length: 8", b"Content-Length: 9")),
            "extra": gzip.compress(plain + b"more")}[damage]
    with pytest.raises((ValueError, KeyError)):
        list(warc.records(io.BytesIO(data)))


def test_a_repeated_attempt_replaces_its_archive(tmp_path):
    for payload in (b"first", b"second"):
        archive = warc._Archive(f"file://{tmp_path}", "part-00000-00000.warc.gz")
        archive.add(warc.record("1", "u", payload, None, False, "d"))
        assert archive.finish()[1] == 1
    assert [p.name for p in tmp_path.iterdir()] == ["part-00000-00000.warc.gz"]
    with open(tmp_path / "part-00000-00000.warc.gz", "rb") as raw:
        assert [r[6] for r in warc.records(raw)] == [b"second"]
