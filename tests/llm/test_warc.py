import gzip
import io

import pytest
from pyarrow import fs

from ledgerlake.llm import warc

STORE = fs.LocalFileSystem()


def pages(spark):
    big = "x" * 100
    rows = [
        (4, "http://a/4", big), (2, "http://a/2 b\r\nc", big), (9, None, big), (None, "n", big),
        (5, "s", "x" * 99), (6, "s", "x" * 99), (7, "e", None), (8, "e", ""), (2, "again", big),
        (10, "w", "WARC/1.1\r\n\r\n" * 20), (11, "l", "長い" * 300_000), (12, "l", "長い" * 300_000),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_written_and_read_back(spark):
    archives = warc.archive_pages(pages(spark), archive_bytes=500)
    got = {(r.page, r.url): r for r in warc.read_archives(archives).collect()}
    assert len(got) == 12
    kinds = {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()}
    assert kinds["4", "http://a/4"] == ("revisit", "2", 100)
    assert kinds["2", "http://a/2%20b%0D%0Ac"] == kinds["2", "again"] == ("response", None, 100)
    assert kinds["9", None] == ("revisit", "2", 100) and kinds[None, "n"] == ("revisit", "2", 100)
    assert kinds["5", "s"] == kinds["6", "s"] == ("response", None, 99)
    assert kinds["7", "e"] == kinds["8", "e"] == ("response", None, 0)
    assert kinds["12", "l"] == ("revisit", "11", 1_800_000)
    assert len({r.payload_digest for r in got.values()}) == 5


def test_members_and_index(spark):
    for row in warc.archive_pages(pages(spark)).collect():
        path = row.archive.removeprefix("file://")
        with open(path, "rb") as file, open(f"{path}.idx") as index:
            data = file.read()
            places = [line.split("\t")[:2] for line in index]
        assert len(places) == row.records
        assert sum(int(n) for _, n in places) == len(data)
        inflated = io.BytesIO(gzip.decompress(data))
        one_by_one = [list(warc.records(io.BytesIO(gzip.decompress(data[int(a) : int(a) + int(n)])))) for a, n in places]
        assert [r for rs in one_by_one for r in rs] == list(warc.records(inflated))


def test_normalises_a_stream_of_several_members(tmp_path):
    one = warc.response("1", "u", b"a" * 10, "d").encoded()
    two = warc.response("2", "u", b"b" * 10, "d").encoded()
    source, target = str(tmp_path / "a.gz"), str(tmp_path / "b.gz")
    with open(source, "wb") as file:
        file.write(gzip.compress(one + two) + gzip.compress(one))
    assert warc.normalise_archive(STORE, source, target, {1: "1"}) == 3
    kinds = [(r.fields["WARC-Type"], r.id, r.refers_to) for r in warc.read_archive(STORE, target)]
    assert kinds == [("response", "1", None), ("revisit", "2", "1"), ("response", "1", None)]


def test_damaged_streams(tmp_path):
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(b"HTTP/1.1 200\r\n")))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(warc.response("1", "u", b"abc", "d").encoded()[:-6])))


def test_no_pages(spark):
    archives = warc.archive_pages(pages(spark).where("false"))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0
