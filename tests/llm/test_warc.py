import base64
import gzip
import hashlib
import io

import pytest
from tenderlake.llm import warc


def test_chunked_framing():
    for payload in (b"", b"x", b"a\r\n\r\nb" * 3000):
        assert warc.dechunked(warc.chunked(payload, 7)) == payload
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_records_of_a_page():
    payload = bytes(range(256)) * 40
    made = list(warc.page_records("7:x", "http://a b/é\n", payload, warc.digest_of(payload), None, 1000))
    stream = io.BytesIO(b"".join(r + b"\r\n\r\n" for r in made))
    read = list(warc.records_in(stream))
    assert [f["warc-type"] for f, _ in read] == ["response"] + ["continuation"] * (len(made) - 1)
    assert [int(f["warc-segment-number"]) for f, _ in read] == list(range(1, len(made) + 1))
    block = b"".join(b for _, b in read)
    assert int(read[-1][0]["warc-segment-total-length"]) == len(block)
    assert warc.payload_of(block) == payload
    with pytest.raises(ValueError):
        list(warc.records_in(io.BytesIO(made[0][:-5])))


def rows_of(pages):
    first, want = {}, []
    for page, html in sorted(((p, h) for p, h in pages if p is not None), key=lambda r: r[0]):
        first.setdefault((html or "").encode(), page)
    for page, html in pages:
        payload = (html or "").encode()
        of = first.get(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        plain = of is None or of == page
        want.append((page, "response" if plain else "revisit", None if plain else of, digest, payload if plain else None))
    return want


def test_round_trip(spark, tmp_path):
    pages = [(i, ["x" * 70000, "é" * 50000, None, "", f"own {i}\r\n\r\nWARC/1.1\r\n"][i % 5]) for i in range(23)]
    pages += [(None, "no id"), (None, "x" * 70000), (3, "repeated"), (3, "repeated")]
    df = spark.createDataFrame([(p, f"http://h/{p}\n", h, "clash", 1) for p, h in pages], "page_id long, url string, html string, payload string, first int")
    warc.write_archive(df.repartition(3), str(tmp_path / "w"))
    found = [tuple(r) for r in warc.read_archive(spark, str(tmp_path / "w")).collect()]
    key = lambda r: tuple(str(x)[:90] for x in r)
    assert sorted(((*r[:4], None if r[4] is None else bytes(r[4])) for r in found), key=key) == sorted(rows_of(pages), key=key)


def test_short_payloads_may_all_be_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "same"), (2, "u", "same")], "page_id long, url string, html string")
    warc.write_archive(df, str(tmp_path / "w"), least=5)
    assert {r.record_type for r in warc.read_archive(spark, str(tmp_path / "w")).collect()} == {"response"}


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    empty.write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op5_segment_reassembly(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("harm", ["gap", "total", "digest"])
def test_damaged_archives_are_refused(spark, tmp_path, harm):
    payload = b"y" * 5000
    made = list(warc.page_records("1:x", "u", payload, warc.digest_of(payload), None, 1000))
    if harm == "gap":
        del made[2]
    elif harm == "total":
        made[-1] = made[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    else:
        made[0] = made[0].replace(b"sha1:", b"sha1:A")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in made)))
    with pytest.raises(Exception, match="segments|digest"):
        warc.read_archive(spark, str(folder)).collect()
