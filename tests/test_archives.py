import datetime
import io
import random
import zipfile
import zlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tenderlake.catalog.bundles import build_archive
from tenderlake.plans.ingest import ingest
from tenderlake.schemas import SILVER, TABLE_HEADERS
from tenderlake.sources import archives as A
from tenderlake.sources.archives import member_type, parse_lines, read_archives, records, unpack, unpack_blocks
from tenderlake.sources.silver import read_silver, write_silver

PERIOD = "202401"
NOTICE_LINE = (
    '"001";"0010";"Unidade São João";"5";"Pregão";"P1";"Compra; com ""aspas"" e\nquebra";"Encerrada";'
    '"26000";"Educação";"26001";"Órgão";"DF";"Brasília";"31/01/2024";"1/2/2024";10665589,3300'
)
LINES = {
    "notice": [NOTICE_LINE, '"002";"0010";"U";"x";"Pregão";"P";"O";"S";;;;;;;"31/02/2024";"";abc;"sobra";"sobra"'],
    "item": ['"001";"0010";"5";"i1";"Papel";2,5000;10,0000;"111";"Fulano"', '"001";"0010";"5"'],
    "bid": ['"001";"0010";"5";"i1";"111";"Fulano"; SIM ', '"001";"0010";"5";"i1";"222";"Beltrano";"NÃO"'],
}


def archive(cut=False, lines=LINES, period=PERIOD):
    return build_archive(period, lines, cut)


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    return folder


def member(content, start, stop, checksum=None, length=None, step=5):
    """One member read from parts of ``step`` bytes: (name, body, end), None if it is not whole."""
    parts = ((at, content[at : at + step]) for at in range(start // step * step, len(content), step))
    found = A._Member(parts, start, stop, checksum, length)
    try:
        found.open()
        body = b"".join(found.chunks())
    except (A._Damaged, zlib.error):
        return None
    return found.name, body, found.ends


def is_intact(content):
    listed = A._directory(len(content), content)
    if not listed:
        return A._is_empty(len(content), content)
    return all(member(content, start, stop, checksum, length) for start, stop, _, checksum, length in listed)


def recover_members(content):
    """The walk from member to member."""
    found, at = {}, content.find(A.HEADER_MARK)
    while at >= 0:
        whole = member(content, at, len(content))
        if whole:
            found[member_type(whole[0])] = whole[1]
        at = content.find(A.HEADER_MARK, whole[2] if whole else at + 1)
    return found


def frame(spark, *contents):
    rows = [(p, f"{p}.zip", c) for p, c in contents]
    return spark.createDataFrame(rows, "period string, path string, content binary")


def test_integrity():
    good = archive()
    assert is_intact(good)
    assert not is_intact(good[: len(good) // 2]) and not is_intact(b"junk") and not is_intact(b"")


def test_recovery_never_returns_part_of_a_member():
    whole = recover_members(archive())
    assert set(whole) == {"Licitação", "ItemLicitação", "ParticipantesLicitação", "EmpenhosRelacionados"}
    content = archive()
    for size in range(0, len(content), 7):
        for name, data in recover_members(content[:size]).items():
            assert data == whole[name]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("streamed", [False, True])
def test_recovery_at_every_cut(method, streamed):
    bodies = {f"{PERIOD}_{t}.csv": (t + ";PK\x03\x04;") .encode() * 9 for t in ("A", "B", "C")}
    buffer = io.BytesIO()
    # Without seeking, sizes follow the data in a descriptor.
    target = io.BufferedWriter(type("Pipe", (io.RawIOBase,), {"writable": lambda s: True, "write": lambda s, b: buffer.write(b)})()) if streamed else buffer
    with zipfile.ZipFile(target, "w", method) as z:
        for name, body in bodies.items():
            z.writestr(name, body)
    if streamed:
        target.flush()
    content = buffer.getvalue()
    for size in range(len(content) + 1):
        for name, data in recover_members(content[:size]).items():
            assert data == bodies[f"{PERIOD}_{name}.csv"]
    if not (streamed and method == zipfile.ZIP_STORED):
        assert set(recover_members(content)) == {"A", "B", "C"}
        assert set(recover_members(b"junk" + content[:-30])) == {"A", "B", "C"}


def test_recovery_refuses_a_wrong_checksum():
    content = bytearray(archive())
    content[14] ^= 1
    assert len(recover_members(bytes(content))) == 3


def harmed(flag=None, method=None):
    """An archive whose first member claims to be encrypted or of another method."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_Licitação.csv", "x")
    content = bytearray(buffer.getvalue())
    central = content.index(b"PK\x01\x02")
    for at, base in ((0, 6), (central, 8)):
        if flag:
            content[at + base] |= flag
        if method:
            content[at + base + 2] = method
    return bytes(content)


def test_large_sizes_and_directories(monkeypatch):
    """Members with 64-bit sizes, and a directory longer than the end of the archive that is looked at."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(40):
            with z.open(f"{PERIOD}_M{i}.csv", "w", force_zip64=True) as f:
                f.write(b"line;%d\n" % i * 50)
    content = buffer.getvalue()
    assert is_intact(content) and set(recover_members(content[:-30])) == {f"M{i}" for i in range(40)}
    assert A._directory(len(content), content[-500:]) is None
    assert len(A._directory(len(content), content[len(content) // 2 :])) == 40


def test_a_directory_beyond_the_end_is_fetched(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_ParticipantesLicitação.csv", ";".join(TABLE_HEADERS["bid"]).encode("latin-1") + b"\n1;2;3;4;5;6;SIM\n")
        for i in range(60):
            z.writestr(f"{PERIOD}_Other{i}.csv", "x")
    blocks = A.as_blocks(frame(spark, (PERIOD, buffer.getvalue()), ("202402", b"no archive"), ("202403", archive())))
    claims = A.directories(blocks, tail=300)
    assert sorted(r["count"] for r in claims.groupBy("archive").count().collect()) == [4, 61]


def test_archives_in_many_blocks_and_tasks(spark, bronze, tmp_path, monkeypatch):
    """Files cut into splits and blocks in their middle; each member of an archive is one stream."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzáé\n") for _ in range(rng.randint(1, 30))).replace("\n", rng.choice(["", " "]))
    lines = {t: [";".join(f'"{i} {word()}"' for _ in TABLE_HEADERS[t]) for i in range(3000)] for t in ("notice", "item", "bid")}
    whole = archive(lines=lines)
    (bronze / "202401.zip").write_bytes(whole)
    (bronze / "202402.zip").write_bytes(archive(lines=lines, cut=True))
    (bronze / "202403.zip").write_bytes(whole[:1000] + b"\xff" * 50 + whole[1050:])
    (bronze / "202404.zip").write_bytes(b"")
    monkeypatch.setattr(A, "BLOCK", 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        blocks = read_archives(spark, str(bronze), [f"20240{i}" for i in range(1, 6)])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks.filter("period = '202401' AND length(body) > 0").count() > 20
    held = sorted((r["at"], r.body) for r in blocks.filter("period = '202401'").collect())
    assert b"".join(body for _, body in held) == whole
    rows = unpack_blocks(blocks).collect()
    assert {r.period: r.outcome for r in rows if r.table == "status"} == {"202401": "intact", "202402": "partial", "202403": "partial", "202404": "error"}
    got = {}
    for r in rows:
        if r.table != "status":
            got.setdefault((r.period, r.table), []).append((r.line_no, r.line))
    assert set(got) == {("202401", t) for t in lines} | {("202402", "notice"), ("202402", "item"), ("202403", "item"), ("202403", "bid")}
    for (_, table), found in got.items():
        assert [line for _, line in sorted(found)] == lines[table] and sorted(n for n, _ in found) == list(range(3000))


def test_a_file_of_one_block_is_not_written_again(spark, bronze, monkeypatch):
    def write(df):
        raise AssertionError("written to scratch")

    contents = {"202401.zip": archive(), "202401-b.zip": archive(cut=True), "202402.zip": b"junk\n\n", "202403.zip": b""}
    for name, content in contents.items():
        (bronze / name).write_bytes(content)
    months = ["202401", "202402", "202403"]
    with monkeypatch.context() as patch:
        patch.setattr(A, "materialize", write)
        blocks = read_archives(spark, str(bronze), months)
        held = {r.path.rsplit("/", 1)[1]: (r.period, r["size"], r["at"], bytes(r.body)) for r in blocks.collect()}
    assert held == {n: (n[:6], len(c), 0, c) for n, c in contents.items()}
    # Beside a larger file it stays so.
    monkeypatch.setattr(A, "BLOCK", len(contents["202401-b.zip"]))
    both = read_archives(spark, str(bronze), months).collect()
    held = {n: b"".join(r.body for r in sorted(both, key=lambda r: r["at"]) if r.path.endswith("/" + n)) for n in contents}
    assert held == contents


def test_rows_of_an_ingest_are_shuffled_as_packed_archives_only(spark, bronze, tmp_path, monkeypatch):
    from tenderlake.plans import ingest as plan

    shuffled, files = [], []

    def write(df, root, table, **dealt):
        write_silver(df, root, table, **dealt)
        shuffled.append(not dealt.get("dealt"))
        files.extend(read_silver(spark, root, table).select(F.lit(table), "period", F.input_file_name()).distinct().collect())

    monkeypatch.setattr(plan, "write_silver", write)
    months = [f"2024{m:02d}" for m in range(1, 13)]
    for month in months:
        for part in "abcd":
            (bronze / f"{month}-{part}.zip").write_bytes(archive(period=month))
    report = ingest(spark, str(bronze), str(tmp_path / "silver"), months).collect()
    assert all(r.error is None and (r.notice_rows, r.item_rows, r.bid_rows) == (8, 8, 8) for r in report)
    assert shuffled == [False] * 3 and len(files) == 3 * len(months)


def test_items_and_bids_of_one_join_are_those_of_two(spark, tmp_path):
    from tenderlake.catalog import samples
    from tenderlake.catalog.bundles import csv_lines

    at = datetime.datetime(2024, 1, 31)
    orders = [(1, 7, "F", 5.0, at, "5-LOW"), (2, 8, "O", 6.0, at, "1-URGENT"), (2, 8, "O", 6.0, at, "1-URGENT"), (3, 9, "O", None, None, None)]
    lines = [(1, 10, 20, 1, 2.5, 9.0, "R"), (2, 11, 21, 1, 1.0, None, None), (2, 11, 22, 2, 1.0, 3.0, "N"), (3, None, None, 1, None, 1.0, "R"), (None, 1, 1, 1, 1.0, 1.0, "R"), (4, 1, 1, 1, 1.0, 1.0, "R")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    sf = str(tmp_path)
    apart = csv_lines(samples.items(spark, sf), "item").union(csv_lines(samples.bids(spark, sf), "bid"))
    joined = csv_lines(samples.items_and_bids(spark, sf), "item", "bid")
    assert sorted(joined.collect(), key=repr) == sorted(apart.collect(), key=repr) and joined.count() == 12


def test_an_archive_of_one_block_is_unpacked_where_it_is(spark, monkeypatch):
    def meet(batches):
        assert not any(batch.num_rows for batch in batches), "members were dealt out"
        return iter(())

    monkeypatch.setattr(A, "_decode", meet)
    rows = [(PERIOD, "a.zip", archive()), (PERIOD, "b.zip", archive(cut=True)), (PERIOD, "c.zip", b"junk"), (PERIOD, "d.zip", b"")]
    out = unpack(spark.createDataFrame(rows, "period string, path string, content binary"))
    found = {(r["path"], r["table"]): r["n"] for r in out.groupBy("path", "table").agg(F.count("*").alias("n")).collect()}
    assert found == {
        ("a.zip", "status"): 1, ("a.zip", "notice"): 2, ("a.zip", "item"): 2, ("a.zip", "bid"): 2,
        ("b.zip", "status"): 1, ("b.zip", "notice"): 2, ("b.zip", "item"): 2, ("c.zip", "status"): 1, ("d.zip", "status"): 1,
    }


def test_only_its_own_bytes_travel_to_a_member(spark, monkeypatch):
    def weigh(batches):
        for batch in batches:
            for name, body in zip(batch.column("archive").to_pylist(), batch.column("body").to_pylist()):
                yield A.pa.RecordBatch.from_pandas(A.pd.DataFrame({"archive": [name], "line_no": [len(body)]}))

    content = archive()
    half = len(content) // 2
    blocks = spark.createDataFrame(
        [("a", PERIOD, "a.zip", len(content), at, content[at : at + half + 1]) for at in (0, half + 1)], A.BLOCKS
    )
    monkeypatch.setattr(A, "_decode", weigh)
    monkeypatch.setattr(A, "UNPACKED", "archive string, line_no long")
    claims = A.directories(blocks)
    assert claims.count() == 4
    total = A._members(blocks, claims, A._listed).agg(F.sum("line_no")).first()[0]
    assert 0 < total <= len(content)


def test_files_of_one_month_keep_their_order(spark, bronze, tmp_path):
    item = lambda code: {"item": [f'"001";"0010";"5";"{code}";"Papel";1,0;1,0;"111";"Fulano"']}
    (bronze / "202401-b.zip").write_bytes(archive(lines=item("second")))
    (bronze / "202401-a.zip").write_bytes(archive(lines=item("first")))
    silver = str(tmp_path / "silver")
    report = ingest(spark, str(bronze), silver, ["202401"]).first()
    assert report.error is None and report.item_rows == 2
    rows = read_silver(spark, silver, "item").orderBy("line_no").collect()
    assert [r.item_code for r in rows] == ["first", "second"] and rows[1].line_no == A.ARCHIVE_LINES


def test_any_unreadable_archive_is_a_status_row(spark):
    blank = {"bid": ["  ", "\t"]}
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_Licitação.csv", "  \r\n \r\n")
    contents = [harmed(flag=1), harmed(method=99), None, b"", buffer.getvalue(), archive(lines=blank)]
    df = frame(spark, *[(f"20240{i + 1}", c) for i, c in enumerate(contents)])
    status = {r.period: r.outcome for r in unpack(df).filter("table = 'status'").collect()}
    assert status == {"202401": "error", "202402": "error", "202403": "error", "202404": "error", "202405": "intact", "202406": "intact"}
    assert unpack(df).filter("period = '202405' AND table <> 'status'").count() == 0


def test_any_number_of_other_columns(spark):
    headers = list(TABLE_HEADERS["bid"])
    names = [f"Extra {i}" for i in range(30)] + headers
    values = ['"a;b"'] * 30 + ['"001"', '"0010"', '"5"', '"i;1"', '""', "", '"SIM"']
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_ParticipantesLicitação.csv", (";".join(names) + "\n" + ";".join(values) + "\n1;2").encode("latin-1"))
    row, short = parse_lines(unpack(frame(spark, (PERIOD, buffer.getvalue()))), "bid").orderBy("line_no").collect()
    assert (row.notice_no, row.item_code, row.bidder_id, row.bidder_name, row.is_winner) == ("001", "i;1", "", None, True)
    assert short.notice_no is None


def test_member_type():
    assert member_type("202401_Licitação.csv") == "Licitação"
    with pytest.raises(ValueError):
        member_type("readme.csv")


def test_records_keep_line_breaks_inside_quotes():
    stream = io.BytesIO('a;b\r\n"x\ny";1\r\n\r\nlast;2'.encode("latin-1"))
    assert list(records(stream)) == ["a;b", '"x\ny";1', "last;2"]


def test_typed_notices(spark):
    parsed = parse_lines(unpack(frame(spark, (PERIOD, archive()))), "notice")
    assert parsed.columns == SILVER["notice"].names
    first, second = parsed.orderBy("line_no").collect()
    assert first.unit_id == "0010" and first.unit_name == "Unidade São João" and first.modality_id == 5
    assert first.subject == 'Compra; com "aspas" e\nquebra'
    assert first.value == D("10665589.3300") and first.period == PERIOD
    assert first.result_date == datetime.date(2024, 1, 31) and first.opening_date == datetime.date(2024, 2, 1)
    assert second.modality_id is None and second.value is None
    assert second.result_date is None and second.opening_date is None and second.city is None


def test_typed_items_and_bids(spark):
    unpacked = unpack(frame(spark, (PERIOD, archive())))
    items = parse_lines(unpacked, "item").orderBy("line_no").collect()
    assert items[0].quantity == D("2.5000") and items[0].winner_id == "111"
    assert items[1].modality_id == 5 and items[1].item_code is None
    bids = parse_lines(unpacked, "bid").orderBy("line_no").collect()
    assert [b.is_winner for b in bids] == [True, False]


def test_columns_are_found_by_name(spark):
    headers = list(TABLE_HEADERS["bid"])
    moved = ["Extra", *reversed(headers)]
    values = ["?", *reversed(["001", "0010", "5", "i1", "111", "Fulano", "SIM"])]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_ParticipantesLicitação.csv", (";".join(moved) + "\n" + ";".join(values)).encode("latin-1"))
    row = parse_lines(unpack(frame(spark, (PERIOD, buffer.getvalue()))), "bid").first()
    assert (row.notice_no, row.item_code, row.bidder_id, row.is_winner) == ("001", "i1", "111", True)


def test_quoted_empty_is_not_null(spark):
    lines = {"bid": ['"001";"0010";"5";"i1";"";;"SIM"']}
    row = parse_lines(unpack(frame(spark, (PERIOD, archive(lines=lines)))), "bid").first()
    assert row.bidder_id == "" and row.bidder_name is None


def outcomes(report):
    return {r.period: r for r in report.collect()}


def test_ingest_reports_every_period_and_stops_for_none(spark, bronze, tmp_path):
    (bronze / "202401.zip").write_bytes(archive())
    (bronze / "202402.zip").write_bytes(archive(cut=True, period="202402"))
    (bronze / "202403.zip").write_bytes(b"PK not an archive")
    (bronze / "202404.zip").write_bytes(archive(lines={}, period="202404"))
    silver = str(tmp_path / "silver")
    report = outcomes(ingest(spark, str(bronze), silver, ["202401", "202402", "202403", "202404", "202405"]))
    assert report["202401"].error is None and not report["202401"].partial
    assert (report["202401"].notice_rows, report["202401"].item_rows, report["202401"].bid_rows) == (2, 2, 2)
    assert report["202402"].partial and report["202402"].missing_tables == ["bid"]
    assert "recoverable" in report["202403"].error
    assert report["202404"].error is None and report["202404"].notice_rows == 0
    assert report["202405"].error == "archive unavailable"
    periods = {t: {r.period for r in read_silver(spark, silver, t).select("period").distinct().collect()} for t in SILVER}
    assert periods == {"notice": {"202401", "202402"}, "item": {"202401", "202402"}, "bid": {"202401"}}
    schema = read_silver(spark, silver, "notice").schema
    assert schema["value"].dataType == SILVER["notice"]["value"].dataType


def test_reingest_replaces_the_period_only(spark, bronze, tmp_path):
    silver = str(tmp_path / "silver")
    for period in ("202401", "202402"):
        (bronze / f"{period}.zip").write_bytes(archive(period=period))
    ingest(spark, str(bronze), silver, ["202401", "202402"])
    (bronze / "202401.zip").write_bytes(archive(lines={"notice": LINES["notice"]}))
    ingest(spark, str(bronze), silver, ["202401"])
    counts = {(t, p): read_silver(spark, silver, t, [p]).count() for t in SILVER for p in ("202401", "202402")}
    assert counts == {
        ("notice", "202401"): 2, ("notice", "202402"): 2, ("item", "202401"): 0,
        ("item", "202402"): 2, ("bid", "202401"): 0, ("bid", "202402"): 2,
    }


def test_a_failed_period_keeps_its_former_silver(spark, bronze, tmp_path):
    silver = str(tmp_path / "silver")
    (bronze / "202401.zip").write_bytes(archive())
    ingest(spark, str(bronze), silver, ["202401"])
    (bronze / "202401.zip").write_bytes(b"broken")
    assert outcomes(ingest(spark, str(bronze), silver, ["202401"]))["202401"].error
    assert read_silver(spark, silver, "notice").filter(F.col("period") == "202401").count() == 2


def test_missing_silver_is_empty_with_its_schema(spark, tmp_path):
    empty = read_silver(spark, str(tmp_path), "item")
    assert empty.count() == 0 and empty.schema.names == SILVER["item"].names


def test_missing_column_is_an_error_row(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(f"{PERIOD}_Licitação.csv", "Número Licitação;UF\n1;DF".encode("latin-1"))
    rows = unpack(frame(spark, (PERIOD, buffer.getvalue()))).collect()
    assert len(rows) == 1 and rows[0].outcome == "error" and "missing columns" in rows[0].message
