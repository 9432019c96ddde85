"""Monthly ZIP archives of CSV files, read as rows.

An archive of any size is read in blocks: Spark's text reader deals out its bytes, cut at byte 10,
to as many tasks as its size asks for. The directory at the end of the archive says where its
members are; the blocks of a member meet in one task, which inflates them as a stream and hands on
raw lines. Everything after that (splitting fields, typing, filtering) is Spark SQL. A damaged
archive is data, not an exception: it yields a status row and whatever members are intact, which
are found by their own headers.
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import dropwhile, groupby, islice
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.functions.scalars import br_date, br_decimal, lenient_int, yes_flag
from tenderlake.schemas import MEMBER_TABLES, MONEY, SILVER, TABLE_HEADERS
from tenderlake.session import materialize
from tenderlake.sources.files import any_match, sizes

STATUS = "status"
INTACT, PARTIAL, ERROR = "intact", "partial", "error"

# Fixed values of the ZIP format: a member's header, the record that may follow its data, flags, the field of large sizes.
HEADER_MARK, DESCRIPTOR_MARK = b"PK\x03\x04", b"PK\x07\x08"
HEADER, HEADER_SIZE = "<4sHHHHHIIIHH", 30
ENCRYPTED, SIZES_FOLLOW = 1, 8
STORED, DEFLATED = 0, 8
LARGE_FIELD, IN_FIELD = 1, 0xFFFFFFFF

ENCODING = "latin-1"
CHUNK_LINES = 20_000
#: Bytes of a block, and of the end of an archive in which its directory is looked for at first.
BLOCK, TAIL = 1 << 20, 1 << 20
#: Line numbers of the archives of a month, in the order of their paths, begin so far apart.
ARCHIVE_LINES = 10**9

BLOCKS = "archive string, period string, path string, size long, at long, body binary"
CLAIMS = "archive string, no int, start long, stop long, name string, checksum long, length long"
UNPACKED = "archive string, no int, table string, line_no long, line string, name string, begins long, ends long, message string"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive lines of a file split as blocks, numbered within the split."""
    names = ["path", "size", "split", "seq", "body"]
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "split", "line")), strict=True))
    for (path, size, split), lines in groupby(rows, key=itemgetter(0, 1, 2)):
        seq, held, length = 0, [], 0

        def block() -> pa.RecordBatch:
            body = b"\n".join(held) + b"\n"
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (path, size, split, seq, body)], names=names)

        for *_, line in lines:
            held.append(line)
            length += len(line) + 1
            if length >= BLOCK:
                yield block()
                seq, held, length = seq + 1, [], 0
        if held:
            yield block()


def _period(path: Column) -> Column:
    return F.regexp_substr(path, F.lit(r"\d{6}(?=[^/]*\.zip$)"))


def read_archives(spark: SparkSession, bronze: str, periods: list[str]) -> DataFrame:
    """Blocks of the archives of ``periods``; no other file is opened.

    (archive, period, path, size, at, body): ``at`` is the place of the block in its archive. An
    archive without a byte, which readers pass over, has a block of none. Bytes come from
    whatever storage Spark reads, and no value ever holds more than a block and a line. A file of
    one block stays where it is; the bytes of larger ones are written to scratch.
    """
    pattern = f"{bronze}/" + "{" + ",".join(f"{p}*.zip" for p in periods) + "}"
    if not any_match(spark, pattern):
        return spark.createDataFrame([], BLOCKS)
    found = sizes(spark, pattern)
    path = F.col("_metadata.file_path").alias("path")
    # Filters on the length are pushed down: larger files are not opened.
    small = spark.read.format("binaryFile").load(pattern).filter(F.col("length").between(1, BLOCK))
    every = small.select(path, F.col("length").alias("size"), F.lit(0).cast("long").alias("at"), F.col("content").alias("body"))
    if empty := [(p, 0, 0, b"") for p, n in found.items() if not n]:
        every = every.union(spark.createDataFrame(empty, "path string, size long, at long, body binary"))
    if any(n > BLOCK for n in found.values()):
        every = every.union(_in_blocks(spark, pattern))
    return every.select(F.col("path").alias("archive"), _period(F.col("path")).alias("period"), "path", "size", "at", "body")


def _in_blocks(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, size, at, body) of the files larger than a block."""
    path = F.col("_metadata.file_path").alias("path")
    lines = spark.read.option("lineSep", "\n").text(pattern).filter(F.col("_metadata.file_size") > BLOCK).select(
        path, F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("line")
    )
    packed = materialize(lines.mapInArrow(_pack, "path string, size long, split long, seq long, body binary"))
    # One row per split: its bytes, and with them where the next one begins.
    splits = packed.groupBy("path", "split").agg(F.sum(F.octet_length("body")).alias("bytes"))
    begun = F.sum("bytes").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path", "split", F.coalesce(begun, F.lit(0)).alias("begun"))
    sizes = packed.select("path", "split", "seq", F.octet_length("body").alias("bytes"))
    within = F.sum("bytes").over(Window.partitionBy("path", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    places = sizes.select("path", "split", "seq", F.coalesce(within, F.lit(0)).alias("within")).join(splits, ["path", "split"])
    # A row per block, written for the planner to see how small that is: the bytes stay where they are.
    places = materialize(places.select("path", "split", "seq", (F.col("begun") + F.col("within")).alias("at")))
    placed = packed.join(places, ["path", "split", "seq"])
    # The last line need not have been ended by a byte 10.
    body = F.expr("substring(body, 1, cast(least(octet_length(body), size - at) as int))").alias("body")
    return placed.select("path", "size", "at", body)


def as_blocks(archives: DataFrame) -> DataFrame:
    """The blocks of (period, path, content) rows, each row an archive of its own."""
    named = archives.select(F.monotonically_increasing_id().cast("string").alias("archive"), "period", "path", F.coalesce("content", F.lit(b"")).alias("body"))
    size = F.octet_length("body").cast("long")
    return materialize(named.select("archive", "period", "path", size.alias("size"), F.lit(0).cast("long").alias("at"), "body"))


def member_type(name: str) -> str:
    """``202401_Licitação.csv`` -> ``Licitação``; a name without a prefix is an error."""
    _, mark, rest = name.partition("_")
    if not mark:
        raise ValueError(f"{name!r} has no period before its type")
    return rest.removesuffix(".csv")


class _End(io.RawIOBase):
    """An archive of which only the end is at hand."""

    def __init__(self, size: int, tail: bytes) -> None:
        self.size, self.tail, self.at = size, tail, 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self.at, self.size)[whence]
        if place < 0:
            raise OSError("before the start")
        self.at = place
        return place

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        first = self.at - (self.size - len(self.tail))
        if first < 0:
            raise EOFError("not at hand")
        part = self.tail[first : first + len(buffer)]
        buffer[: len(part)] = part
        self.at += len(part)
        return len(part)


def _directory(size: int, tail: bytes) -> list[tuple] | None:
    """(start, stop, name, checksum, length) of the members by the archive's directory; None if the end does not hold all of it.

    An archive without a readable directory has no members here.
    """
    try:
        listed = zipfile.ZipFile(_End(size, tail)).infolist()
    except EOFError:
        return None
    except Exception:  # an unreadable archive is data: cut, or no archive at all
        return []
    starts = sorted(i.header_offset for i in listed)
    stops = dict(zip(starts, [*starts[1:], size]))
    return [(i.header_offset, stops[i.header_offset], i.filename, i.CRC, i.file_size) for i in listed]


def _is_empty(size: int, tail: bytes) -> bool:
    """Whether the directory can be read and lists nothing."""
    try:
        return not zipfile.ZipFile(_End(size, tail)).infolist()
    except Exception:
        return False


def _is_whole() -> Column:
    """Whether a block is all of its archive, so that one row has all that there is to read."""
    return (F.octet_length("body") > 0) & (F.col("at") == 0) & (F.octet_length("body") >= F.col("size"))


def _listed(size: int, end: bytes) -> list[tuple]:
    """What the directory lists: one row without a start if that is nothing, with a start of -1 if the end does not hold all of it."""
    listed = _directory(size, end)
    if listed is None:
        return [(-1, None, None, None, None)]
    return listed or ([(None, None, None, None, None)] if _is_empty(size, end) else [])


def _marked(size: int, body: bytes, at: int = 0) -> list[tuple]:
    """(start, stop, …) of every header mark: what may be a member, without what a directory knows."""
    found = []
    place = body.find(HEADER_MARK)
    while place >= 0:
        found.append((at + place, size, None, None, None))
        place = body.find(HEADER_MARK, place + 1)
    return found


def directories(blocks: DataFrame, tail: int = TAIL) -> DataFrame:
    """``CLAIMS`` of the members listed by the directories of all archives, written to scratch.

    A readable directory without members is one row without a start. The end of the archive that
    is looked at grows until it holds the whole directory. Archives of one block are read where
    they are; of others the ends meet.
    """
    spark = blocks.sparkSession
    names = [f.split()[0] for f in CLAIMS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("archive", "size", "body")), strict=True)
            made = [(archive, n, *row) for archive, size, body in rows for n, row in enumerate(_listed(size, body))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)], names=names)

    found = [materialize(blocks.filter(_is_whole()).select("archive", "size", "body").mapInArrow(look, CLAIMS))]
    left = blocks.filter(~_is_whole())
    while True:

        def read(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            rows = frame.sort_values("at")
            size, first = int(rows["size"].iloc[0]), int(rows["at"].iloc[0])
            end = b"".join(rows["body"])[max(0, size - tail - first) :]
            made = pd.DataFrame([(key[0], n, *row) for n, row in enumerate(_listed(size, end))], columns=names)
            return made.astype({c: "Int64" for c in ("no", "start", "stop", "checksum", "length")})

        ends = left.filter((F.octet_length("body") > 0) & (F.col("at") + F.octet_length("body") > F.col("size") - tail))
        made = materialize(ends.select("archive", "size", "at", "body").groupBy("archive").applyInPandas(read, CLAIMS))
        found.append(made.filter("start IS NULL OR start >= 0"))
        more = made.filter("start < 0").select("archive")
        if more.isEmpty():
            return reduce(DataFrame.union, found, spark.createDataFrame([], CLAIMS))
        left, tail = left.join(more, "archive", "left_semi"), tail * 16


def headers(blocks: DataFrame) -> DataFrame:
    """``CLAIMS`` of every place of a header mark in ``blocks``: what may be a member, without what a directory knows.

    A mark never lies across two blocks of an archive: they are cut behind a byte 10, which it has not.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for archive, size, at, body in zip(*(batch.column(c).to_pylist() for c in ("archive", "size", "at", "body")), strict=True):
                out += [(archive, stop, start) for start, stop, *_ in _marked(size, body, at)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["archive", "stop", "start"])

    marks = blocks.select("archive", "size", "at", "body").mapInArrow(look, "archive string, stop long, start long")
    no = F.row_number().over(Window.partitionBy("archive").orderBy("start")).cast("int")
    none = F.lit(None)
    return materialize(marks.select("archive", no.alias("no"), "start", "stop", none.cast("string").alias("name"), none.cast("long").alias("checksum"), none.cast("long").alias("length")))


class _Damaged(Exception):
    """A member that is not whole."""


@dataclass
class _Member:
    """One member as a stream of blocks (place, bytes), read once from its header on."""

    parts: Iterator[tuple[int, bytes]]
    start: int
    stop: int
    checksum: int | None
    length: int | None
    name: str = ""
    ends: int = 0

    def __post_init__(self) -> None:
        self._at, self._held = self.start, b""

    def _more(self) -> bool:
        for at, body in self.parts:
            part = body[max(0, self._at + len(self._held) - at) : max(0, self.stop - at)]
            if at > self._at + len(self._held):
                raise _Damaged("a block is missing")
            if part:
                self._held += part
                return True
        return False

    def _take(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise _Damaged("cut off")
        part, self._held = self._held[:n], self._held[n:]
        self._at += n
        return part

    def open(self) -> None:
        """Reads the header; what is no header, encrypted or of an unknown method is damage."""
        mark, _, flags, method, _, _, checksum, packed, size, name_size, extra_size = struct.unpack(HEADER, self._take(HEADER_SIZE))
        if mark != HEADER_MARK or flags & ENCRYPTED or method not in (STORED, DEFLATED):
            raise _Damaged("unreadable")
        raw, extra = self._take(name_size), self._take(extra_size)
        try:
            self.name = raw.decode("utf-8")
        except UnicodeDecodeError:
            self.name = raw.decode("cp437")
        self.large = False
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == LARGE_FIELD:
                wide = list(struct.unpack_from(f"<{min(n, len(extra) - 4) // 8}Q", extra, 4))
                self.large = True
                size = wide.pop(0) if size == IN_FIELD and wide else size
                packed = wide.pop(0) if packed == IN_FIELD and wide else packed
            extra = extra[4 + n :]
        self.method, self.follows = method, bool(flags & SIZES_FOLLOW)
        self.claimed = (checksum, size, packed)
        if method == STORED and self.follows and self.length is None:
            raise _Damaged("its size is not known")

    def chunks(self) -> Iterator[bytes]:
        """The content, checked against checksum and size at its end."""
        check = length = 0
        for part in self._inflated() if self.method == DEFLATED else self._stored():
            check, length = zlib.crc32(part, check), length + len(part)
            yield part
        checksum, size, _ = self.claimed
        if self.follows and self.checksum is None:
            if not self._held and not self._more():
                raise _Damaged("cut off")
            first = self._take(4)
            rest = "<IQQ" if self.large else "<III"
            checksum, _, size = struct.unpack(rest, (b"" if first == DESCRIPTOR_MARK else first) + self._take(struct.calcsize(rest) - (0 if first == DESCRIPTOR_MARK else 4)))
        self.ends = self._at
        if (check, length) != ((checksum, size) if self.checksum is None else (self.checksum, self.length)):
            raise _Damaged("wrong checksum or size")

    def _stored(self) -> Iterator[bytes]:
        left = self.length if self.follows else self.claimed[2]
        while left:
            if not self._held and not self._more():
                raise _Damaged("cut off")
            part = self._take(min(left, len(self._held)))
            left -= len(part)
            yield part

    def _inflated(self) -> Iterator[bytes]:
        inflater = zlib.decompressobj(-zlib.MAX_WBITS)
        end = None if self.follows else self._at + self.claimed[2]
        while not inflater.eof:
            if not self._held and not self._more():
                raise _Damaged("cut off")
            part = self._held if end is None else self._held[: end - self._at]
            if not part:
                raise _Damaged("cut off")
            self._take(len(part))
            while part and not inflater.eof:
                yield inflater.decompress(part, BLOCK)
                part = inflater.unconsumed_tail
        self._held, self._at = inflater.unused_data + self._held, self._at - len(inflater.unused_data)


class _Stream(io.RawIOBase):
    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.rest = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            self.rest = next(self.chunks, None)
            if self.rest is None:
                self.rest = b""
                return 0
        part, self.rest = self.rest[: len(buffer)], self.rest[len(buffer) :]
        buffer[: len(part)] = part
        return len(part)


def records(stream: io.BufferedIOBase) -> Iterator[str]:
    """Lines of a CSV stream; a line break inside quotes belongs to its record."""
    parts: list[str] = []
    open_quote = False
    for line in io.TextIOWrapper(stream, encoding=ENCODING, newline="\n"):
        parts.append(line)
        open_quote ^= line.count('"') % 2 == 1
        if not open_quote:
            record = "".join(parts).rstrip("\r\n")
            parts = []
            if record:
                yield record
    if parts:
        yield "".join(parts).rstrip("\r\n")


def raw_fields(line: str) -> list[str]:
    """Fields of a record as written, quotes included; a separator inside quotes is text."""
    fields: list[str] = []
    for part in line.split(";"):
        if fields and fields[-1].count('"') % 2:
            fields[-1] += ";" + part
        else:
            fields.append(part)
    return fields


def _places(table: str, header: str) -> list[int] | None:
    """Where the wanted columns are in the header, however wide; None when they lead it in order."""
    names = next(csv.reader([header], delimiter=";"))
    wanted = list(TABLE_HEADERS[table])
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    places = [names.index(c) for c in wanted]
    return None if places == list(range(len(wanted))) else places


def _picked(line: str, places: list[int]) -> str:
    fields = raw_fields(line)
    return ";".join(fields[p] if p < len(fields) else "" for p in places)


def _lines(chunks: Iterator[bytes], table: str) -> Iterator[str]:
    """Records of a member without its header, the wanted fields first. One of blank lines only has none."""
    every = dropwhile(lambda line: not line.strip(), records(io.BufferedReader(_Stream(chunks), BLOCK)))
    header = next(every, None)
    if header is None:
        return
    places = _places(table, header)
    yield from every if places is None else (_picked(line, places) for line in every)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of every claimed member, then a row that says what became of it.

    Rows come by archive, claim and place of the block, so a member is a stream: no more of it is
    in memory than a block and the lines of a chunk.
    """
    fields = ("archive", "no", "start", "stop", "checksum", "length", "at", "body")
    return _decoded(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in fields), strict=True))


def _decode_whole(claimed: Callable[[int, bytes], list[tuple]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_decode`` of archives of one block each, whose members are what ``claimed`` finds in it."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("archive", "size", "body")), strict=True))
        return _decoded(
            (archive, no, start, stop, checksum, length, 0, body)
            for archive, size, body in every
            for no, (start, stop, _, checksum, length) in enumerate(claimed(size, body))
            if start is not None and 0 <= start < min(stop, len(body))
        )

    return decode


def _decoded(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    columns = [f.split()[0] for f in UNPACKED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def told(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)], names=columns)

    for (archive, no, start, stop, checksum, length), group in groupby(rows, key=itemgetter(0, 1, 2, 3, 4, 5)):
        member = _Member(((at, body) for *_, at, body in group), start, stop, checksum, length)
        message = None
        try:
            member.open()
            kind = member.name.partition("_")[2].removesuffix(".csv")
            table = MEMBER_TABLES.get(kind)
            content = member.chunks()
            if table:
                first, lines = 0, _lines(content, table)
                try:
                    while chunk := list(islice(lines, CHUNK_LINES)):
                        n = len(chunk)
                        numbers = pa.array(range(first, first + n), pa.int64())
                        # Only the line differs from row to row.
                        same = {i: pa.repeat(pa.scalar(v, kinds[i]), n) for i, v in ((0, archive), (1, no), (2, table), (5, member.name), (6, start), (7, None), (8, None))}
                        yield pa.RecordBatch.from_arrays([same[0], same[1], same[2], numbers, pa.array(chunk, kinds[4]), same[5], same[6], same[7], same[8]], names=columns)
                        first += len(chunk)
                except ValueError as error:  # a header without a wanted column
                    message = str(error)
            for _ in content:
                pass
        except (_Damaged, zlib.error) as error:
            yield told([(archive, no, STATUS, None, None, member.name, start, None, f"damaged: {error}")])
            continue
        yield told([(archive, no, STATUS, None, None, member.name, start, member.ends, message)])


def _members(blocks: DataFrame, claims: DataFrame, claimed_in: Callable[[int, bytes], list[tuple]], by_period: bool = False) -> DataFrame:
    """``UNPACKED`` rows of all claims, written to scratch: every claimed member is one stream in one task.

    Archives of one block are decoded where they are, by what ``claimed_in`` finds in them, which
    is what ``claims`` has of them; ``by_period`` those of a period meet first. Of others, only
    the bytes of a member travel to its task.
    """
    whole = blocks.filter(_is_whole())
    if by_period:
        whole = whole.select("archive", "period", "size", "body").hint("rebalance", "period").sortWithinPartitions("period")
    whole = whole.select("archive", "size", "body").mapInArrow(_decode_whole(claimed_in), UNPACKED)
    blocks = blocks.filter(~_is_whole())
    claimed = claims.filter("start >= 0").withColumn("bucket", F.explode(F.expr(f"sequence(start div {BLOCK}, greatest(start, stop - 1) div {BLOCK})")))
    end = F.col("at") + F.octet_length("body")
    solid = blocks.filter(F.octet_length("body") > 0).select(
        "archive", "at", "body", F.explode(F.expr(f"sequence(at div {BLOCK}, (at + octet_length(body) - 1) div {BLOCK})")).alias("bucket")
    )
    # A block and a member that share several buckets meet in the first of them.
    first = F.greatest(F.expr(f"start div {BLOCK}"), F.expr(f"at div {BLOCK}"))
    met = solid.join(claimed, ["archive", "bucket"]).filter((F.col("bucket") == first) & (F.col("at") < F.col("stop")) & (end > F.col("start")))
    fields = ("archive", "no", "start", "stop", "checksum", "length", "at", "body")
    part = F.expr("substring(body, cast(greatest(start - at, 0) + 1 as int), cast(least(stop - at, octet_length(body)) - greatest(start - at, 0) as int))")
    met = met.withColumns({"body": part, "at": F.greatest("start", "at")})
    dealt = met.select(*fields).repartition("archive", "no").sortWithinPartitions("archive", "no", "at")
    return materialize(whole.union(dealt.mapInArrow(_decode, UNPACKED)))


def _walked(verdicts: DataFrame) -> DataFrame:
    """(archive, no): the whole members of damaged archives, as a walk from member to member finds them.

    A mark inside a member that is whole begins no member; of several of one type the last counts.
    """

    def walk(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        kept, end = {}, 0
        for row in frame.sort_values("begins").itertuples():
            if row.begins >= end:
                end = row.ends
                if "_" in row.name:
                    kept[member_type(row.name)] = row.no
        return pd.DataFrame({"archive": key[0], "no": list(kept.values())})

    whole = verdicts.filter("ends IS NOT NULL").select("archive", "no", "name", "begins", "ends")
    return whole.groupBy("archive").applyInPandas(walk, "archive string, no int")


def unpack_blocks(blocks: DataFrame, by_period: bool = False) -> DataFrame:
    """(period, path, table, line_no, line, outcome, message): a status row per archive and a row per CSV record of its modelled members.

    An archive is intact if its directory can be read and every listed member has its checksum;
    else its members are looked for by their headers, and those that are whole are kept. What is
    wrong with an archive is its status and nobody else's. ``by_period`` the records of a period
    lie in few tasks: archives are dealt out while they are packed, a fraction of their rows.
    """
    archives = blocks.groupBy("archive", "period", "path").agg(F.max("size").alias("size"))
    # Files of one month come in the order of their paths.
    rank = F.dense_rank().over(Window.partitionBy("period").orderBy("path")) - 1
    archives = materialize(archives.withColumn("offset", rank.cast("long") * ARCHIVE_LINES))
    claims = directories(blocks)
    listed = _members(blocks, claims, _listed, by_period)
    status = listed.filter(F.col("table") == STATUS)
    # Judged by the number of its members: a damaged archive may have no verdict at all.
    claimed = claims.groupBy("archive").agg(F.count("start").alias("members"))
    judged = status.groupBy("archive").agg(F.count_if(F.col("ends").isNotNull()).alias("whole"))
    good = claimed.join(judged, "archive", "left").filter(F.col("members") == F.coalesce("whole", F.lit(0))).select("archive")
    good = materialize(good)
    bad = archives.join(good, "archive", "left_anti")
    # Of several members of one type the last one listed counts.
    by_type = status.join(good, "archive", "left_semi").withColumn("type", F.when(F.contains("name", F.lit("_")), F.regexp_replace(F.regexp_replace("name", r"^[^_]*_", ""), r"\.csv$", "")))
    chosen = by_type.filter("type IS NOT NULL").groupBy("archive", "type").agg(F.max("no").alias("no")).select("archive", "no")
    nameless = F.max(F.when(F.isnull("type"), F.concat(F.lit("'"), "name", F.lit("' has no period before its type"))))
    refused = by_type.join(chosen.withColumn("chosen", F.lit(True)), ["archive", "no"], "left").groupBy("archive").agg(
        F.coalesce(nameless, F.max(F.when(F.col("chosen"), F.col("message")))).alias("message")
    )
    outcomes = good.join(refused, "archive", "left").select("archive", F.lit(INTACT).alias("found"), "message")
    # Members that do not count are few; as a written list they are sent to the lines, which stay where they are.
    passed = materialize(status.select("archive", "no").join(chosen, ["archive", "no"], "left_anti"))
    lines = listed.filter(F.col("table") != STATUS).join(passed, ["archive", "no"], "left_anti")
    if not bad.isEmpty():
        torn = _members(harmed := blocks.join(bad.select("archive"), "archive", "left_semi"), headers(harmed.filter(~_is_whole())), _marked, by_period)
        kept = materialize(_walked(torn.filter(F.col("table") == STATUS)))
        whole = torn.join(kept, ["archive", "no"], "left_semi")
        told = whole.filter(F.col("table") == STATUS).groupBy("archive").agg(F.max("message").alias("message"), F.lit(PARTIAL).alias("found"))
        message = F.when(F.isnull("found"), F.lit("not a single whole member is recoverable")).otherwise(F.col("message"))
        outcomes = outcomes.union(bad.select("archive").join(told, "archive", "left").select("archive", "found", message.alias("message")))
        lines = lines.union(whole.filter(F.col("table") != STATUS))
    outcomes = materialize(outcomes)
    none = F.lit(None).cast("string")
    of_status = outcomes.join(archives, "archive").select(
        "period", "path", F.lit(STATUS).alias("table"), F.lit(0).cast("long").alias("line_no"), none.alias("line"),
        F.when(F.col("message").isNull(), F.col("found")).otherwise(ERROR).alias("outcome"), "message",
    )
    # One row per archive, written like the lists above.
    usable = materialize(outcomes.filter("message IS NULL").select("archive").join(archives.select("archive", "period", "path", "offset"), "archive"))
    of_lines = lines.join(usable, "archive").select(
        "period", "path", "table", (F.col("line_no") + F.col("offset")).alias("line_no"), "line", none.alias("outcome"), none.alias("message")
    )
    return of_status.union(of_lines)


def unpack(archives: DataFrame) -> DataFrame:
    """``unpack_blocks`` of (period, path, content) rows."""
    return unpack_blocks(as_blocks(archives))


def _typed(raw: Column, field: T.StructField) -> Column:
    if field.dataType == MONEY:
        return br_decimal(raw)
    if isinstance(field.dataType, T.DateType):
        return br_date(raw)
    if isinstance(field.dataType, T.IntegerType):
        return lenient_int(raw)
    if isinstance(field.dataType, T.BooleanType):
        return yes_flag(raw)
    return raw


def parse_lines(unpacked: DataFrame, table: str) -> DataFrame:
    """Typed rows of one silver table: unreadable numbers and dates become null."""
    headers = TABLE_HEADERS[table]
    schema = ", ".join(f"c{i} string" for i in range(len(headers)))
    # Only an unquoted empty field is null; "" is an empty string. Fields beyond the modelled ones are passed over.
    options = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "\u0000"}
    fields = unpacked.filter(F.col("table") == table).select(
        "period", "line_no", F.from_csv("line", schema, options).alias("_f")
    )
    columns = [_typed(F.col(f"_f.c{i}"), SILVER[table][name]).alias(name) for i, name in enumerate(headers.values())]
    return fields.select(*columns, "line_no", "period")
