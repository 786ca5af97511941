"""JSON arrays in pieces: one large array is read by many tasks.

A file is divided into byte ranges. A first pass finds for each range whether it holds an odd number of quotes and how far it
moves the nesting depth, both if it begins outside a text and if it begins inside one. Running sums over the ranges of a file
(a few numbers each) tell how each range really begins. A second pass cuts out the records: a range owns those that begin
behind a ``[`` or ``,`` of its own on the first level, and reads on past its end to finish the last one. Brackets, quotes and
backslashes are single bytes in UTF-8, so a border inside a letter does no harm.

A packed file (gzip, bzip2) can be read from its beginning only: it is one range, which a task takes in pieces in one pass.
"""

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
READ_ON = 1 << 16
PIECE_BYTES = 1 << 20  # of a packed file, as unpacked
PACKED = (".gz", ".bz2")
_ESCAPED = re.compile(rb"\\.", re.S)
_OPEN, _CLOSE = np.isin(np.arange(256), list(b"[{")), np.isin(np.arange(256), list(b"]}"))
_MARK = np.isin(np.arange(256), list(b'"[]{},'))


SCHEMES = ("file", "hdfs", "s3", "gs", "abfs", "abfss")  # what a task can open at a byte


def opens(path: str) -> bool:
    scheme = path.split(":", 1)[0] if ":" in path else "file"
    return scheme in SCHEMES


def _place(path: str):
    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    system, inner = _place(path)
    return system.open_input_file(inner)


def _unpacked(path: str):
    system, inner = _place(path)
    return system.open_input_stream(inner, compression="detect")


def _read(file, start: int, end: int) -> bytes:
    return file.read_at(end - start, start)


def _plain(file, start: int, end: int) -> bytes:
    """The bytes of a range with every escape overwritten, so that each quote left opens or closes a text."""
    data, back, run = _read(file, start, end), start, 0
    while back > 0:  # an odd run of backslashes in front escapes the first byte
        step = _read(file, max(0, back - READ_ON), back)
        tail = len(step) - len(step.rstrip(b"\\"))
        run, back = run + tail, max(0, back - READ_ON)
        if tail < len(step):
            break
    if run % 2:
        data = b"_" + data[1:]
    return _ESCAPED.sub(b"__", data)


def _marks(plain: bytes):
    """(places, values) of the quotes, brackets and commas; all that follows works on these few bytes."""
    b = np.frombuffer(plain, np.uint8)
    at = np.flatnonzero(_MARK[b])
    return at, b[at]


def _levels(marks: np.ndarray, inside: bool):
    """(outside any text, depth relative to the start) behind each mark."""
    outside = (np.cumsum(marks == 34) + inside) % 2 == 0
    return outside, np.cumsum((_OPEN[marks] & outside).astype(np.int64) - (_CLOSE[marks] & outside))


def _is_array(file) -> bool:
    at, size = 0, file.size()
    while at < size:
        head = _read(file, at, min(size, at + READ_ON)).removeprefix(b"\xef\xbb\xbf" if at == 0 else b"").lstrip()
        if head:
            return head.startswith(b"[")
        at += READ_ON
    return False


def _moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.itertuples():
            if r.path.endswith(PACKED):  # has no range behind it
                yield pd.DataFrame({"path": [r.path], "start": [r.start], "end": [r.end], "odd": [0], "outside": [0], "inside": [0]})
                continue
            with _open(r.path) as file:
                plain = _plain(file, r.start, r.end)
            marks = _marks(plain)[1]
            depth = [int(_levels(marks, inside)[1][-1]) if len(marks) else 0 for inside in (False, True)]
            yield pd.DataFrame({"path": [r.path], "start": [r.start], "end": [r.end], "odd": [plain.count(b'"') % 2],
                                "outside": [depth[0]], "inside": [depth[1]]})


def _borders(plain: bytes, inside: bool, depth: int):
    """Places of the brackets and commas of the first level; whether the range ends inside a text, and how deep."""
    at, marks = _marks(plain)
    if not len(at):
        return at, inside, depth
    outside, level = _levels(marks, inside)
    level = level + depth
    hit = outside & (((marks == 44) & (level == 1)) | ((marks == 91) & (level == 1)) | ((marks == 93) & (level == 0)))
    return at[hit], bool(not outside[-1]), int(level[-1])


def _texts(pieces) -> pd.DataFrame:
    return pd.DataFrame({"json": [t for t in (p.decode("utf-8", "replace") for p in pieces) if t.strip()]}, dtype=str)


def _elements(stream) -> Iterator[list[bytes]]:
    """The elements of a stream's array, some at a time; a task holds one piece and one element."""
    data = stream.read(PIECE_BYTES)
    head = data.removeprefix(b"\xef\xbb\xbf").lstrip()
    while not head and (more := stream.read(PIECE_BYTES)):
        data, head = more, more.lstrip()
    if not head.startswith(b"["):
        yield [b"".join([head, *iter(lambda: stream.read(PIECE_BYTES), b"")])]
        return
    inside, depth, held, half = False, 0, None, b""
    while data:
        data, plain = half + data, _ESCAPED.sub(b"__", half + data)
        half = data[-1:] if plain.endswith(b"\\") else b""  # an escape that is cut waits for its other byte
        if half:
            data, plain = data[:-1], plain[:-1]
        cuts, inside, depth = _borders(plain, inside, depth)
        cuts = cuts.tolist()
        if cuts:
            first = [b"".join([*held, data[:cuts[0]]])] if held is not None else []
            yield first + [data[a + 1:b] for a, b in zip(cuts, cuts[1:]) if plain[a] != 93]
            held = [data[cuts[-1] + 1:]] if plain[cuts[-1]] != 93 else None
        elif held is not None:
            held.append(data)
        data = stream.read(PIECE_BYTES)
    if held is not None:
        yield [b"".join([*held, half])]


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.itertuples():
            if r.path.endswith(PACKED):
                with _unpacked(r.path) as stream:
                    for pieces in _elements(stream):
                        yield _texts(pieces)
                continue
            with _open(r.path) as file:
                if not _is_array(file):
                    if r.start == 0:
                        text = _read(file, 0, file.size()).removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace")
                        yield pd.DataFrame({"json": [text] if text.strip() else []}, dtype=str)
                    continue
                raw, size = _read(file, r.start, r.end), file.size()
                plain = _plain(file, r.start, r.end)
                cuts, inside, depth = _borders(plain, bool(r.begins_inside), int(r.depth))
                starts = [c for c in cuts if plain[c] != 93]
                pieces = [raw[a + 1:b] for a, b in zip(cuts, cuts[1:]) if plain[a] != 93]
                if starts and starts[-1] == cuts[-1]:  # the last record goes on behind the range
                    last, at = [raw[starts[-1] + 1:]], r.end
                    while at < size:
                        stop = min(size, at + READ_ON)
                        more, inside, depth = _borders(_plain(file, at, stop), inside, depth)
                        if len(more):
                            last.append(_read(file, at, at + int(more[0])))
                            break
                        last.append(_read(file, at, stop))
                        at = stop
                    pieces.append(b"".join(last))
                yield _texts(pieces)


def array_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(json): one text per element of the arrays in the files of ``path``. Empty arrays and files have none. A file that is no
    array is one element, and an array that is cut off keeps its last piece. A task holds one range and one element, or of a
    packed file one piece and one element."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path", "length").filter("length > 0")
    packed = reduce(or_, [F.col("path").endswith(x) for x in PACKED])
    files = files.withColumn("step", F.when(packed, F.col("length")).otherwise(F.lit(range_bytes)).cast("long"))
    ranges = files.select("path", "length", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.col("step")))
                          .alias("start")).select("path", "start", F.least("length", F.col("start") + F.col("step")).alias("end"))
    # the ranges of one listing task are spread over all tasks; by number, since a range is a short row that stands for much work
    tasks = 2 * spark.sparkContext.defaultParallelism
    moves = ranges.repartition(tasks).mapInPandas(_moves, "path string, start long, end long, odd int, outside long, inside long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = moves.withColumn("begins_inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    moved = F.when(F.col("begins_inside") == 0, F.col("outside")).otherwise(F.col("inside"))
    begun = begun.withColumn("_moved", moved).withColumn("depth", F.coalesce(F.sum("_moved").over(before), F.lit(0)))
    return (begun.select("path", "start", "end", "begins_inside", "depth").repartition(tasks)
            .mapInPandas(_records, "json string"))


def read_json_array(spark: SparkSession, path: str, schema: str, corrupt: str = "_corrupt_record",
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The elements as rows of ``schema``; one that is no object of this kind keeps its text in ``corrupt``."""
    row = F.from_json("json", f"{schema}, {corrupt} string", {"columnNameOfCorruptRecord": corrupt})
    return array_records(spark, path, range_bytes).select(row.alias("r")).select("r.*")


def write_json_array(df: DataFrame, folder: str, compression: str = "none") -> None:
    """Every file holds one array, an element per line; files are written as the rows come. With gzip or bzip2 a file takes a
    small part of the disk, and one task to read it."""
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["["]})
        first = True
        for batch in batches:
            if len(batch):
                values = list("," + batch["value"])
                if first:
                    values[0], first = values[0][1:], False
                yield pd.DataFrame({"value": values})
        yield pd.DataFrame({"value": ["]"]})

    (df.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(lines, "value string").write.mode("overwrite")
     .text(folder, compression=compression))
