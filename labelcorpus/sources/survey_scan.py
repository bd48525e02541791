"""Splittable scan of one large JSON document: ``{"<key>": [record, record, ...], ...}`` read by many tasks.

A byte range of a document does not know whether it begins inside a string, nor how deep. Every range is therefore summed up
for both cases (the parity of its quotes, and how many brackets more are opened than closed, inside or outside a string at the
beginning); a fold over these few numbers a range gives each range's true state, and then each range cuts out the records
that begin in it, reading on past its end for the last one. Parsing stays with ``from_json``.

Two passes over the file, each in ``chunk_bytes`` pieces: a task holds one piece and its last record. The driver holds four numbers a
piece and one row for each array of the root object. A document that does not end outside all strings and brackets raises.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelcorpus.session import materialize

# The functions travel to the executors by value, so that workers need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 8 << 20
_KEY_BEFORE = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)


def _open(uri: str):
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _backslashes_before(file, at: int) -> int:
    """Length of the run of backslashes that ends at a place."""
    run, step = 0, 64
    while at > 0:
        begin = max(0, at - step)
        data = file.read_at(at - begin, begin)
        tail = len(data) - len(data.rstrip(b"\\"))
        run += tail
        if tail < len(data):
            break
        at, step = begin, 2 * step
    return run


def _structure(data: bytes, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, quotes before each byte that are not escaped, +1 or -1 at brackets); ``run``: backslashes before the data."""
    raw = np.frombuffer(data, np.uint8)
    at = np.arange(len(raw), dtype=np.int32)
    plain = np.maximum.accumulate(np.where(raw != 92, at, np.int32(-1 - run)))  # last byte that is no backslash
    before = np.concatenate([np.array([-1 - run], np.int32), plain[:-1]])
    quote = (raw == 34) & ((at - 1 - before) % 2 == 0)
    quotes = np.cumsum(quote, dtype=np.int32)
    bracket = np.where((raw == 123) | (raw == 91), 1, np.where((raw == 125) | (raw == 93), -1, 0)).astype(np.int8)
    return raw, quotes - quote, bracket


def _outside(quotes: np.ndarray, bracket: np.ndarray, in_string: int) -> np.ndarray:
    """Brackets outside strings."""
    return np.where((quotes + in_string) % 2 == 0, bracket, 0).astype(np.int8)


SUMMARY = "number bigint, flips int, opened_outside bigint, opened_inside bigint"
FOUND = "place bigint, key string, record string"


def _summarise(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    with _open(uri) as file:
        for batch in batches:
            for row in batch.to_pylist():
                data = file.read_at(row["stop"] - row["start"], row["start"])
                raw, quotes, bracket = _structure(data, _backslashes_before(file, row["start"]))
                last_is_quote = int(raw[-1] == 34 and _ends_string(data, file, row["start"]))
                yield pa.RecordBatch.from_pydict({
                    "number": [row["number"]], "flips": pa.array([int(quotes[-1] + last_is_quote) % 2], pa.int32()),
                    "opened_outside": [int(_outside(quotes, bracket, 0).sum(dtype=np.int64))],
                    "opened_inside": [int(_outside(quotes, bracket, 1).sum(dtype=np.int64))]})


def _ends_string(data: bytes, file, start: int) -> bool:
    """True if the last byte, a quote, is not escaped."""
    return _backslashes_before(file, start + len(data) - 1) % 2 == 0


def _cut(batches: Iterator[pa.RecordBatch], uri: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    with _open(uri) as file:
        size = file.size()
        for batch in batches:
            for row in batch.to_pylist():
                start, state, depth = row["start"], row["in_string"], row["depth"]
                data = file.read_at(row["stop"] - start, start)
                run = _backslashes_before(file, start)
                raw, quotes, bracket = _structure(data, run)
                change = _outside(quotes, bracket, state)
                after = depth + np.cumsum(change, dtype=np.int32)
                keys = [(start + int(i), _key(file, start + int(i)), None)
                        for i in np.flatnonzero((change == 1) & (after == 2) & (raw == 91))]
                begins = np.flatnonzero((change == 1) & (after == 3) & (raw == 123))
                ends = np.flatnonzero((change == -1) & (after == 2) & (raw == 125))
                ends = ends[ends >= begins[0]] if len(begins) else ends[:0]
                records = [(start + int(b), None, data[b:e + 1].decode()) for b, e in zip(begins, ends)]
                if len(begins) > len(ends):
                    b = int(begins[-1])
                    records.append((start + b, None, _rest(file, start + b, size, chunk_bytes).decode()))
                if keys or records:
                    place, key, text = zip(*keys, *records)
                    yield pa.RecordBatch.from_pydict({"place": pa.array(place, pa.int64()), "key": pa.array(key, pa.string()),
                                                      "record": pa.array(text, pa.string())})


def _rest(file, begin: int, size: int, chunk_bytes: int) -> bytes:
    """The object that begins at a place, however long."""
    parts, at, quotes_so_far, depth, run = [], begin, 0, 0, 0
    while at < size:
        data = file.read_at(min(1 << 16, chunk_bytes), at)
        raw, quotes, bracket = _structure(data, run)
        change = _outside(quotes, bracket, quotes_so_far % 2)
        after = depth + np.cumsum(change, dtype=np.int32)
        ends = np.flatnonzero((change == -1) & (after == 0))
        if len(ends):
            return b"".join([*parts, data[:int(ends[0]) + 1]])
        parts.append(data)
        quotes_so_far += int(quotes[-1] + (raw[-1] == 34 and _ends_string(data, file, at)))
        depth, at = int(after[-1]), at + len(data)
        run = _backslashes_before(file, at)
    raise ValueError(f"the record at byte {begin} does not end")


def _key(file, at: int) -> str:
    """The key before an array's bracket."""
    span = 1 << 10
    while True:
        begin = max(0, at - span)
        found = _KEY_BEFORE.search(file.read_at(at - begin, begin))
        if found or begin == 0:
            return found.group(1).decode() if found else ""
        span *= 4


def _uri(spark: SparkSession, path: str) -> tuple:
    """(file system, path and uri) of a path as Spark's readers understand it; the uri is for pyarrow."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, hadoop, re.sub(r"^file:/(?!//)", "file:///", system.makeQualified(hadoop).toString())


def _join_files(batches: Iterator[pa.RecordBatch], parts: list[str], target: str, block: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    for batch in batches:
        if batch.num_rows:
            system, at = fs.FileSystem.from_uri(target)
            written = 0
            with system.open_output_stream(at) as out:
                for part in parts:
                    with _open(part) as file:
                        for place in range(0, file.size(), block):
                            data = file.read_at(block, place)
                            out.write(data)
                            written += len(data)
            yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int64())})


def write_document(lines: DataFrame, order: list[str], path: str) -> int:
    """Write the column ``value`` as the lines of one text file, by ``order``; returns its bytes.

    Many tasks sort and write; one task then only copies their files one after the other, block by block, so that no task
    holds or sorts the document.
    """
    spark, folder = lines.sparkSession, f"{path}-parts"
    lines.orderBy(*order).select("value").write.text(folder)
    system, hadoop, _ = _uri(spark, folder)
    files = [f.getPath().toString() for f in system.listStatus(hadoop)]
    parts = sorted(_uri(spark, f)[2] for f in files if f.rsplit("/", 1)[-1].startswith("part-"))
    target = _uri(spark, path)[2]
    copied = spark.range(0, 1, 1, numPartitions=1).mapInArrow(lambda b: _join_files(b, parts, target), "written bigint")
    return copied.first()["written"]


def array_records(spark: SparkSession, path: str, key: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(place, record): the objects of the root's array ``key`` as JSON text, with their byte place in the document."""
    system, hadoop, uri = _uri(spark, path)
    size = system.getFileStatus(hadoop).getLen()
    n = max(1, -(-size // chunk_bytes))
    number = F.col("id")
    chunks = spark.range(0, n, 1, numPartitions=n).select(
        number.alias("number"), (number * chunk_bytes).alias("start"), F.least((number + 1) * chunk_bytes, F.lit(size)).alias("stop"))
    if size == 0:
        return spark.createDataFrame([], "place bigint, record string")
    sums = sorted(chunks.mapInArrow(lambda b: _summarise(b, uri), SUMMARY).collect())
    states, in_string, depth = [], 0, 0
    for s in sums:
        states.append((s["number"], in_string, depth))
        depth += s["opened_inside"] if in_string else s["opened_outside"]
        in_string ^= s["flips"]
    if in_string or depth:
        raise ValueError(f"{path} is no whole JSON document")
    begin = spark.createDataFrame(states, "number bigint, in_string int, depth int")
    known = chunks.join(F.broadcast(begin), "number")  # one row of three numbers a piece
    found = materialize(known.mapInArrow(lambda b: _cut(b, uri, chunk_bytes), FOUND))
    arrays = sorted((r["place"], r["key"]) for r in found.where(F.col("key").isNotNull()).select("place", "key").collect())
    inside = F.lit(False)
    for i, (place, name) in enumerate(arrays):
        if name == key:
            until = arrays[i + 1][0] if i + 1 < len(arrays) else size
            inside = inside | F.col("place").between(place, until)
    return found.where(F.col("record").isNotNull() & inside).select("place", "record")


def read_split(spark: SparkSession, path: str, key: str, schema: T.StructType, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The parsed records of ``array_records``."""
    return (array_records(spark, path, key, chunk_bytes).select(F.from_json("record", schema).alias("f")).select("f.*"))
