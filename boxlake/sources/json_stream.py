"""Large JSON documents read as a stream of the elements of their lists."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes read at once, elements per batch, and characters of elements after which a batch is passed on.
CHUNK, BATCH, BATCH_CHARS = 1 << 20, 2_000, 8 << 20

_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},"]', re.S)


def elements(chunks: Iterable[str]) -> Iterator[tuple[str, int, str]]:
    """(list, position, text) of every element of a top-level list (its name is ''), or of the lists in a top-level object.

    Only the current element and the current chunk are held. Members that are no lists are passed over. A document that
    is neither list nor object, or that ends early, raises ValueError; what elements hold is not checked here.
    """
    held, at, start, depth, position = "", 0, 0, 0, 0
    top, name, listed, word = "", "", False, ""
    for chunk in chunks:
        # What lies before the current element (or the current mark, outside of elements) is no longer needed.
        cut = start if listed else at
        held, at, start = held[cut:] + chunk, at - cut, start - cut
        while (m := _MARK.search(held, at)) is not None:
            mark = m[0]
            if mark == '"':
                at = m.start()  # a string that goes on in the next chunk
                break
            at = m.end()
            if mark[0] == '"':
                if not listed and depth == 1:
                    word = mark
                continue
            if mark in "[{":
                depth += 1
                if depth == 1:
                    if held[: m.start()].strip("\ufeff \t\r\n"):
                        raise ValueError("no JSON list or object")
                    top = mark
                if mark == "[" and (depth == 1 or (depth == 2 and top == "{" and not listed)):
                    name, listed, start, position = (json.loads(word) if depth == 2 else ""), True, at, 0
                    level = depth
                continue
            ends = mark in "]}"
            if listed and depth == level and (mark == "," or ends):
                text = held[start : m.start()].strip()
                if text:
                    yield name, position, text
                elif mark == "," or position:
                    raise ValueError(f"empty element {position} in list {name!r}")
                position, start = position + 1, at
                listed = not ends
            if ends:
                depth -= 1
                if depth < 0:
                    raise ValueError("unbalanced brackets")
    if depth or not top:
        raise ValueError("the document ends early")


def _chunks(path: str) -> Iterator[str]:
    path = re.sub(r"^file:/+", "/", path)
    fs, inner = pafs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (pafs.LocalFileSystem(), path)
    decode = codecs.getincrementaldecoder("utf-8")(errors="replace").decode
    with fs.open_input_stream(inner) as f:
        while data := f.read(CHUNK):
            yield decode(data)
        yield decode(b"", True)


def stream_json(spark: SparkSession, path: str) -> DataFrame:
    """(list, pos, value): the elements of the lists of a JSON file (or of the files of a folder), as JSON text.

    A file is one task's stream, whose memory does not grow with the file; the elements are then spread evenly, so that
    whatever parses them runs on all executors. Files may be of any size, which a row per file may not.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["list", "pos", "value"]
        for b in batches:
            for p in b.column(0).to_pylist():
                rows: list[tuple[str, int, str]] = []
                size = 0
                for row in elements(_chunks(p)):
                    rows.append(row)
                    size += len(row[2])
                    if len(rows) >= BATCH or size >= BATCH_CHARS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], names)

    out = files.mapInArrow(run, "list string, pos bigint, value string")
    return out.repartition(spark.sparkContext.defaultParallelism, F.col("list"), F.col("pos"))
