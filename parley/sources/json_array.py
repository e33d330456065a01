"""One JSON array as a table, read and written by many tasks.

Writing: each task writes its elements as a part file, the commit lists the parts that count, and a second small job copies them
to their places in the one file. Reading: a file is cut into ranges of bytes; a first job sums up each range (quotes, depth), a
prefix over these sums tells in which state each range begins, and then every range gives the elements that begin in it.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Bytes that one reading task takes, and that are read at once to finish an element.
RANGE_BYTES, MORE_BYTES = 32 << 20, 1 << 20
#: Elements of an Arrow batch.
BATCH = 2_000
#: The list of a written folder's parts.
MANIFEST = "_array.json"
QUOTE, SLASH, COMMA = 34, 92, 44
OPEN, CLOSE = (91, 123), (93, 125)


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a path or a URI."""
    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), os.path.abspath(path))


# --- structure -------------------------------------------------------------------------------------------------------


@dataclass
class State:
    """Where a range of bytes begins: inside a string or not, how many brackets deep, behind how many backslashes."""

    inside: bool = False
    depth: int = 0
    slashes: int = 0


def _quotes(data: np.ndarray, slashes: int) -> np.ndarray:
    """Places of the quotes that no odd number of backslashes precedes; ``slashes`` stand before the data."""
    quotes = np.flatnonzero(data == QUOTE)
    n = np.zeros(len(quotes), np.int64)
    going = np.arange(len(quotes))
    while len(going):
        at = quotes[going] - n[going] - 1
        n[going[at < 0]] += slashes
        going = going[(at >= 0) & (data[np.maximum(at, 0)] == SLASH)]
        n[going] += 1
    return quotes[n % 2 == 0]


def _trailing(data: np.ndarray, slashes: int) -> int:
    other = np.flatnonzero(data != SLASH)
    return len(data) - 1 - int(other[-1]) if len(other) else len(data) + slashes


def marks(data: np.ndarray, state: State) -> tuple[np.ndarray, np.ndarray, State]:
    """(places, kinds, state behind the data): where the array begins (1), an element ends and another begins (2), the array
    ends (0)."""
    quotes = _quotes(data, state.slashes)
    signs = np.flatnonzero(np.isin(data, (*OPEN, *CLOSE, COMMA)))
    signs = signs[(np.searchsorted(quotes, signs) + state.inside) % 2 == 0]
    found = data[signs]
    step = np.isin(found, OPEN).astype(np.int64) - np.isin(found, CLOSE)
    depth = state.depth + np.cumsum(step)
    begins = (found == OPEN[0]) & (depth == 1) & (step > 0)
    ends = (found == CLOSE[0]) & (depth == 0)
    between = (found == COMMA) & (depth == 1)
    which = begins | ends | between
    kinds = np.where(begins, 1, np.where(between, 2, 0))[which]
    after = State(bool((len(quotes) + state.inside) % 2), int(depth[-1]) if len(depth) else state.depth, _trailing(data, state.slashes))
    return signs[which], kinds, after


def summed(data: np.ndarray, slashes: int) -> tuple[int, int, int]:
    """(number of quotes, change of depth if the range begins outside a string, if it begins inside)."""
    quotes = _quotes(data, slashes)
    signs = np.flatnonzero(np.isin(data, (*OPEN, *CLOSE)))
    step = np.where(np.isin(data[signs], OPEN), 1, -1)
    odd = np.searchsorted(quotes, signs) % 2 == 1
    return len(quotes), int(step[~odd].sum()), int(step[odd].sum())


def _before(file, start: int) -> int:
    """Backslashes that stand right before a place of a file."""
    n, at = 0, start
    while at > 0:
        size = min(at, 256)
        file.seek(at - size)
        held = np.frombuffer(file.read(size), np.uint8)
        run = _trailing(held, 0)
        n += run
        if run < size:
            break
        at -= size
    return n


# --- reading ---------------------------------------------------------------------------------------------------------


@dataclass
class Range(InputPartition):
    """Bytes of a file, and the state in which they begin. A part of a written folder has elements without brackets."""

    path: str
    start: int
    stop: int
    inside: bool = False
    depth: int = 0
    bare: bool = False


def elements(file, part: Range) -> Iterator[bytes]:
    """The texts of the elements that begin in the range, the last one read to its end."""
    slashes = _before(file, part.start)
    file.seek(part.start)
    state = State(part.inside, part.depth, slashes)
    held, at = b"", part.start
    # where the element at hand begins in ``held``; None between elements that are not this range's
    begin = 0 if part.bare and part.start == 0 else None
    size = part.stop - part.start
    while True:
        data = file.read(size)
        if not data:
            break
        places, kinds, state = marks(np.frombuffer(data, np.uint8), state)
        if not part.bare and at == 0 and part.start == 0 and not data.lstrip().startswith(b"["):
            raise ValueError(f"{part.path}: not a JSON array")
        base, held = len(held), held + data
        for place, kind in zip(places.tolist(), kinds.tolist()):
            if begin is not None:
                text = held[begin : base + place].strip()
                if text:
                    yield text
            # what begins beyond the range is another task's
            begin = base + place + 1 if kind and at + place < part.stop else None
            if at + place >= part.stop or not kind:
                return
        if begin is None:
            if at + len(data) >= part.stop:
                return
            held = b""
        else:
            held, begin = held[begin:], 0
        at += len(data)
        size = MORE_BYTES
    if begin is not None:
        if not part.bare:
            raise ValueError(f"{part.path}: the JSON array has no end")
        if text := held[begin:].strip():
            yield text


class JsonArrayReader(DataSourceReader):
    def __init__(self, options: dict):
        self.ranges = [Range(**r) for r in json.loads(options["ranges"])] if "ranges" in options else files_of(options["path"])

    def partitions(self):
        return self.ranges or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, path = located(partition.path)
        with fs.open_input_file(path) as file:
            batch = []
            for text in elements(file, partition):
                batch.append(text)
                if len(batch) == BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(batch, pa.binary()).cast(pa.string())], names=["value"])
                    batch = []
            if batch:
                yield pa.RecordBatch.from_arrays([pa.array(batch, pa.binary()).cast(pa.string())], names=["value"])


def files_of(path: str) -> list[Range]:
    """Whole files: the one at ``path``, or the parts that its manifest lists."""
    fs, where = located(path)
    info = fs.get_file_info(where)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [Range(path, 0, info.size)]
    with fs.open_input_stream(f"{where}/{MANIFEST}") as f:
        parts = json.load(f)
    return [Range(f"{path.rstrip('/')}/{p['file']}", 0, p["bytes"], False, 1, True) for p in parts if p["rows"]]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
            fs, where = located(path)
            with fs.open_input_file(where) as file:
                slashes = _before(file, start)
                file.seek(start)
                rows.append((path, start, *summed(np.frombuffer(file.read(stop - start), np.uint8), slashes)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)] if rows else [pa.array([], t) for t in (pa.string(), *[pa.int64()] * 4)], names=["path", "start", "quotes", "outside", "inside"])


def ranges_of(spark: SparkSession, path: str, most: int | None = None) -> list[Range]:
    """The ranges of the files at ``path`` with the states they begin in. Files of one range need no look; of others, one job
    gives three numbers a range to the driver."""
    most = most or RANGE_BYTES
    whole = files_of(path)
    cut = [(f.path, a, min(a + most, f.stop)) for f in whole if f.stop > most for a in range(0, f.stop, most)]
    sums = {}
    if cut:
        rows = spark.createDataFrame(cut, "path string, start long, stop long").repartition(min(len(cut), 10_000), "path", "start")
        sums = {(r.path, r.start): r for r in rows.mapInArrow(_sums, "path string, start long, quotes long, outside long, inside long").collect()}
    out = []
    for f in whole:
        inside, depth = f.inside, f.depth
        for a in range(0, max(f.stop, 1), most):
            out.append(Range(f.path, a, min(a + most, f.stop), inside, depth, f.bare))
            if (s := sums.get((f.path, a))) is not None:
                depth += s.inside if inside else s.outside
                inside = bool((inside + s.quotes) % 2)
    return out


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """value: the JSON text of each element of the array, or of the arrays' parts, at ``path``."""
    spark.dataSource.register(JsonArraySource)
    ranges = json.dumps([{k: getattr(r, k) for k in ("path", "start", "stop", "inside", "depth", "bare")} for r in ranges_of(spark, path)])
    return spark.read.format("json_array").option("ranges", ranges).load()


def inferred(texts: DataFrame) -> T.StructType:
    """A schema for all elements, merged over the whole table; numbers with a fraction are doubles."""
    found = texts.agg(F.schema_of_variant_agg(F.parse_json("value"))).first()[0]
    if found in (None, "VOID", "OBJECT<>"):
        return T.StructType()
    ddl = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", found).replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    if not ddl.startswith("STRUCT<"):
        raise ValueError("the elements of the array are not objects")
    return texts.sparkSession.createDataFrame([], f"x {ddl}").schema["x"].dataType


def read_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The objects of a JSON array as rows; without a schema, a pass over the file finds one. A file of any size is read by as
    many tasks as it has ranges. Elements without any field, where there is no schema, are rows without a column."""
    texts = read_texts(spark, path)
    schema = schema or inferred(texts)
    return texts.select(F.from_json("value", schema).alias("x")).select("x.*") if schema.fields else texts.select()


# --- writing ---------------------------------------------------------------------------------------------------------


@dataclass
class Part(WriterCommitMessage):
    number: int
    file: str
    rows: int
    bytes: int


class JsonArrayWriter(DataSourceArrowWriter):
    """Writes the texts of the one column as elements, indented if asked for; a task's part counts only once it is committed,
    so parts of lost or repeated tasks are left out."""

    def __init__(self, options: dict):
        self.path, indent = options["path"], options.get("indent")
        self.indent = int(indent) if indent else None
        self.job = uuid.uuid4().hex

    def element(self, text: str) -> str:
        if self.indent is None:
            return text
        pad = " " * self.indent
        return pad + json.dumps(json.loads(text), ensure_ascii=False, indent=self.indent).replace("\n", "\n" + pad)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        fs, where = located(self.path)
        fs.create_dir(where, recursive=True)
        name = f"part-{task.partitionId():06d}-{self.job}-{task.taskAttemptId()}.json"
        rows = size = 0
        with fs.open_output_stream(f"{where}/{name}") as out:
            for batch in batches:
                texts = [self.element(t) for t in batch.column(0).to_pylist()]
                if texts:
                    data = ((",\n" if rows else "") + ",\n".join(texts)).encode("utf-8", "surrogatepass")
                    out.write(data)
                    rows, size = rows + len(texts), size + len(data)
        return Part(task.partitionId(), name, rows, size)

    def commit(self, messages: list[Part | None]) -> None:
        fs, where = located(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        kept = {m.file for m in parts if m.rows}
        fs.create_dir(where, recursive=True)
        with fs.open_output_stream(f"{where}/{MANIFEST}") as out:
            out.write(json.dumps([{"file": m.file, "rows": m.rows, "bytes": m.bytes} for m in parts if m.rows]).encode())
        for info in fs.get_file_info(pafs.FileSelector(where)):
            if info.base_name.startswith("part-") and info.base_name not in kept:
                fs.delete_file(info.path)

    def abort(self, messages: list[Part | None]) -> None:
        fs, where = located(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{where}/{m.file}")


class JsonArraySource(DataSource):
    """``format("json_array")``: a column ``value`` with the JSON text of each element. Written to a folder of parts with a
    list of them; read from such a folder, or from a file, a file as one range unless ``ranges`` says otherwise."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return JsonArrayReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if [f.dataType for f in schema.fields] != [T.StringType()]:
            raise ValueError("a JSON array is written from one column of JSON texts")
        return JsonArrayWriter(dict(self.options))


def _placed(target: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for path, offset, comma in zip(*(c.to_pylist() for c in batch.columns)):
                with open(path, "rb") as part, open(target, "r+b") as out:
                    out.seek(offset)
                    if comma:
                        out.write(b",\n")
                    while data := part.read(8 << 20):
                        out.write(data)
                        n += len(data)
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    return place


def _json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def write_array(df: DataFrame, path: str, indent: int | None = 4) -> int:
    """The rows as one JSON array in one file, and their number. No row passes the driver: tasks write parts, and tasks copy
    these to their places in the file, each of which may be done again. On a file system that cannot be written at a place
    the folder of parts stays at ``path``; it reads the same. With an indent, decimals are written as doubles."""
    spark = df.sparkSession
    spark.dataSource.register(JsonArraySource)
    fs, where = located(path)
    local = isinstance(fs, pafs.LocalFileSystem)
    folder = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}" if local else path
    writer = df.select(_json(df).alias("value")).write.format("json_array").mode("append")
    (writer.option("indent", indent) if indent else writer).save(folder)
    parts = files_of(folder)
    _, inner = located(folder)
    with fs.open_input_stream(f"{inner}/{MANIFEST}") as f:
        n = sum(p["rows"] for p in json.load(f))
    if not local:
        return n
    begin, end = b"[\n", b"\n]\n"
    offsets, at = [], len(begin)
    for i, p in enumerate(parts):
        offsets.append((located(p.path)[1], at, i > 0))
        at += p.stop + (2 if i else 0)
    draft = f"{inner}.draft"
    with open(draft, "wb") as out:
        if not parts:
            out.write(b"[]\n")
        else:
            out.write(begin)
            out.seek(at)
            out.write(end)
    if parts:
        rows = spark.createDataFrame(offsets, "path string, offset long, comma boolean").repartition(min(len(parts), 1_000), "path")
        rows.mapInArrow(_placed(draft), "n long").agg(F.sum("n")).collect()
    if os.path.isdir(where):
        fs.delete_dir(where)
    os.replace(draft, where)
    fs.delete_dir(inner)
    return n
