"""Captures as a registered data source: ``spark.read.format("captures")``, and a sink.

Reading::

    register(spark)
    plan = save_plan(spark, "/data/captures", "/shared/plan")        # once
    spark.read.format("captures").option("plan", plan).load().where("kind = 'packet' and dst_port = 443")

A partition holds planned ranges of about ``PIECE_BYTES`` in all, fewer while there are few
partitions.  Without a plan ``load(directory)`` takes whole files.  These filters are pushed into the scan: ``kind`` and ``file``
(``=``, ``in``; partitions of other files are never opened), and on packets ``ts_us`` and
``dst_port`` (comparisons, ``=``, ``in``) and ``protocol`` (``=``, ``in``), which drop
packets before any text is made of them; a scan without ``dns`` rows reads no DNS message.
Everything else is left to Spark.

Writing takes rows (file, ts_us, frame) and writes one capture per run of equal ``file``
names, pcapng for names that end so and pcap for others; a file appears under its name only
when all tasks have ended.  :func:`write_captures` deals and orders the rows for it.

Executors and the driver open paths themselves: a mounted file system, or one that Arrow
reads.  Other stores are served by ``captures.read_captures(by_path=False)``.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from beatline.sources import capture_bytes as cb
from beatline.sources.captures import (
    CAPTURE_EXTENSIONS,
    DECODED_SCHEMA,
    KINDS,
    PIECE_BYTES,
    RANGE,
    decode_range,
    is_local,
    list_captures,
    plan_captures,
    plan_range,
)

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
COMPARISONS = {GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}
PARTITIONS = 64                  # of a scan that PIECE_BYTES alone would cut into fewer
_LINK, _SNAP = cb.ETHERNET, 1 << 18


def register(spark: SparkSession) -> None:
    """Make ``format("captures")`` known to the session and let filters reach it."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(CaptureSource)


def save_plan(spark: SparkSession, directory: str, plan: str, piece_bytes: int = PIECE_BYTES) -> str:
    """Plan the captures of a directory (see ``captures.plan_captures``) and keep the plan as Parquet."""
    files = list_captures(spark, directory).select("path", "length")
    plan_captures(files, piece_bytes).where("split = 0 or first is not null").select(*RANGE).write.mode("overwrite").parquet(plan)
    return plan


def _file_system(uri: str):
    from pyarrow.fs import FileSystem, LocalFileSystem
    return (LocalFileSystem(), unquote(urlparse(uri).path)) if is_local(uri) else FileSystem.from_uri(uri)


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self):
        return DECODED_SCHEMA

    def reader(self, schema) -> "CaptureReader":
        return CaptureReader(self.options.get("path"), self.options.get("plan"))

    def writer(self, schema, overwrite: bool) -> "CaptureWriter":
        if overwrite:
            raise ValueError("captures are added to a directory: use mode('append')")
        return CaptureWriter(self.options["path"], schema.fieldNames())


@dataclass
class CaptureRange:
    path: str
    length: int
    hi: int
    first: int | None
    next: int | None
    context: str | None
    broken: bool
    base: int

    @property
    def size(self) -> int:
        return 0 if self.first is None else max(0, self.hi - self.first)


@dataclass
class CaptureRanges(InputPartition):
    ranges: list                 # CaptureRange


def packed(ranges: list[CaptureRange]) -> list[CaptureRanges]:
    """Ranges in their order, in partitions of about ``PIECE_BYTES``, or of a share of a smaller input."""
    share = min(PIECE_BYTES, sum(r.size for r in ranges) // PARTITIONS)
    out, held = [], 0
    for r in ranges:
        if not out or held and held + r.size > share:
            out.append(CaptureRanges([]))
            held = 0
        out[-1].ranges.append(r)
        held += r.size
    return out


@dataclass(frozen=True)
class Wanted:
    """Pushed conditions on packets, evaluated on arrays."""
    tests: tuple                 # (column, operator or None for membership, value)

    def __call__(self, ts: np.ndarray, known: np.ndarray, port: np.ndarray, protocol: np.ndarray) -> np.ndarray:
        out = np.ones(len(ts), dtype=bool)
        for column, compare, value in self.tests:
            if column == "protocol":
                out &= np.isin(np.array(cb.NAMES.to_pylist(), dtype=object), value)[protocol]
                continue
            x = ts if column == "ts_us" else port
            out &= np.isin(x, value) if compare is None else compare(x, value)
            if column == "ts_us":
                out &= known
        return out


class CaptureReader(DataSourceReader):
    def __init__(self, path: str | None, plan: str | None):
        if not (path or plan):
            raise ValueError("captures need a path or a plan")
        self.path, self.plan = path, plan
        self.kinds, self.files, self.tests = KINDS, None, ()

    def pushFilters(self, filters: list) -> Iterable:
        for f in filters:
            if not self._push(f):
                yield f

    def _push(self, f) -> bool:
        if not isinstance(f, (EqualTo, In, *COMPARISONS)) or len(f.attribute) != 1:
            return False
        column = f.attribute[0]
        values = [v for v in (f.value if isinstance(f, In) else [f.value])]
        if any(v is None for v in values):
            return False
        exact = isinstance(f, (EqualTo, In))
        if column == "kind" and exact:
            self.kinds = self.kinds & frozenset(values)
        elif column == "file" and exact:
            self.files = frozenset(values) if self.files is None else self.files & frozenset(values)
        elif column in ("ts_us", "dst_port") or column == "protocol" and exact:
            self.tests = (*self.tests, (column, None if exact else COMPARISONS[type(f)], values if exact else values[0]))
            self.kinds = self.kinds & {"packet"}           # other rows have no such cell
        else:
            return False
        return True

    def partitions(self) -> list[CaptureRanges]:
        found = self._planned() if self.plan else self._listed()
        return packed([r for r in found if self.files is None or r.path in self.files])

    def _planned(self) -> Iterator[CaptureRange]:
        import pyarrow.parquet as pq
        fs, at = _file_system(self.plan)
        for row in pq.read_table(at, filesystem=fs, columns=RANGE).to_pylist():
            yield CaptureRange(**row)

    def _listed(self) -> Iterator[CaptureRange]:
        from pyarrow.fs import FileSelector, FileType
        fs, at = _file_system(self.path)
        for info in sorted(fs.get_file_info(FileSelector(at, allow_not_found=True)), key=lambda i: i.path):
            if info.type == FileType.File and info.size and info.path.lower().endswith(CAPTURE_EXTENSIONS):
                name = f"file:{info.path}" if is_local(self.path) else f"{urlparse(self.path).scheme}://{info.path}"
                yield CaptureRange(name, info.size, info.size, -1, None, None, False, 0)

    def read(self, partition: CaptureRanges) -> Iterator[pa.RecordBatch]:
        keep = Wanted(self.tests) if self.tests else None
        for r in partition.ranges:
            if r.first == -1:                               # not planned: the whole file
                first, end, context, _, _, broken = plan_range(r.path, r.length, 0, r.length)
                r = CaptureRange(r.path, r.length, r.hi, first, end, context, broken, 0)
            yield from decode_range(r.path, r.length, r.hi, r.first, r.next, r.context, r.broken, r.base, self.kinds, keep)


# --- sink -----------------------------------------------------------------------

def _pcap_head() -> bytes:
    return struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, _SNAP, _LINK)


def _pcap_record(ts: int, frame: bytes) -> bytes:
    return struct.pack("<IIII", ts // cb.MICROS, ts % cb.MICROS, len(frame), len(frame)) + frame


def _block(kind: int, body: bytes) -> bytes:
    return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)


def _ng_head() -> bytes:
    return _block(cb.SECTION, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + _block(cb.INTERFACE, struct.pack("<HHI", _LINK, 0, _SNAP))


def _ng_record(ts: int, frame: bytes) -> bytes:
    head = struct.pack("<IIIII", 0, ts >> 32, ts & 0xFFFFFFFF, len(frame), len(frame))
    return _block(cb.ENHANCED, head + frame + b"\0" * (-len(frame) % 4))


@dataclass
class Written(WriterCommitMessage):
    files: list                  # (temporary name, name)


class CaptureWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str]):
        missing = {"file", "ts_us", "frame"} - set(columns)
        if missing:
            raise ValueError(f"captures: input is missing required columns: {sorted(missing)}")
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = _file_system(self.path)
        fs.create_dir(at, recursive=True)
        out, open_name, record, done = None, None, None, []
        for b in iterator:
            for name, ts, frame in zip(*(b.column(c).to_pylist() for c in ("file", "ts_us", "frame"))):
                if name != open_name:
                    if out:
                        out.close()
                    if not re.fullmatch(r"[^/\0]+", name):
                        raise ValueError(f"captures: not a file name: {name!r}")
                    hidden = f"{at}/.{uuid.uuid4().hex}.tmp"
                    out, open_name = fs.open_output_stream(hidden, buffer_size=1 << 20), name
                    done.append((hidden, f"{at}/{name}"))
                    ng = name.lower().endswith(".pcapng")
                    record = _ng_record if ng else _pcap_record
                    out.write(_ng_head() if ng else _pcap_head())
                out.write(record(ts, frame))
        if out:
            out.close()
        return Written(done)

    def commit(self, messages: list) -> None:
        fs, _ = _file_system(self.path)
        files = [f for m in messages if m for f in m.files]
        twice = len(files) - len({name for _, name in files})
        if twice:
            self.abort(messages)
            raise ValueError(f"captures: {twice} files were written by several tasks; deal the rows by file")
        for hidden, name in files:
            fs.move(hidden, name)

    def abort(self, messages: list) -> None:
        fs, _ = _file_system(self.path)
        for hidden in (h for m in messages if m for h, _ in m.files):
            fs.delete_file(hidden)


def write_captures(frames: DataFrame, directory: str, order: list[str]) -> None:
    """Write rows (file, ts_us, frame) as one capture per ``file``, packets by ``order``.

    A capture is one sequence of bytes, so each is written by one task; rows are dealt by the
    file name's hash, which needs no first pass over the frames.  Rows without a time or a frame cannot be written and raise.
    """
    register(frames.sparkSession)
    checked = frames.select("file", F.when(F.col("ts_us").isNull() | F.col("frame").isNull(), F.raise_error(
        F.lit("captures: a packet needs a time and bytes"))).otherwise(F.col("ts_us")).alias("ts_us"), "frame", *[
            F.col(c).alias(f"_order{k}") for k, c in enumerate(order)])
    (checked.repartition("file").sortWithinPartitions("file", *[f"_order{k}" for k in range(len(order))])
     .select("file", "ts_us", "frame").write.format("captures").mode("append").save(directory))


def base_name(path):
    """The file's own name, as a column."""
    return F.regexp_extract(path, r"([^/]+)$", 1)
