"""Packet captures as a Spark job: S1–S3, A1, A2, J1.

* **S1** ``binaryFile`` lists the directory (not recursive) and keeps
  ``.pcap`` / ``.pcapng`` in any letter case.
* **S2/S3** files are cut at any byte.  A first pass plans: each task guesses the first
  record of its range, follows the record headers to the range's end, and tells where the
  chain goes on; a range whose guess is not where the chain before it ends is planned again
  from there.  A second pass decodes the planned ranges with NumPy: one row per IP
  packet, one per DNS A answer and one counter row per range (parsed / non-IP /
  malformed).  ``capture_source`` offers the same scan as a registered data source.
* **A1** rolls packets up per (file, src, dst, port, protocol): one window
  + aggregate on the same key (one exchange).
* **A2** numbers flows by first appearance over all files: ranges of
  (file, first packet), a running number in each, offsets from the ranges' counts.
* **J1** attaches the last DNS answer for the destination *of the same file*.
"""

from __future__ import annotations

import logging
import mmap
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.functions.columns import round_half_up, strip_trailing_dots
from beatline.session import checkpoint_dir, scratch_path
from beatline.sources import capture_bytes as cb
from beatline.sources.files import is_directory

log = logging.getLogger(__name__)
PIECE_BYTES = 128 << 20
TASKS_PER_CORE = 4
HEAD_BYTES = 1 << 16
LOGGED_FILES = 20
ROWS_PER_BATCH = 65_536

# ---------------------------------------------------------------------------
# Capture extensions.
# ---------------------------------------------------------------------------
CAPTURE_EXTENSIONS = (".pcap", ".pcapng")

DECODED_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),          # packet | dns | stats
    T.StructField("file", T.StringType()),
    T.StructField("packet_idx", T.LongType()),
    T.StructField("answer_idx", T.IntegerType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("ts_us", T.LongType()),
    T.StructField("packet_size", T.IntegerType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("has_dns_lookup", T.IntegerType()),
    T.StructField("ip", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("n_total", T.LongType()),
    T.StructField("n_parsed", T.LongType()),
    T.StructField("n_skipped", T.LongType()),
    T.StructField("n_errors", T.LongType()),
])
_ARROW = {"kind": pa.string(), "file": pa.string(), "packet_idx": pa.int64(), "answer_idx": pa.int32(), "src_ip": pa.string(),
          "dst_ip": pa.string(), "dst_port": pa.int32(), "ts_us": pa.int64(), "packet_size": pa.int32(),
          "protocol": pa.string(), "has_dns_lookup": pa.int32(), "ip": pa.string(), "domain": pa.string(),
          "n_total": pa.int64(), "n_parsed": pa.int64(), "n_skipped": pa.int64(), "n_errors": pa.int64()}
KINDS = frozenset(("packet", "dns", "stats"))


# --- bytes of a file ------------------------------------------------------------

def is_local(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def read_range(path: str, lo: int, hi: int):
    """Bytes [lo, hi) of a file: mapped where the path is local, read through Arrow's file systems elsewhere."""
    if hi <= lo:
        return b""
    if is_local(path):
        with open(unquote(urlparse(path).path), "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))[lo:hi]
    from pyarrow.fs import FileSystem
    fs, name = FileSystem.from_uri(path)
    with fs.open_input_file(name) as f:
        return f.read_at(hi - lo, lo)


# --- decoding -------------------------------------------------------------------

def _batch(n: int, path: str, kind: str, **columns) -> pa.RecordBatch:
    fixed = {"kind": pa.repeat(kind, n), "file": pa.repeat(path, n)}
    return pa.RecordBatch.from_arrays(
        [(fixed | columns)[c].cast(t) if c in fixed or c in columns else pa.nulls(n, t) for c, t in _ARROW.items()],
        names=list(_ARROW))


def decoded(path: str, buf, run: cb.Run, size: int, base: int = 0, first: int = 0, kinds: frozenset = KINDS,
            keep: Callable | None = None, broken: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of a run of records of one capture: packets, DNS answers, then one counter row.

    ``first`` is the number of the run's first record in the file; ``keep`` leaves packets
    out early (see ``capture_bytes.decode``).
    """
    parsed = errors = 0
    for p in cb.decode(buf, run, size, base, keep, ROWS_PER_BATCH):
        n = len(p.index)
        parsed, errors = parsed + n, errors + p.errors
        index = p.index + first
        if n and "packet" in kinds:
            yield _batch(n, path, "packet", packet_idx=pa.array(index), src_ip=p.src, dst_ip=p.dst, dst_port=pa.array(p.port),
                         ts_us=p.ts, packet_size=pa.array(p.size), protocol=p.protocol, has_dns_lookup=pa.array(p.dns))
        if "dns" in kinds and p.dns.any():
            found = []
            for k in p.dns.nonzero()[0]:
                try:
                    for a, (ip, name) in enumerate(cb.dns_answers(bytes(buf[int(p.payload[k]):int(p.stop[k])]))):
                        found.append((int(index[k]), a, ip, name))
                except (ValueError, struct.error, IndexError, RecursionError):     # answers before the fault stay
                    pass
            if found:
                at, a, ip, name = (pa.array(list(c)) for c in zip(*found))
                yield _batch(len(found), path, "dns", packet_idx=at, answer_idx=a, ip=ip, domain=name)
    if "stats" in kinds:
        total = len(run.offsets)
        yield _batch(1, path, "stats", n_total=pa.array([total]), n_parsed=pa.array([parsed]),
                     n_skipped=pa.array([total - parsed - errors]), n_errors=pa.array([errors + (broken or run.broken)]))


def decode_whole(path: str, content) -> Iterator[pa.RecordBatch]:
    """Rows of a capture held in memory."""
    size = len(content)
    try:
        start = cb.opened(content[:24])
    except ValueError:
        yield from decoded(path, content, cb.NOTHING, size, broken=True)
        return
    yield from decoded(path, content, cb.walk(content, start[0], size, size, start[1]) if start else cb.NOTHING, size)


def iter_capture_rows(path: str, content) -> Iterator[dict]:
    """:func:`decode_whole` as dicts without the empty cells (small files and tests)."""
    for b in decode_whole(path, content):
        for row in b.to_pylist():
            yield {k: v for k, v in row.items() if v is not None or k == "ts_us" and row["kind"] == "packet"}


def decode_capture(path: str, content) -> list[dict]:
    """All decoded rows of one capture (small files and tests)."""
    return list(iter_capture_rows(path, content))


def _decode_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield from decode_whole(path, content)


# --- planning -------------------------------------------------------------------

PLAN = ("path string, length long, split long, lo long, hi long, first long, next long, before string, "
        "context string, n long, broken boolean")
_PLAN = {"path": pa.string(), "length": pa.int64(), "split": pa.int64(), "lo": pa.int64(), "hi": pa.int64(), "first": pa.int64(),
         "next": pa.int64(), "before": pa.string(), "context": pa.string(), "n": pa.int64(), "broken": pa.bool_()}


def plan_range(path: str, size: int, lo: int, hi: int, due: int | None = None, context: str | None = None) -> tuple:
    """(first, next, context before, context after, records, broken) of the records that begin in [lo, hi).

    ``due`` and ``context`` say where the chain of the range before ended; without them
    the first range starts behind the file header and others are guessed.
    """
    none = (None, None, None, None, 0, False)
    if due is None:
        head = read_range(path, 0, min(size, HEAD_BYTES))
        try:
            start = cb.opened(head[:24])
        except ValueError:
            return none if lo else (None, size, None, None, 0, True)
        if start is None:
            return none
        due, known = start
        if not lo and due >= hi:                   # a range shorter than the file header
            return None, due, known.text(), known.text(), 0, False
        if lo:                                     # as after the blocks before the file's first packet
            run = cb.walk(head, due, len(head), len(head), known)
            known = [c for at, c in run.epochs if at == 0][-1]
            buf = read_range(path, lo, min(size, hi + cb.WINDOW))
            due = cb.resync(buf, lo, hi, size, known, lo)
            if due is None:
                return none
    else:
        known = cb.Context.of(context)
    if due >= hi:
        return none
    run = cb.walk(read_range(path, due, min(size, hi + cb.WINDOW)), due, hi, size, known, due)
    return due, run.end, known.text(), run.context.text(), len(run.offsets), run.broken


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(*r[:5], *plan_range(r[0], r[1], *r[3:])) for r in zip(*(c.to_pylist() for c in b.columns))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _PLAN.values())], names=list(_PLAN))


def _spread(ranges: DataFrame) -> DataFrame:
    """Ranges in file order, dealt to tasks of about ``PIECE_BYTES``, smaller ones while a core has few tasks.

    A task costs more than reading a small range, so small ranges and files share one.
    """
    n, held = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0))).first()
    tasks = max(-(-held // PIECE_BYTES), TASKS_PER_CORE * ranges.sparkSession.sparkContext.defaultParallelism)
    return ranges.repartitionByRange(max(1, min(n, tasks)), "path", "split")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_captures(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Ranges of about ``piece_bytes`` of every file (path, length) and the records each owns.

    A guess is right when it is where the chain of the ranges before ended, under the same
    byte order and interfaces.  Ranges with another one are planned again from there, until
    none is left; each round settles the first wrong range of every file at least.
    ``base`` is the number of the range's first record.
    """
    step = F.lit(int(piece_bytes))
    split = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.expr(f"(length - 1) div {int(piece_bytes)}"), F.lit(0)).cast("long")))
    ranges = files.select("path", "length", split.alias("split")).select(
        "path", "length", "split", (F.col("split") * step).alias("lo"), F.least((F.col("split") + 1) * step, F.col("length")).alias("hi"),
        F.lit(None).cast("long").alias("due"), F.lit(None).cast("string").alias("known"))
    plan = _written(_spread(ranges).mapInArrow(_plan, PLAN), "capture-plan")
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        seen = plan.withColumns({"due": F.max("next").over(before), "known": F.last("context", True).over(before),
                                 "over": F.coalesce(F.max("broken").over(before), F.lit(False)),
                                 "base": F.coalesce(F.sum("n").over(before), F.lit(0))})
        due = F.when(F.col("over"), F.col("length")).otherwise(F.col("due"))
        wrong = F.when(due >= F.col("hi"), F.col("first").isNotNull()).otherwise(
            ~F.col("first").eqNullSafe(due) | ~F.col("before").eqNullSafe(F.col("known")))
        seen = seen.withColumn("wrong", (F.col("split") > 0) & F.col("due").isNotNull() & wrong).withColumn("due", due)
        again = _written(seen, "capture-plan")
        if not again.where("wrong").limit(1).count():
            return again.select("path", "length", "split", "lo", "hi", "first", "next", F.col("before").alias("context"),
                                "n", "broken", "base")
        redone = _spread(again.where("wrong").select("path", "length", "split", "lo", "hi", "due", "known")).mapInArrow(_plan, PLAN)
        plan = _written(again.where("not wrong").select(*plan.columns).unionByName(redone), "capture-plan")


def decode_range(path: str, size: int, hi: int, first: int | None, end: int | None, context: str | None, broken: bool, base: int,
                 kinds: frozenset = KINDS, keep: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a planned range."""
    if first is None:
        run, buf, first = cb.NOTHING, b"", 0
    else:
        buf = read_range(path, first, min(size, hi + cb.WINDOW if broken else max(end, first + 16)))
        run = cb.walk(buf, first, hi, size, cb.Context.of(context), first)
    yield from decoded(path, buf, run, size, first, base, kinds, keep, broken)


RANGE = ["path", "length", "hi", "first", "next", "context", "broken", "base"]


def _decode_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            yield from decode_range(*r)


# --- S1–S3 ----------------------------------------------------------------------

def list_captures(spark: SparkSession, directory: str) -> DataFrame:
    """Capture files of a directory (not recursive), any letter case; none if it is missing.

    Any other failure to list (permission, network) rises.
    """
    ext = "|".join(e.lstrip(".") for e in CAPTURE_EXTENSIONS)
    if not is_directory(spark, directory):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(directory)
    return files.where(F.lower(F.col("path")).rlike(rf"\.({ext})$"))


def decode(files: DataFrame, by_path: bool = True, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Decoded rows of every capture, by ranges of files.

    ``by_path``: captures that every executor can open (mounted, or through Arrow's file
    systems), cut into ranges of ``piece_bytes``.  Otherwise the bytes come through Spark
    (``content``), one whole file per row, which Spark limits to 2 GB a file.
    """
    if not by_path:
        return files.select("path", "content").mapInArrow(_decode_contents, DECODED_SCHEMA)
    return _spread(plan_captures(files.select("path", "length"), piece_bytes).where("split = 0 or first is not null")).select(
        *RANGE).mapInArrow(_decode_ranges, DECODED_SCHEMA)


def read_captures(spark: SparkSession, directory: str, by_path: bool | None = None,
                  piece_bytes: int = PIECE_BYTES) -> dict[str, DataFrame]:
    """``packets``, ``dns_answers`` and per-file ``stats`` tables.

    ``by_path`` None: by path where the files have a local path, through Spark
    elsewhere.  The decoded rows are written once, by kind, to the shared checkpoint
    folder; each table reads its own part.  ``stats.n_errors`` counts malformed
    packets and truncated or unreadable files.
    """
    checkpoint_dir(spark)
    files = list_captures(spark, directory)
    if by_path is None:
        by_path = files.select("path").where(~F.col("path").rlike("^(file:|/)")).limit(1).count() == 0
    out = scratch_path(spark, f"captures-{uuid.uuid4().hex}")
    decode(files, by_path, piece_bytes).write.partitionBy("kind").parquet(out)
    return capture_parts(spark.read.schema(DECODED_SCHEMA).parquet(out))


def capture_parts(rows: DataFrame) -> dict[str, DataFrame]:
    """The ``packets``, ``dns_answers`` and ``stats`` tables of decoded rows."""
    packets = rows.where(F.col("kind") == "packet").select(
        "file", "packet_idx", "src_ip", "dst_ip", "dst_port", "ts_us",
        F.timestamp_micros("ts_us").alias("timestamp"), "packet_size", "protocol", "has_dns_lookup")
    dns = rows.where(F.col("kind") == "dns").select("file", "packet_idx", "answer_idx", "ip",
                                                    strip_trailing_dots("domain").alias("domain"))
    counts = ["n_total", "n_parsed", "n_skipped", "n_errors"]
    stats = rows.where(F.col("kind") == "stats").groupBy("file").agg(*[F.sum(c).alias(c) for c in counts])
    return {"packets": packets, "dns_answers": dns, "stats": stats}


# --- A1, A2, J1 -----------------------------------------------------------------

ROLLUP_KEY = ["file", "src_ip", "dst_ip", "dst_port", "protocol"]


HOT_TUPLE_ROWS = 2_000_000


def _ranked_packets(packets: DataFrame, hot_rows: int | None) -> DataFrame:
    """Packets with ``_rn`` (time order inside their rollup group) and ``_n``.

    Groups above ``hot_rows`` packets are ranked through time slices
    (``hotflows.global_rank``) so no single task orders a huge group.
    """
    base = packets.select(*ROLLUP_KEY, "ts_us", "packet_idx", "packet_size", "has_dns_lookup")

    def window_route(b: DataFrame) -> DataFrame:
        w = Window.partitionBy(*ROLLUP_KEY).orderBy(F.col("ts_us").asc_nulls_last(), "packet_idx")
        return b.select("*", F.row_number().over(w).alias("_rn"),
                        F.count(F.lit(1)).over(Window.partitionBy(*ROLLUP_KEY)).alias("_n"))

    if hot_rows is None:
        return window_route(base)
    from beatline.operators import hotflows
    stats = base.groupBy(*ROLLUP_KEY).agg(F.count(F.lit(1)).alias("_n"), F.count("ts_us").alias("_m"),
                                          F.min("ts_us").alias("_tmin"), F.max("ts_us").alias("_tmax"))
    hot = stats.where(F.col("_n") > F.lit(hot_rows))
    n_hot = hot.count()                    # at most N / hot_rows groups
    if n_hot == 0:
        return window_route(base)
    hb = F.broadcast(hot) if n_hot <= hotflows.MAX_BROADCAST_HOT_FLOWS else hot
    cold = window_route(base.join(hb.select(*ROLLUP_KEY), ROLLUP_KEY, "left_anti"))
    hot_part = hotflows.global_rank(base.join(hb, ROLLUP_KEY).withColumn("_tbkey", F.col("packet_idx")),
                                    hot_rows, ROLLUP_KEY)
    return cold.unionByName(hot_part.withColumnRenamed("_rank", "_rn").select(*cold.columns))


def packets_to_flows(packets: DataFrame, hot_rows: int | None = HOT_TUPLE_ROWS) -> DataFrame:
    """A1: one connection record per (file, src, dst, port, protocol).

    First time; duration ``round(max(0.001, last − first), 4)`` s; total
    size; the first ``max(1, n div 2)`` packets in time order are "sent",
    the rest "received" (sent again when that is 0); DNS flag max; not
    failed; empty domain.  Window and aggregate share one exchange.
    """
    p = _ranked_packets(packets, hot_rows)
    half = F.greatest(F.lit(1), F.floor(F.col("_n") / 2))
    size = F.coalesce(F.col("packet_size").cast("bigint"), F.lit(0))
    g = p.groupBy(*ROLLUP_KEY).agg(
        F.min("ts_us").alias("ts_us"), F.max("ts_us").alias("_last"), F.min("packet_idx").alias("_first_idx"),
        F.sum(size).alias("packet_size"),
        F.sum(F.when(F.col("_rn") <= half, size).otherwise(F.lit(0))).alias("bytes_sent"),
        F.sum(F.when(F.col("_rn") > half, size).otherwise(F.lit(0))).alias("_recv"),
        F.max("has_dns_lookup").alias("has_dns_lookup"))
    dur = F.greatest(F.lit(0.001), (F.col("_last") - F.col("ts_us")) / F.lit(1e6))
    return g.select(
        *ROLLUP_KEY, "ts_us", F.timestamp_micros("ts_us").alias("timestamp"), "packet_size",
        round_half_up(dur, 4).alias("connection_duration"), "bytes_sent",
        F.when(F.col("_recv") == 0, F.col("bytes_sent")).otherwise(F.col("_recv")).alias("bytes_received"),
        F.lit(0).alias("is_failed"), F.coalesce(F.col("has_dns_lookup"), F.lit(0)).alias("has_dns_lookup"),
        F.lit("").alias("dst_domain"), "_first_idx")


def number_flows(flows: DataFrame) -> DataFrame:
    """A2: ``flow_id = pcap_flow_%06d`` by first appearance, files in name order.

    Flows are cut into ranges of (file, first packet, key), so a file of any size is
    numbered by many tasks.  A flow's number is its place in its range plus the
    number of flows in the ranges before: sums over one row per range.
    """
    order = ["file", "_first_idx", *ROLLUP_KEY[1:]]
    checkpoint_dir(flows.sparkSession)
    place = F.monotonically_increasing_id()          # the range's number << 33, plus the place in it
    ranged = flows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place).checkpoint(eager=True)
    part, rank = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (ranged.withColumns({"_part": part, "_rank": rank}).join(F.broadcast(before), "_part")
            .withColumn("flow_id", F.format_string("pcap_flow_%06d", F.col("_before") + F.col("_rank")))
            .drop("_place", "_part", "_rank", "_before"))


def latest_domains(dns: DataFrame) -> DataFrame:
    """J1 (map side): per (file, ip) the domain of the last answer in packet order."""
    return dns.groupBy("file", "ip").agg(
        F.max_by("domain", F.struct("packet_idx", "answer_idx")).alias("_domain"))


def enrich_domains(flows: DataFrame, dns: DataFrame) -> DataFrame:
    """``dst_domain`` from the same file's DNS answers, '' when none."""
    m = latest_domains(dns).withColumnRenamed("ip", "dst_ip")
    return (flows.drop("dst_domain").join(m, ["file", "dst_ip"], "left")
            .withColumn("dst_domain", F.coalesce(F.col("_domain"), F.lit(""))).drop("_domain"))


def capture_tables(spark: SparkSession, directory: str, by_path: bool | None = None) -> dict[str, DataFrame]:
    """S1–S3 → A1 → A2 → J1: ``connections`` of a capture directory, and its ``stats`` (errors per file)."""
    c = read_captures(spark, directory, by_path)
    flows = number_flows(packets_to_flows(c["packets"]))
    return {"connections": enrich_domains(flows, c["dns_answers"]).drop("_first_idx"), "stats": c["stats"]}


def capture_connections(spark: SparkSession, directory: str, by_path: bool | None = None) -> DataFrame:
    """The connection records of :func:`capture_tables`; files with errors are logged."""
    tables = capture_tables(spark, directory, by_path)
    for r in tables["stats"].where("n_errors > 0").orderBy("file").limit(LOGGED_FILES).collect():
        log.warning("capture %s: %d of %d packets malformed, or the file is truncated", r.file, r.n_errors, r.n_total)
    return tables["connections"]


def packets_as_connections(packets: DataFrame) -> DataFrame:
    """T1 fix: each packet as one connection record (sent = its size, rest 0/NULL),
    so a single capture can reach the per-flow minimum."""
    return packets.select(
        "file", "packet_idx", "src_ip", "dst_ip", "dst_port", "ts_us",
        F.col("packet_size").cast("bigint").alias("packet_size"), "protocol",
        F.lit(0.0).alias("connection_duration"), F.col("packet_size").cast("bigint").alias("bytes_sent"),
        F.lit(None).cast("bigint").alias("bytes_received"), F.lit(0).alias("is_failed"),
        "has_dns_lookup")
