"""Captures cut at any byte, decoded by arrays, read and written as a data source."""

import os
import random
import struct
import tempfile
import time

import plain_captures
import pytest
from test_captures import T, dns_response, eth, fragment, ipv4, pcap, pcapng, same, tcp, udp

import beatline.sources.capture_bytes as cb
import beatline.sources.captures as cap
from beatline.sources import capture_source as source


def v6(proto, payload):
    return struct.pack(">IHBB16s16s", 6 << 28, len(payload), proto, 64, b"\x20\x01" + b"\0" * 13 + b"\x01",
                       b"\xfe\x80" + b"\0" * 13 + b"\x02") + payload


def frame(rng):
    ip = f"10.{rng.randrange(3)}.0.{rng.randrange(250)}"
    sport, dport = rng.choice([53, 5353, 40000, 1]), rng.choice([443, 53, 8443, 123])
    load = rng.choice([b"", b"x" * rng.randrange(60), b"\0" * 40, dns_response("a.example.com", ip), dns_response("b.c", ip)[:-3]])
    head = tcp(sport, dport)
    kind = rng.randrange(12)
    if kind == 0:
        return eth(0x0806, b"\0" * rng.randrange(40))
    if kind == 1:
        return eth(0x0800, ipv4(ip, "8.8.8.8", 6, head + load)[:rng.randrange(40)])
    if kind == 2:
        return eth(0x8100, b"\0\1" + struct.pack(">H", 0x88A8) + b"\0\2" + struct.pack(">H", 0x0800) + ipv4(ip, "9.9.9.9", 17, udp(sport, dport, load)))
    if kind == 3:
        return eth(0x0800, fragment(ip, "1.1.1.1", 17, rng.choice([0, 185, 0x2000]), udp(sport, dport, load)))
    if kind == 4:
        return eth(0x86DD, v6(rng.choice([6, 17, 58]), rng.choice([head, udp(sport, dport, b"")]) + load))
    if kind == 5:
        ext = struct.pack(">BB6x", rng.choice([17, 44, 60]), 0) + struct.pack(">BBHI", 17, 0, rng.choice([0, 800]), 7)
        return eth(0x86DD, v6(rng.choice([0, 43, 60, 44]), ext + udp(sport, dport, load)))
    if kind == 6:
        return bytes(rng.randrange(256) for _ in range(rng.randrange(70)))
    if kind == 7:
        return eth(0x0800, ipv4(ip, "2.2.2.2", rng.choice([1, 2, 89, 255]), load))
    return eth(0x0800, ipv4(ip, f"45.33.{rng.randrange(4)}.1", rng.choice([6, 17]), (head if kind % 2 else udp(sport, dport, b"")) + load))


def block(order, kind, body):
    body += b"\0" * (-len(body) % 4)
    return struct.pack(order + "II", kind, len(body) + 12) + body + struct.pack(order + "I", len(body) + 12)


def sections(rng, n):
    """A pcapng file of several sections, byte orders, interfaces and block types."""
    out = b""
    for _ in range(rng.randrange(1, 4)):
        order = rng.choice("<>")
        out += block(order, 0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1))
        links, names = 0, 0
        for _ in range(n):
            k = rng.randrange(40)
            if k == 0 or not links and rng.random() < 0.8:
                unit = rng.choice([b"", struct.pack(order + "HHB3x", 9, 1, rng.choice([6, 9, 3, 0x80 | 20])) + struct.pack(order + "HH", 0, 0)])
                out += block(order, 1, struct.pack(order + "HHI", rng.choice([1, 1, 1, 101, 113]), 0, rng.choice([0, 65535, 60])) + unit)
                links += 1
            elif k == 1:
                out += block(order, rng.choice([4, 5, 0x0BAD]), b"n" * rng.randrange(50))
                names += 1
            elif k == 2:
                f = frame(rng)
                out += block(order, 3, struct.pack(order + "I", len(f)) + f)
            else:
                f, t = frame(rng), (T + rng.randrange(10 ** 6)) * 10 ** 6
                out += block(order, 6, struct.pack(order + "IIIII", rng.randrange(max(1, links) + 1), t >> 32, t & 0xFFFFFFFF, len(f), len(f)) + f)
    return out


def plain_pcap(rng, n):
    order, magic = rng.choice("<>"), rng.choice([0xA1B2C3D4, 0xA1B23C4D])
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, rng.choice([1, 1, 1, 101, 113, 7]))
    for k in range(n):
        f = frame(rng)
        out += struct.pack(order + "IIII", T + k, rng.randrange(10 ** 6), len(f), len(f) + rng.randrange(2)) + f
    return out


def files(seed, n):
    rng = random.Random(seed)
    out = {}
    for k in range(6):
        out[f"p{k}.pcap"], out[f"s{k}.pcapng"] = plain_pcap(rng, n), sections(rng, n)
    out["cut.pcap"], out["cut.pcapng"] = out["p0.pcap"][:-7], out["s0.pcapng"][:-5]
    out["tail.pcap"], out["tail.pcapng"] = out["p1.pcap"] + b"\1\2\3", out["s1.pcapng"] + b"\0" * 14
    middle = len(out["s2.pcapng"]) // 2 // 4 * 4
    out["fault.pcapng"] = out["s2.pcapng"][:middle] + b"\xff" * 8 + out["s2.pcapng"][middle:]
    out["empty.pcap"], out["none.pcapng"], out["other.pcap"] = b"", b"\x0a\x0d", b"no capture at all, really not one"
    nested = pcap([(T + k, eth(0x0800, ipv4("10.0.0.1", "10.0.0.2", 17, udp(1, 2, pcap([(T, b"inner" * 9)] * 40)[24:])))) for k in range(9)])
    out["nested.pcap"] = nested                     # payloads that look like chains of records
    return out


@pytest.mark.parametrize("seed", range(4))
def test_arrays_decode_as_record_by_record(seed):
    for name, content in files(seed, 120).items():
        want = same(plain_captures.iter_capture_rows(name, content))
        assert same(cap.iter_capture_rows(name, content)) == want, name


def folder(contents):
    d = tempfile.mkdtemp(prefix="beatline-cuts-")
    for name, content in contents.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(content)
    return d


def test_cuts_at_any_byte_give_the_whole_decode(spark):
    contents = files(11, 60)
    d = folder(contents)
    del contents["empty.pcap"]                      # Spark lists no file without bytes
    want = sorted(str(r) for name, c in contents.items() for r in same(
        r for r in plain_captures.iter_capture_rows(name, c) if r["kind"] != "stats"))
    stats = sorted((name, r["n_total"], r["n_parsed"], r["n_skipped"], r["n_errors"]) for name, c in contents.items()
                   for r in plain_captures.iter_capture_rows(name, c) if r["kind"] == "stats")
    listed = cap.list_captures(spark, d)
    for piece in (1000 + random.Random(3).randrange(999), 1 << 30):
        rows = [r.asDict() for r in cap.decode(listed, piece_bytes=piece).collect()]
        for r in rows:
            r["file"] = os.path.basename(r["file"])
        assert sorted(str(r) for r in same(r for r in rows if r["kind"] != "stats")) == want, piece
        total = {}
        for r in rows:
            if r["kind"] == "stats":
                at = total.setdefault(r["file"], [0, 0, 0, 0])
                total[r["file"]] = [a + r[c] for a, c in zip(at, ("n_total", "n_parsed", "n_skipped", "n_errors"))]
        assert sorted((k, *v) for k, v in total.items()) == stats, piece


def test_guesses_are_right_or_found_wrong(spark):
    contents = files(5, 200)
    d = folder({k: contents[k] for k in ("p2.pcap", "nested.pcap")})
    listed = cap.list_captures(spark, d).select("path", "length")
    plan = cap.plan_captures(listed, 500).collect()
    for path in {r.path for r in plan}:
        content = open(path.removeprefix("file:"), "rb").read()
        start, context = cb.opened(content)
        offsets = cb.walk(content, start, len(content), len(content), context).offsets.tolist()
        got = [r for r in sorted(plan, key=lambda r: r.split) if r.path == path and r.first is not None]
        assert [r.first for r in got] == [next(o for o in offsets if o >= r.lo) for r in got]
        assert [r.base for r in got] == [offsets.index(r.first) for r in got] and sum(r.n for r in got) == len(offsets)


def test_decoding_by_arrays_is_ten_times_faster():
    rng = random.Random(1)
    frames = [(T + k, eth(0x0800, ipv4(f"10.0.0.{rng.randrange(250)}", "45.33.32.1", 6, tcp(40000, 443) + b"x" * 400))) for k in range(30_000)]
    content = pcap([]) + b"".join(pcap([f])[24:] for f in frames)
    began = time.perf_counter()
    n = sum(b.num_rows for b in cap.decode_whole("x", content))
    fast = time.perf_counter() - began
    began = time.perf_counter()
    assert n == sum(1 for _ in plain_captures.iter_capture_rows("x", content)) == 30_001
    assert time.perf_counter() - began > 5 * fast      # measured: over 10; half of that on a busy machine


def test_source_pushes_filters_and_prunes_files(spark):
    contents = files(7, 60)
    d = folder(contents)
    source.register(spark)
    plan = source.save_plan(spark, d, os.path.join(tempfile.mkdtemp(), "plan"), 3000)
    whole = cap.decode(cap.list_captures(spark, d))
    conditions = ["kind = 'packet' and dst_port = 443", "kind = 'dns'", "kind = 'stats'", "protocol in ('UDP', 'ICMP')",
                  f"ts_us >= {T * 10 ** 6 + 50} and ts_us < {(T + 90) * 10 ** 6} and src_ip like '10.1%'", "dst_port is null",
                  f"file = 'file:{d}/p3.pcap'", f"file in ('file:{d}/p3.pcap', 'file:{d}/s1.pcapng') and dst_port > 200", "ip is not null"]
    for c in conditions:
        got = spark.read.format("captures").option("plan", plan).load().where(c)
        columns = [x for x in got.columns if not x.startswith("n_")]
        want = sorted(map(str, whole.where(c).select(columns).distinct().collect()))
        assert sorted(map(str, got.select(columns).distinct().collect())) == want and want, c
        if c in conditions[:3]:
            alone = spark.read.format("captures").load(d).where(c)
            assert sorted(map(str, alone.select(columns).distinct().collect())) == want, c
    reader = source.CaptureReader(None, plan)
    rest = source.EqualTo(("src_ip",), "10.0.0.1")
    assert list(reader.pushFilters([source.EqualTo(("dst_port",), 443), rest])) == [rest] and reader.kinds == {"packet"}
    one = spark.read.format("captures").option("plan", plan).load().where(conditions[6])
    assert one.rdd.getNumPartitions() < spark.read.format("captures").option("plan", plan).load().rdd.getNumPartitions() / 5


def test_written_captures_read_back(spark):
    rng = random.Random(4)
    rows = [(f"f{k % 3}.{'pcapng' if k % 3 else 'pcap'}", k, (T + k) * 10 ** 6 + k, bytearray(frame(rng))) for k in range(200)]
    d = os.path.join(tempfile.mkdtemp(), "new")
    frames = spark.createDataFrame(rows, "file string, place long, ts_us long, frame binary").repartition(7)
    source.write_captures(frames, d, ["place"])
    assert sorted(os.listdir(d)) == ["f0.pcap", "f1.pcapng", "f2.pcapng"]
    for name in os.listdir(d):
        want = (pcapng if name.endswith("ng") else pcap)([])
        content = open(os.path.join(d, name), "rb").read()
        assert content[:4] == want[:4]
        got = [r for r in plain_captures.iter_capture_rows(name, content) if r["kind"] == "packet"]
        own = [r for r in rows if r[0] == name]
        assert [r["ts_us"] for r in got] == [own[r["packet_idx"]][2] for r in got]
    with pytest.raises(Exception, match="time and bytes"):
        source.write_captures(frames.withColumn("ts_us", source.F.lit(None).cast("long")), d + "2", ["place"])


def test_small_ranges_share_tasks(spark):
    contents = {f"f{k}.pcap{'ng' * (k % 2)}": (pcapng if k % 2 else pcap)([(T + i, eth(0x0800, ipv4(
        "10.0.0.1", "10.0.0.2", 6, tcp(1, i)))) for i in range(20)]) for k in range(60)}
    d = folder(contents)
    plan = source.save_plan(spark, d, tempfile.mkdtemp(prefix="beatline-plan-"), 400)
    n_ranges = spark.read.parquet(plan).count()
    assert n_ranges > 200
    rows = cap.decode(cap.list_captures(spark, d), piece_bytes=400)
    assert rows.rdd.getNumPartitions() <= cap.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    scan = source.CaptureReader(None, plan).partitions()
    assert len(scan) <= 2 * source.PARTITIONS and sum(len(p.ranges) for p in scan) == n_ranges
    source.register(spark)
    scanned = spark.read.format("captures").option("plan", plan).load()
    assert scanned.rdd.getNumPartitions() == len(scan)
    for kind, n in (("packet", 1200), ("stats", n_ranges)):
        assert scanned.where(f"kind = '{kind}'").count() == rows.where(f"kind = '{kind}'").count() == n


def test_ranges_are_packed_by_bytes(monkeypatch):
    def at(first, hi):
        return source.CaptureRange("x", 10_000, hi, first, hi, None, False, 0)
    monkeypatch.setattr(source, "PIECE_BYTES", 100)
    sizes = [60, 30, 20, 200, 0, 50, 51]
    ranges = [at(1000, 1000 + s) for s in sizes] + [at(None, 5)]
    monkeypatch.setattr(source, "PARTITIONS", 1)
    assert [[r.size for r in p.ranges] for p in source.packed(ranges)] == [[60, 30], [20], [200], [0, 50], [51, 0]]
    assert source.packed([]) == []
