import os
import struct
import tempfile

import plain_captures

import beatline.sources.captures as cap
from beatline.sources.captures import capture_connections, read_captures

T = 1704067200  # 2024-01-01 00:00:00 UTC


def eth(ethertype: int, payload: bytes) -> bytes:
    return b"\x00\x11\x22\x33\x44\x55" + b"\x66\x77\x88\x99\xaa\xbb" + struct.pack(">H", ethertype) + payload


def ipv4(src: str, dst: str, proto: int, payload: bytes) -> bytes:
    hdr = struct.pack(">BBHHHBBH4s4s", 0x45, 0, 20 + len(payload), 0, 0, 64, proto, 0,
                      bytes(int(x) for x in src.split(".")), bytes(int(x) for x in dst.split(".")))
    return hdr + payload


def udp(sport: int, dport: int, payload: bytes) -> bytes:
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def tcp(sport: int, dport: int) -> bytes:
    return struct.pack(">HHIIBBHHH", sport, dport, 0, 0, 5 << 4, 0x02, 1024, 0, 0)


def dns_response(name: str, ip: str) -> bytes:
    q = b"".join(bytes([len(p)]) + p.encode() for p in name.split(".")) + b"\x00" + struct.pack(">HH", 1, 1)
    a = b"\xc0\x0c" + struct.pack(">HHIH", 1, 1, 60, 4) + bytes(int(x) for x in ip.split("."))
    return struct.pack(">HHHHHH", 7, 0x8180, 1, 1, 0, 0) + q + a


def pcap(frames) -> bytes:
    out = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for ts, frame in frames:
        out += struct.pack("<IIII", int(ts), int(round((ts % 1) * 1e6)), len(frame), len(frame)) + frame
    return out


def pcapng(frames) -> bytes:
    shb_body = struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)
    shb = struct.pack("<II", 0x0A0D0D0A, 12 + len(shb_body)) + shb_body + struct.pack("<I", 12 + len(shb_body))
    idb_body = struct.pack("<HHI", 1, 0, 65535)
    idb = struct.pack("<II", 1, 12 + len(idb_body)) + idb_body + struct.pack("<I", 12 + len(idb_body))
    out = shb + idb
    for ts, frame in frames:
        ticks = int(round(ts * 1e6))
        pad = frame + b"\x00" * ((4 - len(frame) % 4) % 4)
        body = struct.pack("<IIIII", 0, ticks >> 32, ticks & 0xFFFFFFFF, len(frame), len(frame)) + pad
        out += struct.pack("<II", 6, 12 + len(body)) + body + struct.pack("<I", 12 + len(body))
    return out


def make_dir():
    d = tempfile.mkdtemp(prefix="beatline-cap-")
    dns = eth(0x0800, ipv4("8.8.8.8", "10.0.0.5", 17, udp(53, 40000, dns_response("example.com", "45.33.32.156"))))
    syn = eth(0x0800, ipv4("10.0.0.5", "45.33.32.156", 6, tcp(40001, 443)))
    arp = eth(0x0806, b"\x00" * 28)
    v6 = eth(0x86DD, struct.pack(">IHBB16s16s", 6 << 28, 8 + 4, 17, 64, b"\x20\x01" + b"\x00" * 13 + b"\x01",
                                 b"\x20\x01" + b"\x00" * 13 + b"\x02") + udp(5000, 123, b"ntp!"))
    broken = eth(0x0800, b"\x45\x00\x00")
    with open(os.path.join(d, "a.PCAP"), "wb") as f:
        f.write(pcap([(T + 1.5, dns), (T + 2.0, syn), (T + 3.0, arp), (T + 4.0, v6), (T + 5.0, broken)]))
    with open(os.path.join(d, "b.pcapng"), "wb") as f:
        f.write(pcapng([(T + 10.25, syn)]))
    with open(os.path.join(d, "notes.txt"), "wb") as f:
        f.write(b"not a capture")
    return d


def test_decode_captures(spark):
    c = read_captures(spark, make_dir())
    pk = sorted((os.path.basename(r.file), r.packet_idx, r.src_ip, r.dst_ip, r.dst_port, r.ts_us, r.protocol,
                 r.has_dns_lookup) for r in c["packets"].collect())
    assert pk == [
        ("a.PCAP", 0, "8.8.8.8", "10.0.0.5", 40000, (T + 1) * 1_000_000 + 500_000, "UDP", 1),
        ("a.PCAP", 1, "10.0.0.5", "45.33.32.156", 443, (T + 2) * 1_000_000, "TCP", 0),
        ("a.PCAP", 3, "2001::1", "2001::2", 123, (T + 4) * 1_000_000, "UDP", 0),
        ("b.pcapng", 0, "10.0.0.5", "45.33.32.156", 443, (T + 10) * 1_000_000 + 250_000, "TCP", 0),
    ]
    dns = [(r.ip, r.domain) for r in c["dns_answers"].collect()]
    assert dns == [("45.33.32.156", "example.com")]
    st = {os.path.basename(r.file): (r.n_total, r.n_parsed, r.n_skipped, r.n_errors) for r in c["stats"].collect()}
    assert st == {"a.PCAP": (5, 3, 1, 1), "b.pcapng": (1, 1, 0, 0)}


def test_capture_connections_with_domains(spark):
    flows = capture_connections(spark, make_dir()).collect()
    by = {(os.path.basename(r.file), r.dst_ip, r.dst_port): r for r in flows}
    assert by[("a.PCAP", "45.33.32.156", 443)].dst_domain == "example.com"
    assert by[("b.pcapng", "45.33.32.156", 443)].dst_domain == ""        # DNS map is per file
    assert sorted(r.flow_id for r in flows) == [f"pcap_flow_{i:06d}" for i in range(4)]
    one = by[("b.pcapng", "45.33.32.156", 443)]
    assert one.connection_duration == 0.001 and one.bytes_received == one.bytes_sent


def test_missing_directory_is_empty(spark):
    c = read_captures(spark, "/nonexistent/beatline-captures")
    assert c["packets"].count() == 0


def test_content_and_path_decoding_agree(spark, monkeypatch):
    d = make_dir()
    monkeypatch.setattr(cap, "ROWS_PER_BATCH", 2)          # several Arrow batches per file
    a = sorted(tuple(r) for r in read_captures(spark, d, by_path=True)["packets"].collect())
    b = sorted(tuple(r) for r in read_captures(spark, d, by_path=False)["packets"].collect())
    assert a == b and len(a) == 4


def fragment(src, dst, proto, offset, payload):
    p = bytearray(ipv4(src, dst, proto, payload))
    p[6:8] = struct.pack(">H", offset)
    return bytes(p)


def rows_of(content):
    """Decoded rows, the same from the library as record by record."""
    found = list(cap.iter_capture_rows("x", content))
    assert same(found) == same(plain_captures.iter_capture_rows("x", content))
    return found


def same(rows):
    return sorted((sorted((k, v) for k, v in r.items() if v is not None) for r in rows), key=repr)


def test_later_fragments_have_no_port():
    later = eth(0x0800, fragment("10.0.0.1", "10.0.0.2", 17, 185, b"\x27\x0f\x27\x0f" * 4))
    first = eth(0x0800, fragment("10.0.0.1", "10.0.0.2", 17, 0x2000, udp(5, 9999, b"x" * 8)))
    v6 = struct.pack(">IHBB16s16s", 6 << 28, 16, 44, 64, b"\0" * 15 + b"\1", b"\0" * 15 + b"\2")
    six = eth(0x86DD, v6 + struct.pack(">BBHI", 17, 0, 100 << 3, 7) + b"\x27\x0f\x27\x0f")
    got = [(r["dst_port"], r["has_dns_lookup"]) for r in rows_of(pcap([(T, later), (T, first), (T, six)])) if r["kind"] == "packet"]
    assert got == [(0, 0), (9999, 0), (0, 0)]


def test_simple_packet_blocks_leave_padding_out():
    frame = eth(0x0800, ipv4("10.0.0.1", "10.0.0.2", 17, udp(1, 2, b"x")))      # 43 bytes
    head = pcapng([])
    body = struct.pack("<I", len(frame)) + frame + b"\0" * (-len(frame) % 4)
    block = struct.pack("<II", 3, 12 + len(body)) + body + struct.pack("<I", 12 + len(body))
    packet = [r for r in rows_of(head + block) if r["kind"] == "packet"]
    assert [(r["packet_size"], r["ts_us"]) for r in packet] == [(43, None)]


def test_answers_before_a_malformed_one_stay():
    msg = bytearray(dns_response("example.com", "1.2.3.4"))
    msg[6:8] = struct.pack(">H", 3)
    msg += b"\xc0\x0c" + struct.pack(">HHIH", 1, 1, 60, 4) + b"\5\6\7\x08" + b"\xc0\xff\0"
    frame = eth(0x0800, ipv4("8.8.8.8", "10.0.0.5", 17, udp(53, 4000, bytes(msg))))
    got = rows_of(pcap([(T, frame)]))
    assert [r["ip"] for r in got if r["kind"] == "dns"] == ["1.2.3.4", "5.6.7.8"]
    assert got[-1]["n_errors"] == 0


def test_truncated_files_are_counted():
    frame = eth(0x0800, ipv4("10.0.0.1", "10.0.0.2", 6, tcp(1, 2)))
    whole = pcapng([(T, frame), (T + 1, frame)])
    got = rows_of(whole[:-6])
    assert [r["kind"] for r in got] == ["packet", "stats"] and got[-1]["n_errors"] == 1
    assert rows_of(b"no capture at all, really")[-1]["n_errors"] == 1 and rows_of(b"")[-1]["n_total"] == 0


def test_split_files_decode_as_whole_ones(spark):
    d = tempfile.mkdtemp(prefix="beatline-split-")
    frames = [(T + i, eth(0x0800, ipv4("10.0.0.5", "45.33.32.156", 6, tcp(40001, i + 1)))) for i in range(300)]
    for name, write in (("a.pcap", pcap), ("b.pcapng", pcapng)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(write(frames))
    with open(os.path.join(d, "b.pcapng"), "ab") as f:
        f.write(b"\0" * 13)
    out = [read_captures(spark, d, by_path=p, piece_bytes=n) for p, n in ((True, 1000), (True, 1 << 30), (False, 0))]
    rows = [sorted(map(tuple, c["packets"].collect())) for c in out]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 600
    stats = [sorted(map(tuple, c["stats"].collect())) for c in out]
    assert stats[0] == stats[1] == stats[2] and [s[-1] for s in stats[0]] == [0, 1]
    plan = cap.plan_captures(cap.list_captures(spark, d).select("path", "length"), 1000)
    assert plan.where("first is not null").count() > 20


def test_flows_of_one_file_are_numbered_by_many_tasks(spark):
    from pyspark.sql import functions as F
    n = 40_000
    flows = spark.range(n).select(
        F.lit("one").alias("file"), F.concat(F.lit("10.0."), (F.col("id") % 250).cast("string")).alias("src_ip"), F.lit("d").alias("dst_ip"),
        F.lit(443).alias("dst_port"), F.lit("TCP").alias("protocol"), F.xxhash64("id").alias("_first_idx"))
    flows = flows.unionByName(flows.limit(3).withColumn("file", F.lit("two")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = cap.number_flows(flows).select("file", "_first_idx", "flow_id")
        rows = sorted(map(tuple, out.collect()))
        order = ["file", "_first_idx"]
        sizes = [r["count"] for r in flows.repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r[2] for r in rows] == [f"pcap_flow_{k:06d}" for k in range(n + 3)]
    assert max(sizes) <= 2 * (n + 3) / len(sizes)
