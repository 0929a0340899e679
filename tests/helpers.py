"""Small hand-made connection tables (times in seconds from 2024-01-01 UTC)."""

T0 = 1704067200000000  # 2024-01-01 00:00:00 UTC in µs

COLS = ("flow_id long, src_ip string, dst_ip string, dst_port int, ts_us long, packet_size long, "
        "connection_duration double, bytes_sent long, bytes_received long, is_failed int, has_dns_lookup int")


def flow(times_s, sizes=None, src="10.0.0.1", dst="45.33.32.156", port=443, recv=120, start_id=0,
         dns=0, failed=0):
    sizes = sizes if sizes is not None else [250] * len(times_s)
    rows = []
    for i, (t, s) in enumerate(zip(times_s, sizes)):
        ts = None if t is None else T0 + int(round(t * 1_000_000))
        r = recv[i] if isinstance(recv, list) else recv
        rows.append((start_id + i, src, dst, port, ts, s, 1.0, s, r, failed, dns))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)
