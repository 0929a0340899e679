"""A capture decoded record by record in plain Python: what the library's decoder is compared with."""

import ipaddress
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

PROTOCOL_NAMES = {1: "ICMP", 6: "TCP", 17: "UDP", 58: "ICMPv6"}
DNS_PORTS = (53, 5353)


@dataclass(frozen=True)
class Piece:
    """A run of whole records of one capture, and what reading them needs.

    ``first`` is the number of the first record; ``order`` the byte order; ``units``
    the time units per second; ``interfaces`` the (link type, units per second, snap
    length) of a pcapng section so far, or the one of a pcap file.
    """
    start: int
    end: int
    first: int
    ng: bool
    order: str
    interfaces: tuple

    def text(self) -> str:
        return json.dumps([self.start, self.end, self.first, self.ng, self.order, self.interfaces])

    @staticmethod
    def of(text: str) -> "Piece":
        start, end, first, ng, order, interfaces = json.loads(text)
        return Piece(start, end, first, ng, order, tuple(map(tuple, interfaces)))


def whole(buf) -> Piece | None:
    """The piece that covers a whole file; None for an empty one."""
    if len(buf) < 4:
        return None
    magic = bytes(buf[:4])
    if magic == b"\x0a\x0d\x0d\x0a":
        return Piece(0, len(buf), 0, True, "<", ())
    table = {b"\xd4\xc3\xb2\xa1": ("<", 10 ** 6), b"\xa1\xb2\xc3\xd4": (">", 10 ** 6),
             b"\x4d\x3c\xb2\xa1": ("<", 10 ** 9), b"\xa1\xb2\x3c\x4d": (">", 10 ** 9)}
    if magic not in table or len(buf) < 24:
        raise ValueError("not a capture file")
    order, units = table[magic]
    link = struct.unpack(order + "I", buf[20:24])[0] & 0x0FFFFFFF
    return Piece(24, len(buf), 0, False, order, ((link, units, 0),))


def records(buf, piece: Piece, marks: int = 0):
    """(ts_us, link type, frame bytes) of a piece; with ``marks`` the pieces of about so many bytes instead.

    Marks read record headers only.
    """
    off, e, ifaces, first = piece.start, piece.order, list(piece.interfaces), piece.first
    n, begin = first, (off, first, e, tuple(ifaces))

    def cut(at: int) -> Piece:
        return Piece(begin[0], at, begin[1], piece.ng, begin[2], begin[3])

    while off + (12 if piece.ng else 16) <= piece.end:
        if marks and off - begin[0] >= marks:
            yield cut(off)
            begin = (off, n, e, tuple(ifaces))
        if not piece.ng:
            sec, frac, incl, _orig = struct.unpack(e + "IIII", buf[off:off + 16])
            link, units, _ = ifaces[0]
            if not marks:
                yield sec * 1_000_000 + frac * 1_000_000 // units, link, buf[off + 16:off + 16 + incl]
            off, n = off + 16 + incl, n + 1
            continue
        btype = struct.unpack(e + "I", buf[off:off + 4])[0]
        if btype == 0x0A0D0D0A:      # section header: byte order from its magic
            e = "<" if bytes(buf[off + 8:off + 12]) == b"\x4d\x3c\x2b\x1a" else ">"
            ifaces = []
        btype, size = struct.unpack(e + "II", buf[off:off + 8])
        if size < 12 or off + size > piece.end:
            if marks:                # the piece that holds the fault reports it when it is decoded
                break
            raise ValueError("truncated block")
        if btype == 1:
            ifaces.append(_interface(buf[off + 8:off + size - 4], e))
        elif btype in (3, 6):
            n += 1
            if not marks:
                yield _block(btype, buf[off + 8:off + size - 4], e, ifaces)
        off += size
    if marks:
        yield cut(piece.end)


def _interface(body: bytes, e: str) -> tuple[int, int, int]:
    """Link type, time units per second and snap length of an interface description."""
    link, _, snap = struct.unpack(e + "HHI", body[0:8])
    units, o = 1_000_000, 8
    while o + 4 <= len(body):
        code, size = struct.unpack(e + "HH", body[o:o + 4])
        if code == 0:
            break
        if code == 9 and size >= 1:
            v = body[o + 4]
            units = 2 ** (v & 0x7F) if v & 0x80 else 10 ** v
        o += 4 + ((size + 3) // 4) * 4
    return link, units, snap


def _block(btype: int, body: bytes, e: str, ifaces: list):
    if btype == 6:                   # enhanced packet
        iface, hi, lo, cap, _orig = struct.unpack(e + "IIIII", body[:20])
        link, units, _ = ifaces[iface] if iface < len(ifaces) else (1, 1_000_000, 0)
        return ((hi << 32) | lo) * 1_000_000 // units, link, body[20:20 + cap]
    link, _, snap = ifaces[0] if ifaces else (1, 0, 0)
    size = struct.unpack(e + "I", body[:4])[0]      # simple packet: no time stamp, padded to 4 bytes
    return None, link, body[4:4 + (min(size, snap) if snap else size)]


def _network_layer(linktype: int, data: bytes):
    """(ethertype-ish version, offset of the IP header) or None for non-IP."""
    if linktype == 1:                # Ethernet (+ VLAN tags)
        if len(data) < 14:
            return None
        et, off = struct.unpack(">H", data[12:14])[0], 14
        while et in (0x8100, 0x88A8) and len(data) >= off + 4:
            et, off = struct.unpack(">H", data[off + 2:off + 4])[0], off + 4
        return {0x0800: (4, off), 0x86DD: (6, off)}.get(et)
    if linktype == 113:              # Linux cooked capture
        if len(data) < 16:
            return None
        et = struct.unpack(">H", data[14:16])[0]
        return {0x0800: (4, 16), 0x86DD: (6, 16)}.get(et)
    if linktype in (101, 12, 14, 228, 229):   # raw IP
        if not data:
            return None
        v = data[0] >> 4
        return (v, 0) if v in (4, 6) else None
    return None


def _dns_answers(payload: bytes):
    """A records of a DNS message, (ip, name) in answer order; a malformed one raises after those before it."""
    if len(payload) < 12:
        return
    qd, an = struct.unpack(">HH", payload[4:8])

    def name_at(o, depth=0):
        labels = []
        while True:
            ln = payload[o]
            if ln == 0:
                return ".".join(labels) + ".", o + 1
            if ln & 0xC0 == 0xC0:
                ptr = struct.unpack(">H", payload[o:o + 2])[0] & 0x3FFF
                if depth > 16:
                    raise ValueError("loop")
                rest, _ = name_at(ptr, depth + 1)
                labels.append(rest[:-1]) if rest != "." else None
                return ".".join(labels) + ".", o + 2
            labels.append(payload[o + 1:o + 1 + ln].decode("utf-8", "replace"))
            o += 1 + ln

    o = 12
    for _ in range(qd):
        _, o = name_at(o)
        o += 4
    for _ in range(an):
        name, o = name_at(o)
        rtype, _cls, _ttl, rdlen = struct.unpack(">HHIH", payload[o:o + 10])
        o += 10
        if rtype == 1 and rdlen == 4:
            if len(payload) < o + 4:
                raise ValueError("truncated answer")
            yield ".".join(str(b) for b in payload[o:o + 4]), name
        o += rdlen


def iter_capture_rows(path: str, content, piece: Piece | None = None) -> Iterator[dict]:
    """Decoded rows of one capture (or one piece of it), streamed: packets, DNS answers,
    then one counter row (total / parsed / non-IP skipped / malformed)."""
    total = parsed = errors = bad_file = 0
    try:
        piece = piece or whole(content)
        found = records(content, piece) if piece else iter(())
    except ValueError:
        bad_file, found = 1, iter(())
    while True:
        try:
            rec = next(found)
        except StopIteration:
            break
        except (ValueError, struct.error, IndexError):     # truncated file: keep what was read, and count it
            bad_file = 1
            break
        idx, (ts_us, linktype, data) = piece.first + total, rec
        total += 1
        try:
            net = _network_layer(linktype, data)
            if net is None:
                continue
            ver, off = net
            if ver == 4:
                ihl = (data[off] & 0x0F) * 4
                proto = data[off + 9]
                src = str(ipaddress.IPv4Address(data[off + 12:off + 16]))
                dst = str(ipaddress.IPv4Address(data[off + 16:off + 20]))
                l4, layer = off + ihl, proto
                later = struct.unpack(">H", data[off + 6:off + 8])[0] & 0x1FFF   # fragment offset
            else:
                proto = data[off + 6]
                src = str(ipaddress.IPv6Address(data[off + 8:off + 24]))
                dst = str(ipaddress.IPv6Address(data[off + 24:off + 40]))
                l4, layer, later = off + 40, proto, 0
                while layer in (0, 43, 60, 44) and l4 + 8 <= len(data) and not later:
                    nxt = data[l4]
                    if layer == 44:
                        later = struct.unpack(">H", data[l4 + 2:l4 + 4])[0] >> 3
                    l4 += 8 if layer == 44 else (data[l4 + 1] + 1) * 8
                    layer = nxt
            name = PROTOCOL_NAMES.get(proto, f"OTHER({proto})")
            dport, sport, has_dns, payload = 0, 0, 0, b""
            if later:                # not the first fragment: no header of the next layer
                pass
            elif layer in (6, 17) and len(data) >= l4 + 4:
                sport, dport = struct.unpack(">HH", data[l4:l4 + 4])
                name = "TCP" if layer == 6 else "UDP"
                if layer == 17:
                    payload = data[l4 + 8:]
                elif len(data) >= l4 + 13:
                    payload = data[l4 + ((data[l4 + 12] >> 4) * 4) + 2:]   # DNS over TCP: length prefix
                has_dns = int((sport in DNS_PORTS or dport in DNS_PORTS) and len(payload) >= 12)
            elif ver == 4 and proto == 1:
                name = "ICMP"
            row = {"kind": "packet", "file": path, "packet_idx": idx, "src_ip": src, "dst_ip": dst,
                   "dst_port": int(dport), "ts_us": ts_us, "packet_size": len(data), "protocol": name,
                   "has_dns_lookup": has_dns}
        except Exception:  # noqa: BLE001 — malformed packet: counted, skipped
            errors += 1
            continue
        parsed += 1
        yield row
        if has_dns:
            try:
                for a_idx, (ip, dom) in enumerate(_dns_answers(payload)):
                    yield {"kind": "dns", "file": path, "packet_idx": idx, "answer_idx": a_idx, "ip": ip,
                           "domain": dom}
            except (ValueError, struct.error, IndexError, RecursionError):   # answers before the fault stay
                pass
    yield {"kind": "stats", "file": path, "n_total": total, "n_parsed": parsed,
           "n_skipped": total - parsed - errors, "n_errors": errors + bad_file}
