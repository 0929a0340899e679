"""Capture bytes to columns and back: the helpers that run inside capture tasks.

*Split.*  A task owns the records whose headers begin in its range of bytes.  It finds
the first of them by resynchronisation: the first offset from which a chain of
``CHAIN`` record headers fits.  The guess is checked afterwards against the end of the
chain of the range before (see ``captures.plan_captures``).

*Walk.*  Only record headers are followed, one step a record.

*Decode.*  All fields of a run of records are gathered by NumPy at once; addresses are
formatted once per distinct value.  Only DNS answers are read record by record.
"""

from __future__ import annotations

import ipaddress
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ---------------------------------------------------------------------------
# Block types, link types, protocol names, DNS ports.
# ---------------------------------------------------------------------------
SECTION, INTERFACE, SIMPLE, ENHANCED = 0x0A0D0D0A, 1, 3, 6
ETHERNET, COOKED, RAW_IP = 1, 113, (101, 12, 14, 228, 229)
IPV4, IPV6, VLAN = 0x0800, 0x86DD, (0x8100, 0x88A8)
EXTENSIONS, FRAGMENT = (0, 43, 60, 44), 44
TCP, UDP = 6, 17
PROTOCOL_NAMES = {1: "ICMP", 6: "TCP", 17: "UDP", 58: "ICMPv6"}
DNS_PORTS = (53, 5353)

CHAIN = 12
LONGEST_RECORD = 1 << 18        # a guessed record is no longer than this or the file's snap length
WINDOW = 1 << 20                # bytes beyond its range that a task may look at to find a chain
MICROS = 1_000_000


@dataclass(frozen=True)
class Context:
    """What reading on from some record needs: the byte order and the interfaces so far.

    Interfaces are (link type, time units per second, snap length); a pcap file has one.
    """
    ng: bool
    order: str
    interfaces: tuple

    def text(self) -> str:
        return json.dumps([self.ng, self.order, self.interfaces])

    @staticmethod
    def of(text: str) -> "Context":
        ng, order, interfaces = json.loads(text)
        return Context(ng, order, tuple(map(tuple, interfaces)))


@dataclass
class Run:
    """Records of one range: offsets, and the context from each record number on."""
    offsets: np.ndarray
    epochs: list                 # (first record, Context)
    end: int                     # where the chain goes on
    broken: bool = False

    @property
    def context(self) -> Context:
        return self.epochs[-1][1]


def opened(head) -> tuple[int, Context] | None:
    """(first record, context) of a file from its first bytes; None for an empty one."""
    if len(head) < 4:
        return None
    magic = bytes(head[:4])
    if magic == b"\x0a\x0d\x0d\x0a":
        return 0, Context(True, "<", ())
    kinds = {b"\xd4\xc3\xb2\xa1": ("<", MICROS), b"\xa1\xb2\xc3\xd4": (">", MICROS),
             b"\x4d\x3c\xb2\xa1": ("<", 10 ** 9), b"\xa1\xb2\x3c\x4d": (">", 10 ** 9)}
    if magic not in kinds or len(head) < 24:
        raise ValueError("not a capture file")
    order, units = kinds[magic]
    snap, link = struct.unpack(order + "II", bytes(head[16:24]))
    return 24, Context(False, order, ((link & 0x0FFFFFFF, units, snap),))


#: No record.
NOTHING = Run(np.zeros(0, np.int64), [(0, Context(False, "<", ()))], 0)


# --- walking record headers -----------------------------------------------------------

def walk(buf, at: int, until: int, size: int, context: Context, base: int = 0) -> Run:
    """Records that begin in [at, until); ``buf`` holds the file of ``size`` bytes from ``base`` on."""
    return (_walk_blocks if context.ng else _walk_records)(buf, at, until, size, context, base)


def _walk_records(buf, at: int, until: int, size: int, context: Context, base: int) -> Run:
    length, offsets, stop = struct.Struct(context.order + "I").unpack_from, [], min(until, size - 15)
    while at < stop:
        offsets.append(at)
        at += 16 + length(buf, at - base + 8)[0]
    return Run(np.array(offsets, dtype=np.int64), [(0, context)], at if at < size - 15 else size)


def _walk_blocks(buf, at: int, until: int, size: int, context: Context, base: int) -> Run:
    offsets, epochs, order = [], [(0, context)], context.order
    head = struct.Struct(order + "II").unpack_from
    stop = min(until, size - 11)

    def broken() -> Run:
        return Run(np.array(offsets, dtype=np.int64), epochs, size, True)

    while at < stop:
        kind, length = head(buf, at - base)
        if kind == SECTION:                       # the byte order comes from the section's own magic
            order = "<" if bytes(buf[at - base + 8:at - base + 12]) == b"\x4d\x3c\x2b\x1a" else ">"
            head = struct.Struct(order + "II").unpack_from
            kind, length = head(buf, at - base)
            epochs.append((len(offsets), Context(True, order, ())))
        if length < 12 or at + length > size:
            return broken()
        if kind == ENHANCED and length < 32 or kind == SIMPLE and length < 16:
            return broken()
        if kind == INTERFACE:
            try:
                found = _interface(bytes(buf[at - base + 8:at - base + length - 4]), order)
            except (struct.error, IndexError):
                return broken()
            epochs.append((len(offsets), Context(True, order, (*epochs[-1][1].interfaces, found))))
        elif kind in (ENHANCED, SIMPLE):
            offsets.append(at)
        at += length
    return Run(np.array(offsets, dtype=np.int64), epochs, at if at < size - 11 else size)


def _interface(body: bytes, order: str) -> tuple[int, int, int]:
    """Link type, time units per second and snap length of an interface description."""
    link, _, snap = struct.unpack(order + "HHI", body[0:8])
    units, at = MICROS, 8
    while at + 4 <= len(body):
        code, size = struct.unpack(order + "HH", body[at:at + 4])
        if code == 0:
            break
        if code == 9 and size >= 1:
            v = body[at + 4]
            units = 2 ** (v & 0x7F) if v & 0x80 else 10 ** v
        at += 4 + ((size + 3) // 4) * 4
    return link, units, snap


# --- resynchronisation -----------------------------------------------------------------

def _u32(b: np.ndarray, at: np.ndarray, order: str) -> np.ndarray:
    shifts = (0, 8, 16, 24) if order == "<" else (24, 16, 8, 0)
    return sum(b[at + k].astype(np.int64) << s for k, s in enumerate(shifts))


def resync(buf, at: int, until: int, size: int, context: Context, base: int = 0) -> int | None:
    """The first offset in [at, until) from which ``CHAIN`` record headers follow one another.

    The chain may reach the end of the file, or leave what ``buf`` holds, earlier.
    None if no offset fits; the range then seems to own no record.
    """
    b = np.frombuffer(buf, dtype=np.uint8)
    held = base + len(b)
    step = 1 << 16
    for low in range(at, until, step):
        start = np.arange(low, min(low + step, until), dtype=np.int64)
        if context.ng:
            start = start[start % 4 == 0]
        best = None
        for order in "<>" if context.ng else context.order:
            alive, where = start, start
            for _ in range(CHAIN):
                known = where + 16 <= held
                inside = where[known] - base
                ahead = _next(b, inside, order, context, held - base) + base
                fits = np.ones(len(where), dtype=bool)
                fits[known] = (ahead >= 0) & (ahead <= size)
                where = where.copy()
                where[known] = ahead
                alive, where = alive[fits], where[fits]
            if len(alive):
                best = int(alive[0]) if best is None else min(best, int(alive[0]))
        if best is not None:
            return best
    return None


def _next(b: np.ndarray, at: np.ndarray, order: str, context: Context, held: int) -> np.ndarray:
    """Where the record after each offset would begin; far below 0 where none can stand there."""
    none = -(1 << 60)
    if not len(at):
        return at
    if context.ng:
        length = _u32(b, at + 4, order)
        fits = (length >= 12) & (length % 4 == 0) & (length <= WINDOW)
        tail = at + length - 4
        seen = fits & (tail + 4 <= held)
        fits[seen] = _u32(b, tail[seen], order) == length[seen]
        return np.where(fits, at + length, none)
    (_, units, snap), = context.interfaces
    part, kept, whole = (_u32(b, at + k, order) for k in (4, 8, 12))
    fits = (part < units) & (kept > 0) & (kept <= whole) & (kept <= max(snap, LONGEST_RECORD))
    return np.where(fits, at + 16 + kept, none)


# --- decoding ------------------------------------------------------------------------

class _Bytes:
    """Gathers at arrays of offsets; offsets beyond the end read the last byte (callers mask them)."""

    def __init__(self, buf):
        self.b = np.frombuffer(buf, dtype=np.uint8)

    def u8(self, at: np.ndarray) -> np.ndarray:
        return self.b.take(at, mode="clip").astype(np.int64)

    def be16(self, at: np.ndarray) -> np.ndarray:
        return self.u8(at) << 8 | self.u8(at + 1)

    def u32(self, at: np.ndarray, order: str) -> np.ndarray:
        return _u32(self.b, np.minimum(at, len(self.b) - 4), order)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        return self.b.take(at[:, None] + np.arange(width), mode="clip")


def _micros(ticks: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Microseconds of unsigned 64-bit ticks, rounded down."""
    out = np.zeros(len(ticks), dtype=np.int64)
    for u in np.unique(units):
        u, m = int(u), units == u
        if u >= 1 << 43:                          # ticks finer than any clock: beyond 64-bit products
            out[m] = [int(t) * MICROS // u for t in ticks[m]]
        else:
            whole = ticks[m] // np.uint64(u)
            out[m] = (whole * np.uint64(MICROS) + (ticks[m] - whole * np.uint64(u)) * np.uint64(MICROS) // np.uint64(u)).astype(np.int64)
    return out


def _frames(b: _Bytes, offsets: np.ndarray, context: Context, file_end: int):
    """(start, captured bytes, time in microseconds, time known, link type) of records; offsets count in the buffer."""
    if not context.ng:
        (link, units, _), = context.interfaces
        seconds, part, kept = (b.u32(offsets + k, context.order) for k in (0, 4, 8))
        ts = seconds * MICROS + part * MICROS // units
        return offsets + 16, np.minimum(kept, file_end - offsets - 16), ts, np.ones(len(offsets), bool), np.full(len(offsets), link)
    kind, length, iface = (b.u32(offsets + k, context.order) for k in (0, 4, 8))
    table = np.array([(i[0], i[1]) for i in context.interfaces] + [(ETHERNET, MICROS)], dtype=np.int64)
    known = kind == ENHANCED
    which = np.minimum(np.where(known, iface, 0), len(table) - 1)
    link, units = table[which, 0], table[which, 1]
    ticks = b.u32(offsets + 12, context.order).astype(np.uint64) << np.uint64(32) | b.u32(offsets + 16, context.order).astype(np.uint64)
    ts = np.where(known, _micros(ticks, units), 0)
    snap = context.interfaces[0][2] if context.interfaces else 0
    simple = np.minimum(iface, snap) if snap else iface
    size = np.where(known, np.minimum(b.u32(offsets + 20, context.order), length - 32), np.minimum(simple, length - 16))
    return offsets + np.where(known, 28, 12), np.maximum(size, 0), ts, known, link


def _network(b: _Bytes, at: np.ndarray, size: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(IP version or 0, offset of the IP header in the frame)."""
    kind, header = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    m = (link == ETHERNET) & (size >= 14)
    kind[m], header[m] = b.be16(at[m] + 12), 14
    tagged = m & np.isin(kind, VLAN) & (size >= header + 4)
    while tagged.any():
        kind[tagged] = b.be16(at[tagged] + header[tagged] + 2)
        header[tagged] += 4
        tagged &= np.isin(kind, VLAN) & (size >= header + 4)
    m = (link == COOKED) & (size >= 16)
    kind[m], header[m] = b.be16(at[m] + 14), 16
    version = np.where(kind == IPV4, 4, np.where(kind == IPV6, 6, 0))
    m = np.isin(link, RAW_IP) & (size >= 1)
    first = b.u8(at[m]) >> 4
    version[m] = np.where((first == 4) | (first == 6), first, 0)
    return version, header


def _addresses(b: _Bytes, at: np.ndarray, version: np.ndarray) -> pa.Array:
    """Address texts, each distinct value formatted once."""
    code, texts = np.zeros(len(at), np.int64), []
    for v, width, kind in ((4, 4, ipaddress.IPv4Address), (6, 16, ipaddress.IPv6Address)):
        m = np.flatnonzero(version == v)
        if len(m):
            raw = pa.Array.from_buffers(pa.binary(width), len(m), [None, pa.py_buffer(b.rows(at[m], width).tobytes())])
            coded = raw.dictionary_encode()
            code[m] = coded.indices.to_numpy() + len(texts)
            texts += [str(kind(x)) for x in coded.dictionary.to_pylist()]
    return pc.take(pa.array(texts, pa.string()), pa.array(code))


NAMES = pa.array([PROTOCOL_NAMES.get(k, f"OTHER({k})") for k in range(256)])


@dataclass
class Packets:
    """Columns of the IP packets of a run, and where the DNS messages among them lie."""
    index: np.ndarray            # record number in the run
    ts: pa.Array
    src: pa.Array
    dst: pa.Array
    port: np.ndarray
    size: np.ndarray
    protocol: pa.Array
    dns: np.ndarray
    payload: np.ndarray          # of the message, in the buffer
    stop: np.ndarray
    errors: int


def decode(buf, run: Run, file_end: int, base: int = 0, keep=None, rows: int = 1 << 16) -> Iterator[Packets]:
    """Packets of ``run``, by stretches of ``rows`` records at most that share a context.

    ``keep(ts, known, port, protocol number)`` may return a mask of packets that are wanted:
    the others are left out before any text is made of them.
    """
    if not len(run.offsets):
        return
    b = _Bytes(buf)
    for k, (first, context) in enumerate(run.epochs):
        last = run.epochs[k + 1][0] if k + 1 < len(run.epochs) else len(run.offsets)
        for at in range(first, last, rows):
            yield _decoded(b, run.offsets[at:min(at + rows, last)] - base, at, context, file_end - base, keep)


def _decoded(b: _Bytes, offsets: np.ndarray, first: int, context: Context, file_end: int, keep) -> Packets:
    at, size, ts, known, link = _frames(b, offsets, context, file_end)
    version, header = _network(b, at, size, link)
    short = ((version == 4) & (size < header + 20)) | ((version == 6) & (size < header + 40))
    m = np.flatnonzero((version > 0) & ~short)
    at, size, ts, known, version, header = (x[m] for x in (at, size, ts, known, version, header))
    ip, four = at + header, version == 4
    proto = np.where(four, b.u8(ip + 9), b.u8(ip + 6))
    upper = header + np.where(four, (b.u8(ip) & 15) * 4, 40)
    layer, later = proto.copy(), np.where(four, b.be16(ip + 6) & 0x1FFF, 0)
    open_ = ~four & np.isin(layer, EXTENSIONS) & (upper + 8 <= size)
    while open_.any():                            # extension headers of IPv6
        x, cut = at[open_] + upper[open_], layer[open_] == FRAGMENT
        later[open_] = np.where(cut, b.be16(x + 2) >> 3, later[open_])
        upper[open_] += np.where(cut, 8, (b.u8(x + 1) + 1) * 8)
        layer[open_] = b.u8(x)
        open_ &= np.isin(layer, EXTENSIONS) & (upper + 8 <= size) & (later == 0)
    ported = (later == 0) & ((layer == TCP) | (layer == UDP)) & (size >= upper + 4)
    source, port = (np.where(ported, b.be16(at + upper + k), 0) for k in (0, 2))
    number = np.where(ported, layer, proto)
    inner = np.where(layer == UDP, upper + 8, np.where(size >= upper + 13, upper + (b.u8(at + upper + 12) >> 4) * 4 + 2, size))
    dns = ported & (np.isin(source, DNS_PORTS) | np.isin(port, DNS_PORTS)) & (size - inner >= 12)
    if keep is not None:
        want = np.flatnonzero(keep(ts, known, port, number))
        m, at, size, ts, known, version, ip, port, number, dns, inner = (
            x[want] for x in (m, at, size, ts, known, version, ip, port, number, dns, inner))
        four = version == 4
    return Packets(m + first, pa.array(ts, mask=~known), _addresses(b, ip + np.where(four, 12, 8), version),
                   _addresses(b, ip + np.where(four, 16, 24), version), port, size,
                   pc.take(NAMES, pa.array(number)), dns.astype(np.int32), at + inner, at + size, int(short.sum()))


def dns_answers(payload: bytes) -> Iterator[tuple[str, str]]:
    """A records of a DNS message, (ip, name) in answer order; a malformed one raises after those before it."""
    if len(payload) < 12:
        return
    questions, answers = struct.unpack(">HH", payload[4:8])

    def name(at: int, depth: int = 0) -> tuple[str, int]:
        labels = []
        while True:
            size = payload[at]
            if size == 0:
                return ".".join(labels) + ".", at + 1
            if size & 0xC0 == 0xC0:
                if depth > 16:
                    raise ValueError("loop")
                rest, _ = name(struct.unpack(">H", payload[at:at + 2])[0] & 0x3FFF, depth + 1)
                if rest != ".":
                    labels.append(rest[:-1])
                return ".".join(labels) + ".", at + 2
            labels.append(payload[at + 1:at + 1 + size].decode("utf-8", "replace"))
            at += 1 + size

    at = 12
    for _ in range(questions):
        _, at = name(at)
        at += 4
    for _ in range(answers):
        owner, at = name(at)
        kind, _, _, size = struct.unpack(">HHIH", payload[at:at + 10])
        at += 10
        if kind == 1 and size == 4:
            if len(payload) < at + 4:
                raise ValueError("truncated answer")
            yield ".".join(str(x) for x in payload[at:at + 4]), owner
        at += size
