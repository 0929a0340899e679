"""N-best SentencePiece segmentation, encoding and decoding.

A text is escaped as SentencePiece does it (blank to U+2581, one put in front)
and cut where no piece can cross: before a run of U+2581 that ends a word, around
line feeds, and between a letter and a following stop or mark (checked against
the vocabulary when the model is loaded).  Each cut piece of text gives a lattice
of vocabulary pieces; a forward Viterbi pass gives the best score up to every
position, which is an exact heuristic for a backward A* search, so the N best
paths leave the queue in order of score.  The N best segmentations of the text
combine those of its parts.  Characters without a piece become bytes, at the
score of an unknown piece (lowest score less 10).

New parts of a run of rows are segmented together: :class:`Lattices` builds the lattices
of many parts as arrays and takes the forward pass and the A* search through all of them
in step.  It keeps the order of the search part by part, ties included.

A null or empty text has no ids, score 0 and decodes to the empty text.  Ties are
broken by the lattice's own order, so results do not depend on the order of rows.  Rows
are kept as they are, repeated ones and those without an id too; an empty table gives no
rows; columns besides the key and the text are ignored.  A text that holds U+2581 itself decodes
to blanks there (``round_trip`` is false).
"""

from __future__ import annotations

import heapq
import itertools
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from beatline.llm.common import small_batches
from beatline.llm.token_store import slices

SPACE = "▁"
CACHE_PARTS = 500_000
CACHED_LENGTH = 64
NBEST = 2
SLICE_BYTES = 1 << 20    # of texts whose new parts are segmented together
TOGETHER = 8192          # parts whose lattices are held at once
IDS = "<i4"


def pack(ids: tuple[int, ...] | list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    out = array("i", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, IDS).tolist()


class Lattices:
    """Lattices of many parts at once, as arrays: the two best segmentations of each.

    The vertices are the positions of all parts, one part after the other; an edge is a
    piece from the position it starts at to the one it ends at.
    """

    def __init__(self, pieces: dict[str, tuple[tuple[int], float]]):
        letters = sorted({c for p in pieces for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.base = len(letters) + 1
        self.longest = max(map(len, pieces))
        nodes = {"": 0}
        steps = {}
        for p in pieces:
            for k in range(len(p)):
                to = nodes.setdefault(p[:k + 1], len(nodes))
                steps[nodes[p[:k]] * self.base + int(self.letter[ord(p[k])])] = to
        self.steps = np.array(sorted(steps), np.int64)
        self.to = np.array([steps[k] for k in self.steps.tolist()], np.int64)
        self.first = np.full(self.base, -1, np.int64)              # the nodes behind single letters
        self.first[self.steps[self.steps < self.base]] = self.to[self.steps < self.base]
        self.piece, self.score = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
        for p, ((i,), score) in pieces.items():
            self.piece[nodes[p]], self.score[nodes[p]] = i, score

    def covered(self, parts: list[str]) -> np.ndarray:
        """Parts all of whose letters are pieces of their own, so that no bytes are needed."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        first = self.first[self._letters(parts)]
        single = (first >= 0) & (self.piece[first] >= 0)
        return np.logical_and.reduceat(single, np.cumsum(size) - size)

    def _letters(self, parts: list[str]) -> np.ndarray:
        return self.letter[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")]

    def _follow(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The trie's nodes behind ``letter``, -1 where there is none."""
        key = node * self.base + letter
        at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
        return np.where(self.steps[at] == key, self.to[at], -1)

    def edges(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """Root vertex and length of the parts; start, node of the trie and, by vertex, first and number
        of the edges that end there (by ascending start); the best score up to every vertex."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        code = self._letters(parts)
        begin = np.cumsum(size) - size
        part = np.repeat(np.arange(len(parts)), size)
        left = np.repeat(begin + size, size) - np.arange(len(code))
        at, node = np.arange(len(code)), np.zeros(len(code), np.int64)
        found = []
        for step in range(1, self.longest + 1):
            node = self._follow(node, code[at + step - 1]) if step > 1 else self.first[code]
            ok = node >= 0
            at, node = at[ok], node[ok]
            hit = self.piece[node] >= 0
            found.append((at[hit] + part[at[hit]], node[hit], np.full(int(hit.sum()), step)))
            more = left[at] > step
            at, node = at[more], node[more]
            if not len(at):
                break
        start, node, length = (np.concatenate(x) for x in zip(*found))
        root = begin + np.arange(len(parts))
        depth = np.zeros(len(code) + len(parts), np.int64)
        depth[np.arange(len(code)) + part + 1] = np.arange(len(code)) - begin[part] + 1
        end = start + length
        order = np.argsort((depth[end] * len(depth) + end) * (self.longest + 1) - length)
        start, node, end = start[order], node[order], end[order]
        number = np.bincount(end, minlength=len(depth))
        first = np.flatnonzero(np.diff(end, prepend=-1))           # the edges of one vertex stand together
        at_vertex = np.zeros(len(depth), np.int64)
        at_vertex[end[first]] = first
        best = np.zeros(len(depth))
        bounds = np.searchsorted(depth[end[first]], np.arange(1, int(size.max()) + 2))
        for lo, hi in zip(bounds, bounds[1:]):
            a, b = first[lo], first[hi] if hi < len(first) else len(start)
            best[end[first[lo:hi]]] = np.maximum.reduceat(best[start[a:b]] + self.score[node[a:b]], first[lo:hi] - a)
        return root, size, start, node, at_vertex, number, best

    def first_two(self, parts: list[str]) -> list[tuple[bytes, float, float]]:
        """Packed ids and score of the best segmentation, and what the second best lacks (inf if there is
        none), of parts that are ``covered``: the search of ``Codec.part_nbest`` in all parts in step.

        As the heuristic is exact, the best entry an expansion puts into the queue leads to the best
        result, whichever entries wait; so of these only the first can lead to the second result, and
        its estimate is that result's score.  Among equal entries the one nearest to its start goes first.
        Scores that are no whole numbers may differ from the other search's in their last bits.
        """
        root, size, start, node, first, number, best = self.edges(parts)
        n = len(parts)
        score, piece = self.score[node], self.piece[node]
        waiting = np.full(n, np.inf)
        part, vertex, behind = np.arange(n), root + size, np.zeros(n)
        owners, ids = [], []
        while len(part):
            many = number[vertex]
            group = np.cumsum(many) - many
            edge = np.arange(int(many.sum())) + np.repeat(first[vertex] - group, many)
            cost = -(best[start[edge]] + np.repeat(behind, many) + score[edge])
            least = np.flatnonzero(cost == np.repeat(np.minimum.reduceat(cost, group), many))
            head = least[np.searchsorted(least, group)]
            cost[head] = np.inf
            waiting[part] = np.minimum(waiting[part], np.minimum.reduceat(cost, group))
            taken = edge[head]
            owners.append(part)
            ids.append(piece[taken])
            behind, vertex = behind + score[taken], start[taken]
            on = np.flatnonzero(vertex > root[part])
            part, vertex, behind = part[on], vertex[on], behind[on]
        owner, flat = np.concatenate(owners[::-1]), np.concatenate(ids[::-1])      # the search goes backward
        packed = flat[np.argsort(owner, kind="stable")].astype(IDS).tobytes()
        ends = (np.cumsum(np.bincount(owner, minlength=n)) * 4).tolist()
        top = best[root + size]
        return [(packed[a:b], s, lack) for a, b, s, lack in zip([0, *ends], ends, top.tolist(), (top + waiting).tolist())]


class Codec:
    """A model's pieces and scores; ``nbest``, ``encode`` and ``decode`` of whole texts."""

    def __init__(self, path: str, nbest: int = NBEST):
        import sentencepiece as sp
        model = sp.SentencePieceProcessor(model_file=path)
        self.n = nbest
        self.pieces: dict[str, tuple[tuple[int], float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        as_byte = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        for i in range(model.get_piece_size()):
            p = model.id_to_piece(i)
            control = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            self.bytes_of.append(as_byte[i] if i in as_byte else b"" if control else p.replace(SPACE, " ").encode())
            if not control and i not in as_byte:
                self.pieces[p] = ((i,), model.get_score(i))
        self.unknown = min(s for _, s in self.pieces.values()) - 10.0
        # the pieces letter by letter: a letter leads to [its followers, the piece that ends there]
        self.trie: dict = {}
        for p, hit in self.pieces.items():
            followers = self.trie
            for c in p:
                node = followers.setdefault(c, [{}, None])
                followers = node[0]
            node[1] = hit
        after_letter = {b for p in self.pieces for a, b in zip(p, p[1:]) if a.isalpha()}
        marks = "".join(re.escape(c) for c in ".,;:!?|#$%*&" if c not in after_letter)
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces) or any("\n" in p for p in self.pieces):
            raise ValueError("pieces of this model cross words or lines")
        end = f"(?=[{SPACE}\n{marks}]|\\Z)"
        self.cut = re.compile(f"{SPACE}*[^\\W\\d_]+{end}|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.cache: dict[str, tuple[bytes, float, float]] = {}
        self.old: dict[str, tuple[bytes, float, float]] = {}      # the generation before
        self.lattices = Lattices(self.pieces)

    def lattice(self, part: str) -> tuple[list[list[tuple[int, tuple[int, ...], float]]], list[float]]:
        """Nodes (start, ids, score) per end position, and the best score up to every position.

        The forward pass runs as the lattice is built: all nodes that end at a position
        start before it.
        """
        n, trie = len(part), self.trie
        ends: list[list] = [[] for _ in range(n + 1)]
        best = [0.0] + [float("-inf")] * n
        for i in range(n):
            here, followers, single = best[i], trie, False
            for j in range(i, n):
                node = followers.get(part[j])
                if node is None:
                    break
                followers, hit = node
                if hit is not None:
                    ids, score = hit
                    ends[j + 1].append((i, ids, score))
                    if here + score > best[j + 1]:
                        best[j + 1] = here + score
                    single = single or j == i
            if not single:
                ids = tuple(self.byte_ids[b] for b in part[i].encode("utf-8", "surrogatepass"))
                ends[i + 1].append((i, ids, self.unknown))
                best[i + 1] = max(best[i + 1], here + self.unknown)
        return ends, best

    def part_nbest(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of one part, best first.

        Among equal scores the path nearest to its start goes first, so ties
        never widen the search: each result costs one walk along its path.
        """
        ends, best = self.lattice(part)
        push, pop = heapq.heappush, heapq.heappop
        tick = 0
        queue: list = [(-best[-1], len(part), 0, 0.0, None)]
        found = []
        while queue and len(found) < n:
            f, j, _, behind, path = pop(queue)
            if j == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                found.append((-f, tuple(ids)))
                continue
            for i, piece, s in ends[j]:
                tick += 1
                push(queue, (-(best[i] + behind + s), i, tick, behind + s, (piece, path)))
        return found

    def first_two(self, part: str) -> tuple[tuple[int, ...], float, float]:
        """Ids and score of the best segmentation, and what the second best lacks (inf if there is none)."""
        found = self.part_nbest(part, 2)
        score, ids = found[0]
        return ids, score, score - found[1][0] if len(found) > 1 else float("inf")

    def parts(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def lookup_all(self, texts: list[list[str]]) -> list[list[tuple[bytes, float, float]]]:
        """As ``lookup``, of many texts (cut into parts): the new parts are segmented together."""
        flat = list(itertools.chain.from_iterable(texts))
        out = list(map(self.cache.get, flat))
        missing = [k for k, hit in enumerate(out) if hit is None]
        if missing:
            if len(self.cache) > CACHE_PARTS // 2:
                self.old, self.cache = self.cache, {}
            self._learn_all(sorted({p for p in map(flat.__getitem__, missing) if len(p) <= CACHED_LENGTH and not self._kept(p)}))
            for k in missing:
                p = flat[k]
                out[k] = self.cache.get(p) or self._kept(p) or self._learn(p)
        ends = list(itertools.accumulate(map(len, texts), initial=0))
        return [out[a:b] for a, b in zip(ends, ends[1:])]

    def _learn_all(self, parts: list[str]) -> None:
        """Cache the segmentations of parts that need no bytes."""
        if parts:
            parts = list(itertools.compress(parts, self.lattices.covered(parts).tolist()))
        for k in range(0, len(parts), TOGETHER):
            some = parts[k:k + TOGETHER]
            self.cache.update(zip(some, self.lattices.first_two(some)))

    def lookup(self, parts: list[str]) -> list[tuple[bytes, float, float]]:
        """Ids (little-endian 32-bit), score and loss of the second best (inf if there is none) of every part."""
        out = list(map(self.cache.get, parts))
        missing = [k for k, hit in enumerate(out) if hit is None]
        if missing:
            if len(self.cache) > CACHE_PARTS // 2:
                self.old, self.cache = self.cache, {}
            for k in missing:
                p = parts[k]
                out[k] = self.cache.get(p) or self._kept(p) or self._learn(p)
        return out

    def _kept(self, part: str) -> tuple[bytes, float, float] | None:
        hit = self.old.get(part)
        if hit is not None:
            self.cache[part] = hit
        return hit

    def _learn(self, part: str) -> tuple[bytes, float, float]:
        ids, score, loss = self.first_two(part)
        hit = pack(ids), score, loss
        if len(part) <= CACHED_LENGTH:
            self.cache[part] = hit
        return hit

    def combined(self, parts: list[str], found: list[tuple[bytes, float, float]] | None = None) -> list[tuple[float, bytes]]:
        """The best segmentations (score, packed ids) of a text cut into ``parts``, best first;
        ``found`` is what ``lookup`` gives for them.

        Any of the N best differs from the best path in fewer than N parts, and
        only in parts whose own loss is among the N - 1 smallest.
        """
        packed, scores, lacks = zip(*(self.lookup(parts) if found is None else found)) if parts else ((), (), ())
        total = sum(scores)
        losses = heapq.nsmallest(self.n - 1, zip(lacks, range(len(lacks))))
        open_parts = [i for loss, i in losses if loss < float("inf")]
        choices = {i: self.part_nbest(parts[i], self.n) for i in open_parts}
        ways: list[tuple[float, dict[int, int]]] = [(0.0, {})]
        for i in open_parts:
            ways = heapq.nsmallest(self.n, ((loss + choices[i][0][0] - s, ch | ({i: k} if k else {}))
                                            for loss, ch in ways for k, (s, _) in enumerate(choices[i])),
                                   key=lambda w: (w[0], sorted(w[1].items())))
        out = []
        for loss, changes in ways:
            chosen = list(packed)
            for i, k in changes.items():
                chosen[i] = pack(choices[i][k][1])
            out.append((total - loss, b"".join(chosen)))
        return out

    def nbest(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The best segmentations (score, ids) of a whole text, best first."""
        return [(score, unpack(ids)) for score, ids in self.combined(self.parts(text or ""))]

    def encode(self, text: str | None) -> list[int]:
        return self.best(text or "")[0]

    def packed(self, text: str, parts: list[str] | None = None, found: list | None = None) -> tuple[bytes, float, float | None, bool, bytes | None]:
        """Ids and score of the best segmentation, the score of the second best, whether the best
        decodes to the text, and the ids of the second best; ids little-endian 32-bit."""
        ways = self.combined(self.parts(text) if parts is None else parts, found)
        (score, ids), (second, others) = ways[0], ways[1] if len(ways) > 1 else (None, None)
        return ids, score, second, self.raw(unpack(ids)) == (f" {text}" if text else "").encode("utf-8", "surrogatepass"), others

    def best(self, text: str) -> tuple[list[int], float, float | None]:
        """Ids and score of the best segmentation, and the score of the second best."""
        ids, score, second, *_ = self.packed(text)
        return unpack(ids), score, second

    def raw(self, ids: list[int]) -> bytes:
        """The bytes that ids stand for, with the blank that was put in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        raw = self.raw(ids).decode("utf-8", "surrogatepass")
        return raw[1:] if raw.startswith(" ") else raw


_CODECS: dict[tuple[str, int], Codec] = {}


def codec(path: str, nbest: int = NBEST) -> Codec:
    if (path, nbest) not in _CODECS:
        _CODECS[path, nbest] = Codec(path, nbest)
    return _CODECS[path, nbest]


def _segmented(docs: DataFrame, model_path: str, key: str, names: list[str], kinds: str, columns,
               more_names: tuple[str, ...] = (), more=lambda ids: []) -> DataFrame:
    """Rows (key, ``columns`` of the packed ids, score, second_score, round_trip, ``more`` of the second best
    ids: longs) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                texts = [t or "" for t in piece.column(1).to_pylist()]
                parts = [c.parts(t) for t in texts]
                ids, score, second, exact, others = (list(x) for x in zip(*map(c.packed, texts, parts, c.lookup_all(parts))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *columns(ids), pa.array(score, pa.float64()), pa.array(second, pa.float64()),
                     pa.array(exact, pa.bool_()), *more(others)],
                    names=[key, *names, "score", "second_score", "round_trip", *more_names])
    return small_batches(docs).select(f"`{key}`", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"`{key}` {dict(docs.dtypes)[key]}, {kinds}, score double, second_score double, round_trip boolean"
        + "".join(f", {n} long" for n in more_names))


def _lists(ids: list[bytes]) -> list[pa.Array]:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), IDS)))]


def _sums(ids: list[bytes | None]) -> list[pa.Array]:
    return [pa.array([None if x is None else f(x) for x in ids], pa.int64()) for f in (lambda x: len(x) // 4, zlib.crc32)]


def encode(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, score, second_score, round_trip) of every row of ``docs`` (key, text)."""
    return _segmented(docs, model_path, key, ["ids"], "ids array<int>", _lists)


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) from rows of (key, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())],
                names=[key, "text"])
    return encoded.select(f"`{key}`", "ids").mapInArrow(run, f"`{key}` {dict(encoded.dtypes)[key]}, text string")


def digest(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """As :func:`encode`, with the ids reduced to their number and CRC-32 (little-endian uint32), and the same
    of the second best ids (null if there are none)."""
    return _segmented(docs, model_path, key, ["n_pieces", "ids_crc32"], "n_pieces long, ids_crc32 long", _sums,
                      ("second_pieces", "second_crc32"), _sums)
