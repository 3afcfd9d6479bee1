"""SentencePiece encoding and decoding by suffix-array matching.

The vocabulary is a byte-pair model with byte fallback: the text is a row of characters, and
as long as two neighbours make a piece, the neighbours of the best-scored piece (the leftmost of equals)
are joined; characters that are no piece become their bytes.

A batch is encoded at once. Its texts (spaces as the word mark, one put in front) are cut into units
where no piece can reach across. The distinct units are concatenated, with a byte between them
that occurs in no text, and the suffixes of that text are sorted by as many bytes as
the longest piece has. Every piece is found by binary search as a range of suffixes; each member of the range is an edge
(place, length, piece). Edges are sorted by place and length. Then the units are relaxed: in every round
each unit contracts the best edge that covers exactly two neighbours, until no such edge is left.
(Scores of this model rank merges and don't add up, so the edges are relaxed in merge order, not by a shortest path.)

Decoding concatenates the pieces' bytes and takes off the mark in front. Null and empty texts have
no tokens. A word mark (U+2581) in a text is read as a space, which is the only thing that decoding doesn't give back.
Each row is encoded for itself, repeated rows too; an empty table gives no rows. Ties between merges go to the leftmost. A text of any length is encoded
whole; a unit without a break is relaxed with a heap. Extra columns take no part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytekernel as K
from .packing import lean_batches, trim
from .storage import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
_BETWEEN = 0xFF
_BITS = 6  # of an edge's length
#: Units of more characters are relaxed with a heap, one merge at a time.
LONG_UNIT = 256
#: Texts of about so many bytes are a batch, whose units are told apart together.
BATCH_BYTES = 4 << 20
#: Different units of about so many bytes are indexed together.
INDEX_BYTES = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes (a space for the word mark), their merge ranks, and the ids of the 256 byte pieces."""

    ids: np.ndarray
    pieces: tuple[bytes, ...]
    ranks: np.ndarray
    byte_ids: np.ndarray
    spelled: tuple[bytes, ...]  #: of every id, the bytes it stands for

    @staticmethod
    def read(path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        pieces = [sp.id_to_piece(i).encode().replace(MARK, b" ") for i in normal]
        scores = -np.array([sp.get_score(i) for i in normal])
        byte_ids, spelled = np.full(256, -1, dtype=np.int64), [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                code = int(sp.id_to_piece(i)[3:5], 16)
                byte_ids[code], spelled[i] = i, bytes([code])
        for i, p in zip(normal, pieces, strict=True):
            spelled[i] = p
        if (byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte fallback")
        return Vocabulary(np.array(normal), tuple(pieces), np.unique(scores, return_inverse=True)[1].astype(np.int64), byte_ids, tuple(spelled))


class Codec:
    """Encodes and decodes batches; holds what can be worked out from the vocabulary alone."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.longest = max(map(len, v.pieces))
        if self.longest >= 1 << _BITS:
            raise ValueError("a piece is too long for an edge")
        several = [p for p in v.pieces if len(p.decode()) > 1]
        self.cut_at_space = not any(b" " in p.lstrip(b" ") for p in several)
        inside = np.zeros(256, dtype=bool)
        inside[list(set(b"".join(several)))] = True
        #: ASCII characters that are in no piece of several characters
        self.alone = ~inside & (np.arange(256) < 128)
        words = -(-self.longest // 8)
        pad = np.zeros((len(v.pieces), 8 * words), dtype=np.uint8)
        for i, p in enumerate(v.pieces):
            pad[i, : len(p)] = np.frombuffer(p, dtype=np.uint8)
        self.sizes = np.array([len(p) for p in v.pieces])
        self.keys = pad.reshape(len(v.pieces), words, 8)[:, :, ::-1].copy().view(np.uint64)[:, :, 0]
        self.spelled_bytes = np.frombuffer(b"".join(v.spelled), dtype=np.uint8)
        self.spelled_off = np.r_[0, np.cumsum([len(x) for x in v.spelled])]

    # units

    def units(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the units (the next start ends one), and the n + 1 unit offsets of the texts."""
        first = np.zeros(len(buf) + 1, dtype=bool)
        first[off] = True
        if self.cut_at_space and len(buf):
            space = buf == 0x20
            first[1:-1] |= space[1:] & ~space[:-1]
            alone = self.alone[buf]
            first[:-1] |= alone
            first[1:] |= alone
        starts = np.flatnonzero(first[:-1])
        return starts, np.searchsorted(starts, off)

    # suffixes and edges

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place << _BITS | length) of every occurrence of a piece, sorted, and the piece's number."""
        n = len(text)
        wide = np.r_[text, np.zeros(8 * (self.keys.shape[1] + 1), dtype=np.uint8)]
        key = np.zeros(n + 8 * self.keys.shape[1], dtype=np.uint64)
        for k in range(8):
            key = (key << np.uint64(8)) | wide[k : k + len(key)]
        lead = np.flatnonzero(((text & 0xC0) != 0x80) & (text != _BETWEEN))
        # ranks by 8 bytes, then by doubling to the longest piece
        rank = np.zeros(n + 8 * self.keys.shape[1] + self.longest + 64, dtype=np.int64)
        rank[: len(key)] = K.numbered(key)[0] + 1
        reach = 8
        while reach < self.longest:
            both = rank[: len(key)] * (len(key) + 2) + rank[reach : reach + len(key)]
            rank[: len(key)] = K.numbered(both)[0] + 1
            reach *= 2
        suffixes = lead[np.argsort(rank[lead])]
        low, high = np.zeros(len(self.sizes), dtype=np.int64), np.full(len(self.sizes), len(suffixes), dtype=np.int64)
        for w in range(self.keys.shape[1]):
            left = np.clip(self.sizes - 8 * w, 0, 8)
            live = np.flatnonzero((left > 0) & (high > low))
            fill = ((np.uint64(1) << (np.uint64(8) * (8 - left[live]).astype(np.uint64) % np.uint64(64))) - np.uint64(1)) * (left[live] < 8).astype(np.uint64)
            least, most = self.keys[live, w], self.keys[live, w] | fill
            a = self._bisect(key, suffixes, 8 * w, low[live], high[live], least, False)
            b = self._bisect(key, suffixes, 8 * w, a, high[live], most, True)
            low[live], high[live] = a, b
        count = np.maximum(high - low, 0)
        index = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        edge = (suffixes[index] << _BITS) | np.repeat(self.sizes, count)
        by = np.argsort(edge)
        return edge[by], np.repeat(np.arange(len(count)), count)[by]

    @staticmethod
    def _bisect(key: np.ndarray, suffixes: np.ndarray, skip: int, low: np.ndarray, high: np.ndarray, target: np.ndarray, after: bool) -> np.ndarray:
        """First place in each range whose 8 bytes after ``skip`` are not below (or are above) the target."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_]) >> 1
            v = key[suffixes[mid] + skip]
            up = (v <= target[open_]) if after else (v < target[open_])
            low[open_[up]] = mid[up] + 1
            high[open_[~up]] = mid[~up]

    def _find(self, edge: np.ndarray, piece: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that cover these places exactly; -1 without one."""
        size = end - start
        want = (start << _BITS) | np.minimum(size, (1 << _BITS) - 1)
        at = np.minimum(np.searchsorted(edge, want), max(0, len(edge) - 1))
        return np.where((edge[at] == want) & (size <= self.longest), piece[at], -1) if len(edge) else np.full(len(start), -1)

    # relaxation

    def encode_units(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and the n + 1 token offsets of the units."""
        parts = [self._encode_indexed(buf, starts[i:j], ends[i:j]) for i, j in K.chunks(np.r_[0, np.cumsum(ends - starts)], INDEX_BYTES)]
        counts = np.concatenate([np.zeros(1, np.int64), *(np.diff(o) for _, o in parts)])
        return np.concatenate([np.zeros(0, np.int32), *(x for x, _ in parts)]), np.cumsum(counts)

    def _encode_indexed(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that are concatenated and indexed together."""
        size = ends - starts
        at = np.cumsum(size + 1) - size - 1
        text = np.full(int((size + 1).sum()), _BETWEEN, dtype=np.uint8)
        spot = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        text[np.repeat(at, size) + spot] = buf[np.repeat(starts, size) + spot]
        edge, piece = self.edges(text)
        start = np.flatnonzero(((text & 0xC0) != 0x80) & (text != _BETWEEN))
        unit = np.searchsorted(at, start, "right") - 1
        end = np.r_[start[1:], len(text)]
        last = np.r_[unit[1:] != unit[:-1], True] if len(unit) else np.zeros(0, bool)
        end[last] = at[unit[last]] + size[unit[last]]
        chars = np.bincount(unit, minlength=len(size))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for u in np.flatnonzero(chars > LONG_UNIT):
            mine = slice(int(np.searchsorted(unit, u)), int(np.searchsorted(unit, u, "right")))
            done.append(self._relax_long(start[mine], end[mine], edge, piece))
        short = chars[unit] <= LONG_UNIT
        done += self._relax(start[short], end[short], unit[short], edge, piece)
        s = np.concatenate([x for x, _ in done]) if done else np.zeros(0, np.int64)
        e = np.concatenate([x for _, x in done]) if done else np.zeros(0, np.int64)
        by = np.argsort(s)
        return self._spell(text, s[by], e[by], edge, piece, at)

    def _relax(self, start, end, unit, edge, piece) -> list[tuple[np.ndarray, np.ndarray]]:
        """Contract the best edge of every unit, round by round; symbols of units without an edge leave."""
        none = np.int64(1) << 60
        ranks = self.v.ranks
        done = []

        def value(i: np.ndarray) -> np.ndarray:
            """Rank and place of joining symbol i and the next one."""
            ok = i[(i + 1 < len(start))]
            ok = ok[unit[ok] == unit[ok + 1]]
            p = self._find(edge, piece, start[ok], end[ok + 1])
            out = np.full(len(start), none) if len(i) == len(start) else best
            out[i] = none
            hit = p >= 0
            out[ok[hit]] = (ranks[p[hit]] << 40) | start[ok[hit]]
            return out

        best = np.zeros(0, np.int64)
        if len(start):
            best = value(np.arange(len(start)))
        while len(start):
            edges_of = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            least = np.minimum.reduceat(best, edges_of)
            sizes = np.diff(np.r_[edges_of, len(start)])
            active = np.repeat(least < none, sizes)
            if not active.all():
                done.append((start[~active], end[~active]))
                start, end, unit, best = start[active], end[active], unit[active], best[active]
                least, sizes = least[least < none], sizes[least < none]
                if not len(start):
                    break
            pick = np.flatnonzero(best == np.repeat(least, sizes))  # one a unit: the place is part of the value
            end[pick] = end[pick + 1]
            keep = np.ones(len(start), dtype=bool)
            keep[pick + 1] = False
            moved = np.cumsum(keep) - 1
            start, end, unit, best = start[keep], end[keep], unit[keep], best[keep]
            pick = moved[pick]
            before = pick[(pick > 0)] - 1
            before = before[unit[before] == unit[before + 1]]
            stale = np.unique(np.r_[pick, before])
            if len(stale) == len(start):
                best = value(np.arange(len(start)))
            else:
                best = value(stale)
        return done

    def _relax_long(self, start, end, edge, piece) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long unit, with a heap of its edges."""
        n = len(start)
        lo, hi = np.searchsorted(edge, [int(start[0]) << _BITS, int(end[-1]) << _BITS])
        known = dict(zip(edge[lo:hi].tolist(), self.v.ranks[piece[lo:hi]].tolist(), strict=True))
        s, e = start.tolist(), end.tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and e[j] - s[i] <= self.longest and (r := known.get(s[i] << _BITS | (e[j] - s[i]))) is not None:
                heapq.heappush(heap, (r, s[i], e[j], i))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, _, stop, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or e[j] != stop:
                continue
            e[i], alive[j], after[i] = e[j], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        kept = [i for i in range(n) if alive[i]]
        return np.array([s[i] for i in kept], dtype=np.int64), np.array([e[i] for i in kept], dtype=np.int64)

    def _spell(self, text, start, end, edge, piece, at) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols; a symbol that is no piece becomes its bytes."""
        found = self._find(edge, piece, start, end)
        size = np.where(found >= 0, 1, end - start)
        out = np.repeat(np.where(found >= 0, self.v.ids[np.maximum(found, 0)], 0), size)
        first = np.cumsum(size) - size
        raw = np.flatnonzero(found < 0)
        many = (end - start)[raw]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        out[np.repeat(first[raw], many) + step] = self.v.byte_ids[text[np.repeat(start[raw], many) + step]]
        tokens = np.r_[0, np.cumsum(size)]
        return out.astype(np.int32), tokens[np.searchsorted(start, np.r_[at, len(text)])]

    # batches

    @staticmethod
    def prepared(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One buffer of all texts with the mark in front and spaces for marks; empty texts stay empty."""
        raw = [b" " + t.encode().replace(MARK, b" ") if t else b"" for t in texts]
        return np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])].astype(np.int64)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """A batch, in runs of texts i to j - 1: i, j, ids one after another, token offsets, and the decoded bytes, which are those of the texts."""
        starts, uoff = self.units(buf, off)
        which, first = K.numbered(self._names(buf, off, starts, np.r_[starts[1:], len(buf)]))
        ends = np.r_[starts[1:], len(buf)]
        ids, toff = self.encode_units(buf, starts[first], ends[first])
        for i, j in K.chunks(off):
            unit = which[uoff[i] : uoff[j]]
            size = np.diff(toff)[unit] if len(toff) > 1 else np.zeros(0, np.int64)
            total = np.r_[0, np.cumsum(size)]
            index = np.arange(int(total[-1])) - np.repeat(total[:-1] - toff[unit], size)
            mine, by_text = ids[index], total[uoff[i : j + 1] - uoff[i]]
            back = self.decode(mine)
            if not np.array_equal(back, buf[off[i] : off[j]]):  # two units with one 64-bit name
                mine, by_unit = self.encode_units(buf, starts[uoff[i] : uoff[j]], ends[uoff[i] : uoff[j]])
                by_text, back = by_unit[uoff[i : j + 1] - uoff[i]], self.decode(mine)
            yield i, j, mine, by_text, back

    @staticmethod
    def _names(buf: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        for i, j in K.chunks(off):
            a, b = np.searchsorted(starts, [off[i], off[j]])
            out[a:b] = K.span_hashes(buf[off[i] : off[j]], starts[a:b] - off[i], ends[a:b] - off[i])
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the pieces stand for, one after another; each text's has the mark still in front."""
        a = self.spelled_off[ids]
        size = self.spelled_off[ids.astype(np.int64) + 1] - a
        total = np.r_[0, np.cumsum(size)]
        index = np.arange(int(total[-1])) - np.repeat(total[:-1] - a, size)
        return self.spelled_bytes[index]


_codecs: dict[int, Codec] = {}


def _codec(v: Vocabulary) -> Codec:
    key = hash(v.pieces)
    if key not in _codecs:
        _codecs[key] = Codec(v)
    return _codecs[key]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (of the text that decoding gives back) and same (whether it is the text) of every row.

    The vocabulary is read by the driver and sent along: it is a fixed file of about 1 MB.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value)
        for b in batches:
            for i, j in K.chunks(K.text_buffer(b.column(1))[1], BATCH_BYTES):
                trim()
                texts = b.column(1).slice(i, j - i).to_pylist()
                buf, off = codec.prepared(texts)
                for k, m, ids, toff, back in codec.encode(buf, off):
                    ends = off[k : m + 1] - off[k]
                    decoded = [back[a:z].tobytes()[1:] for a, z in zip(ends[:-1], ends[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).slice(i + k, m - k), pa.array(np.diff(toff)), pa.ListArray.from_arrays(pa.array(toff.astype(np.int32)), pa.array(ids)),
                            pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()), pa.array([x == (t or "").encode() for x, t in zip(decoded, texts[k:m], strict=True)], pa.bool_()),
                        ],
                        names=["doc_id", "n_tokens", "ids", "decoded_sha256", "same"],
                    )

    slim = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(lean_batches(run), "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, same boolean")
