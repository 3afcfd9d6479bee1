r"""Removal of passages that occur more than once, by a compacted de Bruijn graph.

A window is WINDOW consecutive words of one document. Every word covered by a window whose words also start anywhere else, in the
same document too, is removed. Windows are judged on the input, not on what is left.

The graph's edges are the windows (from their words but the last to their words but the first), and a document is a walk.

1. Documents are dealt into blocks by hash. Of each run of SEED_WORDS words within a window the one of least hash is the window's seed; equal windows have
   equal seeds. Neighbouring windows share seeds, so there is about one seed in 14 words. Seeds that occur at one place only can't be of a
   repeated window. The rest go back to their blocks: rows of seed and block, counted by Spark.
2. A block sends each hash range the distinct edges of its windows with repeated seeds: sorted, packed, and with a tag each that says which words lie before and
   behind, or that this isn't the same everywhere. A range adds up what all blocks sent. An edge stays if it occurs twice; it is inside a
   nonbranching path if all its tags agree. Blocks get their repeated edges back.
3. A block cuts its walks where a path branches or ends. What lies between is a compacted path: one row of its first edge, length, and a
   digest of its words, with the place where it stands in the source.
4. These rows meet in Spark: paths that agree in edge, length and words occur as often as there are rows. A row that has no other like it holds
   windows that only their 64-bit hashes made equal. Such rows name themselves (they are single), so that usually nothing goes back to the blocks.
5. If there are any, their windows are looked at again, each by a digest of its words, together with all windows of the corpus that share a bit of a bitmap (4 MB at
   most) with them. Windows whose words are nowhere else are taken off, and the documents are written anew.

A very common passage is one entry a block and range, and rows of one path are added up before they are exchanged, so no key is hot. A long document is a part of a
block, in memory in proportion to it. Messages between blocks and ranges grow with their product, as those of Spark's own exchanges grow with that of tasks.

Words are runs outside ``[\x20\x09-\x0D]``, unchanged. Each row is a document of its own, repeated rows and rows that share a doc_id or have none too; null and
empty texts have no words, nothing is removed from them, and their digest is that of an empty string. Documents of fewer words than a window stay whole. Ties don't
arise. An empty table gives no rows. Extra columns take no part and may have any names.
Rows that agree in doc_id and whole text are dealt to one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytekernel as K
from .packing import deal_blocks, expand, lean_cogroup, lean_group, squeeze, unpack
from .storage import materialise

WINDOW, SEED_WORDS = 35, 8
#: Bytes of text of a block on average.
BLOCK_BYTES = 8 << 20
#: Bits of hashes by which runs of words are told apart before their words are compared; fewer in tests.
HASH_BITS = 64
#: Words whose bytes are gathered at once.
JOINED_WORDS = 1 << 16
#: Bits of the bitmap of edges that are looked at again.
BITMAP_BITS, PIECE_BITS = 1 << 25, 1 << 15


class Walks:
    """The words, windows and edges of a block's documents, which are put in order, so that a word's number is the same in every pass."""

    def __init__(self, packed: pa.Table, window: int, bits: int):
        self.docs = unpack(packed).sort_by([("doc_id", "ascending"), ("digest", "ascending")]).combine_chunks()
        self.window, self.bits = window, bits
        self.buf, off = K.text_buffer(self.docs.column("text"))
        starts, ends, hashes, counts = [], [], [], []
        for i, j in K.chunks(off):
            a, b, first = K.word_spans(self.buf[off[i] : off[j]], off[i : j + 1] - off[i])
            hashes.append(K.span_hashes(self.buf[off[i] : off[j]], a, b))
            starts.append(a + off[i])
            ends.append(b + off[i])
            counts.append(np.diff(first))
        none = np.zeros(0, dtype=np.int64)
        self.starts, self.ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.first = np.r_[0, np.cumsum(np.concatenate([none, *counts]))]
        n = np.diff(self.first)
        self.begin, self.end = np.repeat(self.first[:-1], n), np.repeat(self.first[1:], n)

    def whole(self) -> np.ndarray:
        """Whether a window begins at a word; the last words of the block, at which none can, are left out."""
        return (np.arange(len(self.hashes)) + self.window <= self.end)[: max(0, len(self.hashes) - self.window + 1)]

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the seed of the window at each word, and of each different seed of the block at how many places it stands."""
        each, whole = self._runs(SEED_WORDS) | np.uint64(1), self.whole()
        reach = self.window - SEED_WORDS + 1
        least = K.sliding(each, reach, np.minimum)
        pad = np.zeros(reach - 1, dtype=np.uint64)
        # a run of words is the seed of a window that covers it, if the greatest of these windows' seeds is its own hash: they are its hash at most
        taken = K.sliding(np.concatenate([pad, np.where(whole, least, np.uint64(0)), pad]), reach, np.maximum) == each if len(least) else each[:0] > 0
        return least, each[: len(taken)][taken]

    def edges(self) -> np.ndarray:
        return self._runs(self.window)

    def _runs(self, n: int) -> np.ndarray:
        h = K.run_hashes(self.hashes, n)
        return h >> np.uint64(64 - self.bits) if self.bits < 64 else h

    def tags(self, at: np.ndarray) -> np.ndarray:
        """32 bits, not 0, of the words before and behind the windows that begin at these words, or of there being none."""
        before, behind = at > self.begin[at], at + self.window < self.end[at]
        one, other = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
        one[before], other[behind] = self.hashes[at[before] - 1], self.hashes[at[behind] + self.window]
        with np.errstate(over="ignore"):
            both = K.mix64(one * np.uint64(3) + other)
        return (both >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with a space behind each, and where each begins (and the end)."""
        size = self.ends - self.starts + 1
        at = np.r_[0, np.cumsum(size)]
        source, out = np.r_[self.buf, np.uint8(0x20)], np.empty(at[-1], dtype=np.uint8)
        for i in range(0, len(size), JOINED_WORDS):
            j = min(i + JOINED_WORDS, len(size))
            out[at[i] : at[j]] = source[np.repeat(self.starts[i:j] - at[i:j], size[i:j]) + np.arange(at[i], at[j])]
        out[at[1:] - 1] = 0x20
        return out, at


def _agreed(order: np.ndarray, first: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Of each group (beginning at ``first`` in this order) the tag if all are the same, else 0."""
    tags = tags[order]
    low, high = np.minimum.reduceat(tags, first), np.maximum.reduceat(tags, first)
    return np.where(low == high, low, 0).astype(np.uint32)


def _sorted_groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(x, kind="stable")
    return order, np.flatnonzero(np.r_[True, x[order][1:] != x[order][:-1]][: len(x)])


def _blob(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True)


def _array(blob: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), dtype=kind)


def _tag_planes(x: np.ndarray) -> bytes:
    return _blob(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 4).T)


def _tags_of(blob: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(_array(blob, 4 * n, np.uint8).reshape(4, n).T).view(np.uint32).reshape(-1)


def _deltas(x: np.ndarray) -> bytes:
    return squeeze(np.diff(x, prepend=np.uint64(0)))


class Graph:
    """What a block knows of the graph from the ranges: its repeated edges, and which lie inside a nonbranching path."""

    def __init__(self, rows: pa.Table):
        each = sorted(zip(*(rows.column(c).to_pylist() for c in ("part", "size", "edges", "inner")), strict=True), key=lambda r: r[0])
        found = [(np.cumsum(expand(e, n), dtype=np.uint64), _array(i, n, np.uint8) > 0) for part, n, e, i in each if part >= 0]
        self.edges = np.concatenate([np.zeros(0, np.uint64), *(e for e, _ in found)])
        self.inner = np.concatenate([np.zeros(0, bool), *(i for _, i in found)])
        places = zip(rows.column("part").to_pylist(), rows.column("places").to_pylist(), strict=True)
        self.false = np.array(sorted(x for part, of_part in places if part < 0 for x in of_part), dtype=np.int64)

    def look_up(self, walks: Walks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the window at each word: its edge, whether it is repeated, and whether it lies inside a path."""
        edges, whole = walks.edges(), walks.whole()
        repeated, inner = np.zeros(len(edges), bool), np.zeros(len(edges), bool)
        if len(self.edges):
            at = np.flatnonzero(whole)
            number = np.minimum(np.searchsorted(self.edges, edges[at]), len(self.edges) - 1)
            hit = self.edges[number] == edges[at]
            repeated[at], inner[at] = hit, hit & self.inner[number]
        repeated[self.false] = False
        return edges, repeated, inner


def _paths(repeated: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where compacted paths begin, and how many windows they have."""
    before, inner_before = np.r_[False, repeated[:-1]][: len(repeated)], np.r_[False, inner[:-1]][: len(inner)]
    begins = repeated & ~(before & inner & inner_before)
    at = np.flatnonzero(begins)
    # a path ends where the next begins or where windows are no longer repeated
    stops = np.flatnonzero(np.r_[before & ~repeated, True] | np.r_[begins, False])
    return at, stops[np.searchsorted(stops, at, "right")] - at


def _covered(repeated: np.ndarray, n: int, window: int) -> np.ndarray:
    change = np.zeros(n + window + 1, dtype=np.int32)
    change[: len(repeated)] += repeated
    change[window : window + len(repeated)] -= repeated
    return np.cumsum(change)[:n] > 0


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_DOC = "doc_id long, digest long, n_words long, removed array<struct<begin: long, end: long>>, kept_sha256 string, kept_text string"
_PATH = "edge long, windows long, words binary, block int, at long"
_REPLY = "block int, part int, size long, edges binary, inner binary, places array<long>"


def _documents(walks: Walks, covered: np.ndarray, joined: np.ndarray, at: np.ndarray, texts: bool) -> list[pa.Array]:
    spans, shas, kept = [], [], []
    size = np.diff(at)
    for a, b in zip(walks.first[:-1].tolist(), walks.first[1:].tolist(), strict=True):
        mine, body = covered[a:b], joined[at[a] : at[b]]
        spans.append([{"begin": x, "end": y} for x, y in _runs(mine)])
        body = (body[np.repeat(~mine, size[a:b])] if spans[-1] else body)[:-1].tobytes()
        shas.append(hashlib.sha256(body).hexdigest())
        kept.append(body.decode() if texts else None)
    named = [walks.docs.column(c).combine_chunks() for c in ("doc_id", "digest")]
    return [*named, pa.array(np.diff(walks.first)), pa.array(spans, pa.list_(_SPAN)), pa.array(shas, pa.string()), pa.array(kept, pa.string())]


class Corpus:
    """The documents in blocks, and the passes over them."""

    def __init__(self, docs: DataFrame, window: int, bits: int):
        size = F.sum(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long"))
        self.parts = max(1, -(-int(docs.select(size).first()[0] or 0) // BLOCK_BYTES))
        self.window, self.bits = window, bits
        self.blocks = deal_blocks(docs, self.parts).groupBy("block")

    def repeated_seeds(self) -> DataFrame:
        """block, seed: the seeds that stand at two places or more, to every block that has them."""
        window, bits = self.window, self.bits

        def send(key: tuple, packed: pa.Table) -> pa.Table:
            seeds, counts = K.distinct(Walks(packed, window, bits).seeds()[1])
            return pa.table({"block": pa.array([key[0].as_py()] * len(seeds), pa.int32()), "seed": pa.array(seeds.view(np.int64)), "several": pa.array(counts > 1)})

        sent = self.blocks.applyInArrow(lean_group(send), "block int, seed long, several boolean")
        by = Window.partitionBy("seed")
        return sent.select("block", "seed", (F.count("*").over(by) + F.max(F.col("several").cast("int")).over(by)).alias("n")).where("n > 1").select("block", "seed")

    def repeated_edges(self) -> DataFrame:
        """block, part, size, edges and inner: the edges that occur twice or more, by hash range, to every block that has them."""
        window, bits, parts = self.window, self.bits, self.parts
        borders = np.array([(k << bits) // parts for k in range(1, parts)], dtype=np.uint64)

        def send(key: tuple, packed: pa.Table, seeds: pa.Table) -> pa.Table:
            walks = Walks(packed, window, bits)
            least = walks.seeds()[0]
            known = np.sort(seeds.column("seed").to_numpy().view(np.uint64))
            at = np.flatnonzero(walks.whole())
            if len(known):
                number = np.minimum(np.searchsorted(known, least[at]), len(known) - 1)
                at = at[known[number] == least[at]]
            else:
                at = at[:0]
            edges, tags = walks.edges()[at], walks.tags(at)
            order, first = _sorted_groups(edges)
            several = np.diff(np.r_[first, len(edges)]) > 1
            edges, tags = edges[order][first], _agreed(order, first, tags) if len(first) else tags
            cut = np.r_[0, np.searchsorted(edges, borders), len(edges)]
            rows = [(p, int(cut[p]), int(cut[p + 1])) for p in range(parts) if cut[p + 1] > cut[p]]
            return pa.table({
                "part": pa.array([p for p, _, _ in rows], pa.int32()),
                "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "size": pa.array([b - a for _, a, b in rows], pa.int64()),
                "edges": pa.array([_deltas(edges[a:b]) for _, a, b in rows], pa.binary()),
                "several": pa.array([_blob(np.packbits(several[a:b])) for _, a, b in rows], pa.binary()),
                "tags": pa.array([_tag_planes(tags[a:b]) for _, a, b in rows], pa.binary()),
            })

        def count(key: tuple, rows: pa.Table) -> pa.Table:
            sent = list(zip(*(rows.column(c).to_pylist() for c in ("block", "size", "edges", "several", "tags")), strict=True))
            each = [np.cumsum(expand(e, n), dtype=np.uint64) for _, n, e, _, _ in sent]
            edges = np.concatenate(each)
            order, first = _sorted_groups(edges)
            n_each = np.concatenate([np.unpackbits(_array(s, -(-n // 8), np.uint8), count=n) for _, n, _, s, _ in sent]).astype(np.int64) + 1
            n, tag = np.add.reduceat(n_each[order], first), _agreed(order, first, np.concatenate([_tags_of(t, n) for _, n, _, _, t in sent]))
            edges = edges[order][first][n > 1]
            inner = (tag[n > 1] > 0).astype(np.uint8)
            out = []
            for (block, *_), mine in zip(sent, each, strict=True):
                number = np.searchsorted(edges, mine)
                hit = edges[np.minimum(number, len(edges) - 1)] == mine if len(edges) else np.zeros(len(mine), bool)
                if hit.any():
                    out.append((block, int(hit.sum()), _deltas(mine[hit]), _blob(inner[number[hit]])))
            return pa.table({
                "block": pa.array([r[0] for r in out], pa.int32()),
                "part": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "size": pa.array([r[1] for r in out], pa.int64()),
                "edges": pa.array([r[2] for r in out], pa.binary()),
                "inner": pa.array([r[3] for r in out], pa.binary()),
                "places": pa.array([None] * len(out), pa.list_(pa.int64())),
            })

        schema = "part int, block int, size long, edges binary, several binary, tags binary"
        sent = self.blocks.cogroup(self.repeated_seeds().groupBy("block")).applyInArrow(lean_cogroup(send), schema)
        return sent.groupBy("part").applyInArrow(lean_group(count), _REPLY)

    def walked(self, replies: DataFrame, texts: bool) -> DataFrame:
        """A row a document (``doc``) and a row a compacted path (``path``), the other being null."""
        window, bits = self.window, self.bits

        def run(key: tuple, packed: pa.Table, known: pa.Table) -> pa.Table:
            walks = Walks(packed, window, bits)
            edges, repeated, inner = Graph(known).look_up(walks)
            begin, length = _paths(repeated, inner)
            covered = _covered(repeated, len(walks.hashes), window)
            joined, at = walks.joined()
            docs = pa.StructArray.from_arrays(_documents(walks, covered, joined, at, texts), fields=_fields(_DOC))
            words = [hashlib.blake2b(joined[at[i] : at[i + n + window - 1]], digest_size=16).digest() for i, n in zip(begin.tolist(), length.tolist(), strict=True)]
            of_paths = [
                pa.array(edges[begin].view(np.int64)), pa.array(length, pa.int64()), pa.array(words, pa.binary()),
                pa.array([key[0].as_py()] * len(begin), pa.int32()), pa.array(begin, pa.int64()),
            ]
            paths = pa.StructArray.from_arrays(of_paths, fields=_fields(_PATH))
            return pa.table({"doc": pa.concat_arrays([docs, pa.nulls(len(paths), docs.type)]), "path": pa.concat_arrays([pa.nulls(len(docs), paths.type), paths])})

        return self.blocks.cogroup(replies.groupBy("block")).applyInArrow(lean_cogroup(run), f"doc struct<{_DOC}>, path struct<{_PATH}>")

    def false_windows(self, replies: DataFrame, single: DataFrame) -> DataFrame:
        """block, places: the windows of all blocks that equal others by hash only, among those of the single paths and all that share a bit with them."""
        window, bits = self.window, self.bits

        def edges_of(key: tuple, packed: pa.Table, paths: pa.Table) -> pa.Table:
            edges = Walks(packed, window, bits).edges()
            found = [edges[i : i + n] for i, n in zip(paths.column("at").to_pylist(), paths.column("windows").to_pylist(), strict=True)]
            return pa.table({"edge": pa.array(np.unique(np.concatenate([edges[:0], *found])).view(np.int64))})

        again = self.blocks.cogroup(single.select("block", "at", "windows").groupBy("block")).applyInArrow(lean_cogroup(edges_of), "edge long")
        bit = F.pmod("edge", F.lit(BITMAP_BITS))
        pieces = again.select(F.floor(bit / PIECE_BITS).cast("int").alias("piece"), (bit % PIECE_BITS).alias("bit"))
        pieces = pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        marked = np.zeros(BITMAP_BITS, dtype=bool)
        for piece, bitmap in pieces.collect():  # BITMAP_BITS altogether at most
            part = np.unpackbits(np.frombuffer(bytes(bitmap), np.uint8), bitorder="little", count=PIECE_BITS).astype(bool)
            marked[piece * PIECE_BITS : (piece + 1) * PIECE_BITS] = part
        packed_bits = np.packbits(marked).tobytes()

        def windows(key: tuple, packed: pa.Table, known: pa.Table) -> pa.Table:
            walks = Walks(packed, window, bits)
            edges, repeated, _ = Graph(known).look_up(walks)
            marked = np.unpackbits(np.frombuffer(packed_bits, np.uint8)).astype(bool)
            begin = np.flatnonzero(repeated & marked[(edges & np.uint64(BITMAP_BITS - 1)).astype(np.int64)])
            joined, at = walks.joined()
            words = [hashlib.blake2b(joined[at[i] : at[i + window]], digest_size=16).digest() for i in begin.tolist()]
            return pa.table({"words": pa.array(words, pa.binary()), "block": pa.array([key[0].as_py()] * len(begin), pa.int32()), "at": pa.array(begin, pa.int64())})

        met = self.blocks.cogroup(replies.groupBy("block")).applyInArrow(lean_cogroup(windows), "words binary, block int, at long")
        alone = met.groupBy("words").agg(F.count("*").alias("n"), F.first("block").alias("block"), F.first("at").alias("at")).where("n = 1")
        return alone.groupBy("block").agg(F.collect_list("at").alias("places"))


def _fields(schema: str) -> list[pa.Field]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<struct<begin: long, end: long>>": pa.list_(_SPAN)}
    columns = (x.replace(";", ",").split(" ", 1) for x in schema.replace("begin: long, end", "begin: long; end").split(", "))
    return [pa.field(name, kinds[kind]) for name, kind in columns]


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False, hash_bits: int = HASH_BITS) -> DataFrame:
    """doc_id, digest (of the whole text), n_words, removed (word spans, end exclusive), kept_sha256 and kept_text (with ``texts``, else null) of every row.

    Kept words are joined by one space.
    """
    if window < SEED_WORDS:
        raise ValueError(f"a window has {SEED_WORDS} words at least")
    corpus = Corpus(docs, window, hash_bits)
    replies = corpus.repeated_edges()
    walked = materialise(corpus.walked(replies, texts), "repeats-walked")
    paths = walked.where("path is not null").select("path.*").groupBy("edge", "windows", "words")
    paths = paths.agg(F.count("*").alias("n"), F.first("block").alias("block"), F.first("at").alias("at"))
    single = paths.where("n = 1")
    if not single.isEmpty():
        single = materialise(single, "repeats-single")
        none = F.lit(None).cast("binary")
        false = corpus.false_windows(replies, single)
        false = false.select("block", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("size"), none.alias("edges"), none.alias("inner"), "places")
        walked = materialise(corpus.walked(replies.unionByName(materialise(false, "repeats-false")), texts), "repeats-again")
    return walked.where("doc is not null").select("doc.*")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text of every row, the text without its repeated passages where it has any, else as it was kept: words joined by one space."""
    return remove_repeats(docs, window, texts=True).select("doc_id", F.col("kept_text").alias("text"))


def removal_digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of what ``remove_repeats`` gives."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["begin"])
    return removed.select("doc_id", "n_words", n.alias("n_removed"), "kept_sha256")
