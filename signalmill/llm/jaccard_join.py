"""N-gram Jaccard join with filters under several global token orders.

A document is the set of its distinct 5-word shingles. Two documents link when
100 * |intersection| >= 80 * |union|. Under any total order of the tokens, the first
|x| - ceil(0.8 |x|) + 1 tokens of linked sets share one. Each order gives such a filter, and a pair
must pass all of them before its texts are brought together and it is verified on them whole.

1. Documents are dealt into blocks by hash of doc_id and text. Blocks send hash ranges their distinct
   tokens (the first ``ORDER_BITS`` bits, sorted and packed) with counts of sets, and get back the level of each:
   0 for a token of one set, else 1 + the whole log2 of its count.
2. The orders put tokens of low level first, then go by a hash that differs from order to
   order. Any order is right; two tokens that share their first bits only share a level.
   A document whose prefix under some order has no token of level 1 or more links with no other set. The others
   are candidates: their texts and prefixes go to a table of their own.
3. Every set has a 64-bit name (with its size), and documents with the same set are one class from here on, with a number
   of its own (its node). The candidates' prefix tokens of level 1 or more under the first order are dealt by token, very common ones
   salted, and sorted; a stream over them keeps tokens of two classes or more. These are the buckets.
4. ``ROUNDS`` times every bucket draws one class by hash as its centre, and the classes in other
   components than the centre's are paired with it. Verified pairs make the components grow; a group of near copies of any size
   costs as many pairs as members.
5. Pairs inside a bucket that are still in different components are then all formed, so no
   link that could change a component is left out. Each row of a bucket knows the tokens before its own in
   its document's prefix; a pair that has one of them in common is formed there and not here.
6. A pair must share a token in the prefixes under every other order too. That is looked up in slim rows of 16 bits a
   token, which may let a pair pass but never stop one that shares a token. Texts move only for pairs that pass all filters;
   their intersection is counted on the sets of the whole texts.

Two different sets with one name and one size would count as one class; among n classes of a size that has odds of n^2 / 2^65 (for
a billion of them 0.03). Two shingles with one 64-bit hash change an intersection by one.

A document is a row: rows that share a doc_id but not the text are nodes of their own, which aren't linked by their doc_id. Null texts
and texts without words have an empty set and link with nothing. Repeated rows and copies are
members of one class. Rows without doc_id take part in nothing and keep a null component. Ties can't arise: a component is named by
its smallest doc_id. An empty table gives no rows. A very long text is a block of its own. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import smallest_labels
from . import bytekernel as K
from .packing import deal_blocks, expand, lean_batches, lean_cogroup, lean_group, squeeze, unpack
from .storage import join_sized, materialise, scratch, shuffle_width, without_rows

WORDS = 5
PERCENT = 80
ORDERS = 3
ROUNDS = 3
#: Tokens before its own that a bucket's row knows.
BEFORE = 6
#: Bits of a token by which its level is counted; more tell more tokens apart and take more room in the exchange.
ORDER_BITS = 40
#: From this level on (counts of 128 and more) a token's bucket is dealt in salts.
HOT_LEVEL = 8
#: Characters of a block, and of a hash range, on average.
BLOCK_CHARACTERS = 8_000_000
#: Members of a centre that one salt verifies, and the most salts of a centre; a salt is a stream, so its members may be any number.
SALT_MEMBERS, MOST_SALTS = 64, 4096


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    buf, off = K.text_buffer(column)
    for i, j in K.chunks(off):
        s, o = K.shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i], WORDS)
        for d in range(j - i):
            yield s[o[d] : o[d + 1]]


def _signature(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(K.mix64(s * np.uint64(0x9FB21C651E98DF25)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0


def _block_tokens(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct first bits of the tokens of a block, and in how many different sets of the block they are."""
    different = list({x.tobytes(): x for x in sets if len(x)}.values())
    if not different:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return K.distinct(np.concatenate(different) >> np.uint64(64 - ORDER_BITS))


def _send(key: tuple, rows: pa.Table, parts: int) -> pa.Table:
    u, c = _block_tokens(list(_sets(unpack(rows).column("text"))))
    edges = np.r_[0, np.searchsorted(u, np.array([(k << ORDER_BITS) // parts for k in range(1, parts)], dtype=np.uint64)), len(u)]
    sent = [(p, int(edges[p]), int(edges[p + 1])) for p in range(parts) if edges[p + 1] > edges[p]]
    return pa.table({
        "part": pa.array([p for p, _, _ in sent], pa.int32()), "block": pa.array([key[0].as_py()] * len(sent), pa.int32()), "size": pa.array([b - a for _, a, b in sent], pa.int64()),
        "tokens": pa.array([squeeze(np.diff(u[a:b], prepend=np.uint64(0))) for _, a, b in sent], pa.binary()), "tallies": pa.array([squeeze(c[a:b]) for _, a, b in sent], pa.binary()),
    })


def _reply(key: tuple, rows: pa.Table) -> pa.Table:
    sent = list(zip(*(rows.column(c).to_pylist() for c in ("block", "size", "tokens", "tallies")), strict=True))
    tokens = [np.cumsum(expand(x, n), dtype=np.uint64) for _, n, x, _ in sent]
    both = np.concatenate(tokens)
    by = np.argsort(both, kind="stable")
    first = np.flatnonzero(np.r_[True, both[by][1:] != both[by][:-1]])
    u, sums = both[by][first], np.add.reduceat(np.concatenate([expand(x, n) for _, n, _, x in sent])[by], first)
    level = np.where(sums > 1, 1 + np.floor(np.log2(np.maximum(sums, 1))), 0)
    return pa.table({
        "block": pa.array([b for b, *_ in sent], pa.int32()), "part": pa.array([key[0].as_py()] * len(sent), pa.int32()), "size": pa.array([n for _, n, *_ in sent], pa.int64()),
        "levels": pa.array([squeeze(level[np.searchsorted(u, x)]) for x in tokens], pa.binary()),
    })


_DEALT = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("digest", pa.int64()), ("salt", pa.int32()), ("signature", pa.int64()), ("size", pa.int32()), ("tags", pa.list_(pa.list_(pa.int16()))), ("before", pa.list_(pa.int64())), ("place", pa.int32()), ("text", pa.string())])


def _deal(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Of a block: a ``set`` row for each document, a ``token`` row for each shared token of a candidate's first prefix, and of each
    class of candidates a ``text`` row for the smallest doc_id."""
    replies = sorted(zip(*(right.column(c).to_pylist() for c in ("part", "size", "levels")), strict=True))
    block = unpack(left)
    sets = list(_sets(block.column("text")))
    docs, texts = block.column("doc_id").to_pylist(), block.column("text")
    names = [_signature(s) for s in sets]
    u = _block_tokens(sets)[0]
    levels = np.concatenate([expand(x, n) for _, n, x in replies]) if replies else np.zeros(0, np.uint64)
    firsts: dict[tuple, int] = {}
    for d, s in enumerate(sets):
        if docs[d] is not None and len(s) and docs[d] <= docs[firsts.setdefault((names[d], len(s)), d)]:
            firsts[names[d], len(s)] = d
    candidates, tokens, salts, owner, before, places = [], [], [], [], [], []
    for d in firsts.values():
        s = sets[d]
        level = levels[np.searchsorted(u, s >> np.uint64(64 - ORDER_BITS))]
        if not level.any():
            continue
        shared = [x[lv > 0] for x, lv in (prefix(s, level, k) for k in range(ORDERS))]
        if all(len(x) for x in shared):
            candidates.append((d, [np.unique(x.astype(np.uint16)).view(np.int16).tolist() for x in shared[1:]]))
            first, lv = prefix(s, level, 0)
            places.append(np.flatnonzero(lv > 0) + 1)
            first, lv = first[lv > 0], lv[lv > 0].astype(np.int64)
            tokens.append(first.view(np.int64))
            before += [tokens[-1][max(0, k - BEFORE) : k].tolist() for k in range(len(first))]
            salts.append(np.where(lv >= HOT_LEVEL, 1 + names[d] % (1 << np.clip(lv - HOT_LEVEL + 1, 0, 12)), 0))
            owner.append(np.full(len(first), d))
    n, m = len(sets), len(candidates)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    signature, size = np.array(names, dtype=np.int64), np.array([len(s) for s in sets], dtype=np.int32)
    at = np.array([d for d, _ in candidates], dtype=np.int64)

    def rows(kind: str, ids, salt, index, digest=None, tags=None, before=None, place=None, text=None) -> pa.Table:
        k = len(index)
        return pa.Table.from_arrays([
            pa.array([kind] * k, pa.string()), pa.array(ids, pa.int64()), pa.nulls(k, pa.int64()) if digest is None else digest, pa.array(salt, pa.int32()), pa.array(signature[index]), pa.array(size[index]),
            pa.array(tags or [None] * k, _DEALT.field("tags").type), pa.array(before or [None] * k, pa.list_(pa.int64())), pa.nulls(k, pa.int32()) if place is None else pa.array(place, pa.int32()), pa.array(text or [None] * k, pa.string()),
        ], schema=_DEALT)

    return pa.concat_tables([
        rows("set", docs, np.zeros(n, np.int32), np.arange(n), digest=block.column("digest").combine_chunks()),
        rows("text", [docs[d] for d in at], np.zeros(m, np.int32), at, tags=[t for _, t in candidates], text=texts.take(pa.array(at)).to_pylist()),
        rows("token", np.concatenate(tokens) if tokens else [], np.concatenate(salts).astype(np.int32) if salts else [], owner, before=before, place=np.concatenate(places) if places else None),
    ])


def prefix(s: np.ndarray, level: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set under an order, as many as linked sets must share one of, in that order, and their levels."""
    n = len(s)
    p = n - (PERCENT * n + 99) // 100 + 1
    key = (level.astype(np.uint64) << np.uint64(56)) | (K.mix64(s ^ np.uint64(0xC2B2AE3D27D4EB4F * (order + 1) % (1 << 64))) >> np.uint64(8))
    first = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
    first = first[np.argsort(key[first])]
    return s[first], level[first]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = int(np.isin(a, b, assume_unique=True, kind="sort").sum()) if len(a) <= len(b) else int(np.isin(b, a, assume_unique=True, kind="sort").sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, salt and class: each class once, without tokens of one class; salted tokens all stay."""
    names = ["token", "signature", "size", "before", "place"]
    held: pa.RecordBatch | None = None  # the last different row so far, with whether it is out already
    held_out = False
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
        token, salt, sig, size = (rows.column(c).to_numpy() for c in ("token", "salt", "signature", "size"))
        new = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1]) | (size[1:] != size[:-1])])
        same = token[new][1:] == token[new][:-1]
        keep = (np.r_[False, same] | np.r_[same, False]) | (salt[new] > 0)
        last_out = bool(keep[-1]) or (held_out and len(new) == 1)
        if held_out:
            keep[0] = False
        yield pa.RecordBatch.from_struct_array(rows.take(pa.array(new[keep])).select(names).to_struct_array().combine_chunks()) if keep.any() else b.slice(0, 0).select(names)
        held, held_out = rows.slice(int(new[-1]), 1).to_batches()[0], last_out


def _verify_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each centre, whose own row comes first."""
    now, centre = None, None
    for b in batches:
        out: list[tuple[int, int]] = []
        for c, salt, node, s in zip(*(b.column(k).to_pylist() for k in range(3)), _sets(b.column(3)), strict=True):
            if node == c:
                now, centre = (c, salt), s
            elif now == (c, salt) and linked(centre, s):
                out.append((c, node))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def _verified(texts: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The linked pairs among ``pairs`` (centre, member), which needn't differ. A centre with many members is verified in salts."""
    pairs = materialise(pairs.distinct(), f"jaccard-{name}-pairs")
    tags = texts.select("node", "tags")
    centres = materialise(pairs.groupBy("centre").agg(F.count("*").alias("members")).join(tags.withColumnsRenamed({"node": "centre", "tags": "centre_tags"}), "centre"), f"jaccard-{name}-centres")
    both = join_sized(pairs, centres, "centre", "members").join(tags.withColumnRenamed("node", "member"), "member")
    for k in range(ORDERS - 1):
        both = both.where(F.arrays_overlap(F.col("tags")[k], F.col("centre_tags")[k]))
    salts = F.least(F.ceil(F.col("members") / SALT_MEMBERS), F.lit(MOST_SALTS))
    members = materialise(both.select("centre", F.pmod(F.xxhash64("member"), salts).cast("int").alias("salt"), F.col("member").alias("node")), f"jaccard-{name}-members")
    heads = members.select("centre", "salt", F.col("centre").alias("node")).distinct()
    rows = texts.select("node", "text").join(members.unionByName(heads), "node").select("centre", "salt", "node", "text")
    rows = rows.repartition(shuffle_width(pairs.sparkSession), "centre", "salt").sortWithinPartitions("centre", "salt", F.col("node") != F.col("centre"))
    return rows.mapInArrow(lean_batches(_verify_rows), "a long, b long")


def _may_link(size: Column, place: Column, other_size: Column, other_place: Column) -> Column:
    """Whether sets of these sizes can link if their first common token is at these places of their orders."""
    shared = 1 + F.least(size - place, other_size - other_place)
    return shared * (100 + PERCENT) >= PERCENT * (size + other_size)


def _placed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of their node's component, at first the node itself."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def join_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written rows, doc_id, digest, signature, size of every row, and written classes (see ``_classes``); nothing else that was written stays."""
    with scratch(docs.sparkSession) as keep:
        rows, classes = _classes(docs)
        return keep(rows, "jaccard-rows"), keep(classes, "jaccard-labelled")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows, doc_id, digest, signature, size of every row, and classes: signature, size, node, doc (the smallest doc_id), n (rows) and label of every set that isn't empty."""
    width = shuffle_width(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, -(-int(slim.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARACTERS))
    by_block = deal_blocks(slim, parts).groupBy("block")
    sent = by_block.applyInArrow(lean_group(lambda key, rows: _send(key, rows, parts)), "part int, block int, size long, tokens binary, tallies binary")
    replies = sent.groupBy("part").applyInArrow(lean_group(_reply), "block int, part int, size long, levels binary")
    dealt = by_block.cogroup(replies.groupBy("block")).applyInArrow(lean_cogroup(_deal), "kind string, id long, digest long, salt int, signature long, size int, tags array<array<short>>, before array<long>, place int, text string")
    dealt = materialise(dealt, "jaccard-dealt")

    name = ["signature", "size"]
    rows = dealt.where("kind = 'set'").select(F.col("id").alias("doc_id"), "digest", *name)
    classes = rows.where("size > 0 and doc_id is not null").groupBy(*name).agg(F.min("doc_id").alias("doc"), F.count("*").alias("n"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    nodes = classes.select(*name, "node")
    # blocks that hold copies of a class send a text each; one of them is the class's
    texts = dealt.where("kind = 'text'").groupBy(*name).agg(F.min_by(F.struct("tags", "text"), "id").alias("of"))
    texts = materialise(texts.join(nodes, name).select("node", "of.tags", "of.text"), "jaccard-texts")

    tokens = dealt.where("kind = 'token'").select(F.col("id").alias("token"), "salt", *name, "before", "place")
    tokens = tokens.repartition(width, "token", "salt").sortWithinPartitions("token", "salt", *name)
    shared = tokens.mapInArrow(lean_batches(_shared_tokens), "token long, signature long, size int, before array<long>, place int")
    buckets = materialise(shared.join(nodes, name).select("token", "node", "size", "before", "place"), "jaccard-buckets")

    labels = nodes.select("node", F.col("node").alias("label")).limit(0)
    for k in range(ROUNDS):
        placed = _placed(buckets.drop("before"), labels)
        # at first the class whose token comes earliest, which has the fewest tokens of its own; then by hash
        order = F.struct(F.col("place") if k == 0 else F.lit(0), F.xxhash64("node", F.lit(k)))
        drawn = placed.groupBy("token").agg(F.min_by(F.struct("node", "size", "label", "place"), order).alias("c"))
        drawn = drawn.select("token", F.col("c.node").alias("centre"), F.col("c.size").alias("centre_size"), F.col("c.label").alias("centre_label"), F.col("c.place").alias("centre_place"))
        pairs = placed.join(drawn, "token").where((F.col("label") != F.col("centre_label")) & _may_link(F.col("size"), F.col("place"), F.col("centre_size"), F.col("centre_place")))
        links = _verified(texts, pairs.select("centre", F.col("node").alias("member")), str(k))
        labels = smallest_labels(links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))

    placed = _placed(buckets, labels)
    mixed = placed.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
    open_ = materialise(placed.join(mixed, "token"), "jaccard-open")
    left, right = open_.alias("l"), open_.alias("r")
    here = F.expr("l.token = r.token and l.node < r.node and l.label <> r.label and not arrays_overlap(l.before, r.before)")
    rest = left.join(right, here & _may_link(F.col("l.size"), F.col("l.place"), F.col("r.size"), F.col("r.place")))
    links = _verified(texts, rest.select(F.col("l.node").alias("centre"), F.col("r.node").alias("member")), "rest")
    labels = smallest_labels(links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
    return rows, _placed(classes, labels)


def _components(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with their class's doc, label and component (the smallest doc_id of the label), null without a class."""
    components = materialise(classes.groupBy("label").agg(F.min("doc").alias("component"), F.count("*").alias("classes")), "jaccard-components")
    named = join_sized(classes, components, "label", "classes").select("signature", "size", "doc", "n", "label", "component")
    named = materialise(named, "jaccard-named")
    some = F.expr("size > 0 and doc_id is not null")
    joined = join_sized(rows.where(some), named, ["signature", "size"], "n")
    return joined.unionByName(rows.where(F.expr("size = 0 or doc_id is null")), allowMissingColumns=True)


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row."""
    out = _components(*join_classes(docs))
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a component, with all their columns, and one row of each component: with its smallest doc_id, and of
    several such texts the one with the least digest."""
    found = materialise(_components(*join_classes(docs)).where("component is not null"), "jaccard-found")
    first = found.where("doc_id = component").groupBy("label", "doc_id", "digest").agg(F.count("*").alias("n"))
    several = materialise(first.groupBy("label").agg(F.min("digest").alias("keep"), F.sum("n").alias("rows")).where("rows > 1"), "jaccard-several")
    first = materialise(first.join(several, "label"), "jaccard-first")
    gone = found.where("doc_id <> component").select("doc_id", "digest").unionByName(first.where("digest <> keep").select("doc_id", "digest"))
    return without_rows(docs, materialise(gone.distinct(), "jaccard-gone"), first.where("digest = keep and n > 1"))
