"""Stupid-backoff language-model scores of a corpus against itself, relationally.

Each document is scored by the n-gram counts of all *other* documents (its own occurrences are
taken off, so a text doesn't vouch for itself; ``leave_one_out=False`` keeps them):

    S(w | context) = count(context w) / count(context)   if that n-gram occurs,
                     alpha * S(w | context without its first word)   otherwise;
    S(w) = count(w) / N, or alpha / (N + 1) for a word that doesn't occur.

A document's total is the sum of ln S over its words, each rounded to a millionth, so that
sums don't depend on their order; its score is the mean a word, so that long and short texts compare.

1. Documents are dealt into blocks by hash of doc_id. A block explodes its documents into
   words and pairs, aggregates them, and sends each hash range its distinct n-grams with counts, sorted
   and packed (differences of 64-bit hashes).
2. Each hash range adds up its part of the count tables and joins it to what every block
   sent: a block gets back the corpus counts of its n-grams, in the order in which it sent them.
3. For each longer order the same is done again with the n-grams that can occur in another
   document at all: both of their shorter n-grams do. (If an n-gram is in two documents,
   all its occurrences pass; of the others the count is the document's own.)
4. A block joins the counts to its exploded n-grams and sums per document.

A very common n-gram is one entry a block, so no key is hot; only the corpus's number of words goes to the driver.
Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z in lower case. Null and empty texts have no words, a
total of 0 and no score; an empty table gives no rows. Each row is a document of its own, repeated rows and rows that share a doc_id or
have none too. Ties don't arise, as sums are of integers. A very long text is a block of its own, in memory in proportion to it.
N-grams are told apart by 64-bit hashes: among n different ones n^2 / 2^65 pairs are expected to share one. Extra columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytekernel as K
from .packing import deal_blocks, expand, lean_cogroup, lean_group, squeeze, unpack

ALPHA = 0.4
ORDER = 3
#: Orders that are sent whole, in the first exchange.
FULL_ORDERS = 2
#: Words of a block, and of a hash range, on average; smaller blocks need less memory and repeat more n-grams.
BLOCK_WORDS = 1_300_000


class Grams:
    """The n-grams of a block of documents. An occurrence ends at a word; ``place`` is the word's place in its document."""

    def __init__(self, texts: pa.ChunkedArray):
        buf, off = K.text_buffer(texts)
        parts = [K.word_hashes(buf[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in K.chunks(off)]
        self.n_words = np.concatenate([np.diff(o) for _, o in parts]) if parts else np.zeros(0, np.int64)
        self.words = np.concatenate([w for w, _ in parts]) if parts else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.n_words), dtype=np.int32), self.n_words)
        self.place = (np.arange(len(self.words)) - np.repeat(np.cumsum(self.n_words) - self.n_words, self.n_words)).astype(np.int32)

    def ending_at(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n-grams that end at these places of ``self.words``."""
        h = np.full(len(self.words), 0, dtype=np.uint64)
        h[n - 1 :] = K.gram_hashes(self.words, n)
        return h[words]

    def tally(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the n-grams that end at these places: the number of each among the distinct ones in order, how
        often its own document has it among them, and the count of each distinct one."""
        grams = self.ending_at(words, n)
        by = np.argsort(grams)
        grams = grams[by]
        first = np.r_[True, grams[1:] != grams[:-1]][: len(grams)]
        del grams
        number = np.cumsum(first, dtype=np.int32) - 1
        counts = np.bincount(number)
        own = np.ones(len(words), dtype=np.int32)
        several = np.flatnonzero(counts[number] > 1)
        key = number[several].astype(np.int64) * max(1, len(self.n_words)) + self.doc[words[by[several]]]
        again = np.argsort(key)
        key = key[again]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        own[several[again]] = np.repeat(np.diff(np.r_[edge, len(key)]), np.diff(np.r_[edge, len(key)]))
        out = np.empty((2, len(words)), dtype=np.int32)
        out[0, by], out[1, by] = number, own
        return out[0], out[1], counts

    def wanted(self, n: int, occurs: np.ndarray | None) -> np.ndarray:
        """Places where an n-gram ends that may be in another document. ``occurs``: of each word, the (n - 1)-gram's count in other documents."""
        here = self.place >= n - 1
        if n > FULL_ORDERS:
            here[1:] &= (occurs[1:] > 0) & (occurs[:-1] > 0)
        return np.flatnonzero(here)

    def counts(self, replies: dict[int, np.ndarray], elsewhere: bool = True) -> list[np.ndarray]:
        """By order, as far as there are replies: of every word, its n-gram's count in other documents (or in the corpus)."""
        out: list[np.ndarray] = []
        occurs = None
        for n in range(1, len(replies) + 1):
            words = self.wanted(n, occurs)
            number, own, _ = self.tally(words, n)
            occurs = np.zeros(len(self.words), dtype=np.int64)
            occurs[words] = replies[n][number] - own
            count = occurs
            if not elsewhere:
                rest = np.flatnonzero(self.place >= n - 1)
                count = occurs.copy()
                count[rest] += self.tally(rest, n)[1]
            out.append(count)
        return out


def _ranges(u: np.ndarray, parts: int) -> np.ndarray:
    """Borders in the sorted hashes of ``parts`` equal ranges of all hashes."""
    return np.r_[0, np.searchsorted(u, np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)), len(u)]


def _block_scores(g: Grams, have: list[np.ndarray], total: np.ndarray, alpha: float) -> np.ndarray:
    """Sum of millionths of ln S of each document. ``have``: by order, the count that scores at each word; ``total``: N for each word."""
    order, n = len(have), len(g.place)
    s, done = np.zeros(n), np.zeros(n, dtype=bool)
    for k in range(order, 0, -1):
        hit = ~done & (g.place >= k - 1) & (have[k - 1] > 0)
        steps = np.minimum(g.place[hit], order - 1) - (k - 1)
        # the context of the n-gram that ends at word i is the shorter one that ends at word i - 1
        below = have[k - 2][np.flatnonzero(hit) - 1] if k > 1 else total[hit]
        s[hit] = alpha**steps * (have[k - 1][hit] / below)
        done |= hit
    s[~done] = alpha ** (np.minimum(g.place[~done], order - 1) + 1.0) / (total[~done] + 1)
    return np.bincount(g.doc, weights=np.rint(np.log(s) * 1e6), minlength=len(g.n_words)).astype(np.int64)


def _replies(rows: pa.Table) -> dict[int, np.ndarray]:
    """By order: the counts that came back, in the order of the hashes."""
    got: dict[int, list] = {}
    for n, part, size, counts in sorted(zip(*(rows.column(c).to_pylist() for c in ("n", "part", "size", "counts")), strict=True), key=lambda r: r[:2]):
        got.setdefault(n, []).append(expand(counts, size).astype(np.int64))
    return {n: np.concatenate(x) for n, x in got.items()}


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, leave_one_out: bool = True) -> DataFrame:
    """doc_id, n_words, total_micro (the sum over the words, in millionths) and score (the mean a word) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    word_count = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    n_all = int(rows.select(word_count.alias("n")).agg(F.sum("n")).first()[0] or 0)
    parts = max(1, -(-n_all // BLOCK_WORDS))
    by_block = deal_blocks(rows, parts).groupBy("block")

    def send(block: int, g: Grams, n: int, occurs: np.ndarray | None) -> pa.Table:
        u, c = K.distinct(g.ending_at(g.wanted(n, occurs), n))  # in the order of tally's numbers
        edges = _ranges(u, parts)
        rows = [(p, int(edges[p]), int(edges[p + 1])) for p in range(parts) if edges[p + 1] > edges[p]]
        return pa.table({
            "part": pa.array([p for p, _, _ in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()), "n": pa.array([n] * len(rows), pa.int32()), "size": pa.array([b - a for _, a, b in rows], pa.int64()),
            "grams": pa.array([squeeze(np.diff(u[a:b], prepend=np.uint64(0))) for _, a, b in rows], pa.binary()), "tallies": pa.array([squeeze(c[a:b]) for _, a, b in rows], pa.binary()),
        })

    def explode(key: tuple, rows: pa.Table) -> pa.Table:
        g = Grams(unpack(rows).column("text"))
        return pa.concat_tables([send(key[0].as_py(), g, n, None) for n in range(1, min(order, FULL_ORDERS) + 1)])

    def explode_longer(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        g, replies = Grams(unpack(left).column("text")), _replies(right)
        if not replies:  # a block without words sends nothing
            return send(key[0].as_py(), g, 1, None)
        return send(key[0].as_py(), g, len(replies) + 1, g.counts(replies)[-1])

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        sent = list(zip(*(rows.column(c).to_pylist() for c in ("block", "size", "grams", "tallies")), strict=True))
        grams = [np.cumsum(expand(x, size), dtype=np.uint64) for _, size, x, _ in sent]
        both = np.concatenate(grams)
        by = np.argsort(both, kind="stable")
        first = np.flatnonzero(np.r_[True, both[by][1:] != both[by][:-1]])
        u, sums = both[by][first], np.add.reduceat(np.concatenate([expand(x, size) for _, size, _, x in sent])[by], first)
        return pa.table({
            "block": pa.array([b for b, *_ in sent], pa.int32()), "n": pa.array([key[1].as_py()] * len(sent), pa.int32()), "part": pa.array([key[0].as_py()] * len(sent), pa.int32()),
            "size": pa.array([s for _, s, *_ in sent], pa.int64()), "counts": pa.array([squeeze(sums[np.searchsorted(u, x)]) for x in grams], pa.binary()),
        })

    def join(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        block = unpack(left)
        g, replies = Grams(block.column("text")), _replies(right)
        for n in range(len(replies) + 1, order + 1):  # no n-gram of this order was sent
            replies[n] = np.zeros(0, np.int64)
        total = n_all - g.n_words[g.doc] if leave_one_out else np.full(len(g.words), n_all)
        micro = _block_scores(g, g.counts(replies, leave_one_out), total, alpha)
        mean = np.where(g.n_words > 0, micro / 1e6 / np.maximum(g.n_words, 1), np.nan)
        return pa.table({"doc_id": block.column("doc_id"), "n_words": pa.array(g.n_words), "total_micro": pa.array(micro), "score": pa.array(mean, pa.float64(), mask=g.n_words == 0)})

    packed = "part int, block int, n int, size long, grams binary, tallies binary"
    counted = "block int, n int, part int, size long, counts binary"
    replies = by_block.applyInArrow(lean_group(explode), packed).groupBy("part", "n").applyInArrow(lean_group(count), counted)
    for _ in range(FULL_ORDERS + 1, order + 1):
        longer = by_block.cogroup(replies.groupBy("block")).applyInArrow(lean_cogroup(explode_longer), packed)
        replies = replies.unionByName(longer.groupBy("part", "n").applyInArrow(lean_group(count), counted))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(lean_cogroup(join), "doc_id long, n_words long, total_micro long, score double")
