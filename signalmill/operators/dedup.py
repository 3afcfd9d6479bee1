"""Duplicates of articles: by url, by title, by vector, and the order-dependent combination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..dims import BLOCKED_URLS
from ..functions.text import dedup_title, title_fingerprint
from ..session import materialise, measured_joins, scratch
from .components import join_sized, smallest_labels

TITLE_RATIO = 88.0
COSINE = 0.85
#: Rows of one block of vectors or titles.
BLOCK_ROWS = 4096
#: Rows of a block of vectors whose products with the other block are held at once.
TILE_ROWS = 256
#: Vectors that are dealt to their meetings at once.
DEALT_ROWS = 512


def blocked(url: Column) -> Column:
    out = F.lit(False)
    for pattern in BLOCKED_URLS:
        out = out | url.contains(pattern)
    return out


def new_urls(batch: DataFrame, seen: DataFrame, staged: DataFrame, order: str = "arrival") -> DataFrame:
    """Rows of ``batch`` whose raw_url isn't empty, blocked, seen (url) or staged (raw_url), each url once, the first by arrival."""
    rows = batch.where((F.trim(F.coalesce("raw_url", F.lit(""))) != "") & ~blocked(F.col("raw_url")))
    rows = rows.join(seen.select(F.col("url").alias("raw_url")), "raw_url", "left_anti").join(staged.select("raw_url"), "raw_url", "left_anti")
    first = F.row_number().over(Window.partitionBy("raw_url").orderBy(order))
    return rows.withColumn("n_", first).where("n_ = 1").drop("n_")


def fingerprint_groups(rows: DataFrame, title: str = "title", key: str = "id") -> DataFrame:
    """fingerprint, first id and number of rows of each normalised title."""
    return rows.groupBy(title_fingerprint(F.col(title)).alias("fingerprint")).agg(F.min(key).alias("first_id"), F.count("*").alias("n"))


def sorted_tokens(title: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(title, " "), lambda w: w != "")), " ")


def _places(a: str | list[int]) -> dict:
    places: dict = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    return places


#: Characters after which the bound of a common subsequence is looked at again.
LCS_STEP = 24


def _lcs(a: str | list[int], b: str | list[int], least: int = 0, places: dict | None = None) -> int:
    """Length of the longest common subsequence, a bit for each character of ``a``; if it is below ``least`` it may come out lower."""
    places, full = places if places is not None else _places(a), (1 << len(a)) - 1
    row = full
    for at in range(0, len(b), LCS_STEP):
        for c in b[at : at + LCS_STEP]:
            hit = row & places.get(c, 0)
            row = ((row + hit) | (row - hit)) & full
        if len(a) - row.bit_count() + len(b) - at - LCS_STEP < least:
            break
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (length of both); 100 for two empty strings."""
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


#: Pairs of strings that are compared at once, in times words of 64 characters; and with all characters' places, at most.
LCS_WORDS, LCS_PLACES = 1 << 14, 1 << 20
#: Fewer pairs than this are followed one by one.
LCS_FEW = 24


def _encoded(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Characters of texts as numbers, and the code points that these stand for, ascending."""
    points = [np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32) for x in texts]
    letters = np.unique(np.concatenate([*(np.unique(np.concatenate(points[at : at + 64])) for at in range(0, len(points), 64)), np.zeros(0, np.uint32)]))
    return [np.searchsorted(letters, x).astype(np.int32) for x in points], letters


def _lcs_lengths(texts: list[str], a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """``_lcs`` of many pairs (numbers of ``texts``), side by side; one below its ``least`` may come out lower."""
    codes, letters = _encoded(texts)
    return _lcs_of_codes(codes, len(letters), a, b, least, texts)


def _lcs_of_codes(codes: list[np.ndarray], letters: int, a: np.ndarray, b: np.ndarray, least: np.ndarray, texts: list[str] | None = None) -> np.ndarray:
    """``_lcs_lengths`` of texts whose characters are numbers below ``letters``.

    A subsequence of the least length leaves out so few characters that no match lies further from the diagonal than those, so of each row only the words near it are looked at.
    """
    out = np.zeros(len(a), dtype=np.int64)
    size = np.array([len(x) for x in codes], dtype=np.int64)
    k, order = letters + 1, np.lexsort((size[b], size[a]))
    at = 0
    while at < len(order):
        # the longest of the next pairs are the last ones, so the number of words is looked up twice
        n = LCS_WORDS // (int(size[a[order[at]]]) // 64 + 1)
        words = int(size[a[order[min(len(order), at + max(n, 1)) - 1]]]) // 64 + 1
        n = max(1, min(n, LCS_WORDS // words, LCS_PLACES // (words * k)))
        took = order[at : at + n]
        at += n
        live = _followed_pairs(codes, size, a[took], b[took], least[took], words, k, out, took) if n > LCS_FEW else took
        for i in live.tolist():
            x, y = (texts[a[i]], texts[b[i]]) if texts is not None else (codes[a[i]].tolist(), codes[b[i]].tolist())
            out[i] = _lcs(x, y, int(least[i]))
    return out


#: Shares of all characters that the rarest, and the rare ones with them, make up: the classes of characters that pairs are sifted by.
CLASSES = (0.15, 0.4)
#: Pairs of fewer characters in all, or in the mean, are followed at once.
SIFTED_CHARACTERS, SIFTED_LENGTH = 1 << 14, 192
Sieve = list[tuple[list[np.ndarray], int, np.ndarray]]


def _sieve(codes: list[np.ndarray], letters: np.ndarray, counts: np.ndarray) -> Sieve:
    """Of each class of characters what texts have of it, its number of characters, and its columns of ``counts``."""
    total = counts.sum(axis=0, dtype=np.int64)
    order = np.argsort(total, kind="stable")
    of_slot = np.empty(LETTERS, dtype=np.int64)
    of_slot[order] = np.searchsorted(CLASSES, np.cumsum(total[order]) / max(1, total.sum()) - 1e-12)
    of_letter = of_slot[letters % LETTERS]
    out = []
    for c in range(len(CLASSES)):
        mine = of_letter == c
        number = np.cumsum(mine, dtype=np.int32) - 1
        out.append(([number[x[mine[x]]] for x in codes], int(mine.sum()), np.flatnonzero(of_slot == c)))
    return out


def _sifted(sieve: Sieve, counts: np.ndarray, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Numbers of the pairs whose common subsequence may have the least length.

    A common subsequence's characters of one class are a common subsequence of what both texts have of that class. So it is no longer than all classes' together, and of a
    class that isn't looked at yet no longer than the characters that are shared in any order. The rare characters say most in few steps.
    """
    bound = np.zeros(len(a), dtype=np.int64)
    for slot in counts.T:
        bound += np.minimum(slot[a], slot[b])
    live = np.arange(len(a))
    for codes, letters, slots in sieve:
        x, y = a[live], b[live]
        shared = np.zeros(len(live), dtype=np.int64)
        for slot in slots:
            shared += np.minimum(counts[x, slot], counts[y, slot])
        bound[live] += _lcs_of_codes(codes, letters, x, y, np.maximum(least[live] - bound[live] + shared, 0)) - shared
        live = live[bound[live] >= least[live]]
    return live


def _followed_pairs(codes: list[np.ndarray], size: np.ndarray, a: np.ndarray, b: np.ndarray, least: np.ndarray, words: int, k: int, out: np.ndarray, took: np.ndarray) -> np.ndarray:
    """Puts the lengths of pairs into ``out`` at ``took``; the numbers of the last few that are left, as soon as these are few."""
    own, of = np.unique(a, return_inverse=True)
    length = size[own]
    places = np.zeros((words, len(own) * k), dtype=np.uint64)  # by word, string and character
    place = _within(length)
    np.bitwise_or.at(places, (place >> 6, np.repeat(np.arange(len(own)) * k, length) + np.concatenate([codes[i] for i in own])), np.uint64(1) << (place & 63).astype(np.uint64))
    m, n = size[a], size[b]
    others, which = np.unique(b, return_inverse=True)
    wide = np.full((len(others), int(n.max())), k - 1, dtype=np.int32)
    for row, i in zip(wide, others.tolist(), strict=True):
        row[: size[i]] = codes[i]
    steps, base = np.ascontiguousarray(wide.T), of * k
    rows = np.full((words, len(a)), ~np.uint64(0))
    above, below = int((m - least).max()), int((n - least).max())
    for j in range(steps.shape[0]):
        low, high = max(0, j - below), min(words * 64 - 1, j + above)
        index = steps[j].take(which)
        index += base
        carry = None
        for w in range(low >> 6, (high >> 6) + 1):
            row = rows[w]
            hit = places[w].take(index)
            hit &= row
            if low > w * 64 or high < w * 64 + 63:
                hit &= np.uint64(((1 << (min(high - w * 64, 63) + 1)) - 1) & ~((1 << max(low - w * 64, 0)) - 1))
            total = row + hit
            over = total < hit
            if carry is not None:
                total += carry
                over |= total < carry
            row ^= hit
            row |= total
            carry = over.astype(np.uint64)
        if j % 16 == 15 or j + 1 == steps.shape[0]:
            found = 64 * words - np.bitwise_count(rows).sum(axis=0, dtype=np.int64)
            rest = np.maximum(n - j - 1, 0)
            done = (rest == 0) | (found + rest < least)
            if done.all() or done.sum() > len(done) // 4:
                out[took[done]] = found[done]
                go = ~done
                rows, base, which, n, m, least, took = rows[:, go], base[go], which[go], n[go], m[go], least[go], took[go]
                if len(took) <= LCS_FEW:
                    return took
                above, below = int((m - least).max()), int((n - least).max())
    out[took] = 64 * words - np.bitwise_count(rows).sum(axis=0, dtype=np.int64)
    return took[:0]


#: Width of the counts of characters that strings are first compared by.
LETTERS = 32
#: Characters of the strings of one block.
BLOCK_CHARACTERS = 4 << 20
#: Strings of the left side that are counted at once, and pairs that are looked at by their sequences at once.
COUNTED_ROWS, PAIR_ROWS = 16, 1 << 17


#: Tasks of the meetings of titles, in times the session's shuffle partitions, at most.
MEETING_TASKS = 16


def _letter_counts(keys: list[str]) -> np.ndarray:
    out = np.zeros((len(keys), LETTERS), dtype=np.int32)
    for row, key in zip(out, keys, strict=True):
        row[:] = np.bincount(np.frombuffer(key.encode("utf-32-le"), dtype=np.uint32) % LETTERS, minlength=LETTERS)
    return out


def _near_titles(left: list[str], right: list[str], same: bool, threshold: float, fresh: set[str] | None = None) -> list[tuple[str, str, float]]:
    """Pairs of different keys with a ratio of the threshold or more; with ``fresh``, those of which one is in it at least.

    A common subsequence of L characters takes L of each string's characters, so strings of m and n over the threshold t share t (m + n) / 2 characters
    or more, whatever their order. Only keys whose lengths allow it are compared by their characters, and of these only those
    that share enough by their sequence.
    """
    if fresh is not None:  # fresh ones with all, then the others with fresh ones
        new, old = [k for k in left if k in fresh], [k for k in left if k not in fresh]
        if same:
            return _near_titles(new, new, True, threshold) + _near_titles(new, old, False, threshold)
        return _near_titles(new, right, False, threshold) + _near_titles(old, [k for k in right if k in fresh], False, threshold)
    left, right = sorted(left, key=len), sorted(right, key=len)
    out: list[tuple[str, str, float]] = []
    if not left or not right:
        return out
    texts = left if same else left + right
    codes, letters = _encoded(texts)
    size, sieve, counts = np.array([len(x) for x in texts], dtype=np.int64), None, None
    for i, j, least in _sharing(left, right, same, threshold / 100):
        j = j if same else j + len(left)
        if size[i].sum() >= max(SIFTED_CHARACTERS, SIFTED_LENGTH * len(i)):
            if sieve is None:
                counts = _letter_counts(texts)
                sieve = _sieve(codes, letters, counts)
            live = _sifted(sieve, counts, i, j, least)
            i, j, least = i[live], j[live], least[live]
        found = _lcs_of_codes(codes, len(letters), i, j, least, texts)
        for x, y, n in zip(i.tolist(), j.tolist(), found.tolist(), strict=True):
            a, b = texts[x], texts[y]
            score = 200.0 * n / (len(a) + len(b))
            if score >= threshold and a != b:
                out.append((min(a, b), max(a, b), score))
    return out


def _sharing(left: list[str], right: list[str], same: bool, t: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of pairs that share enough characters, and the length that their subsequence needs, up to about PAIR_ROWS at once. Both sides are sorted by length."""
    m, n = (np.array([len(k) for k in keys], dtype=np.int64) for keys in (left, right))
    x, y = (_letter_counts(keys) for keys in (left, right))
    most, longest = max(int(x.max()), int(y.max())), int(max(m[-1], n[-1]))
    of_slot, kind = (np.uint8 if size < 1 << 8 else np.uint16 if size < 1 << 16 else np.int32 for size in (most, longest))
    x, y = (np.ascontiguousarray(c.astype(of_slot).T) for c in (x, y))
    held: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(left), COUNTED_ROWS):
        stop = min(start + COUNTED_ROWS, len(left))
        first, last = np.searchsorted(n, m[start] * t / (2 - t) - 1e-6), np.searchsorted(n, m[stop - 1] * (2 - t) / t + 1e-6, "right")
        first = max(first, start + 1) if same else first
        for at in range(int(first), int(last), BLOCK_ROWS):  # bounded, whatever the blocks hold
            end = min(at + BLOCK_ROWS, int(last))
            shared = np.zeros((stop - start, end - at), dtype=kind)
            both = np.empty(shared.shape, dtype=of_slot)
            for p, q in zip(x, y, strict=True):
                both[:] = p[start:stop, None]
                shared += np.minimum(both, q[at:end], out=both)
            need = np.ceil(t * (m[start:stop, None] + n[None, at:end]) / 2 - 1e-6)
            i, j = np.nonzero(shared >= need)
            least = need[i, j].astype(np.int64)
            i, j = i + start, j + at
            if same:
                keep = i < j
                i, j, least = i[keep], j[keep], least[keep]
            held.append((i, j, least))
            if sum(len(h[0]) for h in held) >= PAIR_ROWS:
                yield tuple(np.concatenate(h) for h in zip(*held, strict=True))
                held = []
    if held:
        yield tuple(np.concatenate(h) for h in zip(*held, strict=True))


def _length_blocks(counts: list[tuple[int, int]], t: float) -> list[tuple[int, int, int, int, int]]:
    """Of each length with its number of keys, ascending: length, first block, its blocks, and the first and last block that it meets.

    Short lengths share a block; one of many keys has several of its own. A block has BLOCK_ROWS keys or BLOCK_CHARACTERS characters on average.
    """
    spans: list[tuple[int, int]] = []  # lengths of a block, least and most
    at, fill = [], 0.0
    for length, n in counts:
        weight = n * max(1 / BLOCK_ROWS, length / BLOCK_CHARACTERS)
        if spans and fill + weight <= 1:
            spans[-1], fill = (spans[-1][0], length), fill + weight
            at.append((length, len(spans) - 1, 1))
        else:
            blocks = max(1, int(np.ceil(weight)))
            at.append((length, len(spans), blocks))
            spans += [(length, length)] * blocks
            fill = weight if blocks == 1 else 1.0
    low, high = np.array([a for a, _ in spans]), np.array([b for _, b in spans])
    last = np.searchsorted(low, high * (2 - t) / t + 1e-6, "right") - 1
    first = np.searchsorted(last, np.arange(len(spans)))
    return [(length, block, n, int(first[block]), int(last[block])) for length, block, n in at]


def title_pairs(titles: DataFrame, threshold: float = TITLE_RATIO) -> DataFrame:
    """a, b, score of all pairs a < b of different keys (strings of sorted tokens) with a ratio of ``threshold`` or more.

    Where ``titles`` have a column ``fresh``, pairs of keys without a fresh row aren't looked for.

    A ratio of the threshold's share t needs lengths within t / (2 - t) of each other. Keys are dealt into blocks of bounded size by length (and by
    hash where many have one length), and a block meets only those whose lengths it allows. Within a meeting lengths, then counts of
    characters, then sequences are compared; only pairs leave it. The table of lengths that the driver looks at has a row a different length.

    Blocks that meet grow with the square of the keys of like length: no signature that a ratio of 88 guarantees is longer than four characters, and
    titles share those in any case.
    """
    t = threshold / 100
    fresh = F.max("fresh") if "fresh" in titles.columns else F.lit(True)
    keys = titles.where("key <> ''").groupBy("key").agg(fresh.alias("fresh"))
    counts = [(r[0], r[1]) for r in keys.groupBy(F.length("key").alias("n")).agg(F.count("*")).orderBy("n").collect()]
    table = _length_blocks(counts, t)
    blocks = keys.sparkSession.createDataFrame(table, "size int, block int, blocks int, first int, last int")
    rows = keys.join(F.broadcast(blocks), F.length("key") == F.col("size")).withColumn("own", F.col("block") + F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    upper = rows.select("key", "fresh", F.explode(F.sequence("own", "last")).alias("j"), F.col("own").alias("i"), F.lit(0).alias("side"))
    earlier = F.explode(F.sequence(F.col("first"), F.col("own") - 1))
    lower = rows.where("first < own").select("key", "fresh", F.col("own").alias("j"), earlier.alias("i"), F.lit(1).alias("side"))

    def meet(key: tuple, found: pa.Table) -> pa.Table:
        names, side = found.column("key").to_pylist(), found.column("side").to_pylist()
        same = key[0].as_py() == key[1].as_py()
        left, right = ([n for n, s in zip(names, side, strict=True) if s == k] for k in (0, 1))
        new = found.filter(found.column("fresh")).column("key").to_pylist()
        pairs = _near_titles(left, left if same else right, same, threshold, None if len(new) == len(names) else set(new))
        a, b, score = ([p[k] for p in pairs] for k in range(3))
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "score": pa.array(score, pa.float64())})

    # meetings are small in bytes and dear in time, so they aren't left to a plan that goes by bytes
    width = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = sum((last - first + 1) * n for _, _, n, first, last in table)
    dealt = upper.unionByName(lower).repartition(max(width, min(met, MEETING_TASKS * width)), "i", "j")
    return dealt.groupBy("i", "j").applyInArrow(meet, "a string, b string, score double")


#: Pivots of the cosine join at most. They, and some numbers of each, are held by the driver and every task.
PIVOTS = 256
#: Radians that rounding may add to an angle.
SLACK = 1e-6


def _unit_rows(column: pa.Array) -> np.ndarray:
    """Unit vectors of a column of arrays of one length, without a Python object a component."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _within(counts: np.ndarray) -> np.ndarray:
    """0 up to each count, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _nonzero(vectors: DataFrame) -> DataFrame:
    fresh = F.col("fresh") if "fresh" in vectors.columns else F.lit(True)
    rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"), fresh.alias("fresh"))
    return rows.where(F.exists("v", lambda x: x != 0))


def cosine_meetings(vectors: DataFrame, threshold: float) -> DataFrame | None:
    """id, v, fresh, cell, i, j and side of each vector for each meeting that it takes part in; None without vectors.

    Vectors belong to the nearest of some pivots. By the triangle inequality on the sphere, a vector can only be near one of another pivot's if its angle to
    that pivot is no more than the threshold's angle and the largest angle of that pivot's own vectors together; then it visits the later of the two pivots. A pivot's
    own vectors and its visitors are dealt into blocks. Own blocks i and j meet (i <= j), and own blocks with visiting ones, whose numbers follow those of its own.
    """
    rows = _nonzero(vectors)
    most = min(PIVOTS, -(-rows.count() // (BLOCK_ROWS // 2)))
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(most).collect() if most else []
    if not drawn:
        return None
    pivots, near = _unit_rows(pa.array([r["v"] for r in drawn], pa.list_(pa.float64()))), float(np.arccos(min(1.0, threshold)))

    def placed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of vectors the angles to all pivots, and the nearest pivot's number, the first of equal ones."""
        angles = np.arccos(np.clip(_unit_rows(column) @ pivots.T, -1.0, 1.0)) if len(column) else np.zeros((0, len(pivots)))
        return angles, np.argmin(angles, axis=1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            angles, cell = placed(b.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(cell)), cell])], names=["cell", "angle"])

    radius, own, guests = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)
    for cell, angle, n in rows.mapInArrow(measure, "cell int, angle double").groupBy("cell").agg(F.max("angle"), F.count("*")).collect():
        radius[cell], own[cell] = angle, -(-n // BLOCK_ROWS)

    def visits(angles: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of rows, and of the pivots that they visit."""
        return np.nonzero((angles <= near + radius + SLACK) & (np.arange(len(pivots)) > cell[:, None]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, n = np.unique(visits(*placed(b.column(1)))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(n, pa.int64())], names=["cell", "n"])

    for cell, n in rows.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        guests[cell] = -(-n // BLOCK_ROWS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row may go to hundreds of meetings, so few rows are dealt at once and leave in pieces
        for b in (b.slice(at, DEALT_ROWS) for b in batches for at in range(0, b.num_rows, DEALT_ROWS)):
            angles, cell = placed(b.column(1))
            draw = b.column(3).to_numpy().astype(np.int64)
            mine, all_rows = draw % own[cell], np.arange(len(cell))
            row, other = visits(angles, cell)
            guest = draw[row] % guests[other]
            parts = []
            for k, c, times, i, j, side in (
                (all_rows, cell, own[cell] - mine, mine, None, 0), (all_rows, cell, mine, None, mine, 1),
                (all_rows, cell, guests[cell], mine, None, 0), (row, other, own[other], None, own[other] + guest, 1),
            ):
                step, first = _within(times), own[cell] if len(parts) == 2 else mine
                i_, j_ = (np.repeat(i, times) if i is not None else step), (np.repeat(j, times) if j is not None else np.repeat(first, times) + step)
                parts.append((np.repeat(k, times), np.repeat(c, times), i_, j_, np.full(len(step), side)))
            take, *numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
            for at in range(0, len(take), BLOCK_ROWS):
                rows_of = pa.array(take[at : at + BLOCK_ROWS])
                columns = [*(b.column(x).take(rows_of) for x in range(3)), *(pa.array(x[at : at + BLOCK_ROWS], pa.int32()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "fresh", "cell", "i", "j", "side"])

    return rows.withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1 << 30))).mapInArrow(deal, "id long, v array<double>, fresh boolean, cell int, i int, j int, side int")


def cosine_pairs(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """a, b, cosine of all pairs a < b (id, v) with a cosine of ``threshold`` (above 0) or more; a zero vector is like none.

    Where ``vectors`` have a column ``fresh``, pairs without a fresh one aren't looked for. Vectors in clusters meet few of the others; where
    there are no clusters, blocks of bounded size all meet each other once. Only pairs over the threshold leave a block.
    """
    if threshold <= 0:
        raise ValueError("a threshold above 0 is needed")
    schema = "a long, b long, cosine double"
    meetings = cosine_meetings(vectors, threshold)
    if meetings is None:
        return vectors.sparkSession.createDataFrame([], schema)

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("id").to_numpy(), b.column("side").to_numpy(), b.column("fresh").to_numpy(zero_copy_only=False), _unit_rows(b.column("v"))) for b in batches]
        ids, side, new, x = (np.concatenate(p) for p in zip(*parts, strict=True))
        del parts
        same = key[1].as_py() == key[2].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        for all_rows, others in ((left[new[left]], right), (left[~new[left]], right[new[right]])):  # fresh ones with all, the others with fresh ones
            y = x[others].T
            for at in range(0, len(all_rows), TILE_ROWS):  # pairs leave tile by tile, as there may be as many as cells
                rows = all_rows[at : at + TILE_ROWS]
                c = x[rows] @ y
                p, q = np.nonzero(c >= threshold)
                a, b = ids[rows[p]], ids[others[q]]
                if same:  # a block meets itself from both sides, so each pair comes twice, once in order
                    p, q, a, b = p[a < b], q[a < b], a[a < b], b[a < b]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(c[p, q])], names=["a", "b", "cosine"])

    return meetings.groupBy("cell", "i", "j").applyInArrow(meet, schema)


def backstop(rows: DataFrame, cached: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Later-stage check: an article (arrival, v) is a duplicate if any earlier one or any cached one is near; duplicates stay comparable."""
    both = rows.select(F.col("arrival").alias("id"), "v").unionByName(cached.select((-1 - F.col("arrival")).alias("id"), "v"))
    near = cosine_pairs(both, threshold).where("b >= 0")
    near = near.groupBy(F.col("b").alias("arrival")).agg(F.count("*").alias("n_near"))
    return rows.join(near, "arrival", "left").withColumn("is_duplicate", F.col("n_near").isNotNull()).drop("n_near")


#: Rounds before the components of what is left are looked at.
GREEDY_ROUNDS = 4
#: Articles and links of a component that one task may follow.
FOLLOWED = 1_000_000


def greedy(nodes: DataFrame, edges: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Sequential duplicate marking without a sequence.

    In arrival order, an article is a duplicate of the first kept article before it that an edge (a < b)
    joins it to; duplicates are compared with nothing. Articles with ``cached`` are kept from the start. Where ``nodes`` have a ``key``,
    articles of one key, or of two keys that ``near`` (a, b) pairs, are joined too; only the earliest articles of each key are looked at, so their
    pairs are never formed. An empty key is like none. Returns arrival, is_duplicate, duplicate_of.

    The kept ones are the first independent set in arrival order. In each round an article with a kept earlier neighbour is a duplicate, and one without
    an earlier undecided neighbour is kept. One with a single earlier undecided neighbour is kept if that one isn't: such articles form trees, in which by pointer
    jumping each finds its root and whether it is an even number of steps away, so a chain of any length is decided with its first article, in rounds of
    the logarithm of its length. After GREEDY_ROUNDS, components of up to FOLLOWED articles and links are followed in arrival order, each as a stream of
    sorted rows; larger ones go on in rounds, so no task's work grows with the largest component.
    """
    with scratch(nodes.sparkSession) as keep_table, measured_joins(nodes.sparkSession):
        keyed = nodes.select("arrival", "key") if "key" in nodes.columns else nodes.select("arrival", F.lit(None).cast("string").alias("key"))
        return keep_table(_marks(nodes, edges, keyed, near), "greedy-marks")


def _marks(nodes: DataFrame, edges: DataFrame, keyed: DataFrame, near: DataFrame | None) -> DataFrame:
    """``keyed`` has a row for each key of an article."""
    nodes = materialise(nodes.select(F.col("arrival").cast("long").alias("arrival"), "cached"), "greedy-nodes")
    keyed = materialise(keyed.where("key <> ''").select(F.col("arrival").cast("long").alias("arrival"), "key"), "greedy-keyed")
    edges = materialise(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a < b").distinct(), "greedy-edges")
    meets = keyed.select("key", F.col("key").alias("other")).distinct()
    if near is not None:
        ways = F.array(F.struct(F.col("a").alias("key"), F.col("b").alias("other")), F.struct(F.col("b").alias("key"), F.col("a").alias("other")))
        meets = meets.unionByName(near.select(F.inline(ways)))
    meets = materialise(meets, "greedy-meets")

    def of(rows: DataFrame) -> DataFrame:
        return keyed.join(rows.select("arrival"), "arrival")

    def joined(rows: DataFrame, others: DataFrame) -> DataFrame:
        """arrival of rows, and first: each of the others that an edge joins to it from before."""
        found = edges.join(rows.select(F.col("arrival").alias("b")), "b").join(others.select(F.col("arrival").alias("a")), "a")
        return found.select(F.col("b").alias("arrival"), F.col("a").alias("first"))

    def before(rows: DataFrame, others: DataFrame) -> DataFrame:
        """arrival, first, last: of rows that have neighbours before them among the others the earliest, and the last of those that edges, and keys by their first two, show."""
        by_edge = joined(rows, others).withColumn("last", F.col("first"))
        first = of(others).groupBy(F.col("key").alias("other")).agg(F.min("arrival").alias("first"))
        second = of(others).withColumnRenamed("key", "other").join(first, "other").where("arrival > first").groupBy("other").agg(F.min("arrival").alias("second"))
        of_key = meets.join(first, "other").join(second, "other", "left").select("key", "first", "second")
        last = F.when(F.col("second") < F.col("arrival"), F.col("second")).otherwise(F.col("first"))
        by_key = of(rows).join(of_key, "key").where("first < arrival").select("arrival", "first", last.alias("last"))
        return by_edge.unionByName(by_key).groupBy("arrival").agg(F.min("first").alias("first"), F.max("last").alias("last"))

    def earliest(rows: DataFrame, others: DataFrame) -> DataFrame:
        by_edge = joined(rows, others)
        first = of(others).groupBy(F.col("key").alias("other")).agg(F.min("arrival").alias("first"))
        of_key = meets.join(first, "other").groupBy("key").agg(F.min("first").alias("first"))
        by_key = of(rows).join(of_key, "key").where("first < arrival").select("arrival", "first")
        return by_edge.unionByName(by_key).groupBy("arrival").agg(F.min("first").alias("first"))

    fresh = nodes.where("not cached").select("arrival")
    open_ = materialise(fresh.join(earliest(fresh, nodes), "arrival", "left_semi"), "greedy-open")
    kept = materialise(nodes.select("arrival").join(open_, "arrival", "left_anti"), "greedy-kept")
    gone = open_.limit(0)
    done = 0
    while not open_.isEmpty():
        dup = materialise(open_.join(earliest(open_, kept), "arrival", "left_semi"), "greedy-dup")
        open_ = materialise(open_.join(dup, "arrival", "left_anti"), "greedy-open")
        waits = materialise(before(open_, open_), "greedy-waits")
        keep = open_.join(waits, "arrival", "left_anti")
        told = _told(waits.where("first = last").select("arrival", F.col("first").alias("root")), keep)
        keep = materialise(keep.unionByName(told.where("keeps").select("arrival")), "greedy-keep")
        dup_too = materialise(told.where("not keeps").select("arrival"), "greedy-dup")
        gone, kept = gone.unionByName(dup).unionByName(dup_too), kept.unionByName(keep)
        open_ = materialise(open_.join(keep, "arrival", "left_anti").join(dup_too, "arrival", "left_anti"), "greedy-open")
        done += 1
        if done >= GREEDY_ROUNDS and not open_.isEmpty():
            dup = materialise(open_.join(earliest(open_, kept), "arrival", "left_semi"), "greedy-dup")
            open_ = materialise(open_.join(dup, "arrival", "left_anti"), "greedy-open")
            small, keep = _followed(open_, edges, materialise(of(open_), "greedy-open-keys"), meets)
            small, keep = materialise(small, "greedy-small"), materialise(keep, "greedy-keep")
            gone, kept = gone.unionByName(dup).unionByName(small.join(keep, "arrival", "left_anti")), kept.unionByName(keep)
            open_ = materialise(open_.join(small, "arrival", "left_anti"), "greedy-open")
    out = nodes.select("arrival").join(earliest(gone, kept), "arrival", "left")
    return out.select("arrival", F.col("first").isNotNull().alias("is_duplicate"), F.col("first").alias("duplicate_of"))


def _told(single: DataFrame, keep: DataFrame) -> DataFrame:
    """arrival, keeps: of articles with a single undecided neighbour (``root``) before them, those whose tree's root is kept."""
    way = materialise(single.withColumn("odd", F.lit(True)), "greedy-way")
    while True:
        up = way.select(F.col("arrival").alias("root"), F.col("root").alias("above"), F.col("odd").alias("odd_above"))
        further = way.join(up, "root", "left")
        if further.where("above is not null").isEmpty():
            break
        odd = F.when(F.col("above").isNull(), F.col("odd")).otherwise(F.col("odd") != F.col("odd_above"))
        way = materialise(further.select("arrival", F.coalesce("above", "root").alias("root"), odd.alias("odd")), "greedy-way")
    return way.join(keep.select(F.col("arrival").alias("root")), "root").select("arrival", (~F.col("odd")).alias("keeps"))


def _followed(open_: DataFrame, edges: DataFrame, keyed: DataFrame, meets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The open articles (without kept neighbours) of components that aren't too large, and those of them that are kept, decided in arrival order.

    A component's rows pass as a sorted stream: its pairs of keys, then by arrival each article's earlier neighbours, its keys, and the article itself. The
    stream remembers the arrivals and keys that are kept, and the pairs of keys.
    """
    first = materialise(keyed.groupBy("key").agg(F.min("arrival").alias("first"), F.count("*").alias("n")), "greedy-first")
    inner = edges.join(open_.select(F.col("arrival").alias("a")), "a", "left_semi").join(open_.select(F.col("arrival").alias("b")), "b", "left_semi")
    inner = materialise(inner.select("a", "b"), "greedy-inner")
    paired = meets.join(first.select("key", "first"), "key").join(first.select(F.col("key").alias("other"), F.col("first").alias("other_first")), "other")
    paired = materialise(paired.where("key <> other").select("key", "other", "first", "other_first"), "greedy-paired")
    of_key = join_sized(keyed, first, "key", "n").select(F.col("first").alias("a"), F.col("arrival").alias("b"))
    labels = smallest_labels(inner.unionByName(of_key).unionByName(paired.select(F.col("first").alias("a"), F.col("other_first").alias("b"))))
    # an open article without neighbours among the open ones is its own component
    nodes = open_.join(labels.withColumnRenamed("node", "arrival"), "arrival", "left").withColumn("label", F.coalesce("label", "arrival"))
    nothing, no_key = F.lit(None).cast("long"), F.lit(None).cast("string")
    by_arrival = nodes.select("label", "arrival")
    rows = nodes.select("label", F.lit(3).alias("phase"), "arrival", nothing.alias("a"), no_key.alias("key"), no_key.alias("other"))
    links = inner.withColumnRenamed("b", "arrival").join(by_arrival, "arrival").select("label", F.lit(1).alias("phase"), "arrival", "a", no_key.alias("key"), no_key.alias("other"))
    keys = keyed.join(by_arrival, "arrival").select("label", F.lit(2).alias("phase"), "arrival", nothing.alias("a"), "key", no_key.alias("other"))
    pairs = paired.withColumnRenamed("first", "arrival").join(by_arrival, "arrival").select("label", F.lit(0).alias("phase"), nothing.alias("arrival"), nothing.alias("a"), "key", "other")
    rows = materialise(rows.unionByName(links).unionByName(keys).unionByName(pairs), "greedy-rows")
    small = materialise(rows.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") <= FOLLOWED), "greedy-small")
    width = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = rows.join(small.select("label"), "label", "left_semi").repartition(width, "label")
    stream = stream.sortWithinPartitions("label", F.col("arrival").asc_nulls_first(), "phase", F.col("a").asc_nulls_last(), "key")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, keys, meeting, near, mine = None, set(), set(), {}, False, []
        for b in batches:
            out = []
            for label, phase, arrival, a, key, other in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if label != now:
                    now, kept, keys, meeting, near, mine = label, set(), set(), {}, False, []
                if phase == 0:
                    meeting.setdefault(key, []).append(other)
                elif phase == 1:
                    near = near or a in kept
                elif phase == 2:
                    mine.append(key)
                    near = near or key in keys or any(k in keys for k in meeting.get(key, ()))
                else:
                    if not near:
                        kept.add(arrival)
                        keys.update(mine)
                        out.append(arrival)
                    near, mine = False, []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["arrival"])

    return nodes.join(small.select("label"), "label", "left_semi").select("arrival"), stream.mapInArrow(follow, "arrival long")


def stacked(articles: DataFrame, ratio_threshold: float = TITLE_RATIO, cosine_threshold: float = COSINE) -> DataFrame:
    """Title and vector layers together (arrival, title, v, cached): near titles and near vectors as keys that meet, then as ``greedy``.

    Titles of the same sorted words are one key, and equal vectors one key, so pairs within such groups are never formed. Cached articles
    are kept in any case, so they aren't compared with each other.
    """
    with scratch(articles.sparkSession) as keep_table, measured_joins(articles.sparkSession):
        key = sorted_tokens(dedup_title(F.col("title")))
        rows = articles.select("arrival", "cached", key.alias("key"), F.col("v").cast("array<double>").alias("v"))
        rows = materialise(rows, "stacked-rows")
        vectors = rows.where(F.exists("v", lambda x: x != 0))
        of_vector = vectors.groupBy("v").agg(F.min("arrival").alias("id"), F.count("*").alias("n"), F.max(~F.col("cached")).alias("fresh"))
        of_vector = materialise(of_vector.withColumn("digest", F.xxhash64("v")), "stacked-vectors")
        slim = materialise(vectors.select("arrival", "v", F.xxhash64("v").alias("digest")), "stacked-slim")
        same = join_sized(slim, of_vector.withColumnRenamed("v", "w"), "digest", "n").where("v = w").select("arrival", F.concat(F.lit("v"), "id").alias("key"))
        titled = rows.where("key <> ''").select("arrival", F.concat(F.lit("t"), "key").alias("key"))
        near = cosine_pairs(of_vector.select("id", "v", "fresh"), cosine_threshold).select(F.concat(F.lit("v"), "a").alias("a"), F.concat(F.lit("v"), "b").alias("b"))
        alike = title_pairs(rows.select("key", (~F.col("cached")).alias("fresh")), ratio_threshold)
        alike = alike.select(F.concat(F.lit("t"), "a").alias("a"), F.concat(F.lit("t"), "b").alias("b"))
        none = rows.sparkSession.createDataFrame([], "a long, b long")
        return keep_table(_marks(rows.select("arrival", "cached"), none, titled.unionByName(same), near.unionByName(alike)), "stacked-marks")


def backfill(cache: DataFrame, staged: DataFrame, cutoff: Column) -> DataFrame:
    """Cache entries from staged rows with id and title that were published from ``cutoff`` on and aren't in the cache."""
    rows = staged.where((F.trim(F.coalesce("article_id", F.lit(""))) != "") & (F.trim(F.coalesce("title", F.lit(""))) != "") & (F.col("published") >= cutoff))
    rows = rows.join(cache.select("article_id"), "article_id", "left_anti")
    return cache.unionByName(rows.select("article_id", "published", "title", title_fingerprint(F.col("title")).alias("title_fp")))


def hashed_vectors(spark: SparkSession, rows: DataFrame, text: str, size: int = 384) -> DataFrame:
    """Stand-in for a sentence model: unit vectors of hashed term counts in column ``v``."""
    words = F.filter(F.split(F.lower(F.col(text)), r"\W+"), lambda w: w != "")

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for slots in b["slots_"]:
                v = np.bincount(np.asarray(slots, dtype=np.int64), minlength=size).astype(np.float64)
                out.append((v / max(1e-12, float(np.linalg.norm(v)))).tolist())
            yield b.drop(columns="slots_").assign(v=out)

    slots = rows.withColumn("slots_", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(size)).cast("int")))
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return slots.mapInPandas(embed, f"{fields}, v array<double>")
