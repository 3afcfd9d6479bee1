"""Links of articles to facilities and states, nesting, candidates and approvals."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import strip
from ..session import short_batches
from .cells import with_running
from .dedup import _lcs, _lcs_lengths

TOP = 3
#: Names of one task of the fuzzy match.
NAME_BLOCK = 2_000
#: Names of up to so many bytes are broadcast; more are shuffled to the articles.
BROADCAST_BYTES = 8 << 20


def linked(articles: DataFrame) -> DataFrame:
    """One row for each facility id of an article, repeated ids too, blank ones left out."""
    return articles.withColumn("dc_id", F.explode("dc_ids")).where(strip(F.col("dc_id")) != "")


def kind(articles: DataFrame) -> DataFrame:
    """``kind``: linked, state (no facility, but states) or neither."""
    return articles.withColumn("kind", F.when(F.size("dc_ids") > 0, "linked").when(F.size("states") > 0, "state").otherwise("neither"))


def state_linked(articles: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row for each known state of articles without a facility, with the state's centroid. The 51 centroids are broadcast."""
    rows = articles.where(F.size("dc_ids") == 0).withColumn("state", F.explode(F.transform("states", lambda s: F.upper(strip(s)))))
    return rows.join(F.broadcast(centroids), "state")


def newest_first(rows: DataFrame, group: str, n: int, date: str = "published", order: str = "row_idx") -> DataFrame:
    """The first n rows of each group by date, undated ones last, then by source order."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col(date).desc_nulls_last(), order))
    return rows.withColumn("place", place).where(F.col("place") <= n)


def nested(rows: DataFrame, group: str, n: int, item: Column, date: str = "published", order: str = "row_idx") -> DataFrame:
    """Of each group: how many rows, and the first n as an array of structs, newest first. Whole groups are never collected."""
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    top = newest_first(rows, group, n, date, order).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("place", item.alias("item")))).alias("items"))
    return counts.join(top, group).select(group, "n", F.transform("items", lambda x: x["item"]).alias("items"))


def facility_articles(facilities: DataFrame, links: DataFrame, n: int = 5) -> DataFrame:
    """Facilities with the number of their articles and the first n; facilities without one have 0."""
    nest = nested(links, "dc_id", n, F.struct("title", "published"))
    return facilities.join(nest, facilities["asset_id"] == nest["dc_id"], "left").drop("dc_id").withColumn("n", F.coalesce("n", F.lit(0)))


def story_facilities(stories: DataFrame, facilities: DataFrame) -> DataFrame:
    """Stories with the labels of their facilities in list order; an unknown id has no details. Of repeated asset ids the last by row_idx counts."""
    last = facilities.withColumn("n_", F.row_number().over(Window.partitionBy("asset_id").orderBy(F.col("row_idx").desc()))).where("n_ = 1").select("asset_id", "label")
    items = stories.select("id", F.posexplode("dc_ids").alias("pos", "asset_id")).join(last, "asset_id", "left")
    items = items.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("label", F.lit("Details unavailable")).alias("label")))).alias("x"))
    return stories.join(items.select("id", F.transform("x", lambda s: s["label"]).alias("facility_labels")), "id", "left")


def first_of_title(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, each title once: those of ``first`` before those of ``second``, in source order."""
    rows = first.withColumn("src_rank", F.lit(0)).unionByName(second.withColumn("src_rank", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("title").orderBy("src_rank", "row_idx"))
    return rows.withColumn("n_", place).where("n_ = 1").drop("n_")


def names(facilities: DataFrame) -> DataFrame:
    """dc_id, field, name: canonical names, aliases that differ, operators of more than three characters. Of one name the last record counts."""
    def field(name: str, condition: Column) -> DataFrame:
        return facilities.where(condition & (strip(F.coalesce(name, F.lit(""))) != "")).select("row_idx", F.col("asset_id").alias("dc_id"), F.lit(name).alias("field"), strip(F.col(name)).alias("name"))

    rows = field("canonical_name", F.lit(True)).unionByName(field("alias", ~F.col("alias").eqNullSafe(F.col("canonical_name")))).unionByName(field("operator", F.length(strip(F.col("operator"))) > 3))
    last = F.row_number().over(Window.partitionBy("name").orderBy(F.col("row_idx").desc(), "field"))
    return rows.withColumn("n_", last).where("n_ = 1").drop("n_", "row_idx")


def queued_ids(queue: DataFrame, overflow: DataFrame) -> DataFrame:
    """article_id of all that wait for review, each once."""
    ids = queue.select("article_id").unionByName(overflow.select("article_id"))
    return ids.where(strip(F.coalesce("article_id", F.lit(""))) != "").distinct()


def eligible(articles: DataFrame) -> DataFrame:
    """Articles without facility that mention one and are no duplicates."""
    return articles.where((F.size("dc_ids") == 0) & F.col("mentions") & ~F.coalesce(F.col("is_duplicate"), F.lit(False)))


def haystack(title: Column, summary: Column, text: Column) -> Column:
    return F.concat_ws(" ", title, summary, text)


def partial_ratio(needle: str, hay: str, least: float = 0.0) -> float:
    """Best ratio of the shorter string with a window of its length in the longer one; windows may hang over the ends.

    With ``least``, scores below it may come out as 0: a window that reaches it differs by few enough steps that
    one of that many and one more pieces of the needle stands in it unchanged, so only windows around pieces are compared.
    """
    if len(needle) > len(hay):
        needle, hay = hay, needle
    if not needle:
        return 0.0
    if needle in hay:
        return 100.0
    m, best = len(needle), 0.0
    steps = int(m * 2 * (1 - least / 100) + 1e-9)
    starts: set[int] = set()
    if least and steps + 1 <= m:
        cuts = [round(k * m / (steps + 1)) for k in range(steps + 2)]
        for a, b in zip(cuts, cuts[1:]):
            at = hay.find(needle[a:b])
            while at >= 0:
                starts.update(range(max(1 - m, at - a - steps), min(len(hay), at - a + steps + 1)))
                at = hay.find(needle[a:b], at + 1)
    else:
        starts = set(range(1 - m, len(hay)))
    letters = Counter(needle)
    for i in starts:
        window = hay[max(0, i) : i + m]
        most = sum(min(n, window.count(c)) for c, n in letters.items())
        if 200.0 * most / (m + len(window)) >= max(least, best):
            best = max(best, 200.0 * _lcs(needle, window) / (m + len(window)))
    return best if best >= least else 0.0


#: Characters of the texts that names are compared with at once.
HAY_CHARACTERS = 1 << 16
#: Number of a text, characters of it, and whether it begins and ends with them.
Piece = tuple[int, str, bool, bool]


def _partial_ratios(names: list[str], hays: list[str], least: float) -> Iterator[tuple[int, int, float]]:
    """Numbers of names and texts with a partial ratio of ``least`` (above 0) or more, and the ratio.

    Texts stand in one row with gaps, and from running counts of each character come those of all windows of a length. A window that shares too few of a name's characters
    is ruled out for all texts at once; of the others the common subsequences are found side by side. Long texts stand there in pieces, each with the windows that begin in it.
    """
    classes: dict[int, list[int]] = {}  # by length, as texts stand apart by the longest name
    for x, name in enumerate(names):
        classes.setdefault(len(name).bit_length(), []).append(x)
    for chosen in classes.values():
        longest = max(len(names[x]) for x in chosen)
        step = max(HAY_CHARACTERS, longest)
        cut: dict[tuple[int, int], float] = {}  # of texts in pieces
        for row in _rows_of_pieces(hays, step, longest):
            for x, k, score in _ratios_in_row(names, chosen, row, longest, step, least):
                if len(hays[k]) > step + longest:
                    cut[x, k] = max(score, cut.get((x, k), 0.0))
                else:
                    yield x, k, score
        yield from ((x, k, score) for (x, k), score in cut.items())


def _rows_of_pieces(hays: list[str], step: int, longest: int) -> Iterator[list[Piece]]:
    """Pieces of texts, a row of HAY_CHARACTERS together, or one larger piece. A piece but for the last reaches ``longest`` characters into the next one, so that no window is lost."""
    row: list[Piece] = []
    held = 0
    for k, hay in enumerate(hays):
        for begin in range(0, max(len(hay) - longest, 1), step):
            last = len(hay) <= begin + step + longest
            text = hay[begin : begin + step + longest]
            if held and held + len(text) + longest > HAY_CHARACTERS:
                yield row
                row, held = [], 0
            row.append((k, text, begin == 0, last))
            held += len(text) + longest
            if last:
                break
    yield row


def _ratios_in_row(names: list[str], chosen: list[int], row: list[Piece], longest: int, step: int, least: float) -> Iterator[tuple[int, int, float]]:
    sizes = np.array([len(text) for _, text, _, _ in row], dtype=np.int64)
    starts = longest + np.cumsum(sizes + longest) - sizes - longest
    total = int(longest + (sizes + longest).sum())
    points = np.full(total, 0xFFFFFFFF, dtype=np.uint32)  # no character
    for (_, text, _, _), at in zip(row, starts.tolist(), strict=True):
        points[at : at + len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    inner = np.array([not begins for _, _, begins, _ in row])
    own = np.where([ends for _, _, _, ends in row], sizes, step)  # windows that begin further are the next piece's
    kind = np.uint8 if longest < 250 else np.int32  # a window's counts are differences of running ones, which may run over

    def running(there: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, dtype=kind), np.cumsum(there, dtype=kind)])

    by_length: dict[int, list[int]] = {}
    for x in chosen:
        by_length.setdefault(len(names[x]), []).append(x)
    filled = running(points != 0xFFFFFFFF)
    sums = {c: running(points == ord(c)) for c in set().union(*(names[x] for x in chosen))}
    for m, group in by_length.items():
        if not m:
            continue
        size = filled[m:] - filled[:-m]
        need = np.array([m + 1] + [next((n for n in range(m + 1) if 200.0 * n / (m + s) >= least), m + 1) for s in range(1, m + 1)], dtype=kind)[size]
        windows = {c: sums[c][m:] - sums[c][:-m] for c in set().union(*(names[x] for x in group))}
        capped: dict[tuple[str, int], np.ndarray] = {}
        short = np.flatnonzero(sizes < m)
        for x in group:
            name = names[x]
            shared = np.zeros(total - m + 1, dtype=kind)
            for c, n in Counter(name).items():
                if (c, n) not in capped:
                    capped[c, n] = np.minimum(windows[c], np.full_like(shared, n))
                shared += capped[c, n]
            at = np.flatnonzero(shared >= need)
            of = np.searchsorted(starts - m, at, "right") - 1 if len(at) else at
            mine = (sizes[of] >= m) & (at - starts[of] >= np.where(inner[of], 0, -m)) & (at - starts[of] < own[of])
            at, of = at[mine], of[mine]
            texts = {name: 0}  # each window once, as many are alike
            which = np.empty(len(at), dtype=np.int64)
            for y, (i, k) in enumerate(zip(at.tolist(), of.tolist(), strict=True)):
                begin = i - int(starts[k])
                which[y] = texts.setdefault(row[k][1][max(0, begin) : begin + m], len(texts))
            best: dict[int, float] = {}
            if len(at):
                listed, lengths = list(texts), np.array([len(text) for text in texts])
                least_of = np.zeros(len(texts), dtype=np.int64)
                least_of[which] = need[at]
                others = np.flatnonzero(least_of)
                found = np.full(len(texts), m)  # the name's own
                others = others[others > 0]
                found[others] = _lcs_lengths(listed, np.zeros(len(others), dtype=np.int64), others, least_of[others])
                for k, score in zip(of.tolist(), (200.0 * found[which] / (m + lengths[which])).tolist(), strict=True):
                    best[k] = max(best.get(k, 0.0), score)
            for k in short.tolist():  # the text is the shorter one, and stands in windows of the name
                best[k] = partial_ratio(name, row[k][1], least)
            yield from ((x, row[k][0], score) for k, score in best.items() if score >= least and score > 0)


def _best_names(names: list, hays: list[str], threshold: float) -> list[tuple]:
    """Number of the text, dc_id, field, name and share of the TOP facilities of each text, best first, ties by dc_id."""
    best: dict[tuple, tuple] = {}
    for x, k, score in _partial_ratios([name for _, _, name in names], hays, threshold):
        dc_id = names[x][0]
        if (score, -x) > best.get((k, dc_id), (0.0, 0)):  # of equal ones the first
            best[k, dc_id] = (score, -x)
    by_text: dict[int, list] = {}
    for (k, dc_id), (score, x) in best.items():
        by_text.setdefault(k, []).append((-score, dc_id, names[-x]))
    return [(k, d, field, name, round(-score / 100, 3)) for k, found in by_text.items() for score, d, (_, field, name) in sorted(found)[:TOP]]


def candidates(articles: DataFrame, facility_names: DataFrame, threshold: float) -> DataFrame:
    """id, dc_id, field, name, confidence of the three best facilities of each article with a partial ratio of ``threshold`` or more.

    Every article is compared with every name. Names of up to BROADCAST_BYTES go to the articles' tasks as they are; more meet the articles in blocks of
    bounded size, by block and salt, so that articles are spread. Of each meeting only an article's best leave, so what comes out grows with
    articles and not with pairs.
    """
    spark = articles.sparkSession
    of_name = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("dc_id", "field", "name")), F.lit(0)).cast("long")
    size, held_bytes = facility_names.agg(F.count("*"), F.coalesce(F.sum(of_name), F.lit(0))).first()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "id long, dc_id string, field string, name string, confidence double"
    columns = schema.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    if held_bytes <= BROADCAST_BYTES:
        held = spark.sparkContext.broadcast([tuple(r) for r in facility_names.select("dc_id", "field", "name").collect()])

        def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                ids = b["id"].tolist()
                yield pd.DataFrame([(ids[k], *x) for k, *x in _best_names(held.value, b["hay"].tolist(), threshold)], columns=columns)

        found = short_batches(articles).select("id", "hay").repartition(width).mapInPandas(alone, schema)
    else:
        blocks = -(-size // NAME_BLOCK)

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for _, rows in b.groupby("block"):
                    ids, names = rows["id"].tolist(), [(n["dc_id"], n["field"], n["name"]) for n in rows["names"].iloc[0]]
                    yield pd.DataFrame([(ids[k], *x) for k, *x in _best_names(names, rows["hay"].tolist(), threshold)], columns=columns)

        def numbers(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        dealt = facility_names.groupBy(F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("dc_id", "field", "name")).alias("names"))
        rows = short_batches(articles).select("id", "hay", F.pmod(F.xxhash64("id"), F.lit(width)).cast("int").alias("salt")).withColumn("block", numbers(blocks))
        found = rows.join(dealt.withColumn("salt", numbers(width)), ["block", "salt"]).select("id", "hay", "names", "block").mapInPandas(meet, schema)
    best = F.row_number().over(Window.partitionBy("id", "dc_id").orderBy(F.col("confidence").desc(), "field"))
    found = found.withColumn("n_", best).where("n_ = 1").drop("n_")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.col("confidence").desc(), "dc_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= TOP).withColumn("match_method", F.concat(F.lit("fuzzy_"), "field"))


#: Characters of a name's beginning by which it meets articles.
HEAD = 6
#: Up to so many beginnings are looked for one by one, more by all pieces of a text.
FEW_HEADS = 300
#: Characters of the pieces that whole texts are cut into before copies of them meet names, at least.
PIECE = 1500


def _pieces(articles: DataFrame, longest: int) -> DataFrame:
    """id, piece and hay of pieces of each whole text; every stretch of up to ``longest`` characters stands in one of them."""
    step = max(PIECE, longest)
    starts = F.sequence(F.lit(0), F.length("hay"), F.lit(step))
    cut = F.transform(starts, lambda i: F.substring(F.col("hay"), i + 1, F.lit(step + longest)))
    return articles.where(F.col("hay").isNotNull()).select("id", F.posexplode(cut).alias("piece", "hay"))


def contained(articles: DataFrame, facility_names: DataFrame) -> DataFrame:
    """id, dc_id, field, name of names that stand literally in an article, anywhere in its text; an article's id is its own.

    A name is looked for only where its first characters (``HEAD``, or all of a shorter name) stand. Names of up to BROADCAST_BYTES go to the articles' tasks, and
    only what is found leaves them. More names meet the pieces of texts in which their first characters stand, so that no whole text is copied for each.
    """
    named = facility_names.where(F.length("name") > 0).withColumn("head_", F.substring("name", 1, HEAD))
    kind = dict(articles.dtypes)["id"]
    of_name = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("dc_id", "field", "name")), F.lit(0)).cast("long")
    size, longest = named.agg(F.coalesce(F.sum(of_name), F.lit(0)), F.coalesce(F.max(F.length("name")), F.lit(0))).first()
    if size <= BROADCAST_BYTES:
        rows: dict[str, list[tuple]] = {}  # by name
        for dc_id, field, name in named.select("dc_id", "field", "name").collect():
            rows.setdefault(name, []).append((dc_id, field, name))
        heads: dict[str, list[str]] = {}
        for name in rows:
            heads.setdefault(name[:HEAD], []).append(name)
        held = articles.sparkSession.sparkContext.broadcast((rows, heads))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, heads = held.value
            few, lengths = len(heads) <= FEW_HEADS, sorted({len(h) for h in heads})
            for b in batches:
                at, found = [], []
                for k, hay in enumerate(b.column(1)):
                    text = hay.as_py() or ""
                    here = [h for h in heads if h in text] if few else {text[i : i + n] for n in lengths for i in range(len(text) - n + 1)} & heads.keys()
                    new = [row for h in here for name in heads[h] if name in text for row in rows[name]]
                    at += [k] * len(new)
                    found += new
                columns = [pa.array([r[x] for r in found], pa.string()) for x in range(3)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], names=["id", "dc_id", "field", "name"])

        return short_batches(articles).select("id", "hay").mapInArrow(look, f"id {kind}, dc_id string, field string, name string")
    lengths = sorted(r[0] for r in named.select(F.length("head_")).distinct().collect())  # HEAD at most
    cut = _pieces(articles, longest)
    parts = [F.regexp_extract_all("hay", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]  # the characters of this length at every place
    places = cut.select("id", "piece", F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *parts))).alias("head_"))
    met = places.join(named, "head_").join(cut, ["id", "piece"])
    return met.where(F.col("hay").contains(F.col("name"))).select("id", "dc_id", "field", "name").distinct()


def review_queue(found: DataFrame, cap: int) -> DataFrame:
    """``queue`` or ``overflow`` by falling confidence; ties by id and facility.

    Places are counted from sums over ranges of distinct confidences, so only ties at the border are ordered.
    """
    counts = found.groupBy("confidence").agg(F.count("*").alias("n_"))
    running = with_running(counts, [], "confidence", "n_").withColumn("before_", F.col("total_") - F.col("below_") - F.col("n_"))
    at = found.join(running.select("confidence", "n_", "before_"), "confidence")
    place = F.when((F.col("before_") < cap) & (F.col("before_") + F.col("n_") > cap), F.row_number().over(Window.partitionBy("confidence").orderBy("id", "dc_id")) + F.col("before_"))
    return at.withColumn("destination", F.when(F.coalesce(place, F.col("before_") + 1) <= cap, "queue").otherwise("overflow")).drop("n_", "before_")


def apply_approvals(feed: DataFrame, approvals: DataFrame) -> DataFrame:
    """Feed with the last approved facility of each article where it has none; ``applied``: whether it was set now."""
    last = approvals.where(F.lower(strip(F.col("review_status"))) == "approved").groupBy("article_id").agg(F.max_by("dc_id", "row_idx").alias("new_"))
    blank = strip(F.coalesce("dc_id", F.lit(""))) == ""
    out = feed.join(last, "article_id", "left").withColumn("applied", blank & F.col("new_").isNotNull())
    return out.withColumn("dc_id", F.when(F.col("applied"), F.col("new_")).otherwise(F.col("dc_id"))).drop("new_")
