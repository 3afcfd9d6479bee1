"""Mixing sources to target weights: hierarchical budgets and seeded token-prefixes, in DataFrame operations only.

Documents hang in a tree of domain, language and source. A token budget flows down from the
root. At each node the children share its budget in proportion to their weights; a child that
cannot use its share (its documents, each ``max_epochs`` times, have fewer tokens) is full, and
what it lacks goes to its siblings in proportion. As a node never receives more than its whole
subtree can use, a shortage passes to the ancestors' level only when all siblings are full.

For children with capacities c and weights w, ordered by c / w, let level_i be (budget - sum of c
before i) / (sum of w from i on). It rises over the full children and falls after them, so the
common level is its maximum and a child's share is min(c, w * level). That is two window sums.

A leaf with quota q takes all its documents floor(q / tokens) times, and of the next epoch the
longest prefix, in the order of md5(seed:epoch:doc_id), that fits in the rest. The cut is
found from token sums over 256 ranges of that hash, then over 256 ranges of the one in which the rest runs out; only
what is left of that is sorted, so a leaf that holds a third of all rows is never in one task. The cut is one hash a leaf,
and selection is a filter on it: texts are not shuffled.

Null languages and sources form the node ``unknown``; nodes without a given weight have
``default_weight``. Null and empty texts have no tokens and come with the prefix they fall in, a
leaf without tokens is not taken; rows that repeat a ``doc_id`` in a leaf, or have none, tie in the order and are taken or left together. An empty
table gives no rows. Very long texts are counted whole where they are. Extra columns take no part and keep their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

WORD = r"[^\x20\x09-\x0D]+"
LEAF = ["domain", "language", "origin"]
#: Digits of the order key by which each of the levels cuts.
RANGE_DIGITS, RANGE_LEVELS = 2, 2


@dataclass(frozen=True)
class Mix:
    """Weights are integers, so that their sums are exact in any order."""

    share: float = 0.6  #: budget as a part of all tokens
    max_epochs: int = 2
    seed: int = 17
    domains: dict[str, int] = field(default_factory=dict)
    languages: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    default_weight: int = 5


def _weight(name: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for key, value in weights.items():
        out = F.when(name == key, F.lit(value)).otherwise(out)
    return out


def _share(rows: DataFrame, parent: list[str], node: str, budget: Column) -> DataFrame:
    """Column ``share`` of each row of ``rows`` (with capacity and weight), whose parent has ``budget``."""
    by = F.col("capacity") / F.col("weight")
    ordered = Window.partitionBy(*parent).orderBy(by, F.col(node))
    before = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = rows.withColumn("level_", (budget - before) / weights)
    top = F.max("level_").over(Window.partitionBy(*parent))
    return level.withColumn("share", F.least(F.col("capacity").cast("double"), F.col("weight") * top)).drop("level_")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """quota of each leaf (domain, language, origin, tokens)."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * mix.max_epochs)
    domains = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    budget = F.floor(F.sum("tokens").over(Window.partitionBy()) * F.lit(mix.share)).cast("double")
    domains = domains.withColumn("budget", budget).withColumn("weight", _weight(F.col("domain"), mix.domains, mix.default_weight))
    domains = _share(domains, [], "domain", F.col("budget")).select("domain", F.col("share").alias("domain_share"))
    languages = leaves.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(F.col("language"), mix.languages, mix.default_weight))
    languages = _share(languages.join(domains, "domain"), ["domain"], "language", F.col("domain_share")).select("domain", "language", F.col("share").alias("language_share"))
    leaves = leaves.withColumn("weight", _weight(F.col("origin"), mix.sources, mix.default_weight)).join(languages, ["domain", "language"])
    leaves = _share(leaves, ["domain", "language"], "origin", F.col("language_share"))
    return leaves.select(*LEAF, "tokens", F.floor(F.round("share", 6)).cast("long").alias("quota"))


def leaf_columns(docs: DataFrame, domain: Column) -> DataFrame:
    """``row`` (all columns of ``docs``, so no name can clash), doc_id, the leaf's columns and ``tokens_``, the words of the whole text."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id"),
        F.coalesce(domain, F.lit("unknown")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("origin"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens_"),
    )


def order_key(mix: Mix) -> Column:
    return F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("epochs"), F.col("doc_id")))


def cuts(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """Of each leaf: tokens, quota, whole epochs and the greatest order key taken in the next one."""
    slim = materialise(leaf_columns(docs.select("doc_id", "text", "lang", "source"), domain).select("doc_id", *LEAF, "tokens_"), "mix-slim")
    leaves = slim.groupBy(*LEAF).agg(F.sum("tokens_").alias("tokens"))
    plan = budgets(leaves, mix).withColumn("epochs", F.coalesce(F.try_divide("quota", "tokens").cast("long"), F.lit(0)))
    plan = materialise(plan.withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")), "mix-plan")

    keyed = slim.join(plan.where("tokens > 0"), LEAF).withColumn("key", order_key(mix)).select(*LEAF, "key", "tokens_", "rest")
    inside = keyed.withColumn("base", F.lit(0))
    for level in range(1, RANGE_LEVELS + 1):
        sums = inside.groupBy(*LEAF, F.substring("key", 1, level * RANGE_DIGITS).alias("range")).agg(F.sum("tokens_").alias("in_range"), F.first("rest").alias("rest"), F.first("base").alias("base"))
        upto = F.col("base") + F.sum("in_range").over(Window.partitionBy(*LEAF).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        crossing = sums.withColumn("upto", upto).where("upto > rest")
        crossing = crossing.groupBy(*LEAF).agg(F.min_by(F.struct("range", (F.col("upto") - F.col("in_range")).alias("base")), "range").alias("x")).select(*LEAF, "x.range", "x.base")
        crossing = materialise(crossing, f"mix-crossing-{level}")
        inside = keyed.join(crossing, LEAF).where(F.col("key").startswith(F.col("range")))
    inside = inside.groupBy(*LEAF, "key").agg(F.sum("tokens_").alias("tokens_"), F.first("rest").alias("rest"), F.first("base").alias("base"))  # rows of one key count together
    running = F.col("base") + F.sum("tokens_").over(Window.partitionBy(*LEAF).orderBy("key"))
    last = inside.withColumn("running", running).where("running <= rest").groupBy(*LEAF).agg(F.max("key").alias("last_key"))
    # without a document of the crossing range, the range's own name lies between the ranges before and its keys
    cut = crossing.join(last, LEAF, "left").select(*LEAF, F.coalesce("last_key", "range").alias("cut"))
    return plan.join(cut, LEAF, "left").select(*LEAF, "tokens", "quota", "epochs", "cut")


def select_mix(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """``row``, the rows of ``docs`` that are taken, with the leaf's columns, tokens_ and ``copies``, how often each is taken."""
    chosen = materialise(cuts(docs, domain, mix), "mix-cuts")
    rows = leaf_columns(docs, domain).join(chosen.where("tokens > 0"), LEAF)
    taken = F.col("epochs") + F.coalesce((order_key(mix) <= F.col("cut")).cast("long"), F.lit(0))
    return rows.withColumn("copies", taken).where("copies > 0").select("row", *LEAF, "tokens_", "copies")


def taken_rows(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """The rows of ``docs`` that are taken, each as often as it is taken, with their own columns."""
    return select_mix(docs, domain, mix).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
