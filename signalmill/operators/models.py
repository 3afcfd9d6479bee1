"""Summaries and classifications by a model that the caller brings, inside ``mapInPandas``.

The client is made once a task by ``factory`` and called with a row's prompt. A failed call is tried again after a
wait that doubles; a client that says its quota is used up is replaced by the ``fallback``'s. After ``BREAKER`` failures in a row
no more calls are made, and what is left is marked as pending, so that a later run takes it up. ``ask`` holds to that task by task. ``ask_once`` holds to it
for a whole run: it asks in waves, the first in one task, and what a wave has shown decides for all that follow. Without a client the rules in ``functions.rules`` do the same work.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, unfenced
from ..session import materialise

PROMPT_CHARACTERS, FEED_CHARACTERS, BODY_CHARACTERS = 3000, 2000, 8000
TRIES, BREAKER = 3, 5
ANSWER = "primary_category string, secondary_categories array<string>, states array<string>, strategy_alignment_score int, relevance_score int, mentions_specific_dc boolean, confidence double"

Client = Callable[[str], str]


class QuotaExceeded(Exception):
    """Raised by a client that will answer no more."""


def prompt(title: Column, text: Column, description: Column) -> Column:
    """Title and the first 3,000 characters of the text, or of the description where there is no text."""
    body = F.when(F.trim(F.coalesce(text, F.lit(""))) != "", text).otherwise(F.coalesce(description, F.lit("")))
    return F.concat_ws("\n\n", title, F.substring(body, 1, PROMPT_CHARACTERS))


def ask(rows: DataFrame, factory: Callable[[], Client], question: str = "prompt", key: str = "article_id", fallback: Callable[[], Client] | None = None, wait: float = 1.0) -> DataFrame:
    """key, answer and status (success, failed or pending) of each row. ``wait``: seconds before the second try."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, other, in_a_row = factory(), fallback, 0
        for b in batches:
            out = []
            for k, q in zip(b["key"], b["question"], strict=True):
                answer, status = None, "pending"
                tries = 0
                while tries < TRIES and in_a_row < BREAKER:
                    try:
                        answer, status = client(q), "success"
                        break
                    except QuotaExceeded:
                        status, tries = "failed", TRIES if other is None else tries
                        if other is not None:
                            client, other = other(), None
                    except Exception:  # any failure of a client counts as one
                        status, tries = "failed", tries + 1
                        if tries < TRIES:
                            time.sleep(wait * 2 ** (tries - 1))
                if status != "pending":
                    in_a_row = 0 if status == "success" else in_a_row + 1
                out.append((k, answer, status))
            yield pd.DataFrame(out, columns=["key", "answer", "status"])

    slim = rows.select(F.col(key).cast("string").alias("key"), F.col(question).alias("question"))
    return slim.mapInPandas(run, "key string, answer string, status string").withColumnRenamed("key", key)


#: Prompts of the first wave, on average, and how many times more each wave has than all before it.
FIRST_WAVE, GROWTH = 8, 3
_ASKED = "key string, answer string, status string"


def _wave(factory: Callable[[], Client], wait: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task of a wave: as in ``ask``, but a used-up quota ends it, and what it didn't come to is ``open``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, in_a_row, spent = factory(), 0, False
        for b in batches:
            out = []
            for k, q in zip(b["key"], b["question"], strict=True):
                answer, status, tries = None, "open", 0
                while tries < TRIES and in_a_row < BREAKER and not spent:
                    try:
                        answer, status = client(q), "success"
                        break
                    except QuotaExceeded:
                        status, spent = "spent", True
                    except Exception:  # any failure of a client counts as one
                        status, tries = "failed", tries + 1
                        if tries < TRIES:
                            time.sleep(wait * 2 ** (tries - 1))
                in_a_row = 0 if status == "success" else in_a_row + (status == "failed")
                out.append((k, answer, status))
            yield pd.DataFrame(out, columns=["key", "answer", "status"])

    return run


def ask_once(rows: DataFrame, factory: Callable[[], Client], question: str = "prompt", key: str = "article_id", fallback: Callable[[], Client] | None = None, wait: float = 1.0) -> DataFrame:
    """As ``ask``, with one fallback and one breaker for the run. Keys are unique; rows without one are asked in the first wave.

    Prompts are dealt into waves by hash: FIRST_WAVE of them in one task, then GROWTH times as many as before in as many more tasks, so the number of waves
    is the logarithm of that of prompts. Answers are written wave by wave, so none is asked for twice. If a wave's quota was used up, all that is open goes on with the
    fallback. A wave of BREAKER failures and no success ends the run: until then a client that always fails was called by the first wave's one task only.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.when(F.col(key).isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(_PLACES)))
    slim = materialise(rows.select(F.col(key).cast("string").alias("key"), F.col(question).alias("question"), place.alias("place")), "asked-rows")
    n = slim.count()
    borders, size = [0], FIRST_WAVE
    while borders[-1] < _PLACES:
        borders.append(min(_PLACES, -(-_PLACES * size // max(1, n))))
        size *= 1 + GROWTH
    done: list[DataFrame] = []
    left, others, stopped = slim.limit(0), [fallback] if fallback else [], False
    client, wave = factory, 0
    while wave < len(borders) - 1 or not left.isEmpty():
        now = left
        if wave < len(borders) - 1:
            now = now.unionByName(slim.where((F.col("place") >= borders[wave]) & (F.col("place") < borders[wave + 1])))
        if stopped:
            done.append(now.select("key", F.lit(None).cast("string").alias("answer"), F.lit("pending").alias("status")))
            left = slim.limit(0)
        else:
            tasks = min(width, (1 + GROWTH) ** wave)
            asked = materialise(now.select("key", "question").repartition(tasks).mapInPandas(_wave(client, wait), _ASKED), "asked")
            count = dict(asked.groupBy("status").count().collect())
            opened = asked.where("status in ('open', 'spent')")
            if count.get("spent") and not others:  # nobody is left to ask
                stopped, opened = True, asked.where("status = 'open'")
                asked = asked.withColumn("status", F.when(F.col("status") == "spent", "failed").otherwise(F.col("status")))
            elif count.get("spent"):
                client = others.pop()
            elif count.get("failed", 0) >= BREAKER and not count.get("success"):
                stopped = True
            done.append(asked.where("status in ('success', 'failed')"))
            left = now.join(opened.select(F.col("key").alias("key_")), F.col("key").eqNullSafe(F.col("key_")), "left_semi")
            left = materialise(left, "asked-left")
        wave += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("key", key)


#: Places of hashes that waves are cut from.
_PLACES = 1 << 40


def decoded(answer: Column) -> Column:
    """The fields of a model's JSON answer, with or without Markdown fences; null if it is none."""
    return F.from_json(unfenced(answer), ANSWER)


def complete(answer: Column) -> Column:
    """Whether an answer has every field of the contract."""
    fields = [x.split()[0] for x in ANSWER.split(", ")]
    return bound(decoded(answer), lambda d: d.isNotNull() & F.forall(F.array(*(d[f].isNotNull() for f in fields)), lambda x: x))
