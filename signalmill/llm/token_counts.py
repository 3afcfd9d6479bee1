"""Token counts of sections by attribution of whole-document tokens.

A document is encoded once, whole, by a byte-level vocabulary. The lengths of its tokens give
every token's span, and the spans are joined to the sections' intervals by binary search of sorted
borders. A token that lies in several sections is allocated by an explicit rule:

* ``majority``: to the section that holds most of its bytes, the earliest of those with most;
* ``first``: to the section that holds its first byte.

Sections are given in code points, ascending, and cover the text; so the counts of a
document's sections add up to its tokens. Null and empty texts have every section with no tokens.
Each row gives its own rows, repeated ones too, and an empty table none. A text of any length is encoded whole. Extra columns take no part.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which this vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[int, tuple[tiktoken.Encoding, np.ndarray]] = {}


def _encoder(ranks: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file's content and the byte length of each token; one a worker process."""
    key = hash(ranks)
    if key not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        sizes = np.zeros(max(table.values()) + 1, dtype=np.int64)
        for token, rank in table.items():
            sizes[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), sizes
    return _encoders[key]


def title_body_closing(text: str) -> list[tuple[str, int, int]]:
    """The first line, the lines between and the last line of three or more; a line break belongs to the line it ends."""
    first = text.find("\n") + 1 or len(text)
    last = text.rstrip("\n").rfind("\n") + 1
    last = last if last > first else len(text)
    return [("title", 0, first), ("body", first, last), ("closing", last, len(text))]


def allocate(ends: np.ndarray, borders: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those among them that lie in several; all in bytes.

    ``ends`` are the tokens' ends, ``borders`` the sections' starts followed by the text's end.
    """
    n = len(borders) - 1
    starts = np.r_[0, ends][: len(ends)].astype(np.int64)
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, ends, "left") - 1
    crossing = np.flatnonzero(first != last)
    owner = first
    if rule == "majority":
        for t in crossing:
            a, b = int(first[t]), int(last[t])
            held = np.minimum(borders[a + 1 : b + 2], ends[t]) - np.maximum(borders[a : b + 1], starts[t])
            owner[t] = a + int(np.argmax(held))
    elif rule != "first":
        raise ValueError(rule)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def count_tokens(docs: DataFrame, sections: Callable[[str], list[tuple[str, int, int]]] = title_body_closing, vocabulary: str = VOCABULARY, rule: str = "majority") -> DataFrame:
    """doc_id, section, start and end (code points), n_tokens, n_crossing of each section.

    The rank file is read by the driver and sent along: it is a fixed file of about 1 MB.
    """
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = _encoder(ranks.value)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                spans = sections(text)
                ends = np.cumsum(sizes[np.asarray(encoder.encode_ordinary(text), dtype=np.int64)])
                size = int(ends[-1]) if len(ends) else 0
                borders = [s for _, s, _ in spans] + [len(text)]
                if size != len(text):  # code points to bytes
                    lead = np.flatnonzero((np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80)
                    borders = np.r_[lead, size][borders]
                tokens, crossing = allocate(ends, np.asarray(borders, dtype=np.int64), rule)
                for (name, s, e), n, x in zip(spans, tokens.tolist(), crossing.tolist(), strict=True):
                    for column, value in zip(out, (doc, name, s, e, n, x), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    slim = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, section string, start long, end long, n_tokens long, n_crossing long")
