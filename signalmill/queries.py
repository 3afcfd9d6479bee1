"""All queries of this library but those of the training-data operators, and their SQL."""

from __future__ import annotations

from .plans import files, market, news

REGISTRY = {**news.REGISTRY, **market.REGISTRY, **files.REGISTRY}
