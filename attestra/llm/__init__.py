"""Operators of a large-scale training-data pipeline; each module has one operator and its query."""

from attestra.llm import bpe, chat, dac, decontaminate, jaccard, licenses, lines, phrases, pieces, pii, quality, search, sharding  # noqa: F401
from attestra.llm.common import ORACLES, QUERIES  # noqa: F401
