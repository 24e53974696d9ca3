"""All queries of the subpackage and their SQL twins."""

from __future__ import annotations

from tallyward.llm import chat_format, cover_tree, decontaminate, html_text, jaccard_join, language, line_dedup, secrets, sentencepiece_unigram, spelling, token_store, url_filter, whitening  # noqa: F401
from tallyward.llm.common import ORACLE, QUERIES  # noqa: F401
