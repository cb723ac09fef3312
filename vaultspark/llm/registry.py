"""All queries of the subpackage."""

from __future__ import annotations

import importlib

from .common import ORACLES, QUERIES

MODULES = ("warc", "html_text", "token_counts", "ngram_join", "sentencepieces", "pii", "fingerprints", "decontamination", "chat", "toxicity", "merkle", "exact_search", "collocations")

for _name in MODULES:
    importlib.import_module(f"{__package__}.{_name}")

__all__ = ["ORACLES", "QUERIES"]
