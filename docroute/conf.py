"""Thresholds of the pipeline in one place; builders take what they need."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class PipelineConf:
    high_tolerance: int = 2
    standard_tolerance: int = 1
    context_chars: int = 40
    phash_distance: int = 10
    text_similarity: float = 50.0
    ocr_compare_pages: int = 10
    reject_pages: int = 5
    reject_ratio: float = 0.70
    batch_pages: int = 48
    rate_limit_seconds: float = 0.8
    settle_seconds: int = 3
    inbox_idle_seconds: int = 8
    processed_idle_seconds: int = 5

    @classmethod
    def from_env(cls, prefix: str = "DOCROUTE_") -> PipelineConf:
        """Values from the environment; one that cannot be read leaves the default."""
        given = {}
        for f in fields(cls):
            try:
                given[f.name] = type(f.default)(os.environ[prefix + f.name.upper()])
            except (KeyError, ValueError):
                continue
        return cls(**given)
