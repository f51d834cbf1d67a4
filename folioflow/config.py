"""Settings of the engine."""

from __future__ import annotations

import os
from dataclasses import dataclass

# Name prefixes of the documents that are extracted.
REQUIRED_PREFIXES = ("INI", "IXP", "DEC", "ROP", "IFS")
# Record types by prompt number, and the prefixes that each prompt applies to.
PROMPT_TYPES = {1: "auditoria", 2: "productos", 3: "desembolsos"}
PROMPT_PREFIXES = {1: ("IXP",), 2: ("ROP", "INI", "DEC", "IFS"), 3: ("ROP", "INI", "DEC", "IFS")}
# Statuses of a batch that is still of interest, and of one that has ended badly.
LIVE_STATUSES = ("validating", "in_progress", "finalizing", "completed")
DEAD_STATUSES = ("failed", "expired", "cancelled")
# Separators of sections, tried one after the other.
SECTION_PATTERNS = (r"\n={50,}\n", r"\n-{50,}\n", r"\n--- DOCUMENT:.*?---\n", r"\n\n#{1,3}\s+", r"\n\n[A-Z][A-Z\s]{10,}\n")
# File endings that the layout stage takes.
EXTENSIONS = ("pdf", "docx", "doc", "pptx", "ppt", "xlsx", "xls", "png", "jpg", "jpeg", "tiff", "bmp")


# Overlap of a project's run; requests of a batch and its hours at most; seconds between messages.
PROJECT_OVERLAP = 500
BATCH_REQUESTS, BATCH_HOURS = 50_000, 24
PACE_SECONDS = 420


@dataclass(frozen=True)
class EngineConfig:
    """compat: reproduce the known defects of the original behaviour instead of fixing them."""

    max_tokens: int = 100_000
    overlap_tokens: int = 512
    max_completion_tokens: int = 1_000
    temperature: float = 0.3
    model: str = "default"
    compat: bool = False
    prefixes: tuple[str, ...] = REQUIRED_PREFIXES
    section_patterns: tuple[str, ...] = SECTION_PATTERNS

    @classmethod
    def project(cls, **settings) -> EngineConfig:
        """Settings of a whole project's run, whose overlap differs from a single document's."""
        return cls(**{"overlap_tokens": PROJECT_OVERLAP, **settings})

    @classmethod
    def from_env(cls, prefix: str = "FOLIOFLOW_") -> EngineConfig:
        """Settings from environment variables named by field."""
        found = {}
        for name, kind in (("max_tokens", int), ("overlap_tokens", int), ("max_completion_tokens", int), ("temperature", float), ("model", str)):
            if raw := os.environ.get(prefix + name.upper()):
                found[name] = kind(raw)
        if raw := os.environ.get(prefix + "COMPAT"):
            found["compat"] = raw.lower() in ("1", "true", "yes")
        return cls(**found)
