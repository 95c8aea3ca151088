"""Settings."""

from __future__ import annotations

import os
from dataclasses import dataclass

MOST_TOKENS = 32768


@dataclass(frozen=True)
class ModelConfig:
    api_key: str = ""
    api_base: str = ""
    model: str = ""
    temperature: float = 0.3
    max_tokens: int = 16384

    def __post_init__(self):
        tokens = 16384 if self.max_tokens <= 0 else min(self.max_tokens, MOST_TOKENS)
        object.__setattr__(self, "max_tokens", tokens)

    @classmethod
    def from_env(cls, prefix: str = "LLM") -> ModelConfig:
        """Settings of the environment variables PREFIX_API_KEY, _API_BASE, _MODEL, _TEMPERATURE and _MAX_TOKENS."""
        kinds = {"api_key": str, "api_base": str, "model": str, "temperature": float, "max_tokens": int}
        given = {k: os.environ.get(f"{prefix}_{k.upper()}") for k in kinds}
        return cls(**{k: kinds[k](v) for k, v in given.items() if v})


@dataclass(frozen=True)
class EngineConfig:
    pool_path: str = "pool.json"
    max_pool_size: int = 450
    max_per_log: int = 10
    file_batch: int = 5
    by_segment: bool = True
    report_folder: str | None = None
    verbose: bool = False
