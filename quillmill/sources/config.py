"""Settings: an environment file, the process environment over it, typed reads, and step defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path


def parse_env(text: str) -> dict[str, str]:
    """NAME=value lines; comments, blank lines, 'export ' and one pair of quotes around a value are taken off."""
    out = {}
    for line in text.splitlines():
        name, mark, value = line.strip().removeprefix("export ").partition("=")
        if mark and not name.startswith("#") and name.strip():
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


@dataclass(frozen=True)
class Settings(Mapping):
    """Values by name; the process environment wins over the file."""

    values: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, candidates: list[str], environment: Mapping[str, str] | None = None) -> Settings:
        """From the first candidate file that there is, and the environment."""
        held = next((parse_env(Path(p).read_text("utf-8")) for p in candidates if Path(p).is_file()), {})
        return cls({**held, **(os.environ if environment is None else environment)})

    def __getitem__(self, name: str) -> str:
        return self.values[name]

    def __iter__(self):
        return iter(self.values)

    def __len__(self) -> int:
        return len(self.values)

    def require(self, name: str) -> str:
        if not (value := self.values.get(name, "")):
            raise KeyError(f"{name} is not set")
        return value

    def number(self, name: str, default: float) -> float:
        return type(default)(self.values.get(name) or default)

    def judge(self) -> Settings:
        """The judge's connection: its own URL and model where set, else the main one's; the key goes with the URL."""
        own = self.values.get("JUDGE_BASE_URL")
        key = self.values.get("JUDGE_API_KEY", "") if own else self.values.get("LLM_API_KEY", "")
        return Settings({**self.values, "LLM_BASE_URL": own or self.values.get("LLM_BASE_URL", ""), "LLM_MODEL": self.values.get("JUDGE_MODEL") or self.values.get("LLM_MODEL", ""), "LLM_API_KEY": key})


@dataclass(frozen=True)
class RunOptions:
    """Options that all steps share. Seed, test sample, split sizes, fix rounds, rates."""

    out_root: str = "output"
    test: bool = False
    test_samples: int = 20
    seed: int = 3407
    strict: bool = False
    max_fix: int = 2
    english_rate: float = 0.20
    max_missing: int = 0
    val_ids: int = 700
    test_ids: int = 700
    include_corrected: bool = True
    ignore_judge: bool = False
    retry_partial: bool = False


# Temperature and answer length of each model step.
STEP_LIMITS = {"1a": (0.0, 8192), "1b": (0.0, 8192), "2a": (0.9, 600), "2b": (0.0, 1024), "2b2": (0.2, 1024)}
