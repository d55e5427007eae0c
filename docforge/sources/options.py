"""Options from the environment and .env files, and prompts; what is set in the environment wins."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

TRUE = {"1", "true", "yes", "y", "on"}


def load_env(path: str, environment: dict[str, str] | None = None) -> dict[str, str]:
    """The environment with the lines NAME=value of a file for names that it lacks; quotes and comments are taken off."""
    out = dict(os.environ if environment is None else environment)
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8-sig").splitlines():
            name, equals, value = line.strip().partition("=")
            if equals and name and not name.startswith("#"):
                out.setdefault(name.strip(), value.strip().strip("\"'"))
    return out


def flag(environment: Mapping[str, str], *names: str, default: bool = False) -> bool:
    """True if the first name that is set has one of the words for it."""
    return next((environment[n].strip().lower() in TRUE for n in names if environment.get(n, "") != ""), default)


def number(environment: Mapping[str, str], *names: str, default: float) -> float:
    """The first name's value as a number of the default's type; what is none gives the default."""
    for n in names:
        if environment.get(n, "") != "":
            try:
                return type(default)(environment[n])
            except ValueError:
                return default
    return default


def listed(value: str) -> list[str]:
    return [part.strip() for part in value.split(",") if part.strip()]


def prompt(path: str, default: str) -> str:
    """A prompt's text, or the default where there is no such file."""
    return Path(path).read_text(encoding="utf-8") if Path(path).exists() else default
