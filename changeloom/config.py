"""Configuration (SRC18): a first argument, then environment variables, then a ``.env`` file, then defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class Config:
    connection: str = "host=localhost dbname=postgres user=postgres"
    output: str = "data"
    tables: frozenset[str] = frozenset()
    #: Files that a micro-batch admits, and its interval; they stand for row counts and idle times.
    max_files: int = 100
    every: str = "5 seconds"


def env_file(path: str | Path) -> dict[str, str]:
    """``KEY=value`` lines; empty lines and those that begin with # are passed over."""
    out = {}
    p = Path(path)
    for line in p.read_text(encoding="utf-8").splitlines() if p.exists() else ():
        key, eq, value = line.partition("=")
        if eq and not line.startswith("#"):
            out[key] = value
    return out


def load(args: Sequence[str] = (), environ: Mapping[str, str] | None = None, file: str | Path = ".env") -> Config:
    values = {**(os.environ if environ is None else environ), **env_file(file)}
    base = Config()
    named = [t for t in values.get("TABLE_NAME", "").replace(" ", "").split(",") if t]
    return Config(args[0] if args else values.get("PG_CONNINFO", base.connection), values.get("OUTPUT_DIR", base.output), frozenset(named), int(values.get("MAX_FILES", base.max_files)), values.get("EVERY", base.every))
