"""Pipelines by name: those that come with the package, those that a program registers, and those that a YAML file lists."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Pipeline:
    """entry: "module:function", called as run() is: (spark, inputs, output, config, settings)."""

    name: str
    entry: str
    title: str = ""
    description: str = ""
    enabled: bool = True

    def load(self) -> Callable:
        module, _, function = self.entry.partition(":")
        if not module or not function:
            raise ValueError(f"the entry of pipeline {self.name} must be module:function")
        try:
            return getattr(importlib.import_module(module), function)
        except (ImportError, AttributeError) as e:
            raise LookupError(f"the entry of pipeline {self.name} can't be loaded: {e}") from e


_KNOWN: dict[str, Pipeline] = {"data_dictionary": Pipeline("data_dictionary", "fieldloom.plans.run:run", "Data dictionary", "profile tables and write their data dictionary and metadata")}


def register(pipeline: Pipeline) -> None:
    _KNOWN[pipeline.name] = pipeline


def listed(path: str) -> list[Pipeline]:
    """Of a YAML file: a map `pipelines` from names to entry, title, description and enabled."""
    import yaml

    with open(path, encoding="utf-8") as f:
        found = (yaml.safe_load(f) or {}).get("pipelines")
    if not isinstance(found, dict) or not found:
        raise ValueError(f"{path} lists no pipelines")
    out = []
    for name, facts in found.items():
        if not isinstance(facts, dict) or not facts.get("entry"):
            raise ValueError(f"pipeline {name} has no entry")
        out.append(Pipeline(str(name), str(facts["entry"]), str(facts.get("title") or ""), str(facts.get("description") or ""), bool(facts.get("enabled", True))))
    return out


def known(path: str | None = None) -> dict[str, Pipeline]:
    """All by name, in order; a file's take the place of others."""
    own = _KNOWN | {p.name: p for p in (listed(path) if path else [])}
    return dict(sorted(own.items()))


def resolved(name: str, path: str | None = None) -> Pipeline:
    found = known(path)
    if name not in found:
        raise LookupError(f"unknown pipeline {name}; known: {', '.join(found)}")
    if not found[name].enabled:
        raise LookupError(f"pipeline {name} is switched off")
    return found[name]
