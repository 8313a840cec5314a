"""Paths of a lake: one folder per (layer, table)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def registry(self) -> str:
        return self.path("models", "registry")

    def model(self, name: str) -> str:
        return self.path("models", f"artefacts/{name}")
