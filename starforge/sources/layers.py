"""Layered path addressing (S5): ``<root>/<layer>/<entity>`` on any Hadoop
file system URI."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layers:
    root: str

    def path(self, layer: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{entity}"

    def bronze(self, entity: str) -> str:
        return self.path("bronze", entity)

    def silver(self, entity: str) -> str:
        return self.path("silver", entity)

    def gold(self, entity: str) -> str:
        return self.path("gold", entity)
