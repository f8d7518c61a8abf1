"""Medallion layout: <root>/<zone>/<table>."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def serving(self, version: str = "current") -> str:
        return f"{self.root}/serving/{version}"
