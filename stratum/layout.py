"""Where each layer lives below one root folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def rejects(self, table: str) -> str:
        return f"{self.root}/bronze_rejects/{table}"

    def staging(self, table: str) -> str:
        return f"{self.root}/bronze_staging/{table}"

    def conformed(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def state(self, reader: str) -> str:
        return f"{self.root}/state/{reader}"
