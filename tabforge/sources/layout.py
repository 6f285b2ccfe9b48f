"""Where the outputs of a run lie."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class OutputLayout:
    """``<base>/<run_id>/{model, predictions, deep_insights_input}``."""
    base: str
    run_id: str

    @staticmethod
    def create(base: str, run_id: str | None = None) -> "OutputLayout":
        rid = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%m%d%Y%H%M%S")
        return OutputLayout(base.rstrip("/"), rid)

    @property
    def root(self) -> str:
        return f"{self.base}/{self.run_id}"

    def model(self, name: str) -> str:
        return f"{self.root}/model/{name}"

    def predictions(self, name: str) -> str:
        return f"{self.root}/predictions/{name}"

    def insights(self, name: str) -> str:
        return f"{self.root}/deep_insights_input/{name}"

    def manifest(self) -> str:
        return f"{self.root}/training_config"
