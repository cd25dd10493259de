"""Typed errors that carry where they arose."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import StrEnum
from typing import Any


class Stage(StrEnum):
    CONFIG = "config"
    SCHEMA = "schema"
    EXTRACT = "extract"
    CLEAN = "clean"
    TRANSFORM = "transform"
    VALIDATE = "validate"
    LOAD = "load"


@dataclass(frozen=True)
class Where:
    table: str | None = None
    column: str | None = None
    rows: tuple[int, ...] = ()
    details: dict[str, Any] = field(default_factory=dict)

    def to_dict(self) -> dict[str, Any]:
        return {"table": self.table, "column": self.column, "rows": list(self.rows), "details": dict(self.details)}

    def __str__(self) -> str:
        said = [f"{k} {v}" for k, v in (("table", self.table), ("column", self.column)) if v]
        if self.rows:
            said.append(f"row{'s' * (len(self.rows) > 1)} {', '.join(map(str, self.rows))}")
        return ", ".join([*said, *(f"{k}: {v}" for k, v in self.details.items())])


class PipelineError(Exception):
    stage: Stage | None = None

    def __init__(self, message: str, where: Where | None = None):
        super().__init__(message)
        self.message, self.where = message, where or Where()

    def __str__(self) -> str:
        at = str(self.where)
        return f"{self.message} ({at})" if at else self.message

    def to_dict(self) -> dict[str, Any]:
        return {"type": type(self).__name__, "stage": self.stage and str(self.stage), "message": self.message} | self.where.to_dict()


class ConfigError(PipelineError):
    stage = Stage.CONFIG


class SchemaError(PipelineError):
    stage = Stage.SCHEMA


class ValidatorError(PipelineError):
    stage = Stage.VALIDATE


class StageError(PipelineError):
    """Errors of the stages that move data."""


class ExtractorError(StageError):
    stage = Stage.EXTRACT


class CleanerError(StageError):
    stage = Stage.CLEAN


class TransformerError(StageError):
    stage = Stage.TRANSFORM


class LoaderError(StageError):
    stage = Stage.LOAD
