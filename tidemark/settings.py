"""Settings from the environment, and JSON logs."""

from __future__ import annotations

import json
import logging
import os
import sys
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    environment: str = "development"
    lake_root: str = "data/lake"
    control_path: str = "data/control.db"
    lineage_path: str = ""
    log_level: str = "INFO"

    @classmethod
    def load(cls, prefix: str = "TIDEMARK_") -> Settings:
        return cls(**{f.name: os.environ[prefix + f.name.upper()] for f in fields(cls) if prefix + f.name.upper() in os.environ})


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        out = {"at": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out)


def configure_logging(level: str = "INFO") -> None:
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(JsonFormatter())
    logging.basicConfig(level=level, handlers=[handler], force=True)
