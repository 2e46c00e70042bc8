"""Settings from the environment: CANOPY_<NAME>, with defaults."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    #: log rows of a page
    page: int = 5000
    #: events of a pop from a queue
    queue_chunk: int = 1000
    #: files of a log that a micro-batch reads at most
    files_per_batch: int = 100
    #: seconds between polls; 0 catches up and stops
    poll_seconds: float = 0.0
    #: folders of a table of documents
    buckets: int = 64
    #: whether a failed batch stops the run
    raise_on_failure: bool = True
    schema: str = "public"

    @classmethod
    def of(cls, environment: Mapping[str, str] | None = None) -> Settings:
        """Values that can't be read as their kind are errors."""
        env = os.environ if environment is None else environment
        found = {}
        for f in fields(cls):
            text = env.get(f"CANOPY_{f.name.upper()}")
            if text is None:
                continue
            kind = type(getattr(cls, f.name))
            try:
                found[f.name] = {"true": True, "1": True, "false": False, "0": False}[text.lower()] if kind is bool else kind(text)
            except (KeyError, ValueError) as error:
                raise ValueError(f"CANOPY_{f.name.upper()}: {text} is no {kind.__name__}") from error
        return cls(**found)


def redacted(url: str) -> str:
    """A URL without its password."""
    return re.sub(r"(://[^:/@]+):[^@]*@", r"\1:***@", url)
