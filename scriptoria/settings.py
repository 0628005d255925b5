"""Places of an archive and its products."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Roots of the source files, the prepared copies, the parsed issues, the tables and the exports."""

    sources: str
    prepared: str
    parsed: str
    tables: str
    exports: str
    default_year: int = 1970

    @staticmethod
    def below(root: str, sources: str | None = None, **other) -> Settings:
        """Defaults below a root; the sources come from the argument, $SCRIPTORIA_SOURCES, or the root."""
        chosen = sources or os.environ.get("SCRIPTORIA_SOURCES") or f"{root}/sources"
        return Settings(chosen, f"{root}/prepared", f"{root}/parsed", f"{root}/tables", root, **other)
