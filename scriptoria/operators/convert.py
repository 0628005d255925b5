"""Conversion of office files by an outside program: the interface, and a converter that has none.

The program itself is not part of this engine; a deployment passes its own ``Converter``.
"""

from __future__ import annotations

from typing import Protocol


class ConversionError(RuntimeError):
    """A file could not be converted; the message names it."""


class Converter(Protocol):
    def convert(self, content: bytes, source: str, target_extension: str) -> bytes:
        """The converted file, or a ConversionError."""


class NoConverter:
    """Knows no conversion; files that need one fail with a clear message."""

    def convert(self, content: bytes, source: str, target_extension: str) -> bytes:
        raise ConversionError(f"no converter is configured: {source} cannot become .{target_extension}")
