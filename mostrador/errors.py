"""Errors raised by the readers and by filter validation."""

from __future__ import annotations


class SalesDataError(Exception):
    """Base class: the input cannot be used as sales data."""


class EmptyInputError(SalesDataError):
    """No input file, or only empty ones."""


class MissingColumnsError(SalesDataError):
    """A required column is absent, or a column has the wrong kind of values."""


class UnreadableInputError(SalesDataError):
    """The input is not text that parses as delimited rows."""


class FilterError(ValueError):
    """A filter name or value was rejected. ``code`` and ``label`` are the public error codes."""

    # Error code and label of a rejected request.
    code = "VF"
    label = "Validación Fallida"

    def __init__(self, detail: str) -> None:
        super().__init__(detail)
        self.detail = detail
