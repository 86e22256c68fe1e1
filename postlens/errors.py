"""Validation errors raised on the driver before any job runs."""

from __future__ import annotations


class PostlensError(Exception):
    """Base class for the library's errors."""


class WrongColumnName(PostlensError, KeyError):
    """One or more requested root columns are absent from the frame."""

    def __init__(self, columns):
        self.columns = list(columns)
        super().__init__(f"unknown column(s): {', '.join(map(str, self.columns))}")

    def __str__(self):  # KeyError would quote the message
        return self.args[0]


class WordTypeError(PostlensError, TypeError):
    """A keyword list holds something other than strings."""

    def __init__(self, bad):
        self.bad = list(bad)
        super().__init__(f"keywords must be strings, got: {self.bad!r}")


class LexiconError(PostlensError, ValueError):
    """Lexicon is empty or repeats a token."""


class CheckpointFolderMissing(PostlensError, RuntimeError):
    """The session names no shared folder for checkpoints."""


class ElbowUndefined(PostlensError, ValueError):
    """The SSE curve has no knee (straight line, all equal, or too short)."""


class ClusteringInputError(PostlensError, ValueError):
    """Features contain nulls, or there are fewer rows than clusters."""
