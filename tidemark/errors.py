"""Errors that carry a process exit code (the sysexits numbers), and the codes of external programs."""

from __future__ import annotations

# Exit codes.
USAGE, DATA, NO_INPUT, UNAVAILABLE, SOFTWARE, OS_FILE, CANT_CREATE, IO, CONFIG = 64, 65, 66, 69, 70, 72, 73, 74, 78
PROGRAM_CODES = {101: "time", 102: "mode or basin", 103: "storm too far from swath centre", 104: "analysis too old", 105: "Barnes analysis", 106: "iteration test", 107: "domain top", 108: "estimation failed", 109: "quality control maximum exceeded"}


class EngineError(Exception):
    code = SOFTWARE

    def __init__(self, message: str, code: int | None = None):
        super().__init__(message)
        self.code = code or self.code


class DataError(EngineError):
    code = DATA


class InputError(EngineError):
    code = IO


class ConfigError(EngineError):
    code = CONFIG


class UsageError(EngineError):
    code = USAGE
