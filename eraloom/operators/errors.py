"""Errors that operators raise."""


class AlignmentError(ValueError):
    """Benchmarks cannot be aligned to the rows."""


class DriftGuardError(ValueError):
    """A quality gate or a required-input check failed."""
