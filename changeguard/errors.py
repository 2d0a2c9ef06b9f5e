"""Refusals."""


class SetTooLarge(ValueError):
    """A set that must be complete is larger than the caller allows."""


class NothingMatched(ValueError):
    """A plan or an apply selected no rows."""


class PlanMissing(LookupError):
    """No stored plan for these inputs, or it is too old."""


class PlanMismatch(PlanMissing):
    """The apply's inputs are not those that were planned, or the plan is too old; nothing was written."""


class DriftRefused(RuntimeError):
    """Rows moved between plan and apply; nothing was written."""

    def __init__(self, message, drift=None, expected=None, actual=None):
        super().__init__(message)
        self.drift = drift
        self.expected = expected
        self.actual = actual


class UnresolvedWrite(RuntimeError):
    """A commit was sent and its outcome is unknown."""
