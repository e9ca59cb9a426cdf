"""Errors raised when a load has to stop."""


class TidemarkError(Exception):
    """Base class of every error the library raises on purpose."""


class WindowError(TidemarkError):
    """An extraction window cannot be built from the given state."""


class SchemaError(TidemarkError):
    """Records do not fit the declared schema, or a page has the wrong shape."""


class WatermarkError(TidemarkError):
    """A watermark would stay where it is or move backwards."""


class PublishConflict(TidemarkError):
    """Another writer published first."""


class GateError(TidemarkError):
    """A blocking quality check failed.

    ``metrics`` holds the rows of the failed gate; they are not stored, because a
    failed batch leaves nothing behind.
    """

    def __init__(self, message: str, metrics: list | None = None):
        super().__init__(message)
        self.metrics = metrics or []
