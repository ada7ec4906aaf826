"""Exceptions raised by the package."""


class SlotweaveError(Exception):
    """Base class."""


class SpecError(SlotweaveError):
    """A spec, rule table or target schema cannot be compiled."""


class SourceError(SlotweaveError):
    """A source table is missing or malformed."""


class DataError(SlotweaveError):
    """The data break a rule that must hold (duplicate keys, strict mode, ...)."""
