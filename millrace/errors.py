"""Exceptions raised by guards and jobs."""


class MillraceError(Exception):
    """Base class; every job writes its audit row before one of these leaves it."""


class UnknownColumnError(MillraceError):
    """A rule names a column the target table does not have."""


class DuplicateColumnError(MillraceError):
    """One batch rewrites the same column twice in the same partition."""


class ConflictingRulesError(MillraceError):
    """Rules of one batch and partition disagree on source or recovery partition."""


class RowCountMismatchError(MillraceError):
    """A rewrite would add or lose rows."""


class FanOutError(MillraceError):
    """A lookup key that target rows match occurs more than once in the lookup."""


class UnknownTypeError(MillraceError):
    """A schema spec names an unsupported type and strict mode is on."""


class MissingFileError(MillraceError):
    """A file named in a list file does not exist."""


class SchemaMismatchError(MillraceError):
    """Rows do not fit the table they should be written to by position."""


class WrongPartitionError(MillraceError, ValueError):
    """A partition is not spelled as columns and their values, or is not the table's."""


class ConcurrentChangeError(MillraceError):
    """Another writer keeps changing a partition while a job rewrites it."""


class UnfinishedJobError(MillraceError):
    """A stage holds checked rows that other rules made."""
