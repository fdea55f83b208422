"""Cleaning raw text (I1, I2, I4) and masking e-mail addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(column: str | Column) -> Column:
    """The text without surrounding spaces; an empty text becomes NULL (B2)."""
    return F.nullif(F.trim(column), F.lit(""))


def parsed(column: str | Column, type_name: str) -> Column:
    """The cleaned text as ``type_name``, or NULL where it does not parse.

    ``try_cast`` gives NULL for bad and overflowing values whether ANSI mode is on or off.
    """
    return trimmed(column).try_cast(type_name)


def mask_email(column: str | Column, privileged: bool | Column = False) -> Column:
    """First character, ``***@`` and the domain; the whole address for privileged readers.

    An address without ``@`` has no domain to show, so nothing follows the ``@``.
    """
    address = F.col(column) if isinstance(column, str) else column
    domain = F.split_part(address, F.lit("@"), F.lit(2))
    masked = F.concat(F.left(address, F.lit(1)), F.lit("***@"), domain)
    allowed = privileged if isinstance(privileged, Column) else F.lit(privileged)
    return F.when(allowed, address).otherwise(masked)
