"""Internationalised labels: the ASCII form (``xn--…``) that DNS and coded suffix
rules use.

Coding is done by Java's own ``IDN`` class (IDNA 2003) through ``try_reflect``, for
the labels that are not ASCII only; a label that it refuses (too long, unassigned
characters) stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The full stops that IDNA takes for the dot between labels.
DOTS = "。．｡"
_ALLOW_UNASSIGNED = 1


def ascii_label(label: Column) -> Column:
    """The coded form of one label; ASCII labels and NULL as they are."""
    coded = F.call_function("try_reflect", F.lit("java.net.IDN"), F.lit("toASCII"), label, F.lit(_ALLOW_UNASSIGNED))
    return F.when(F.octet_length(label) != F.char_length(label), F.coalesce(coded, label)).otherwise(label)


def ascii_labels(labels: Column) -> Column:
    return F.transform(labels, ascii_label)


def plain_dots(name: Column) -> Column:
    """IDNA's other full stops as dots."""
    return F.when(F.octet_length(name) != F.char_length(name), F.translate(name, DOTS, "." * len(DOTS))).otherwise(name)


def ascii_name(name: Column) -> Column:
    """A whole name in coded form: one spelling for both."""
    return F.when(F.octet_length(name) != F.char_length(name), F.array_join(ascii_labels(
        F.split(plain_dots(name), r"\.", -1)), ".")).otherwise(name)
