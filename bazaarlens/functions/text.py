"""Text cleaning for place names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Capitalise each run of letters and digits, lower-case the rest.

    Unlike ``F.initcap`` any other character ends a word, so ``mogi-guacu``
    becomes ``Mogi-Guacu`` and ``d'oeste`` becomes ``D'Oeste``.
    """
    words = F.split(F.lower(text), r"(?<=[^\p{L}\p{N}])")
    capitalised = F.transform(
        words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    return F.array_join(capitalised, "")


def clean_place(text: Column) -> Column:
    """Trimmed, title-cased place name."""
    return title_case(F.trim(text))


def clean_code(text: Column) -> Column:
    """Trimmed, upper-cased code such as a state abbreviation."""
    return F.upper(F.trim(text))
