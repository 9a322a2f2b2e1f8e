"""Text recipes: labels, names, money, templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marked part of a recurrence description starts here and
# ends before the next filler letter.
LABEL_START = 12
LABEL_FILLER = "x"

# Word boundaries of camelCase names.
CAMEL_PATTERNS = (r"([A-Z]+)([A-Z][a-z])", r"([a-z0-9])([A-Z])")


def has_prefix(column: Column, prefix: str) -> Column:
    """Prefix test that ignores ASCII case only."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    head = F.substring(column, 1, len(prefix))
    return F.translate(head, upper, lower) == prefix.translate(str.maketrans(upper, lower))


def label(description: Column) -> Column:
    """Label inside a description.

    Without a filler letter the requested length is minus one, which means the
    single character in front of the start position.
    """
    tail = F.substr(description, F.lit(LABEL_START))
    stop = F.instr(tail, LABEL_FILLER)
    before = F.substring(description, LABEL_START - 1, 1)
    return F.when(stop == 0, before).otherwise(F.substr(description, F.lit(LABEL_START), stop - 1))


def snake_name(name: str) -> str:
    for pattern in CAMEL_PATTERNS:
        name = re.sub(pattern, r"\1_\2", name)
    return name.lower()


def snake_column(name: Column) -> Column:
    for pattern in CAMEL_PATTERNS:
        name = F.regexp_replace(name, pattern, "$1_$2")
    return F.lower(name)


def money(text: Column) -> Column:
    """``9,250.00`` as a double; NULL when it is no number."""
    return F.trim(F.replace(text.cast("string"), F.lit(","), F.lit(""))).try_cast("double")


def number_text(value: Column) -> Column:
    """Double as plain text of 15 digits at most: always a decimal point, no exponent, no padding, at any size."""
    shown = F.format_string("%.14e", value.cast("double"))
    part = lambda n: F.regexp_extract(shown, r"^(-?)(\d)\.(\d+)e([+-]\d+)$", n)
    digits, power = F.concat(part(2), part(3)), part(4).try_cast("int")
    zeros = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)))
    # zeros on both sides, then a point behind the digits that stand before it
    wide = F.concat(zeros(-power), digits, zeros(power - 14))
    before = F.greatest(power, F.lit(0)) + 1
    plain = F.concat(part(1), F.substring(wide, F.lit(1), before), F.lit("."), F.substring(wide, before + 1, F.length(wide)))
    tidy = F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", ".0")
    return F.when(value.isNotNull(), F.when(power.isNull(), value.cast("string")).otherwise(tidy))


def fill(template: str, values: dict[str, Column]) -> Column:
    """``{name}`` slots filled with columns; NULL as soon as one slot is NULL."""
    parts = [p for p in re.split(r"(\{\w+\})", template) if p]
    pieces = [values[p[1:-1]].cast("string") if p.startswith("{") else F.lit(p) for p in parts]
    return F.concat(*pieces)
