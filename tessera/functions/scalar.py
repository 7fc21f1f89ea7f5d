"""Column-level helpers: safe casts, parsing, text casing.

Every helper returns a ``Column`` built from built-in Spark functions, so it
stays inside whole-stage code generation and runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Column

# The boolean words accepted by the classic Python ``strtobool``
# parser, matched case-insensitively.
TRUE_WORDS = ["y", "yes", "t", "true", "on", "1"]
FALSE_WORDS = ["n", "no", "f", "false", "off", "0"]


def _col(c) -> Column:
    return c if isinstance(c, _Column) else F.col(c)


def safe_cast(c, to_type: str) -> Column:
    """Cast that yields NULL for a bad value instead of raising (ANSI mode)."""
    return _col(c).try_cast(to_type)


def parse_bool(c) -> Column:
    """Boolean words to true/false, case-insensitively and without trimming
    (``" true "`` is not a word); any other text (and NULL) gives NULL."""
    word = F.lower(_col(c))
    return (
        F.when(word.isin(TRUE_WORDS), F.lit(True))
        .when(word.isin(FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def parse_date(c, fmt: str = "M/d/yyyy") -> Column:
    """Text to date; unparseable text gives NULL.  ``M/d/yyyy`` accepts padded and unpadded."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def parse_timestamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp in the session time zone; bad text gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def exact(c, scale: int | None) -> Column:
    """The column itself, or with ``scale`` an exact decimal of that scale, whose
    sums do not depend on row order."""
    return _col(c) if scale is None else _col(c).cast(f"decimal(28,{scale})")


def exact_mean(sum_col: Column, count_col: Column) -> Column:
    """Mean as double(exact sum) / count; identical on any engine doing IEEE division.

    NULL when nothing was counted (as ``avg``), never a division by zero.
    """
    return F.when(count_col > 0, sum_col.cast("double") / count_col.cast("double"))


def capitalize_words(c, delimiter: str = " ") -> Column:
    """Split on a literal delimiter, upper-case the first letter of each piece,
    lower-case the rest, and join back.  NULL input gives NULL."""
    pattern = _regex_literal(delimiter)
    pieces = F.split(_col(c), pattern, -1)
    capped = F.transform(
        pieces,
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))),
    )
    return F.array_join(capped, delimiter)


def tidy_name(c) -> Column:
    """``initcap`` then trim both ends: the people-cleaning chain."""
    return F.trim(F.initcap(_col(c)))


def not_header(c, header_prefix: str) -> Column:
    """Keep lines that do not start with the header's first field name."""
    return ~_col(c).startswith(header_prefix)


def split_fields(c, delimiter: str) -> Column:
    """Split a text line on a literal delimiter (``F.split`` takes a regex)."""
    return F.split(_col(c), _regex_literal(delimiter), -1)


def _regex_literal(text: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in text)
