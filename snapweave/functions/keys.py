"""Business-key normalization: strip, float artifacts, case, zero fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator between the parts of a composite key (not escaped inside parts).
KEY_SEP = "|"

# Every character Python's str.strip()/str.split() treat as
# whitespace (str.isspace), so text is cut exactly where the source system cut it.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` takes spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def zero_fill(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to a minimum width; never truncates, keeps a sign in front.

    The empty string stays empty.
    """
    x = _col(c)
    n = F.greatest(F.length(x), F.lit(width))
    signed = F.substring(x, 1, 1).isin("+", "-")
    return (
        F.when(x == "", x)
        .when(signed, F.concat(F.substring(x, 1, 1), F.lpad(F.substring(x, 2, 1 << 30), n - 1, "0")))
        .otherwise(F.lpad(x, n, "0"))
    )


def _plain_text(c: Column) -> Column:
    """Text of a cell; whole numbers in a DOUBLE column in full digits, NaN as missing."""
    number = c.try_cast("double")
    floating = F.typeof(c).isin("double", "float")  # folded away by the optimizer
    whole = (number == F.floor(number)) & (F.abs(number) < 1e18)
    return (F.when(floating & F.isnan(number), F.lit(None).cast("string"))
            .when(floating & whole, c.try_cast("decimal(38,0)").cast("string")).otherwise(c.cast("string")))


def normalize_key(c: Column | str, width: int | None = None) -> Column:
    """Raw key cell to a clean key string.

    NULL or blank -> "" (and stays "" whatever the width); otherwise strip,
    drop a trailing ".0" when the rest is all digits, upper-case, zero fill.
    """
    # Each step reads the previous one once, so nested use stays linear in size.
    t = F.coalesce(strip(_plain_text(_col(c))), F.lit(""))
    t = F.upper(F.regexp_replace(t, r"^(\p{Nd}+)\.0$", "$1"))
    if width is not None:
        t = zero_fill(t, width)
    return t


def composite_key(parts: Sequence[Column]) -> Column:
    """Join already-normalized parts with the key separator."""
    return parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEP, *parts)


def key_complete(parts: Sequence[Column]) -> Column:
    """True when no normalized part is empty."""
    cond = parts[0] != ""
    for p in parts[1:]:
        cond = cond & (p != "")
    return cond
