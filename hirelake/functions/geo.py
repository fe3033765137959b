"""Address and coordinate functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c, split_ws

# --- FIXED VALUES: label that may precede an address ("address") ------------
ADDRESS_LABEL = "주소"
# -----------------------------------------------------------------------------


def _token(tokens: Column, n: int) -> Column:
    return F.try_element_at(tokens, F.lit(n))


def sido(c: ColumnOrName) -> Column:
    """province = first two characters of the first address token, or of
    the second when the first starts with the label. Too few tokens -> NULL."""
    tokens = split_ws(c)
    first = _token(tokens, 1)
    pick = F.when(first.startswith(ADDRESS_LABEL), _token(tokens, 2)).otherwise(first)
    return F.substring(pick, 1, 2)


def gugun(c: ColumnOrName) -> Column:
    """district = first two characters of token 2 (token 3 after the
    label); a one-token address gives NULL."""
    tokens = split_ws(c)
    first = _token(tokens, 1)
    pick = F.when(first.startswith(ADDRESS_LABEL), _token(tokens, 3)).otherwise(_token(tokens, 2))
    return F.substring(pick, 1, 2)


def coord_part(coordinate: ColumnOrName, n: int) -> Column:
    """Element n (1-based) as DOUBLE when the array is not NULL."""
    arr = _c(coordinate)
    return F.when(arr.isNotNull(), F.try_element_at(arr, F.lit(n)).cast("double"))


def coordinate_pair(lat: ColumnOrName, lon: ColumnOrName, truthy: bool = False) -> Column:
    """[lat, lon] when both are present (truthy=True also drops 0.0)."""
    la, lo = _c(lat).cast("double"), _c(lon).cast("double")
    ok = la.isNotNull() & lo.isNotNull()
    if truthy:
        ok = ok & (la != 0.0) & (lo != 0.0)
    return F.when(ok, F.array(la, lo))
