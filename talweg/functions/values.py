"""Guards and conversions of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def strict_number(c: Column, name: str, positive: bool = False) -> Column:
    """The number, or an error: a missing, infinite or negative one (with positive also zero) is a broken source."""
    good = finite(c) & ((c > 0) if positive else (c >= 0))
    return F.when(good, c).otherwise(F.raise_error(F.lit(f"{name} must be finite and {'positive' if positive else 'not negative'}")))


def observation(c: Column, name: str) -> Column:
    """Null stays null, NaN becomes null, anything else must be a finite number of at least zero."""
    missing = c.isNull() | F.isnan(c)
    return F.when(~missing, strict_number(c, name))


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({x: F.when(~F.isnan(x), F.col(x)) for x, kind in df.dtypes if kind in ("double", "float")})


def clean_measures(df: DataFrame) -> DataFrame:
    """Stored rows for an answer: NaN is null, and measures (by their names) must be finite and not negative."""
    df = nan_to_null(df)
    measures = [x for x, kind in df.dtypes if kind in ("double", "float") and (x.endswith(("_km", "_hours", "_pct")) or x.startswith("share_villages_"))]
    return df.withColumns({x: observation(F.col(x), x) for x in measures})


def strict_json(df: DataFrame) -> DataFrame:
    """One column `json`: every row as an object; infinite numbers are errors, NaN is null, nulls are written."""
    checked = {x: F.when(F.col(x).isNull() | F.isnan(x), F.lit(None)).when(F.abs(F.col(x)) < F.lit(float("inf")), F.col(x)).otherwise(F.raise_error(F.lit(f"{x} is infinite"))) for x, kind in df.dtypes if kind in ("double", "float")}
    fixed = df.withColumns(checked) if checked else df
    return fixed.select(F.to_json(F.struct(*[F.col(x) for x in df.columns]), {"ignoreNullFields": "false"}).alias("json"))


def null_safe_equal_rows(df: DataFrame, tolerance: float, pairs: list[tuple[str, str]]) -> Column:
    """Whether every pair of columns agrees: numbers within the tolerance, other values exactly, null with null."""
    kinds, out = dict(df.dtypes), F.lit(True)
    for a, b in pairs:
        if kinds[a] in ("double", "float", "bigint", "int"):
            same = (F.col(a).isNull() & F.col(b).isNull()) | (F.abs(F.col(a) - F.col(b)) <= tolerance)
        else:
            same = F.col(a).eqNullSafe(F.col(b))
        out = out & F.coalesce(same, F.lit(False))
    return out


def half_up(c: Column, digits: int) -> Column:
    """Rounded half up in plain floating arithmetic, which every engine repeats to the last bit."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / scale
