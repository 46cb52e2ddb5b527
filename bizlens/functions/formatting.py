"""pt-BR report formatting as Column builders (currency, percent, compact, deltas).

Rounding rule: the binary double itself is rounded to the shown digits, exact ties to even, as Python's formatter
does for the dashboard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bizlens.functions.common import col_of

def _grouped(abs_value: Column, decimals: int) -> Column:
    """``1234.5`` -> ``1.234,50``: thousands with '.', decimals with ','."""
    return F.translate(F.format_number(abs_value, decimals), ",.", ".,")


def _plain(abs_value: Column, decimals: int) -> Column:
    """``1234.5`` -> ``1234,50`` (no grouping)."""
    return F.translate(F.format_number(abs_value, decimals), ".,", ",")


def format_currency(c, show_sign: bool = False) -> Column:
    """``R$ 1.234,56``; negatives ``R$ -1.234,56``; ``R$ +…`` on request; null -> ``R$ 0,00``."""
    v = col_of(c).cast("double")
    body = _grouped(F.abs(v), 2)
    out = F.when(v < 0, F.concat(F.lit("R$ -"), body))
    if show_sign:
        out = out.when(v > 0, F.concat(F.lit("R$ +"), body))
    return F.when(v.isNull() | F.isnan(v), F.lit("R$ 0,00")).otherwise(out.otherwise(F.concat(F.lit("R$ "), body)))


def format_percentage(c, decimals: int = 1, show_sign: bool = False, scale: float = 100.0) -> Column:
    """Fraction -> ``12,5%`` (``scale=1`` when the value already is a percentage); null -> ``0,0%``, whatever the
    number of decimals."""
    v = col_of(c).cast("double") * F.lit(scale)
    body = _plain(F.abs(v), decimals)
    out = F.when(v < 0, F.concat(F.lit("-"), body, F.lit("%")))
    if show_sign:
        out = out.when(v > 0, F.concat(F.lit("+"), body, F.lit("%")))
    return F.when(v.isNull() | F.isnan(v), F.lit("0,0%")).otherwise(out.otherwise(F.concat(body, F.lit("%"))))


def format_compact(c) -> Column:
    """``12,3K`` / ``1,5M`` / ``2,0B``; below 1000 the rounded integer; null -> ``0``."""
    v = col_of(c).cast("double")
    a = F.abs(v)
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    unit = (F.when(a >= 1e9, F.concat(_plain(a / F.lit(1e9), 1), F.lit("B")))
             .when(a >= 1e6, F.concat(_plain(a / F.lit(1e6), 1), F.lit("M")))
             .when(a >= 1e3, F.concat(_plain(a / F.lit(1e3), 1), F.lit("K")))
             .otherwise(_plain(a, 0)))
    return F.when(v.isNull() | F.isnan(v), F.lit("0")).otherwise(F.concat(sign, unit))


def format_number_br(c, decimals: int = 0) -> Column:
    """Thousands '.' and decimal ','; null -> ``0``."""
    v = col_of(c).cast("double")
    body = _grouped(F.abs(v), decimals)
    return F.when(v.isNull() | F.isnan(v), F.lit("0")).otherwise(
        F.when(v < 0, F.concat(F.lit("-"), body)).otherwise(body))


def signed_fixed(c, decimals: int = 1) -> Column:
    """Python ``f"{x:+.1f}"`` with a decimal comma: ``+1,2`` / ``-0,3``."""
    v = col_of(c).cast("double")
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("+")), _plain(F.abs(v), decimals))


def delta_tag(c) -> Column:
    """Colour tag of a delta: ``normal`` (>0), ``inverse`` (<0), ``off`` (0 or null)."""
    v = col_of(c)
    return F.when(v > 0, F.lit("normal")).when(v < 0, F.lit("inverse")).otherwise(F.lit("off"))


def format_delta(c, is_percentage: bool = False, is_currency: bool = True) -> Column:
    """(text, colour tag) of a delta value as a struct; null -> ('0', 'off')."""
    v = col_of(c).cast("double")
    if is_percentage:
        text = format_percentage(v, 1, show_sign=True)
    elif is_currency:
        text = format_currency(v, show_sign=True)
    else:
        body = _grouped(F.abs(v), 0)
        text = F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("+")), body)
    return F.when(v.isNull() | F.isnan(v), F.struct(F.lit("0").alias("texto"), F.lit("off").alias("cor"))).otherwise(
        F.struct(text.alias("texto"), delta_tag(v).alias("cor")))


def delta_text(pct_pop, pct_yoy, suffix: str = "%") -> Column:
    """``+1,2% (Ano) | +0,3% (Mês)``; without a year-ago base only the month part."""
    pop = F.concat(signed_fixed(pct_pop), F.lit(suffix), F.lit(" (Mês)"))
    yoy = F.concat(signed_fixed(pct_yoy), F.lit(suffix), F.lit(" (Ano) | "))
    return F.when(col_of(pct_yoy).isNull(), pop).otherwise(F.concat(yoy, pop))


def share_text(c) -> Column:
    """Share already in 0..100: ``12,3%``."""
    return F.concat(_plain(col_of(c).cast("double"), 1), F.lit("%"))
