"""Money parsing and arithmetic on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def money_br(c: Column) -> Column:
    """Brazilian money text: '1.234,56', '29,77', '29.77', '980.00 BRL', 'R$ 10'.

    A comma makes dots thousands marks; without one a dot is the decimal mark.
    """
    marks = F.replace(F.replace(F.upper(c), F.lit("R$"), F.lit("")), F.lit("BRL"), F.lit(""))
    bare = F.translate(marks, " \t\n\r\u00a0", "")
    plain = F.when(
        bare.contains(","), F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    ).otherwise(bare)
    return plain.try_cast(MONEY)


def cents(c: Column) -> Column:
    """Whole cents as currency; null counts as zero."""
    return (F.coalesce(c, F.lit(0)).cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(MONEY))


def money_text(c: Column) -> Column:
    """'R$ 1.234,56' for exports; '-' for null."""
    text = F.translate(F.format_number(c, 2), ",.", ".,")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("R$ "), text))


def sum_if(condition: Column, c: Column) -> Column:
    """Sum over the rows that meet a condition, zero where none does."""
    return F.sum(F.when(condition, c).otherwise(F.lit(0).cast(MONEY)))


def percent(part: Column, whole: Column) -> Column:
    """part/whole*100 as double, zero when the whole is zero."""
    return F.when(whole != 0, part.cast("double") * 100.0 / whole.cast("double")).otherwise(0.0)


def near_zero(c: Column, eps: float = 1e-12) -> Column:
    return F.when(F.abs(c) < eps, 0.0).otherwise(c)
