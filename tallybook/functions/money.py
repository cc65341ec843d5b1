"""Amounts, quantities and currencies as column expressions.

A parser returns a struct: the value and ``reason``, the code of the first check that fails (null if none does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.text import let, lookup, meaning, staging, trim, trimmed
from tallybook.vocabulary import CURRENCIES, MONEY_SHAPE, QUANTITY_UNIT

DECIMAL = "decimal(38,10)"
_PLAIN = r"^\d+(\.\d+)?$"


def to_decimal(c: Column) -> Column:
    """A number in any of the usual spellings; null if it isn't one.

    ``( )`` and ``-`` mean negative. With commas and points, the one further right marks the fraction. Commas alone part
    groups of three or, once before one or two digits, a fraction. Several points part groups of three; one is a fraction's.
    """

    return let(trimmed(c), _number)


def _number(s: Column) -> Column:
    """The same of a trimmed text. It stays a text till the end: wide decimals are costly to carry."""
    bracketed = s.startswith("(") & s.endswith(")")
    inner = F.when(bracketed, trim(F.substring(s, F.lit(2), F.length(s) - 2))).otherwise(s)
    negative = bracketed | inner.startswith("-")
    bare = F.when(inner.startswith("-"), trim(F.substring(inner, F.lit(2), F.length(inner)))).otherwise(inner)
    joined = F.when(s.rlike(r"^[!-~]*\z"), bare).otherwise(F.regexp_replace(bare, r"(?U)(?<=\d)\s(?=\d)", ""))

    def pointed(s: Column) -> Column:
        """Without groups, the fraction after a point."""
        commas, points = s.contains(","), s.contains(".")
        comma_last = F.length(F.substring_index(s, ",", -1)) < F.length(F.substring_index(s, ".", -1))
        without = lambda mark, to="": F.replace(s, F.lit(mark), F.lit(to))
        return (
            F.when(commas & points & comma_last, F.regexp_replace(without("."), r",(?=[^,]*$)", "."))
            .when(commas & points, without(","))
            .when(commas & s.rlike(r"^\d{1,3}(,\d{3})+$"), without(","))
            .when(commas & s.rlike(r"^\d+,\d{1,2}$"), without(",", "."))
            .when(commas, F.lit(None))
            .when(s.rlike(r"\..*\."), F.when(s.rlike(r"^\d{1,3}(\.\d{3})+$"), without(".")))
            .otherwise(s)
        )

    def without_groups(j: Column) -> Column:
        return F.when(j.rlike(_PLAIN), j).when(j.rlike(r"^\d[\d.,]*$"), pointed(j))

    value = lambda p: F.when(negative, -p.try_cast(DECIMAL)).otherwise(p.try_cast(DECIMAL))
    return let(joined, lambda j: let(without_groups(j), value))


def money(c: Column) -> Column:
    """Struct (amount, currency, reason) of a text cell such as ``Frw 125,000/=``."""

    def read(s: Column) -> Column:
        """A plain number is all amount; from other texts it is cut out, and currencies stand before and after it."""
        amount = F.when(s.rlike(_PLAIN), s).otherwise(F.nullif(trim(F.regexp_extract(s, MONEY_SHAPE, 2)), F.lit("")))
        return let(amount, lambda n: let(_number(n), lambda v: marked(s, n, v)))

    def marked(s: Column, n: Column, v: Column) -> Column:
        at = F.instr(s, n)
        before, after = F.substring(s, F.lit(1), at - 1), F.substring(s, at + F.length(n), F.length(s))
        mark = lambda x: F.when(F.length(s) > F.length(n), meaning(trim(x), CURRENCIES))
        return let(mark(before), lambda a: let(mark(after), lambda b: result(s, a, b, v)))

    def result(s: Column, a: Column, b: Column, v: Column) -> Column:
        reason = F.when(s == "", "MISSING_FIELD").when(a != b, "CURRENCY_CONFLICT").when(v.isNull(), "BAD_AMOUNT")
        fine = v.isNotNull() & ~F.coalesce(a != b, F.lit(False))
        return F.struct(F.when(fine, v).alias("amount"), F.when(fine, F.coalesce(a, b)).alias("currency"), reason.alias("reason"))

    def bare(x: Column) -> Column:
        """Without white space around it and ``/=`` behind it; hard blanks become blanks. Only texts beyond plain ASCII need patterns replaced."""
        other = F.regexp_replace(F.regexp_replace(trim(F.coalesce(x, F.lit(""))), r"(?U)\s*/[=\-]$", ""), "\u00a0", " ")
        cut = F.rtrim(F.substring(x, F.lit(1), F.length(x) - 2))
        return F.when(x.rlike(r"^[!-~](?:[ -~]*[!-~&&[^=\-]])?\z"), x).when(x.rlike(r"^[!-~][ -~]*/[=\-]\z"), cut).otherwise(other)

    return let(c, lambda x: let(bare(x), read))


def quantity(c: Column) -> Column:
    """Struct (quantity, reason) of a text cell such as ``1,100 pcs``; the sign is kept."""

    def result(s: Column, value: Column) -> Column:
        reason = F.when(s == "", "MISSING_FIELD").when(value.isNull(), "BAD_QUANTITY")
        return F.struct(F.when(reason.isNull(), value).alias("quantity"), reason.alias("reason"))

    def bare(s: Column) -> Column:
        """Without its unit, which no text that ends in a digit has."""
        return F.when(F.substring(s, -1, 1).between("0", "9"), s).otherwise(trim(F.regexp_replace(s, QUANTITY_UNIT, "")))

    return let(F.coalesce(trimmed(c), F.lit("")), lambda s: let(bare(s), lambda u: let(_number(u), lambda v: result(s, v))))


def currency(c: Column) -> Column:
    """Struct (currency, reason) of a currency cell; a blank is neither."""
    filled = c.isNotNull() & (trimmed(c) != "")
    return let(lookup(c, CURRENCIES), lambda code: F.struct(code.alias("currency"), F.when(filled & code.isNull(), "UNKNOWN_CURRENCY").alias("reason")))


def resolve_currency(cell: Column, amount_marker: Column, price_marker: Column, header: Column) -> Column:
    """Struct (currency, source, reason): the column before the marker in the text before the header's hint."""

    def chosen(x: Column | dict[str, Column]) -> Column:
        column, marker = x["c"]["currency"], F.coalesce(x["a"], x["p"])
        reason = (
            F.when(x["a"] != x["p"], "CURRENCY_CONFLICT")
            .when(x["c"]["reason"].isNotNull(), x["c"]["reason"])
            .when(column != marker, "CURRENCY_CONFLICT")
            .when(F.coalesce(column, marker, x["h"]).isNull(), "UNKNOWN_CURRENCY")
        )
        source = F.when(column.isNotNull(), "column").when(marker.isNotNull(), "embedded").when(x["h"].isNotNull(), "header")
        return let(reason, lambda r: F.struct(F.when(r.isNull(), F.coalesce(column, marker, x["h"])).alias("currency"), F.when(r.isNull(), source).alias("source"), r.alias("reason")))

    given = {"c": currency(cell), "a": amount_marker, "p": price_marker, "h": header}
    return chosen(given) if staging() else let(F.struct(*[v.alias(k) for k, v in given.items()]), chosen)


def within_tolerance(amount: Column, qty: Column, price: Column) -> Column:
    """The amount is quantity times price, to a cent or a thousandth."""
    return F.abs(amount - (qty * price).cast(DECIMAL)) <= F.greatest(F.lit("0.01").cast(DECIMAL), (amount * F.lit("0.001").cast("decimal(4,3)")).cast(DECIMAL))


def implied_price(amount: Column, qty: Column) -> Column:
    """Amount per unit to four places, half to even; null if the quantity is zero or either is too large to divide."""
    return F.bround(F.try_divide(amount.try_cast("decimal(18,6)"), qty.try_cast("decimal(13,5)")), 4).cast("decimal(18,4)")
