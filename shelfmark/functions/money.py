"""Money as whole minor units. Decimals only: no value passes through a double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import trimmed

# Currencies whose minor unit is not a hundredth.
EXPONENTS = {
    "ADP": 0, "AFN": 0, "ALL": 0, "BHD": 3, "BIF": 0, "BYR": 0, "CLF": 4, "CLP": 0, "DJF": 0,
    "ESP": 0, "GNF": 0, "IQD": 0, "IRR": 0, "ISK": 0, "ITL": 0, "JOD": 3, "JPY": 0, "KMF": 0,
    "KPW": 0, "KRW": 0, "KWD": 3, "LAK": 0, "LBP": 0, "LUF": 0, "LYD": 3, "MGA": 0, "MGF": 0,
    "MMK": 0, "MRO": 0, "OMR": 3, "PYG": 0, "RSD": 0, "RWF": 0, "SLL": 0, "SOS": 0, "STD": 0,
    "SYP": 0, "TMM": 0, "TND": 3, "TRL": 0, "UGX": 0, "UYI": 0, "UYW": 4, "VND": 0, "VUV": 0,
    "XAF": 0, "XOF": 0, "XPF": 0, "YER": 0, "ZMK": 0, "ZWD": 0,
}
DEFAULT_EXPONENT = 2


def currency_code(currency: Column) -> Column:
    return F.upper(trimmed(currency))


def is_currency(currency: Column) -> Column:
    return currency_code(currency).rlike(r"^[A-Z]{3}\z")


def order_currency(order_code: Column, base_code: Column) -> Column:
    """The currency the shopper was charged in; the base currency when that is blank."""
    code = currency_code(F.coalesce(order_code, F.lit("")))
    return F.when(code != "", code).otherwise(currency_code(F.coalesce(base_code, F.lit(""))))


def exponent_of(currency: Column) -> Column:
    """Decimal places of the currency's minor unit. Wherever several amounts of a row are scaled, project it once
    and pass it on as ``places``."""
    code = currency_code(currency)
    result = F.lit(DEFAULT_EXPONENT)
    for exponent in sorted(set(EXPONENTS.values())):
        members = [name for name, places in EXPONENTS.items() if places == exponent]
        result = F.when(code.isin(members), exponent).otherwise(result)
    return result


def _scale_of(places: Column) -> Column:
    """10 ** exponent as a decimal; ``power`` would return a double."""
    result = F.lit(10**DEFAULT_EXPONENT).cast("decimal(5,0)")
    for exponent in sorted(set(EXPONENTS.values())):
        result = F.when(places == exponent, F.lit(10**exponent).cast("decimal(5,0)")).otherwise(result)
    return result


def round_minor(amount: Column, currency: Column, places: Column | None = None) -> Column:
    """A decimal amount in minor units, rounded half away from zero. A stored amount,
    DECIMAL(12,4), scales to 18 digits, which Spark computes as a long."""
    return F.round(amount * _scale_of(exponent_of(currency) if places is None else places), 0).try_cast("bigint")


def amount_parts(amount: Column) -> Column:
    """A text amount as a struct of its digits; null unless it is a plain decimal.

    The same for every currency, so a row that is asked in several reads its text once. ``units`` is the whole part
    where that and four places fit a long for certain, ``first`` the first five digits after the point.
    """
    text = trimmed(amount)
    bare = F.ltrim(text, F.lit("-"))
    whole = F.substring_index(bare, ".", 1)
    spare = F.when(F.instr(bare, ".") > 0, F.substring_index(bare, ".", -1)).otherwise("")
    parts = F.struct(
        text.startswith("-").alias("negative"),
        whole.alias("whole"),
        spare.alias("spare"),
        F.when(F.length(whole) <= 14, whole.try_cast("bigint")).alias("units"),
        F.rpad(F.substring(spare, 1, 5), 5, "0").try_cast("bigint").alias("first"),
    )
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?\z"), parts)


def _power_of(places: Column, most: int = 0) -> Column:
    """10 ** places, or 10 ** (most - places), as a long."""
    result = F.lit(10 ** abs(most - DEFAULT_EXPONENT))
    for exponent in sorted(set(EXPONENTS.values())):
        result = F.when(places == exponent, 10 ** abs(most - exponent)).otherwise(result)
    return result.cast("bigint")


def minor_of(parts: Column, places: Column) -> Column:
    """The minor units of ``amount_parts``, rounded half away from zero. No amount is 0; one of more minor units than a long holds is null.

    Rounding looks at the one digit after the exponent. Where the whole part is too long for a long, digits are joined as
    text up to the exponent, so that no amount is too long to be exact.
    """
    most = max(EXPONENTS.values())
    short = parts["units"] * _power_of(places) + F.floor((F.floor(parts["first"] / _power_of(places, most)) + 5) / 10)
    digits = F.concat(parts["whole"], F.rpad(F.substring(parts["spare"], F.lit(1), places), places, F.lit("0")))
    up = F.when(F.substring(parts["spare"], places + 1, F.lit(1)) >= "5", 1).otherwise(0)
    wide = F.try_add(digits.try_cast("decimal(38,0)").cast("decimal(38,0)"), up.cast("decimal(1,0)"))
    wide = F.when(parts["negative"], -wide).otherwise(wide).try_cast("bigint")
    minor = F.when(parts["units"].isNotNull(), F.when(parts["negative"], -short).otherwise(short)).otherwise(wide)
    return F.when(parts.isNotNull(), minor).otherwise(F.lit(0).cast("bigint"))


def round_minor_text(amount: Column, currency: Column, places: Column | None = None) -> Column:
    """The same for text. What is not a plain decimal counts as 0; what is one but has
    more minor units than a long holds is null."""
    return minor_of(amount_parts(F.coalesce(amount, F.lit(""))), exponent_of(currency) if places is None else places)


def strict_minor_reject(amount: Column, currency: Column) -> Column:
    """Why a text amount cannot be converted without changing it; null when it can."""
    text = trimmed(amount)
    spare = F.substring(
        F.regexp_extract(text, r"^[0-9]+\.([0-9]+)\z", 1), exponent_of(currency) + 1, F.length(text)
    )
    return (
        F.when(text.isNull() | ~text.rlike(r"^[0-9]+(\.[0-9]+)?\z"), "malformed amount")
        .when(~F.coalesce(is_currency(currency), F.lit(False)), "bad currency")
        .when(F.rtrim(spare, F.lit("0")) != "", "too many decimals")
        .when(round_minor_text(amount, currency).isNull(), "too large")
    )


def strict_minor(amount: Column, currency: Column) -> Column:
    """A text amount in minor units, null wherever ``strict_minor_reject`` has a reason."""
    return F.when(strict_minor_reject(amount, currency).isNull(), round_minor_text(amount, currency))


def minor_input_reject(minor: Column, currency: Column) -> Column:
    """Why a text value is not a usable number of minor units; null when it is."""
    text = minor.cast("string")
    return (
        F.when(text.isNull() | ~text.rlike(r"^-?[0-9]+\z"), "not a whole number")
        .when(text.startswith("-") & (text.try_cast("decimal(38,0)") < 0), "negative")
        .when(~F.coalesce(is_currency(currency), F.lit(False)), "bad currency")
    )


def line_value(total: Column, discount: Column, currency: Column, places: Column | None = None) -> Column:
    """What was paid for one order line: both amounts are scaled first, then subtracted."""
    nothing = F.lit(0).cast("decimal(12,4)")
    minor = lambda amount: round_minor(F.coalesce(amount, nothing), currency, places)
    return F.greatest(F.lit(0).cast("bigint"), minor(total) - minor(discount))
