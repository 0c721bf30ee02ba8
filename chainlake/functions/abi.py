"""Fields of EVM logs from their hex words, as column expressions; only 256-bit integers need Python, in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 64


def topic(i: int) -> Column:
    """The i-th topic in lower case, or null."""
    return F.lower(F.try_element_at(F.col("topics"), F.lit(i + 1)))


def topic_word(i: int) -> Column:
    return F.substring(topic(i), 3, WORD)


def data_word(i: int) -> Column:
    return F.lower(F.substring(F.col("data"), 3 + WORD * i, WORD))


def hex_long(c: Column) -> Column:
    """A "0x" string, or a decimal one, as a long; null if it is neither."""
    digits = F.when(c.rlike("^0[xX][0-9a-fA-F]{1,15}$"), F.conv(F.substring(c, 3, 16), 16, 10))
    return F.coalesce(digits, F.when(c.rlike("^[0-9]{1,18}$"), c)).cast("long")


def hex_string(c: Column) -> Column:
    """Binary as "0x" and lower-case hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


def address(word: Column) -> Column:
    return F.concat(F.lit("0x"), F.substring(word, 25, 40))


def small_int(word: Column, bits: int, signed: bool = False) -> Column:
    """An integer of up to 24 bits."""
    digits = bits // 4
    value = F.conv(F.substring(word, WORD - digits + 1, digits), 16, 10).cast("long")
    if signed:
        value = F.when(value >= 1 << (bits - 1), value - F.lit(1 << bits)).otherwise(value)
    return value.cast("int")


def wide_int(word: Column, signed: Column) -> Column:
    """A 256-bit word as a decimal string."""

    def convert(words: pd.Series, signs: pd.Series) -> pd.Series:
        top, full = 1 << 255, 1 << 256
        values = ((None if w is None else int(w, 16), s) for w, s in zip(words, signs, strict=True))
        return pd.Series([None if v is None else str(v - full if s and v >= top else v) for v, s in values], dtype=object)

    return F.pandas_udf(convert, "string")(word, signed)


#: What a word of each type looks like; integers narrower than a word are padded with zeros, or with their sign.
FORMS = {
    "address": "^0{24}[0-9a-f]{40}$",
    "uint8": "^0{62}[0-9a-f]{2}$",
    "uint16": "^0{60}[0-9a-f]{4}$",
    "int24": "^(0{58}[0-7]|f{58}[89a-f])[0-9a-f]{5}$",
    "bool": "^0{63}[01]$",
    "uint256": "^[0-9a-f]{64}$",
    "int256": "^[0-9a-f]{64}$",
}
WIDE = {"uint256": False, "int256": True}


def valid(word: Column, kind: str) -> Column:
    return word.rlike(FORMS[kind])


def value(word: Column, kind: str) -> Column:
    """The value of a valid word of a narrow type."""
    if kind == "address":
        return address(word)
    if kind == "bool":
        return F.substring(word, WORD, 1) == "1"
    return small_int(word, int(kind.lstrip("uint")), kind.startswith("int"))
