"""Number and label text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_text(number: Column, digits: int) -> Column:
    """The number with exactly `digits` decimals; null stays null."""
    return F.round(number, digits).cast(f"decimal(30,{digits})").cast("string")


def signed_text(number: Column) -> Column:
    """One decimal with a leading sign when positive; `-` for null."""
    text = F.concat(F.when(number > 0, F.lit("+")).otherwise(F.lit("")), fixed_text(number, 1))
    return F.coalesce(text, F.lit("-"))


def _label(word: Column) -> Column:
    head = F.upper(F.substring(word, 1, 1))
    tail = F.substring(word, 2, 2147483647)
    return F.concat(head, F.regexp_replace(tail, "^([^_]*)_", "$1 "))


def label_text(labels: Column) -> Column:
    """Readable list: capitalised, the first underscore of each label a space."""
    return F.when(labels.isNull(), F.lit("N/A")).otherwise(
        F.array_join(F.transform(labels, _label), ", ")
    )


def label_text_from_json(text: Column) -> Column:
    """As `label_text` for labels stored as JSON text; other text is shown as it is."""
    labels = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    return F.when(text.isNull() | (text == ""), F.lit("N/A")).otherwise(
        F.when(labels.isNotNull(), label_text(labels)).otherwise(text)
    )
