"""Product display names: built-in string expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: colour words cut from the front of a name ---
COLOURS = (
    "Pembe", "Kırmızı", "Beyaz", "Siyah", "Krem", "Ekru", "Bordo", "Bebe Mavi", "Mavi", "Sarı", "Haki", "Lacivert",
    "Yeşil", "Mor", "Lila", "Gri", "Turuncu", "Fuşya", "Altın", "Gümüş", "Kahverengi", "Vizon", "Pudra", "Somon", "Turkuaz",
)
# --- end of fixed values ---


def head_before(name: Column, stops: tuple[str, ...]) -> Column:
    """Text before the first of the given stop strings."""
    pattern = "|".join("\\Q" + s + "\\E" for s in stops)
    return F.split(name, pattern, 2)[0]


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def short_name(name: Column) -> Column:
    """Names over 60 characters lose everything from a spaced dash, a bar or a gift note on; 70 characters at most."""
    cut = F.when(F.length(name) > 60, head_before(name, (" – ", "|", "-Hediye", " -Hediye"))).otherwise(name)
    return F.substring(cut, 1, 70)


def clean_name(name: Column, colours: tuple[str, ...] = COLOURS) -> Column:
    """Name without its leading colour, up to the first separator; 48 characters at most."""
    plain = strip(F.regexp_replace(name, "^(" + "|".join(colours) + r")[\s,-]+", ""))
    return F.substring(strip(head_before(plain, (",", "|", "(", " - ", "– "))), 1, 48)


def with_override(df: DataFrame, overrides: DataFrame | None, code: str, name: str) -> DataFrame:
    """Names listed in `overrides` (code, name) win over derived ones."""
    if overrides is None:
        return df
    fixed = overrides.select(F.col("code").alias(code), F.col("name").alias("_fixed"))
    return df.join(fixed, code, "left").withColumn(name, F.coalesce("_fixed", name)).drop("_fixed")
