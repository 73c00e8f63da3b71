"""Text to numbers and times, as the marketplace exports write them. Bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: month names of the exports ---
MONTH_NAMES = ("ocak", "subat", "mart", "nisan", "mayis", "haziran", "temmuz", "agustos", "eylul", "ekim", "kasim", "aralik")
MONTH_SHORT = ("Oca", "Şub", "Mar", "Nis", "May", "Haz", "Tem", "Ağu", "Eyl", "Eki", "Kas", "Ara")
# --- end of fixed values ---


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_double(text: Column) -> Column:
    """Double or null; texts that spell NaN or infinity are null too."""
    return F.regexp_extract(F.trim(text), NUMBER, 0).try_cast("double")


def locale_number(text: Column, flavor: str = "report") -> Column:
    """'1.154', '2,17', '+ 47', '-' as numbers.

    report: dots are thousands separators only where a comma is present.
    ads: dots are always thousands separators.
    """
    if flavor == "ads":
        plain = F.replace(text, F.lit("."), F.lit(""))
    elif flavor == "report":
        unsigned = F.replace(text, F.lit("+"), F.lit(""))
        plain = F.when(F.contains(unsigned, F.lit(",")), F.replace(unsigned, F.lit("."), F.lit(""))).otherwise(unsigned)
    else:
        raise ValueError(f"unknown number flavor {flavor!r}")
    return as_double(F.replace(plain, F.lit(","), F.lit(".")))


def _wall_clock(text: Column, pattern: str) -> Column:
    """Day, month, year, hour and minute groups as wall-clock time."""
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, "$3-$2-$1 $4:$5:00").try_cast("timestamp_ntz"))


def report_timestamp(text: Column) -> Column:
    """'dd.MM.yyyy HH:mm' as wall-clock time."""
    return _wall_clock(F.trim(text), r"^(\d{1,2})\.(\d{1,2})\.(\d{4}) (\d{1,2}):(\d{1,2})$")


def report_day(text: Column) -> Column:
    """'dd-MM-yyyy HH:mm' as a date."""
    return F.to_date(_wall_clock(F.trim(text), r"^(\d{1,2})-(\d{1,2})-(\d{4}) (\d{1,2}):(\d{1,2})$"))


def month_header(text: Column) -> Column:
    """'Nis 2026' as the first day of the month."""
    names = F.create_map(*[x for i, m in enumerate(MONTH_SHORT) for x in (F.lit(m), F.lit(i + 1))])
    month = F.try_element_at(names, F.split_part(text, F.lit(" "), F.lit(1)))
    year = F.split_part(text, F.lit(" "), F.lit(2)).try_cast("int")
    return F.when(month.isNotNull() & year.isNotNull(), F.make_date(year, month, F.lit(1)))
