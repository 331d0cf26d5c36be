"""Text, path and payload expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: service, year and month in the name of a monthly trip file.
MONTH_FILE = r"(green|yellow)_tripdata_(\d{4})-(\d{2})"


def zero_fill(value: Column, width: int) -> Column:
    """Pads with zeros on the left; unlike ``lpad`` it never cuts a longer value."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def base64_line(payload: Column | str) -> Column:
    """Base64 on one line, whatever the session says about chunking."""
    return F.replace(F.base64(payload), F.lit("\r\n"), F.lit(""))


def base64_length(payload: Column | str) -> Column:
    """Length of ``base64_line`` without encoding: four letters for every three bytes begun."""
    return F.ceil(F.octet_length(payload) / 3) * 4


def base64_bytes(text: Column | str) -> Column:
    """Decoded bytes, null for text that is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def object_path(prefix: str, year: Column, month: Column, day: Column, name: Column, ext: str) -> Column:
    """``prefix/year/month/day/name.ext`` from text parts; null if any part is missing."""
    return F.concat(
        F.lit(f"{prefix}/"), year, F.lit("/"), month, F.lit("/"), day, F.lit("/"), name, F.lit(f".{ext}")
    )


def day_path(prefix: str, day: Column) -> Column:
    """``prefix/yyyy/MM/dd`` with month and day on two digits."""
    return F.format_string(f"{prefix}/%04d/%02d/%02d", F.year(day), F.month(day), F.day(day))


def month_file_parts(path: Column) -> dict[str, Column]:
    """Service, year and month read off the name of a monthly file."""
    return {
        "service": F.regexp_extract(path, MONTH_FILE, 1),
        "year": F.regexp_extract(path, MONTH_FILE, 2),
        "month": F.regexp_extract(path, MONTH_FILE, 3),
    }


def service_type(name: Column) -> Column:
    """1 for a name with ``yellow``, 2 for one with ``green``, else null."""
    return F.when(name.contains("yellow"), F.lit(1)).when(name.contains("green"), F.lit(2))
