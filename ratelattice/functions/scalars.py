"""Column functions used by the operators; all evaluate inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles, month ranges, status words and rejection texts.
MONTH_RANGES = {1: "JAN-MAR", 2: "APR-JUN", 3: "JUL-SEP", 4: "OCT-DEC"}
QUARTER_NAMES = {1: "Q1", 2: "Q2", 3: "Q3", 4: "Q4"}
OVERFLOW_TEXT = "JAN-MAR"
PLACEHOLDER = "Add a sub group"
TITLE, TITLE_INDEX, ICON = "PL", "baserate", "Icon"
SUCCESS, FAILURE = "SUCCESS", "FAILURE"
UNAUTHORIZED = "User Not Authorized !"
DISPLAY_MINUTES = "yyyy-MM-dd HH:mm"
HISTORY_MINUTES = "MM/dd/yyyy HH:mm"
STORED_NAME_MINUTES = "yyyyMMddHHmm"


def _choose(value: Column, texts: dict[int, str], otherwise: str) -> Column:
    result = F.lit(otherwise)
    for number, text in texts.items():
        result = F.when(value == number, text).otherwise(result)
    return result


def quarter_of(ts: Column) -> Column:
    return F.quarter(ts)


def month_range(quarter: Column) -> Column:
    return _choose(quarter, MONTH_RANGES, OVERFLOW_TEXT)


def quarter_name(quarter: Column) -> Column:
    """Q1..Q4; a quarter outside 1..4 reads JAN-MAR, as it always has."""
    return _choose(quarter, QUARTER_NAMES, OVERFLOW_TEXT)


def fiscal_suffix(ts: Column) -> Column:
    return F.right(F.year(ts).cast("string"), F.lit(2))


def base_rates_title(ts: Column) -> Column:
    return F.concat(F.lit("BASE RATES FY"), fiscal_suffix(ts))


def effective_title(ts: Column, ahead: int = 0, wrap: bool = False) -> Column:
    """"Effective APR-JUN 2024 (Q2)" for the quarter ``ahead`` quarters after ``ts``.

    Without ``wrap`` the quarter number runs past 4 and the year stays, so one
    quarter after Q4 reads "Effective JAN-MAR yyyy (JAN-MAR)".
    """
    number = F.quarter(ts) + ahead
    year = F.year(ts)
    if wrap:
        year = year + F.floor((number - 1) / 4).cast("int")
        number = (number - 1) % 4 + 1
    return F.concat(
        F.lit("Effective "), month_range(number), F.lit(" "), year.cast("string"), F.lit(" ("), quarter_name(number), F.lit(")")
    )


def strip_quotes(label: Column) -> Column:
    return F.translate(label, '"', "")


def not_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def upload_path(original: Column) -> Column:
    """The name with "/" between folders and without "." folders."""
    return F.regexp_replace(F.replace(original, F.lit("\\"), F.lit("/")), r"(^|/)(\./)+", "$1")


def attachment_error(original: Column) -> Column:
    """Why an upload name cannot be stored; null when it can."""
    name = upload_path(original)
    return F.when(name.isNull() | name.rlike(r"^[^.]*\.*$"), "NO_EXTENSION").when(F.contains(name, F.lit("..")), "INVALID_PATH")


def stored_attachment_name(original: Column, ts: Column) -> Column:
    """First two dot-parts with the upload minute between them."""
    parts = F.split(upload_path(original), r"\.")
    name = F.concat(
        F.get(parts, F.lit(0)), F.lit("_"), F.date_format(ts, STORED_NAME_MINUTES), F.lit("."), F.get(parts, F.lit(1))
    )
    return F.when(attachment_error(original).isNull(), name)


def cookie_user(cookie: Column) -> Column:
    """User name inside the third part of a session cookie; null when it cannot be read."""
    token = F.translate(F.get(F.split(cookie, r"\|"), F.lit(2)), "-_", "+/")
    text = F.try_validate_utf8(F.try_to_binary(token, F.lit("base64")).cast("string"))
    return F.get_json_object(text, "$.id_token.user_name")


def cookie_error(cookie: Column) -> Column:
    return F.when(cookie_user(cookie).isNull(), UNAUTHORIZED)


def rate_request(raw: Column) -> Column:
    """JSON request text to ``struct(rate, note)``."""
    return F.from_json(raw, "rate decimal(18,4), note string", {"mode": "PERMISSIVE"})


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or ISO text to a zone-less timestamp; null when neither."""
    return text.try_cast("timestamp_ntz")


def rate_text(rate: Column) -> Column:
    """Cell text of a rate; a cell without history is empty."""
    return F.coalesce(rate.cast("string"), F.lit(""))
