"""Text column expressions: numbers, amounts, distances, dates and status words in Spanish listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentlens.functions.numeric import as_col

# fixed values: words and patterns of the listing site
FURNISHED_PATTERN = r"(?i)amoblad[oa]|amueblad[oa]"
LISTING_ID_PATTERN = r"(MLC-\d+)"
YES_WORDS = ["sí", "si", "true", "1", "1.0"]
NO_WORDS = ["no", "false", "0", "0.0"]
DAYS_THIS_WEEK = 3
INCLUDED_BELOW = 1000
AMOUNT_CEILING = 500_000

MOST_DAYS_BACK = 2000 * 365


def capture(text: Column | str, pattern: str, group: int = 1) -> Column:
    """First capture of ``pattern``, null (not '') when there is none."""
    return F.nullif(F.regexp_extract(as_col(text), pattern, group), F.lit(""))


def to_number(c: Column | str) -> Column:
    """Number of a text; null when it is none, or not finite."""
    value = F.trim(as_col(c).cast("string")).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def to_integer(c: Column | str) -> Column:
    """Integer part of a number text; null when it is not a number or no 32-bit integer."""
    return to_number(c).try_cast("int")


def decimal_comma(c: Column | str) -> Column:
    return F.replace(F.trim(as_col(c)), F.lit(","), F.lit(".")).try_cast("double")


def digits_only(c: Column | str) -> Column:
    return F.nullif(F.regexp_replace(as_col(c), "[^0-9]", ""), F.lit("")).try_cast("double")


def local_amount(c: Column | str) -> Column:
    """Monthly charge text to a number: dots group thousands, small undotted values mean 'included' (0)."""
    text = F.trim(as_col(c))
    dotted = F.contains(text, F.lit("."))
    undotted = F.when(dotted, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    number = F.replace(undotted, F.lit(","), F.lit(".")).try_cast("double")
    return F.when((number < INCLUDED_BELOW) & ~dotted, F.lit(0.0)).when(number <= AMOUNT_CEILING, number)


def distance_metres(c: Column | str) -> Column:
    """'15 metros' / '1.2 km' to metres. A dot before exactly three digits groups thousands; other dots are decimal."""
    pattern = r"(?i)([\d.,]+)\s*(metros|km)"
    raw = capture(c, pattern, 1)
    plain = F.regexp_replace(raw, r"\.(?=\d{3}(?!\d))", "")
    value = F.replace(plain, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.lower(capture(c, pattern, 2)) == "km", value * 1000).otherwise(value)


def relative_date(c: Column | str, as_of: Column | str) -> Column:
    """Date meant by 'hoy', 'esta semana' or 'N día/semana/mes/año', counted back from ``as_of``; null beyond two thousand years."""
    text = F.lower(F.trim(as_col(c)))
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    pattern = r"(\d+)\s*(día|dias|semana|mes|año)"
    n = capture(text, pattern, 1).try_cast("int")
    unit = capture(text, pattern, 2)
    days = F.when(unit.isin("día", "dias"), 1).when(unit == "semana", 7).when(unit == "mes", 30).when(unit == "año", 365)
    back = F.when(text == "hoy", 0).when(text == "esta semana", DAYS_THIS_WEEK).otherwise(F.try_multiply(n, days))
    return F.when(back <= MOST_DAYS_BACK, F.date_sub(as_of, back))


def date_precision(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(F.lower(F.trim(c)) == "esta semana", F.lit("aproximada_categoria")).when(F.length(c) > 0, F.lit("exacta"))


def strip_accents_lower(c: Column | str) -> Column:
    return F.translate(F.trim(F.lower(as_col(c))), "áéíóúñ", "aeioun")


def upper_ascii(c: Column | str) -> Column:
    """Upper case with accents removed and any other non-ASCII character dropped."""
    plain = F.translate(F.upper(F.trim(as_col(c))), "ÁÉÍÓÚÑÜÀÈÌÒÙÂÊÎÔÛÄËÏÖÇÃÕ", "AEIOUNUAEIOUAEIOUAEIOCAO")
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "")


def text_flag(c: Column | str, pattern: str = FURNISHED_PATTERN) -> Column:
    return F.coalesce(as_col(c).rlike(pattern), F.lit(False)).cast("int")


def listing_id(url: Column | str) -> Column:
    return capture(url, LISTING_ID_PATTERN)


def yes_no(c: Column | str, default: bool | None = None) -> Column:
    text = F.lower(F.trim(as_col(c).cast("string")))
    known = F.when(text.isin(YES_WORDS), F.lit(True)).when(text.isin(NO_WORDS), F.lit(False))
    return known if default is None else F.coalesce(known, F.lit(default))


def status_word(message: Column | str) -> Column:
    """State told by a status message; an unknown message still means the listing is not active."""
    text = F.lower(as_col(message))
    return (
        F.when(text.isNull(), F.lit("activo"))
        .when(F.contains(text, F.lit("pausad")), F.lit("pausado"))
        .when(F.contains(text, F.lit("finaliz")), F.lit("finalizado"))
        .otherwise(F.lit("pausado"))
    )


def _plural(n: Column, one: str, many: str) -> Column:
    return F.when(n == 1, F.lit(one)).otherwise(F.lit(many))


def age_label(d: Column | str, as_of: str) -> Column:
    """Age in words: today, days, 30-day months, 365-day years."""
    days = F.datediff(F.lit(as_of).cast("date"), as_col(d))
    months, years = F.floor(days / 30), F.floor(days / 365)
    return (
        F.when(days.isNull(), F.lit("Publicado: fecha no disponible"))
        .when(days <= 0, F.lit("Publicado: hoy"))
        .when(days == 1, F.lit("Publicado: hace 1 día"))
        .when(days < 30, F.concat(F.lit("Publicado: hace "), days.cast("string"), F.lit(" días")))
        .when(days < 365, F.concat(F.lit("Publicado: hace "), months.cast("string"), F.lit(" mes"), _plural(months, "", "es")))
        .otherwise(F.concat(F.lit("Publicado: hace "), years.cast("string"), F.lit(" año"), _plural(years, "", "s")))
    )


def checked_label(d: Column | str, as_of: str) -> Column:
    days = F.datediff(F.lit(as_of).cast("date"), as_col(d))
    return (
        F.when(days.isNull(), F.lit("Datos verificados: fecha desconocida"))
        .when(days <= 0, F.lit("Datos verificados: hoy"))
        .when(days == 1, F.lit("Datos verificados: hace 1 día"))
        .otherwise(F.concat(F.lit("Datos verificados: hace "), days.cast("string"), F.lit(" días")))
    )


def thousands(c: Column | str) -> Column:
    """1234567.2 to '1.234.567'."""
    return F.translate(F.format_number(F.bround(as_col(c), 0), 0), ",", ".")


def place_label(slug: Column | str, district: Column | str, suffix: str = "-biobio") -> Column:
    town = F.initcap(F.replace(F.replace(as_col(slug), F.lit(suffix), F.lit("")), F.lit("-"), F.lit(" ")))
    d = as_col(district)
    return F.when(F.length(F.trim(d)) > 0, F.concat(d, F.lit(", "), town)).otherwise(town)


def canonical_hash8(*columns: str) -> Column:
    """First 8 hex digits of the SHA-256 of the columns as JSON with sorted keys."""
    packed = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))
    return F.substring(F.sha2(packed, 256), 1, 8)


def version_id(counter: Column, stamp: Column, algorithm: Column, digest: Column) -> Column:
    return F.concat(F.format_string("v%04d_", counter.cast("int")), stamp, F.lit("_"), algorithm, F.lit("_"), digest)


def match_check(canonical: Column | str, og_url: Column | str, listing: Column | str) -> Column:
    """True when both the canonical link and the og:url name the listing."""
    listing = as_col(listing)
    return F.coalesce(F.contains(as_col(canonical), listing) & F.contains(as_col(og_url), listing), F.lit(False))


def block_check(html: Column | str, text: Column | str, content_pattern: str, word: str = "captcha", head: int = 8000) -> Column:
    """True when ``word`` is near the top of the page and none of the normal content is present."""
    top = F.substring(F.lower(as_col(html)), 1, head)
    return F.contains(top, F.lit(word)) & ~F.coalesce(as_col(text).rlike(content_pattern), F.lit(False))
