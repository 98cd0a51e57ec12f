"""Scalar text functions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

#: Letters with marks and their plain forms, pair by pair.
MARKED = "àáâäãåçèéêëìíîïñòóôöõùúûüýÿÀÁÂÄÃÅÇÈÉÊËÌÍÎÏÑÒÓÔÖÕÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"

#: Shapes of dashes.
DASHES = "‐‑‒–—―-"

#: Letters that readers give for digits, and the digits.
LOOKALIKES = "oOlIiSsBZz"
LOOKED_LIKE = "0011155822"

#: Roman numerals' parts and their worth.
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}

#: Names of the months in the edition's language.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")

#: Days a month can have; the year may be a leap year.
MONTH_DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def tokens(text: Column) -> Column:
    """FN-09: words between white space, in order."""
    return F.filter(F.split(text, r"[ \t\n\r\f]+"), lambda x: x != "")


def strip_accents(text: Column) -> Column:
    """FN-02 for Latin letters."""
    return F.translate(text, MARKED, PLAIN)


def nfc(text: Column) -> Column:
    """FN-01: canonical composition, trimmed.  Spark has no such function, so texts go to Python in Arrow batches."""
    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFC").str.strip()

    return compose(text)


def fold_search(text: Column) -> Column:
    """FN-03: lower case without accents, character for character; the text itself if a length changed."""
    folded = F.translate(F.lower(text), MARKED, PLAIN)
    return F.when(F.length(folded) == F.length(text), folded).otherwise(text)


def case_only_difference(a: Column, b: Column) -> Column:
    """FN-04"""
    return (a != b) & (F.lower(a) == F.lower(b))


def fold_span(text: Column) -> Column:
    """FN-05: no white space, one dash shape, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"[ \t\n\r\f]+", ""), f"[{DASHES}]", "—"))


def word_key(text: Column) -> Column:
    """FN-06: letters and digits without accents."""
    return F.regexp_replace(strip_accents(F.lower(text)), "[^0-9a-z]", "")


def same_word(a: Column, b: Column) -> Column:
    return (word_key(a) == word_key(b)) & (F.length(word_key(a)) >= 3)


def compress(text: Column) -> Column:
    """FN-07: lower case, no accents, one space for anything else than letters and digits."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(text)), "[^0-9a-z]+", " "))


def digits_of(text: Column) -> Column:
    """FN-12: letters that stand for digits as digits."""
    return F.translate(text, LOOKALIKES, LOOKED_LIKE)


def years_in(text: Column, first: int = 1229, last: int = 1800) -> Column:
    """FN-13: four-digit numbers in a range of years."""
    found = F.regexp_extract_all(digits_of(F.regexp_replace(text, r"[.,]", "")), F.lit(r"(\d{4})"), 1)
    return F.filter(F.transform(found, lambda x: x.cast("int")), lambda y: y.between(first, last))


def from_roman(numeral: Column) -> Column:
    """FN-14: a smaller part before a larger one counts negative."""
    values = F.transform(F.split(F.upper(numeral), ""), lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv]), c), F.lit(0)))
    signed = F.transform(values, lambda v, i: F.when(v < F.coalesce(F.get(values, i + 1), F.lit(0)), -v).otherwise(v))
    return F.aggregate(signed, F.lit(0), lambda a, v: a + v)


def as_day(token: Column) -> Column:
    """FN-15: 1 to 31, else null."""
    day = F.regexp_replace(digits_of(token), "[^0-9]", "").try_cast("int")
    return F.when(day.between(1, 31), day)


def valid_day(month: Column, day: Column) -> Column:
    """FN-16"""
    return day.between(F.lit(1), F.element_at(F.array(*map(F.lit, MONTH_DAYS)), month))


def month_of(token: Column) -> Column:
    """FN-10: the month a token names: contains it, or has its length and at most two other letters, or is one edit away; the first that fits."""
    word = F.lower(token)
    fits = [
        F.when(word.contains(name), number)
        .when((F.length(word) == len(name)) & (F.size(F.filter(F.zip_with(F.split(word, ""), F.split(F.lit(name), ""), lambda x, y: x != y), lambda d: d)) <= 2), number)
        .when(F.levenshtein(word, F.lit(name)) <= 1, number)
        for number, name in enumerate(MONTHS, 1)
    ]
    return F.coalesce(*fits)


def slug(text: Column) -> Column:
    """FN-20"""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def grouped_number(number: Column) -> Column:
    """FN-21: '.' between thousands."""
    return F.translate(F.format_number(number, 0), ",", ".")


def escape_html(text: Column) -> Column:
    """FN-22"""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def snippet(text: Column, at: Column, length: Column, around: int = 110) -> Column:
    """FN-23: what stands around a match at the 1-based place ``at``, with ellipses where it is cut."""
    low = F.greatest(at - around, F.lit(1))
    high = F.least(at + length - 1 + around, F.length(text))
    body = F.substring(text, low, high - low + 1)
    return F.concat(F.when(low > 1, "…").otherwise(""), body, F.when(high < F.length(text), "…").otherwise(""))


def genre(title: Column) -> Column:
    """FN-24: the first word that starts upper case."""
    return F.regexp_extract(title, r"([A-Z][a-z]+)", 1)


def density_height(n: Column, peak: Column, tall: float = 100.0, stub: float = 2.0) -> Column:
    """FN-25: heights grow as the root; a year without entries keeps a stub."""
    return F.when(n > 0, F.round(F.sqrt(n / peak) * tall, 2)).otherwise(F.lit(stub))


def reading_form(text: Column) -> Column:
    """FN-27"""
    return F.translate(text, "ſ", "s")


def siglum_key(siglum: Column) -> Column:
    """FN-17: its groups of one or two capitals; of three groups whose first two are alike, one."""
    groups = F.regexp_extract_all(siglum, F.lit("([A-Z]{1,2})"), 1)
    twice = (F.size(groups) == 3) & (F.get(groups, F.lit(0)) == F.get(groups, F.lit(1)))
    return F.when(twice, F.slice(groups, 2, 2)).otherwise(groups)


def table_label(text: Column) -> Column:
    """FN-18: a row's text without the figure at its end."""
    return F.trim(F.regexp_replace(text, TABLE_FIGURE, ""))


def table_figure(text: Column) -> Column:
    return F.trim(F.regexp_extract(text, TABLE_FIGURE, 0))


#: A figure at the end of a row, perhaps with a unit behind it.
TABLE_FIGURE = r"[0-9][0-9.,]*( [a-z]{1,3}\.?)?$"


def anchor_key(text: Column) -> Column:
    """FN-29"""
    return F.substring(compress(text), 1, 48)


def box_key(page: Column, *corners: Column) -> Column:
    """FN-30: page and corners to five places."""
    return F.concat(page.cast("string"), F.lit(":"), F.concat_ws(",", *[F.format_string("%.5f", c) for c in corners]))


def century(year: Column) -> Column:
    """FN-26"""
    return (F.floor((year - 1) / 100) + 1).cast("int")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def small_caps(paragraph: Column) -> Column:
    """FN-28: a month that heads a paragraph in upper case, and a tight dash after it."""
    name = F.regexp_extract(paragraph, "(?i)^(" + "|".join(MONTHS) + ")", 1)
    rest = F.regexp_replace(F.substring(paragraph, F.length(name) + 1, F.lit(2_147_483_647)), r"^\s*—\s*", "—")
    return F.when(name != "", F.concat(F.upper(name), rest)).otherwise(paragraph)


def sentences(text: Column) -> Column:
    """FN-32: cut after a closing mark that an upper-case letter follows."""
    return F.split(text, r"(?<=[.!?])\s+(?=[A-ZÁÉÍÓÚÑ¿¡])")


def mark_doubt(text: Column, doubtful: Column) -> Column:
    """FN-33: words whose bare form is in a map of doubtful ones, with the variants in brackets."""
    bare = lambda w: F.regexp_replace(w, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "")
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(F.concat(w, F.lit(" ["), F.try_element_at(doubtful, bare(w)), F.lit("]")), w)), " ")


def page_normalise(text: Column) -> Column:
    """FN-08: no-break spaces as spaces, no header lines (=== ... ===), hyphens at line ends stitched, blank lines closed up."""
    clean = F.regexp_replace(F.translate(text, "\u00a0", " "), r"(?m)^===.*===$\n?", "")
    return F.trim(F.regexp_replace(F.regexp_replace(clean, r"[-‐]\n", ""), r"\n{2,}", "\n"))
