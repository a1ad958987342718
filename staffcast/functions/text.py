"""String, list and date expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffcast import settings as S

# Letters without a decomposition, with their usual spelling in plain letters (fixed values).
SPELLED_OUT = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}

# Tokens are runs of two or more word characters of any script (fixed value).
TOKEN_PATTERN = r"(?U)\w\w+"
# The same runs in a text of ASCII characters alone, found several times as fast.
ASCII_TOKEN_PATTERN = r"\w\w+"

# Spellings of a day that are understood, tried in this order; a time may follow the first.
DAY_PATTERNS = (
    (r"^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$", "yyyy-MM-dd"),
    (r"^(\d{4}/\d{2}/\d{2})$", "yyyy/MM/dd"),
    (r"^(\d{8})$", "yyyyMMdd"),
    (r"^(\d{2}/\d{2}/\d{4})$", "dd/MM/yyyy"),
    (r"^(\d{2}\.\d{2}\.\d{4})$", "dd.MM.yyyy"),
)


def _accented_letters() -> tuple[str, str]:
    """Lower-case Latin letters that decompose into a plain letter plus marks, and those plain letters."""
    accented, plain = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter == letter.lower() and base != letter and base.isascii():
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _accented_letters()


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def fold_text(text: Column) -> Column:
    """Lower-case without accents, also those written as marks of their own; a missing text is empty."""

    def folded(lower: Column) -> Column:
        return F.when(_is_ascii(lower), lower).otherwise(_bound(F.translate(lower, ACCENTED, PLAIN), unmarked))

    # Most texts with accents have nothing else that isn't ASCII.
    def unmarked(letters: Column) -> Column:
        plain = F.regexp_replace(letters, r"\p{M}+", "")
        for letter, spelling in SPELLED_OUT.items():
            plain = F.replace(plain, F.lit(letter), F.lit(spelling))
        return F.when(_is_ascii(letters), letters).otherwise(plain)

    return _bound(F.lower(F.coalesce(text, F.lit(""))), folded)


def tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """All word tokens of a folded text that are not stop words."""

    def runs(t: Column) -> Column:
        plain, any_script = (F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (ASCII_TOKEN_PATTERN, TOKEN_PATTERN))
        return F.when(_is_ascii(t), plain).otherwise(any_script)

    found = _bound(text, runs)
    if not stop_words:
        return found
    return F.filter(found, lambda t: ~t.isin(*stop_words))


def clean_profile(profile: Column) -> Column:
    """Profile without its area marker and four-character suffix."""
    unmarked = F.replace(profile, F.lit("Area 3"), F.lit(""))
    body = F.substring(unmarked, F.lit(1), F.greatest(F.length(unmarked) - 4, F.lit(0)))
    return F.regexp_replace(body, r"\s+$", "")


def count_values(delimited: Column) -> Column:
    """Number of ``|``-separated slots; 0 when missing."""
    return F.when(delimited.isNull(), 0).otherwise(F.size(F.split(delimited, r"\|")))


def several_values(delimited: Column) -> Column:
    return (count_values(delimited) > 1).cast("int")


def split_values(delimited: Column, missing: str | None = None) -> Column:
    """Trimmed slots of a ``|``-separated list."""
    filled = delimited if missing is None else F.coalesce(delimited, F.lit(missing))
    return F.transform(F.split(filled, r"\|"), lambda v: F.regexp_replace(v, r"^\s+|\s+$", ""))


def first_mapped_word(text: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Value of the first whitespace-separated word that the mapping knows."""
    pairs = F.create_map(*[F.lit(part) for item in mapping.items() for part in item])
    hits = F.filter(
        F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.try_element_at(pairs, w)),
        lambda z: z.isNotNull(),
    )
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(default))


def work_zone(area: Column) -> Column:
    return first_mapped_word(F.coalesce(area, F.lit(S.ANY_LOCATION)), S.WORK_ZONES, S.OTHER)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def early_flag(created: Column, needed: Column) -> Column:
    return F.coalesce((created < needed).cast("int"), F.lit(0))


def lead_sign(created: Column, needed: Column) -> Column:
    """Sign of the days between creation and need; 0 when a date is missing."""
    return F.coalesce(F.signum(F.datediff(needed, created)), F.lit(0.0)).cast("int")


def to_day(value: Column) -> Column:
    """Day of a text in one of the spellings of ``DAY_PATTERNS``; NULL if it is none."""
    text = F.trim(value.cast("string"))
    return F.coalesce(*[F.try_to_date(F.regexp_extract(text, p, 1), form) for p, form in DAY_PATTERNS])


def unread_day(value: Column) -> Column:
    """1 for a text that should be a day and isn't understood."""
    return (value.isNotNull() & (F.trim(value.cast("string")) != "") & to_day(value).isNull()).cast("int")


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def feature_map(names: Sequence[str]) -> Column:
    """JSON object of the named columns of a row, in the given order."""
    keys = F.array(*[F.lit(n) for n in names])
    values = F.array(*[F.col(f"`{n}`").cast("double") for n in names])
    return F.to_json(F.map_from_arrays(keys, values))


def values_map(names: Sequence[str], array: Column, places: Sequence[int]) -> Column:
    """JSON object of some elements of an array under the given names, in the given order."""
    values = F.transform(F.array(*[F.lit(p) for p in places]), lambda p: F.get(array, p))
    return F.to_json(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), values))
