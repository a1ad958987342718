"""Format-preserving pseudonyms for validated numbers, dates and addresses by keyed Feistel permutations. Native columns only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import read_table

ROUNDS = 8
KEY_SETTING = "spark.staffcast.pseudonym.key"
TEST_KEY = "a key for tests; set your own"

# Where a number may begin and end: not inside a longer one. Commas, colons and slashes part values.
BEGIN, END = r"(?<![0-9A-Za-z])(?<![0-9][.-])", r"(?![0-9A-Za-z])(?![.-][0-9])"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Characters of an account number by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{fours}}}" + rf"\x20?[A-Z0-9]{{{rest}}}" * bool(rest)


# Numbers of a country's length come first, so that a word after one isn't taken for its end.
IBAN = "|".join([*(_iban_of(n, c) + END for n, c in IBAN_LENGTHS.items()), r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?" + END])
# A time may follow a day after a T; slashes part ISO days but are inside others.
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-SU-Za-z]|T(?![0-9])|[.-][0-9])|(?<![0-9]/)[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?!/[0-9])" + END
GROUP = r"[\x20.-]?[0-9]{2,4}"
# With a country code; ten digits in the American way, after a 1 too; pairs in the French way.
PHONE = (
    rf"\+[0-9]{{1,3}}[\x20.-]?(?:\(?[0-9]{{2,4}}\)?(?:{GROUP}){{2,3}}{END}|\(?[0-9]\)?(?:{GROUP}){{2,4}}{END})"
    rf"|(?:1[\x20.-]|1(?=\())?(?:\([0-9]{{3}}\)[\x20.-]?|\(?[0-9]{{3}}\)?[\x20.-])[0-9]{{3}}[\x20.-][0-9]{{4}}{END}"
    rf"|0[1-9](?:(?:\x20[0-9]{{2}}){{4}}|(?:\.[0-9]{{2}}){{4}}|(?:-[0-9]{{2}}){{4}}){END}"
)
# Tried in this order at each place; what matches but isn't valid stays as it is. A host has 127 labels at most; its last one gives back a full stop.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}+",
    "iban": rf"{BEGIN}(?:{IBAN})",
    "ip": rf"(?<![0-9A-Za-z])(?<![0-9]\.){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "date": rf"{BEGIN}(?:{DATE})",
    "ssn": rf"{BEGIN}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{END}",
    "card": rf"{BEGIN}[0-9](?:[\x20-]?[0-9]){{12,18}}{END}",
    "phone": rf"(?<!\+){BEGIN}(?:{PHONE})",
}
CARD_DIGITS = (19, 16, 15, 14, 13)
KINDS = tuple(PATTERNS)


def _any(kinds: tuple[str, ...]) -> str:
    """One pattern for several kinds; its group of the date's mark has a name, as numbers of groups change."""
    parts = (PATTERNS[k].replace("([./])", "(?<mark>[./])").replace(r"\1", r"\k<mark>") for k in kinds)
    return "|".join(f"(?:{p})" for p in parts)


# The first character tells most places apart before anything else is tried.
NUMBERS = rf"(?=[0-9+(A-Z])(?:{_any(KINDS[1:])})"
ANY = rf"{NUMBERS}|(?=[A-Za-z0-9]){_any(KINDS[:1])}"
HINT = "[0-9]{2}|[0-9][. -][0-9]"  # what any number contains, also one of digits with marks between all of them

FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # the days of 1900 to 2099


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: expressions in a lambda would be computed at each mention."""
    return F.transform(F.array(value), use)[0]


def permuted(value: Column, a: Column | int, b: Column | int, key: str, tweak: Column) -> Column:
    """``value`` in 0 .. a*b - 1 under a keyed permutation of that range: a Feistel network on (value / b, value mod b)."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))

    def network(p: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            even = i % 2 == 0
            known = F.when(even, s["right"]).otherwise(s["left"])
            digest = F.sha2(F.concat_ws(":", F.lit(key), p["tweak"], i.cast("string"), known.cast("string")), 256)
            sum_ = F.when(even, s["left"]).otherwise(s["right"]) + F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.when(even, p["a"]).otherwise(p["b"])
            new = F.pmod(sum_, F.when(even, p["a"]).otherwise(p["b"]))
            return F.struct(F.when(even, new).otherwise(s["left"]).alias("left"), F.when(even, s["right"]).otherwise(new).alias("right"))

        right = F.pmod(p["value"], p["b"])
        left = ((p["value"] - right).cast("decimal(20,0)") / p["b"].cast("decimal(20,0)")).cast("long")
        rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
        return F.aggregate(rounds, F.struct(left.alias("left"), right.alias("right")), step, lambda s: s["left"] * p["b"] + s["right"])

    return let(F.struct(value.alias("value"), a.alias("a"), b.alias("b"), tweak.alias("tweak")), network)


def _power(base: int, n: Column, most: int) -> Column:
    """``base`` to the power of ``n`` from a table of constants, exact."""
    return F.element_at(F.array(*[F.lit(base**i).cast("long") for i in range(most + 1)]), n + 1)


def permuted_digits(digits: Column, key: str, kind: str, base: int = 10, most: int = 18) -> Column:
    """A string of digits to a base, at most ``most`` of them, under a permutation of all strings of its length."""

    def change(d: Column) -> Column:
        n = F.char_length(d)
        small = F.floor(n / 2).cast("int")
        new = permuted(F.conv(d, base, 10).cast("long"), _power(base, n - small, most), _power(base, small, most), key, F.concat(F.lit(f"{kind}:"), n.cast("string")))
        return F.lpad(F.lower(F.conv(new.cast("string"), 10, base)), n, F.lit("0"))

    return let(digits, change)


def permuted_runs(digits: Column, key: str, kind: str, base: int, most: int) -> Column:
    """A string of any length, ``most`` digits at a time; the empty one stays."""

    def change(d: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.char_length(d), F.lit(most)), lambda i: permuted_digits(F.substr(d, i, F.lit(most)), key, kind, base, most))
        return F.when(d == "", d).otherwise(F.array_join(runs, ""))

    return let(digits, change)


def refilled(text: Column, kind: str, characters: Column) -> Column:
    """``text`` with its characters of a class replaced, one after the other, by those of a string of their number."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def fill(new: Column) -> Column:
        step = lambda s, c: F.when(
            c.rlike(kind), F.struct(F.concat(s["out"], F.substr(new, s["n"] + 1, F.lit(1))).alias("out"), (s["n"] + 1).alias("n"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n")))
        return F.aggregate(F.split(text, ""), start, step)["out"]

    return let(characters, fill)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of digits with every second from the right doubled, modulo 10."""

    def total(d: Column) -> Column:
        def worth(i: Column) -> Column:
            own = F.substr(d, F.char_length(d) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, own).otherwise(2 * own - F.when(own > 4, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(0), F.char_length(d) - 1), F.lit(0), lambda s, i: s + worth(i)) % 10

    return let(digits, total)


def iban_rest(text: Column) -> Column:
    """An account number, country and check digits moved to its end, modulo 97."""
    plain = F.regexp_replace(text, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda s, c: F.when(c == "", s).otherwise(
        F.when(c.rlike("[0-9]"), (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)
    )
    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _card(text: Column, key: str) -> Column:
    """The first digit stays, the last is made anew to check. Of numbers with other groups beside them only the card's groups change."""

    def change(text: Column) -> Column:
        d = digits_of(text)
        body = let(d, lambda d: F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_digits(F.substr(d, F.lit(2), F.char_length(d) - 2), key, "card")))
        whole = let(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return refilled(text, "[0-9]", whole)

    def valid(text: Column) -> Column:
        return let(digits_of(text), lambda d: (luhn_sum(d) == 0) & d.rlike("[1-9]"))

    # Runs of whole groups with as many digits as a card has, also those that overlap.
    runs = [F.regexp_extract_all(text, F.lit(rf"(?<![0-9])(?=([0-9](?:[\x20-]?[0-9]){{{n - 1}}})(?![0-9]))"), F.lit(1)) for n in CARD_DIGITS]
    tried = F.when(valid(text), F.array(text)).otherwise(F.filter(F.concat(*runs), valid))

    def placed(card: Column) -> Column:
        at = F.instr(text, card)
        return F.concat(F.substr(text, F.lit(1), at - 1), change(card), F.substr(text, at + F.char_length(card)))

    return let(F.get(tried, F.lit(0)), lambda card: F.when(card.isNotNull(), placed(card)))


def _iban(text: Column, key: str) -> Column:
    """The digits after the check digits are permuted (in runs of 18), letters stay, and the check digits are made anew."""
    country, tail = F.substr(text, F.lit(1), F.lit(2)), F.substr(text, F.lit(5))

    def checked(rest: Column) -> Column:
        check = 98 - iban_rest(F.concat(country, F.lit("00"), rest))
        return F.concat(country, F.lpad(check.cast("string"), F.lit(2), F.lit("0")), rest)

    return F.when(iban_rest(text) == 1, let(refilled(tail, "[0-9]", permuted_runs(digits_of(tail), key, "iban", 10, 18)), checked))


def _ip(text: Column, key: str) -> Column:
    value = F.aggregate(F.split(text, r"\."), F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    dotted = lambda v: F.concat_ws(".", *[F.pmod(F.shiftrightunsigned(v, 8 * i), F.lit(256)).cast("string") for i in (3, 2, 1, 0)])
    return let(permuted(value, 65_536, 65_536, key, F.lit("ip")), dotted)


def _date(text: Column, key: str) -> Column:
    """ISO dates; with points the day comes first; with slashes the month, or the day where only that is a date."""
    formats = {"yyyy-MM-dd": text.contains("-"), "dd.MM.yyyy": text.contains("."), "MM/dd/yyyy": text.contains("/"), "dd/MM/yyyy": text.contains("/")}
    a, b = DAYS
    first = F.lit(FIRST_DAY).cast("date")

    def change(day: Column) -> Column:
        number = F.date_diff(day["on"], first).cast("long")
        new = let(permuted(number, a, b, key, F.lit("date")), lambda n: F.date_add(first, n.cast("int")))
        return F.when(number.between(0, a * b - 1), let(new, lambda d: F.coalesce(*[F.when(day["as"] == f, F.date_format(d, f)) for f in formats])))

    read = [F.when(fits, F.try_to_date(text, f)) for f, fits in formats.items()]
    found = F.coalesce(*[F.when(r.isNotNull(), F.struct(r.alias("on"), F.lit(f).alias("as"))) for r, f in zip(read, formats, strict=True)])
    return let(found, change)


def _ssn(text: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substr(text, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")
    pad = lambda c, n: F.lpad(c.cast("string"), F.lit(n), F.lit("0"))

    def spelled(new: Column) -> Column:
        rest = F.floor(new / 9999).cast("long")
        area_of = F.floor(new / (9999 * 99)).cast("long") + 1
        return F.concat_ws("-", pad(area_of + (area_of >= 666).cast("long"), 3), pad(F.pmod(rest, F.lit(99)) + 1, 2), pad(F.pmod(new, F.lit(9999)) + 1, 4))

    return F.when(valid, let(permuted((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, F.lit("ssn")), spelled))


def _phone(text: Column, key: str) -> Column:
    """7 to 15 digits: the last ten are permuted, whatever country code they have; of fewer than ten the first stays."""

    def change(d: Column) -> Column:
        n = F.char_length(d)
        first = F.when(n >= 10, n - 10).otherwise(F.lit(1))
        new = F.concat(F.substr(d, F.lit(1), first), permuted_digits(F.substr(d, first + 1), key, "phone"))
        return F.when(n.between(7, 15), refilled(text, "[0-9]", new))

    return let(digits_of(text), change)


def _email(text: Column, key: str) -> Column:
    """Letters and digits before the ``@`` are permuted as numbers to base 36, ten at a time, without regard to case; the rest stays."""

    def change(local: Column) -> Column:
        new = permuted_runs(F.regexp_replace(local, "[^0-9a-z]", ""), key, "email", 36, 10)
        return F.concat(refilled(local, "[0-9a-z]", new), F.substr(text, F.char_length(local) + 1))

    return let(F.lower(F.substring_index(text, "@", 1)), change)


MAKERS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(text: Column, key: str) -> Column:
    """``kind, text`` for one match: the first kind whose pattern it fits and which finds it valid; else no kind and the text."""
    same = F.struct(F.lit(None).cast("string").alias("kind"), text.alias("text"))
    named = lambda kind: let(MAKERS[kind](text, key), lambda new: F.when(new.isNotNull(), F.struct(F.lit(kind).alias("kind"), new.alias("text"))))
    return F.coalesce(*[F.when(text.rlike(f"^(?:{p})$"), named(kind)) for kind, p in PATTERNS.items()], same)


def _replaced(text: Column, pattern: str, key: str) -> Column:
    """``text`` with pseudonyms for all valid matches of a pattern, and their ``kinds``; texts are searched once for each."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: pseudonym(m, key))
    some = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("new"))
    whole = lambda x: F.struct(
        F.array_join(F.transform(x, lambda y: F.concat(y["gap"], F.coalesce(y["new"]["text"], F.lit("")))), "").alias("text"),
        F.filter(F.transform(x, lambda y: y["new"]["kind"]), lambda k: k.isNotNull()).alias("kinds"),
    )
    return let(some, whole)


def protected(text: Column, key: str) -> Column:
    """``text`` with pseudonyms, and the ``kinds`` that were replaced, in order; null stays null."""
    same = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    return F.when(text.contains("@"), _replaced(text, ANY, key)).when(text.rlike(HINT), _replaced(text, NUMBERS, key)).otherwise(same)


def pseudonymized(docs: DataFrame, text_column: str, key: str, kinds_column: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_column``, and the replaced kinds in ``kinds_column`` if that is named.

    Replaced are e-mail addresses, IBANs with a right checksum, IPv4 addresses, dates from 1900 to 2099, US social security
    numbers of valid ranges, card numbers of 13 to 19 digits with a right check digit, and phone numbers. Each goes through a keyed
    permutation of its format, so it stays valid and equal values stay equal, in one document and across; the permutation
    can be undone with the key. What only looks like one stays. Commas, colons, slashes and spaces part values, a ``T`` a day from its time;
    a card number is also found among other groups of digits, and an account number before a word. Null texts stay null, empty ones empty; rows and other
    columns stay as they are; an empty table gives an empty result.
    """
    held = "_protected"
    while held in docs.columns:
        held += "_"
    out = docs.withColumn(held, protected(F.col(text_column), key))
    new = {text_column: F.col(held)["text"]} | ({kinds_column: F.col(held)["kinds"]} if kinds_column else {})
    return out.withColumns(new).drop(held)


def key_of(spark) -> str:
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def op4_feistel(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonymized(docs, "text", key_of(spark), "kinds")
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", "text", *[count(k) for k in KINDS])
