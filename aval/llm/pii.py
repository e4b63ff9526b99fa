"""Format-preserving pseudonyms for validated personal numbers, dates and addresses.

Values are found by one pattern and validated: card numbers by their check digit, dates by the
calendar, social security numbers and network addresses by their ranges. A keyed Feistel
network permutes each within its format: separators, lengths and check digits stay right, equal
values get equal pseudonyms in every document, different values different ones. The network
works on two numbers (l, r) modulo (a, b), so any domain of a * b values is permuted exactly. Mail
addresses keep their domain; their local part is permuted character by character. Slash dates are
read as dd/MM/yyyy, those valid as MM/dd/yyyy only are permuted among themselves.

Only built-in functions are used. The key is a literal in the query plan: treat plans and event
logs as confidential where it matters. Edge cases: null stays null; values that fail validation
stay as they are; repeated values and rows are treated alike; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

MAIL = r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
PHONE = (r"(?:\+1 ?|(?<![\d(+]))\(\d{3}\) ?\d{3}-\d{4}(?!\d)|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)"
         r"|\+\d{8,15}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])")
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
SLASH_DATE = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
CARD = r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])"
_NUMBERS = "|".join(f"(?:{p})" for p in (ADDRESS, PHONE, SOCIAL, ISO_DATE, SLASH_DATE, CARD))
PATTERN = f"(?:{MAIL})|(?=[0-9+(])(?:{_NUMBERS})"  # one look ahead rules most characters out

# Days from 1900-01-01 to 2099-12-31, as a product.
_DAYS_A, _DAYS_B = 319, 229
_FIRST_DAY, _LAST_DAY = "1900-01-01", "2099-12-31"
# Days after the 12th before each month of a common year; 221 in all.
_LATE_BEFORE = (0, 19, 35, 54, 72, 91, 109, 128, 147, 165, 184, 202)


def _round(key: str, tweak: Column, number: Column, half: Column) -> Column:
    """Sixty pseudo-random bits of the key, the kind of value, the round and one half."""
    said = F.concat_ws(":", F.lit(key), tweak, number.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def permute_pair(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A struct (l, r): the keyed permutation of (left, right) modulo (a, b)."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(state: Column, number: Column) -> Column:
        even = number % 2 == 0
        return F.struct(
            F.when(even, F.pmod(state["l"] + F.pmod(_round(key, tweak, number, state["r"]), a), a))
            .otherwise(state["l"]).alias("l"),
            F.when(~even, F.pmod(state["r"] + F.pmod(_round(key, tweak, number, state["l"]), b), b))
            .otherwise(state["r"]).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _power(exponent: Column) -> Column:
    return F.rpad(F.lit("1"), exponent + 1, "0").cast("long")


def permute_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Permutes strings of 2 to 36 digits, each length in itself."""
    size = F.length(digits)
    head = F.floor(size / 2).cast("int")
    tail = size - head
    out = permute_pair(
        F.substr(digits, F.lit(1), head), F.substr(digits, head + 1), _power(head), _power(tail),
        key, F.concat_ws(":", tweak, size.cast("string")))
    return F.transform(
        F.array(out),
        lambda s: F.concat(F.lpad(s["l"].cast("string"), head, F.lit("0")),
                           F.lpad(s["r"].cast("string"), tail, F.lit("0"))))[0]


def _places(value: Column) -> Column:
    return F.sequence(F.lit(1), F.length(value))


def _laid_out(mask: Column, kind: str, values: Column) -> Column:
    """``mask`` with its characters of ``kind`` replaced, in order, by those of ``values``."""
    def place(at: Column) -> Column:
        here = F.substr(mask, at, F.lit(1))
        before = F.length(F.regexp_replace(F.substr(mask, F.lit(1), at), f"[^{kind}]", ""))
        return F.when(here.rlike(f"[{kind}]"), F.substr(values, before, F.lit(1))).otherwise(here)

    return F.array_join(F.transform(_places(mask), place), "")


def luhn_sum(digits: Column) -> Column:
    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at + 1, F.lit(1)).cast("int")
        doubled = digit * (F.lit(2) - at % 2)
        return total + doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(_places(digits), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, F.lit("card"))
    checked = F.transform(F.array(body), lambda p: F.concat(
        p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))[0]
    return F.when(luhn_sum(digits) % 10 == 0,
                  F.transform(F.array(checked), lambda d: _laid_out(value, "0-9", d))[0])


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .-])|^\+1(?=\()", 0)
    local = F.substr(value, F.length(country) + 1)
    new = permute_digits(_digits(local), key, F.concat(F.lit("phone"), country))
    return F.concat(country, F.transform(F.array(new), lambda d: _laid_out(local, "0-9", d))[0])


def _address(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    size = F.lit(65536)
    new = permute_pair(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], size, size, key, F.lit("ip"))

    def octets(s: Column) -> Column:
        return F.concat_ws(".", *(x.cast("string") for x in (
            F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)))

    return F.transform(F.array(new), octets)[0]


def _social(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, s, n).cast("int") for s, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permute_pair(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key,
                       F.lit("social"))

    def text(s: Column) -> Column:
        return F.format_string(
            "%03d-%02d-%04d", F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1),
            F.floor(s["r"] / 9999) + 1, s["r"] % 9999 + 1)

    return F.when(valid, F.transform(F.array(new), text)[0])


def _date(value: Column, layout: str, key: str) -> Column:
    day = F.try_to_date(value, layout)
    since = F.date_diff(day, F.lit(_FIRST_DAY).cast("date"))
    new = permute_pair(F.floor(since / _DAYS_B), since % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), key,
                       F.lit("date"))
    moved = F.transform(F.array(new), lambda s: F.date_format(F.date_add(
        F.lit(_FIRST_DAY).cast("date"), (s["l"] * _DAYS_B + s["r"]).cast("int")), layout))[0]
    return F.when(day.between(F.lit(_FIRST_DAY).cast("date"), F.lit(_LAST_DAY).cast("date")), moved)


def _month_first(value: Column, key: str) -> Column:
    """Dates valid as MM/dd/yyyy only, the days after the 12th, permuted among themselves.

    The 49 leap days have a permutation of their own, since 200 years of 221 days leave them out.
    """
    day = F.try_to_date(value, "MM/dd/yyyy")
    before = F.array(*map(F.lit, _LATE_BEFORE))
    place = F.element_at(before, F.month(day)) + F.dayofmonth(day) - 13
    new = permute_pair(F.year(day) - 1900, place, F.lit(200), F.lit(221), key, F.lit("month-first"))
    leap = F.floor((F.year(day) - 1904) / 4)
    new_leap = permute_pair(F.floor(leap / 7), leap % 7, F.lit(7), F.lit(7), key, F.lit("leap-day"))

    def text(s: Column) -> Column:
        month = F.size(F.filter(before, lambda b: b <= s["r"]))
        return F.format_string(
            "%02d/%02d/%04d", month, s["r"] - F.element_at(before, month) + 13, s["l"] + 1900)

    def leap_text(s: Column) -> Column:
        return F.format_string("02/29/%04d", 1904 + 4 * (7 * s["l"] + s["r"]))

    known = day.between(F.lit(_FIRST_DAY).cast("date"), F.lit(_LAST_DAY).cast("date"))
    is_leap = (F.month(day) == 2) & (F.dayofmonth(day) == 29)
    return F.when(known & is_leap, F.transform(F.array(new_leap), leap_text)[0]).when(
        known & (F.dayofmonth(day) > 12), F.transform(F.array(new), text)[0])


def _shifted(half: Column, stream: Column) -> Column:
    """Every character moved within its class by the byte of ``stream`` (hex) at its place."""
    def move(at: Column) -> Column:
        char = F.substr(half, at, F.lit(1))
        by = F.conv(F.substr(stream, at * 2 - 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(char)

        def turn(first: int, size: int) -> Column:
            return F.char(F.pmod(code - first + by, F.lit(size)) + first)

        return (F.when(code < 58, turn(48, 10)).when(code < 91, turn(65, 26)).otherwise(turn(97, 26)))

    return F.array_join(F.transform(_places(half), move), "")


def _mail(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    domain = F.substr(value, F.length(local) + 1)
    plain = F.regexp_replace(local, "[^A-Za-z0-9]", "")
    head = F.floor(F.length(plain) / 2).cast("int")
    start = F.struct(F.substr(plain, F.lit(1), head).alias("l"), F.substr(plain, head + 1).alias("r"))

    def stream(number: Column, half: Column) -> Column:
        return F.sha2(F.concat_ws(
            ":", F.lit(key), F.lit("mail"), F.lower(domain), F.length(plain).cast("string"),
            number.cast("string"), F.lower(half)), 256)

    def step(state: Column, number: Column) -> Column:
        even = number % 2 == 0
        return F.struct(
            F.when(even & (F.length(state["l"]) > 0), _shifted(state["l"], stream(number, state["r"])))
            .otherwise(state["l"]).alias("l"),
            F.when(~even, _shifted(state["r"], stream(number, state["l"])))
            .otherwise(state["r"]).alias("r"))

    new = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    laid = F.transform(F.array(new), lambda s: _laid_out(local, "A-Za-z0-9", F.concat(s["l"], s["r"])))[0]
    return F.concat(laid, domain)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; the value itself if it fails validation."""
    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    slash = F.coalesce(_date(value, "dd/MM/yyyy", key), _month_first(value, key))
    return F.coalesce(
        F.when(value.contains("@"), _mail(value, key))
        .when(whole(ADDRESS), _address(value, key))
        .when(whole(PHONE), _phone(value, key))
        .when(whole(SOCIAL), _social(value, key))
        .when(whole(ISO_DATE), _date(value, "yyyy-MM-dd", key))
        .when(whole(SLASH_DATE), slash)
        .otherwise(_card(value, key)),
        value)


def pseudonymised(text: Column, key: str) -> Column:
    """``text`` with every validated value replaced."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    between = F.split(text, PATTERN, -1)
    new = F.transform(found, lambda value: pseudonym(value, key))
    joined = F.zip_with(between, new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))))
    return F.when(text.rlike(PATTERN), F.array_join(joined, "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with the values in ``column`` replaced; a projection, no shuffle."""
    return docs.withColumn(column, pseudonymised(F.col(column), key))
