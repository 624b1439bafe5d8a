"""Pseudonyms for personal numbers and dates that keep their format.

Only DataFrame functions. Matches of one pattern are cut out of the text, validated, permuted under a key within the
values of their format, and put back. The permutation is a Feistel network over two parts l < a and r < b, so any
format with a * b values is its own domain. Equal values have equal pseudonyms in all documents, different ones
different pseudonyms. What does not validate stays as it is.

Formats: payment card numbers with a right check digit (13 to 19 digits, plain, in fours, or as 4-6-5), phone numbers (the ten
digits after the country code; in other groupings the digits after the country code, of an unbroken number all but
the first three), IPv4 addresses, social security numbers, dates from 1600-03-01 to 2400-02-29 (each
within its 400-year cycle of the calendar, as year-month-day, day.month.year, month/day/year, or day/month/year where
that is no date; the pseudonym is written and read the same way), account numbers (IBAN of 37 countries; the digits, with
new check digits, while bank letters stay), and the local part of mail addresses (letters and
digits, in blocks of 22; equal up to case).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, packed, unpacked

ROUNDS = 10
# A host has 127 labels at most; an open repetition of a group would take the regex engine's stack, a frame a label.
MAIL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62}\.){1,127}[A-Za-z]{2,24}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EDGE, END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
# Lengths of account numbers by country.
IBAN = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "VA": 22,
}


def _accounts() -> tuple[str, ...]:
    """A pattern per length, plain or in fours."""
    patterns = []
    for size in sorted(set(IBAN.values())):
        countries = "|".join(c for c, n in IBAN.items() if n == size)
        fours, rest = divmod(size - 4, 4)
        patterns.append(f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    return tuple(patterns)


DATES = (
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"[0-9]{4}/[0-9]{2}/[0-9]{2}",
    r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}",
    r"[0-9]{2}/[0-9]{2}/[0-9]{4}",
    r"[0-9]{2}-[0-9]{2}-[0-9]{4}",
    r"[1-9][0-9]?/[1-9][0-9]?/[0-9]{4}",
    r"[1-9][0-9]?\.[1-9][0-9]?\.[0-9]{4}",
)
TEN_DIGITS = (
    r"\+[0-9]{1,3}[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-][0-9]{4}",
    r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
    r"[0-9]{3}-[0-9]{3}-[0-9]{4}",
)
NUMBERS = (
    *TEN_DIGITS[:2],
    *DATES,
    rf"(?<![0-9]\.){OCTET}(?:\.{OCTET}){{3}}(?!\.[0-9])",
    r"[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}",
    r"[0-9]{4}([ \-])[0-9]{6}\2[0-9]{5}",
    r"[0-9]{13,19}",
    r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    TEN_DIGITS[2],
    r"\+[0-9]{1,3}([ .\-])[0-9](?:\3[0-9]{2}){4}",
    r"\+[0-9]{1,3}[ .\-](?:\(0\) ?)?[0-9]{2,3}[ .\-][0-9]{3}(?:[ .\-][0-9]{2}){2}",
    r"\+[0-9]{1,3}[ .\-](?:\(0\) ?)?[0-9]{1,4}[ .\-][0-9]{3,5}[ .\-][0-9]{3,4}",
    r"\+[0-9]{1,3}[ .\-](?:\(0\) ?)?[0-9]{2,5}[ .\-][0-9]{5,8}",
    r"\+[0-9]{1,3}[ .\-][0-9]{7,12}",
    r"\+[0-9]{8,15}",
    r"0[1-9]([ .\-])[0-9]{2}(?:\4[0-9]{2}){3}",
    *_accounts(),
)
PATTERN = f"{EDGE}(?:{MAIL}|{'|'.join(NUMBERS)}){END}"
PHONE = r"^(.*?)[0-9]{3}([^0-9]*)[0-9]{3}([^0-9]*)[0-9]{4}$"
CYCLE, CYCLE_A, CYCLE_B = 146_097, 189, 773  # days of 400 years
BLOCK = 22
#: A date that has to keep its way of writing is permuted again until it has it; at least a quarter of all dates have.
WALK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _big(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("bigint")


def _random(key: Column, kind: str, a: Column, b: Column, i: Column, value: Column) -> Column:
    """60 bits of a keyed hash."""
    message = F.concat_ws("|", F.lit(kind), a.cast("string"), b.cast("string"), i.cast("string"), value.cast("string"))
    inner = F.sha2(F.concat(key, F.lit("|"), message).cast("binary"), 256)
    digest = F.sha2(F.concat(key, F.lit("#"), inner).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def feistel(key: Column, kind: str, left: Column, a: Column | int, right: Column, b: Column | int) -> Column:
    """A struct ``l``, ``r``: a permutation of all pairs with 0 <= l < a and 0 <= r < b; a and b below 2^58."""
    a, b = _big(a), _big(b)

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        moved_l = F.pmod(s["l"] + F.pmod(_random(key, kind, a, b, i, s["r"]), a), a)
        moved_r = F.pmod(s["r"] + F.pmod(_random(key, kind, a, b, i, s["l"]), b), b)
        return F.struct(F.when(even, moved_l).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(moved_r).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(_big(left).alias("l"), _big(right).alias("r")), step)


def _power(base: int, exponent: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**i).cast("bigint") for i in range(12)]), exponent.cast("int") + 1)


def _permuted_digits(key: Column, kind: str, digits: Column, base: int = 10) -> Column:
    """A string of digits (of base 36: lower case) as another one of the same length, up to 22."""

    def whole(s: Column) -> Column:
        first = F.ceil(F.length(s) / 2).cast("int")
        second = F.length(s) - first
        left = F.conv(F.substring(s, F.lit(1), first), base, 10)
        right = F.coalesce(F.conv(F.nullif(F.substring(s, first + 1, second), F.lit("")), base, 10), F.lit("0"))

        def text(p: Column) -> Column:
            parts = [F.lower(F.lpad(F.conv(p[n].cast("string"), 10, base), size, "0")) for n, size in (("l", first), ("r", second))]
            return F.concat(parts[0], F.when(second > 0, parts[1]).otherwise(F.lit("")))

        return _let(feistel(key, kind, left, _power(base, first), right, _power(base, second)), text)

    return _let(digits, whole)


def _permuted_blocks(key: Column, kind: str, s: Column, base: int) -> Column:
    """The same for a string of any length, block by block, each with a key of its own."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.length(s) - 1) / BLOCK).cast("int"), F.lit(0))),
        lambda i: _permuted_digits(F.concat(key, F.lit("."), i.cast("string")), kind, F.substring(s, i * BLOCK + 1, F.lit(BLOCK)), base),
    )
    return F.array_join(blocks, "")


def _refilled(text: Column, new: Column, places: str) -> Column:
    """The text with its characters of the class ``places`` taken one by one from ``new``."""

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(text, F.lit(1), i), f"[^{places}]", ""))
        return F.when(c.rlike(f"[{places}]"), F.substring(new, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column, weights_from_right: int) -> Column:
    """The check sum; every second digit is doubled, beginning with the last one if ``weights_from_right`` is 1."""
    reversed_ = F.split(F.reverse(digits), "")

    def add(total: Column, c: Column) -> Column:
        value = c.cast("int")
        doubled = value * 2
        return F.struct(
            (total["sum"] + F.when(total["double"], F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(value)).alias("sum"), (~total["double"]).alias("double")
        )

    return F.aggregate(F.filter(reversed_, lambda c: c != ""), F.struct(F.lit(0).alias("sum"), F.lit(bool(weights_from_right)).alias("double")), add, lambda t: t["sum"])


def _card(key: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")

    def valid(d: Column) -> Column:
        payload = F.substring(d, F.lit(1), F.length(d) - 1)
        full = _let(_permuted_digits(key, "card", payload), lambda p: F.concat(p, F.pmod(-_luhn(p, 1), F.lit(10)).cast("string")))
        group = F.substring(m, F.lit(5), F.lit(1))
        fours = lambda f: F.call_function("concat_ws", group, *[F.substring(f, F.lit(i), F.lit(4)) for i in (1, 5, 9, 13)])
        three = lambda f: F.call_function("concat_ws", group, *[F.substring(f, F.lit(i), F.lit(n)) for i, n in ((1, 4), (5, 6), (11, 5))])
        spaced = _let(full, lambda f: F.when(F.length(m) == F.length(d), f).when(F.length(d) == 15, three(f)).otherwise(fours(f)))
        return F.when(_luhn(d, 0) % 10 == 0, spaced).otherwise(m)

    return _let(digits, valid)


def _phone(key: Column, m: Column) -> Column:
    ten = F.right(F.regexp_replace(m, "[^0-9]", ""), F.lit(10))

    def put(p: Column) -> Column:
        parts = [F.substring(p, F.lit(i), F.lit(n)) for i, n in ((1, 3), (4, 3), (7, 4))]
        return F.concat(F.regexp_extract(m, PHONE, 1), parts[0], F.regexp_extract(m, PHONE, 2), parts[1], F.regexp_extract(m, PHONE, 3), parts[2])

    return _let(_permuted_digits(key, "phone", ten), put)


def _social(key: Column, m: Column) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999, each as a number from 0."""
    area, group, serial = F.substring(m, 1, 3).cast("int"), F.substring(m, 5, 2).cast("int"), F.substring(m, 8, 4).cast("int")
    place = F.when(area > 666, area - 2).otherwise(area - 1)

    def text(p: Column) -> Column:
        number = F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1)
        parts = (number, 3), (F.floor(p["r"] / 9999) + 1, 2), (p["r"] % 9999 + 1, 4)
        return F.concat_ws("-", *[F.lpad(x.cast("bigint").cast("string"), n, "0") for x, n in parts])

    moved = _let(feistel(key, "social", place, 898, (group - 1) * 9999 + serial - 1, 99 * 9999), text)
    return F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), moved).otherwise(m)


def _address(key: Column, m: Column) -> Column:
    def moved(o: Column) -> Column:
        part = [F.get(o, F.lit(i)).cast("int") for i in range(4)]

        def text(p: Column) -> Column:
            return F.concat_ws(".", *[x.cast("bigint").cast("string") for h in ("l", "r") for x in (F.floor(p[h] / 256), p[h] % 256)])

        return _let(feistel(key, "address", part[0] * 256 + part[1], 65536, part[2] * 256 + part[3], 65536), text)

    return _let(F.split(m, r"\."), moved)


def _national(key: Column, m: Column) -> Column:
    """Ten digits of which the first is 0 and the second is not."""
    d = F.regexp_replace(m, "[^0-9]", "")
    moved = feistel(key, "national", F.substring(d, 2, 5).cast("int") - 10_000, 90_000, F.substring(d, 7, 4).cast("int"), 10_000)
    number = _let(moved, lambda p: F.concat(F.lit("0"), (p["l"] + 10_000).cast("string"), F.lpad(p["r"].cast("string"), 4, "0")))
    return _let(number, lambda new: _refilled(m, new, "0-9"))


def _abroad(key: Column, m: Column) -> Column:
    def rest(own: Column) -> Column:
        new = _permuted_digits(key, "phone", F.regexp_replace(own, "[^0-9]", ""))
        return _let(new, lambda n: _refilled(own, n, "0-9"))

    code = F.regexp_extract(m, r"^(\+[0-9]{1,3}[ .\-](?:\(0\) ?)?|\+[0-9]{3})", 1)
    return F.concat(code, _let(F.substring(m, F.length(code) + 1, F.length(m)), rest))


def _mod97(s: Column) -> Column:
    """The remainder by 97, a letter read as 10 to 35."""

    def add(total: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), add)


def _account(key: Column, m: Column) -> Column:
    def valid(s: Column) -> Column:
        country, check, own = F.substring(s, 1, 2), F.substring(s, 3, 2), F.substring(s, F.lit(5), F.length(s))
        digits = F.regexp_replace(own, "[^0-9]", "")

        def put(new: Column) -> Column:
            checked = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return _let(F.concat(country, checked, new), lambda full: _refilled(m, full, "A-Z0-9"))

        moved = _let(_permuted_blocks(key, "account", digits, 10), lambda n: _let(_refilled(own, n, "0-9"), put))
        right = check.between("02", "98") & (_mod97(F.concat(own, country, check)) == 1) & (digits != "")
        return F.when(right, moved).otherwise(m)

    return _let(F.replace(m, F.lit(" "), F.lit("")), valid)


def _date(key: Column, m: Column) -> Column:
    """Read as month/day/year before day/month/year. A date that is only the latter becomes another one that is only the
    latter, and one without leading zeros another one that can be written so: each way of writing is a domain of its own."""
    first, second, third = (F.get(F.split(m, r"[./\-]"), F.lit(i)) for i in range(3))
    ymd, mdy, dmy = (F.concat_ws("-", *x).try_cast("date") for x in ((first, second, third), (third, first, second), (third, second, first)))
    split = F.regexp_extract(m, r"[./\-]", 0)
    padded = F.length(m) == 10

    def moved(read: Column) -> Column:
        day, order = read["day"], read["order"]
        number = F.datediff(day, F.lit("1600-03-01").cast("date"))
        within = F.pmod(number, F.lit(CYCLE))

        def step(place: Column) -> Column:
            return _let(feistel(key, "date", F.floor(place / CYCLE_B), CYCLE_A, place % CYCLE_B, CYCLE_B), lambda p: p["l"] * CYCLE_B + p["r"])

        def at(place: Column) -> Column:
            return F.date_add(day, (place - within).cast("int"))

        def written_so(d: Column) -> Column:
            short = padded | (F.month(d) < 10) | (F.dayofmonth(d) < 10)
            return short & ((order != "only dmy") | (F.dayofmonth(d) > 12))

        def text(d: Column) -> Column:
            y = F.lpad(F.year(d).cast("string"), 4, "0")
            month, dom = (F.when(padded | (x >= 10), F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string")) for x in (F.month(d), F.dayofmonth(d)))
            parts = F.when(order == "ymd", F.array(y, month, dom)).when(order == "mdy", F.array(month, dom, y)).otherwise(F.array(dom, month, y))
            return F.concat(parts[0], split, parts[1], split, parts[2])

        place = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(within.cast("bigint")), lambda p, _: F.when(written_so(at(p)), p).otherwise(step(p)))
        known = F.coalesce((number >= 0) & (number < 2 * CYCLE), F.lit(False))
        return F.when(~known, m).otherwise(_let(place, lambda p: _let(at(p), text)))

    way = F.when(F.length(first) == 4, "ymd").when(split == ".", "dmy").when(mdy.isNotNull(), "mdy").otherwise("only dmy")
    day = F.when(way == "ymd", ymd).when(way == "mdy", mdy).otherwise(dmy)
    return _let(F.struct(day.alias("day"), way.alias("order")), moved)


def _mail(key: Column, m: Column) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

    def moved(low: Column) -> Column:
        def put(new: Column) -> Column:
            joined = _refilled(low, new, "a-z0-9")
            return F.when(m == F.upper(m), F.upper(joined)).otherwise(joined)

        kept = F.regexp_replace(low, "[^a-z0-9]", "")
        return F.concat(_let(_permuted_blocks(key, "mail", kept, 36), put), F.lit("@"), domain)

    return _let(F.lower(local), moved)


def pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of one match of ``PATTERN``, the match itself where it does not validate."""
    return (
        F.when(m.contains("@"), _mail(key, m))
        .when(m.rlike("^[A-Z]"), _account(key, m))
        .when(m.rlike(f"^(?:{'|'.join(DATES)})$"), _date(key, m))
        .when(m.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), _address(key, m))
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _social(key, m))
        .when(m.rlike(r"^[0-9]{13,19}$|^[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}([ \-])[0-9]{6}\2[0-9]{5}$"), _card(key, m))
        .when(m.rlike(f"^(?:{'|'.join(TEN_DIGITS)})$"), _phone(key, m))
        .when(m.startswith("+"), _abroad(key, m))
        .otherwise(_national(key, m))
    )


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with pseudonyms in the text, and ``n_matches`` and ``n_replaced``.

    A null text stays null, with zero matches. Rows, ids and other columns are left alone; columns named
    ``n_matches`` or ``n_replaced`` are replaced. The key is part of the plan; keep plans as secret as the key."""
    secret = F.lit(key)
    content = F.col(f"`{text}`")
    some = F.coalesce(content.rlike("[0-9@]"), F.lit(False))
    nothing = F.array().cast("array<string>")
    cut = docs.select(
        packed(docs),
        F.when(some, F.regexp_extract_all(content, F.lit(PATTERN), 0)).otherwise(nothing).alias("matches"),
        F.when(some, F.split(content, PATTERN, -1)).otherwise(nothing).alias("gaps"),
    )
    found = cut.select(ORIGINAL, "matches", "gaps", F.transform("matches", lambda m: pseudonym(m, secret)).alias("new"))
    pieces = F.flatten(F.zip_with("gaps", F.concat("new", F.array(F.lit(""))), lambda g, m: F.array(g, m)))
    joined = F.when(F.size("matches") > 0, F.array_join(pieces, "")).otherwise(F.col(ORIGINAL)[text])
    changed = F.size(F.filter(F.arrays_zip("matches", "new"), lambda p: p["matches"] != p["new"]))
    order = found.select(ORIGINAL, joined.alias("joined"), F.size("matches").cast("bigint").alias("n_matches"), changed.cast("bigint").alias("n_replaced"))
    columns = [c for c in docs.columns if c.lower() not in ("n_matches", "n_replaced")]
    return unpacked(order, docs.columns, **{text: "joined"}, n_matches="n_matches", n_replaced="n_replaced").select(*[f"`{c}`" for c in columns], "n_matches", "n_replaced")
