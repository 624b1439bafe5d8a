from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from streakline.llm.pseudonyms import ROUNDS, feistel, pseudonymize

SCHEMA = "doc_id bigint, text string, n_matches string, `new` int"
KEY = "a key"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def network(key, kind, left, a, right, b):
    def random(i, value):
        return int(sha(key, "#", sha(key, "|", f"{kind}|{a}|{b}|{i}|{value}"))[:15], 16)

    for i in range(ROUNDS):
        if i % 2 == 0:
            left = (left + random(i, right) % a) % a
        else:
            right = (right + random(i, left) % b) % b
    return left, right


def number(s, base):
    return int(s, base) if s else 0


def text_of(value, base, size):
    out = ""
    for _ in range(size):
        value, digit = divmod(value, base)
        out = "0123456789abcdefghijklmnopqrstuvwxyz"[digit] + out
    return out


def digits(key, kind, s, base=10):
    first = (len(s) + 1) // 2
    second = len(s) - first
    left, right = network(key, kind, number(s[:first], base), base**first, number(s[first:], base), base**second)
    return text_of(left, base, first) + text_of(right, base, second)


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def card(m):
    d = re.sub(r"\D", "", m)
    if luhn(d) % 10:
        return m
    payload = digits(KEY, "card", d[:-1])
    full = next(payload + c for c in "0123456789" if luhn(payload + c) % 10 == 0)
    if len(m) == len(d):
        return full
    return m[4].join([full[:4], full[4:10], full[10:]] if len(d) == 15 else [full[i : i + 4] for i in (0, 4, 8, 12)])


def phone(m):
    ten = iter(digits(KEY, "phone", re.sub(r"\D", "", m)[-10:]))
    skip = len(re.sub(r"\D", "", m)) - 10
    out = ""
    for c in m:
        if c.isdigit() and skip:
            skip -= 1
        elif c.isdigit():
            c = next(ten)
        out += c
    return out


def address(m):
    o = [int(x) for x in m.split(".")]
    left, right = network(KEY, "address", o[0] * 256 + o[1], 65536, o[2] * 256 + o[3], 65536)
    return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"


def day(value):
    anchor = date(1600, 3, 1)
    n = (value - anchor).days
    within = n % 146_097
    left, right = network(KEY, "date", within // 773, 189, within % 773, 773)
    return value + timedelta(days=left * 773 + right - within)


def social(m):
    area, group, serial = map(int, m.split("-"))
    left, right = network(KEY, "social", area - (2 if area > 666 else 1), 898, (group - 1) * 9999 + serial - 1, 99 * 9999)
    return f"{left + (2 if left >= 665 else 1):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"


def mail(m):
    local, domain = m.split("@")
    kept = re.sub(r"[^a-z0-9]", "", local.lower())
    new = iter("".join(digits(f"{KEY}.{i // 22}", "mail", kept[i : i + 22], 36) for i in range(0, len(kept), 22)))
    out = "".join(next(new) if re.match("[a-z0-9]", c) else c for c in local.lower())
    return (out.upper() if m == m.upper() else out) + "@" + domain


def abroad(m):
    code = re.match(r"\+\d{1,3}[ .\-](?:\(0\) ?)?|\+\d{3}", m)[0]
    new = iter(digits(KEY, "phone", re.sub(r"\D", "", m[len(code) :])))
    return code + "".join(next(new) if c.isdigit() else c for c in m[len(code) :])


def national(m):
    d = re.sub(r"\D", "", m)
    left, right = network(KEY, "national", int(d[1:6]) - 10_000, 90_000, int(d[6:]), 10_000)
    new = iter(f"0{left + 10_000}{right:04d}")
    return "".join(next(new) if c.isdigit() else c for c in m)


def account(m):
    s = m.replace(" ", "")
    remainder = lambda x: int("".join(str(int(c, 36)) for c in x)) % 97
    assert remainder(s[4:] + s[:4]) == 1
    d = re.sub(r"\D", "", s[4:])
    new = iter("".join(digits(f"{KEY}.{i // 22}", "account", d[i : i + 22]) for i in range(0, len(d), 22)))
    own = "".join(next(new) if c.isdigit() else c for c in s[4:])
    full = s[:2] + f"{98 - remainder(own + s[:2] + '00'):02d}" + own
    assert remainder(full[4:] + full[:4]) == 1
    put = iter(full)
    return "".join(c if c == " " else next(put) for c in m)


def written(m):
    """A date with slashes, dashes or dots between its parts."""
    split = re.search(r"\D", m)[0]
    a, b, c = map(int, m.split(split))
    padded = len(m) == 10
    dmy = split == "." or a > 12 or date_or_none(c, a, b) is None
    only = dmy and split != "."
    value = day(date(c, b, a) if dmy else date(c, a, b))
    while not ((padded or value.month < 10 or value.day < 10) and (not only or value.day > 12)):
        value = day(value)
    parts = (value.day, value.month) if dmy else (value.month, value.day)
    return split.join([*(f"{x:02d}" if padded else str(x) for x in parts), f"{value.year:04d}"])


def date_or_none(*parts):
    try:
        return date(*parts)
    except ValueError:
        return None


SAME = str
CASES = [
    ("4111111111111111", card), ("4111-1111-1111-1111", card), ("4111 1111 1111 1111", card), ("4111111111111112", SAME), ("378282246310005", card),
    ("6011000990139424123", SAME), ("+1 (017) 555-7713", phone), ("(212) 555-0100", phone), ("212-555-0100", phone), ("+49 212 555 0100", phone),
    ("10.0.0.255", address), ("256.1.1.1", SAME), ("1.2.3.4.5", SAME), ("123-45-6789", social), ("899-99-9999", social), ("666-45-6789", SAME), ("000-45-6789", SAME),
    ("x@example.com", mail), ("First.Last+tag9@mail5.example.com", mail), ("ANANHA.34@MAIL7.EXAMPLE.COM", mail), (("ab9" * 17) + "@a.org", mail),
    ("+33 1 23 45 67 89", abroad), ("+44 20 7946 0958", abroad), ("+44 (0)20 7946 0958", abroad), ("+41 44 668 18 00", abroad), ("+34 912 345 678", abroad),
    ("+49 30 1234567", abroad), ("+4915112345678", abroad), ("+1 2125550100", abroad), ("01 23 45 67 89", national), ("06.12.34.56.78", national), ("00 12 34 56 78", SAME),
    ("DE89 3704 0044 0532 0130 00", account), ("DE89370400440532013000", account), ("GB29 NWBK 6016 1331 9268 19", account), ("FR1420041010050500013M02606", account),
    ("MT84MALT011000012345MTLCAST001S", account), ("ES91 2100 0418 4502 0005 1332", account), ("DE88370400440532013000", SAME), ("XX89370400440532013000", SAME),
    ("25/12/1999", written), ("31-01-2020", written), ("12-31-2020", written), ("1/2/1999", written), ("9/30/1999", written), ("30/9/1999", written), ("1.2.1999", written),
    ("25.12.1999", written), ("32/12/1999", SAME), ("13/13/1999", SAME), ("01/2/1999", SAME), ("30/02/1999", SAME),
    ("2024-13-01", SAME), ("2023-02-29", SAME), ("1500-01-01", SAME), ("2400-03-01", SAME), ("v4111111111111111", SAME), ("12345", SAME),
]
DAYS = [date(2024, 2, 29), date(1600, 3, 1), date(2400, 2, 29), date(1999, 12, 31)]


def test_formats(spark):
    """Each kind equals a plain implementation, in the middle of a text and alone."""
    cases = CASES + [(f"{d:%Y-%m-%d}", lambda m: f"{day(date.fromisoformat(m)):%Y-%m-%d}") for d in DAYS]
    cases += [(f"{d:%Y/%m/%d}", lambda m: f"{day(date.fromisoformat(m.replace('/', '-'))):%Y/%m/%d}") for d in DAYS]
    cases += [(f"{d:%d.%m.%Y}", lambda m: f"{day(date(int(m[6:]), int(m[3:5]), int(m[:2]))):%d.%m.%Y}") for d in DAYS]
    cases += [(f"{d:%m/%d/%Y}", lambda m: f"{day(date(int(m[6:]), int(m[:2]), int(m[3:5]))):%m/%d/%Y}") for d in DAYS]
    rows = [(2 * i + k, before + m + after, "x", 1) for i, (m, _) in enumerate(cases) for k, (before, after) in enumerate([("", ""), ("é, ", "$$$ and 7 more.")])]
    got = pseudonymize(spark.createDataFrame(rows, SCHEMA), KEY)
    assert got.columns == ["doc_id", "text", "new", "n_matches", "n_replaced"]
    found = {r["doc_id"]: r for r in got.collect()}
    for i, (m, f) in enumerate(cases):
        new = f(m)
        assert (found[2 * i]["text"], found[2 * i + 1]["text"]) == (new, f"é, {new}$$$ and 7 more."), m
        assert found[2 * i]["n_replaced"] == (f is not SAME)


@pytest.mark.parametrize(("a", "b"), [(189, 773), (36, 1), (7, 100)])
def test_permutation(spark, a, b):
    pairs = spark.range(a * b).select(feistel(F.lit("k"), "t", F.floor(F.col("id") / b), a, F.col("id") % b, b).alias("p")).select("p.l", "p.r")
    row = pairs.agg(F.countDistinct("l", "r").alias("n"), F.min("l"), F.max("l"), F.min("r"), F.max("r")).first()
    assert tuple(row) == (a * b, 0, a - 1, 0, b - 1)


def test_each_way_of_writing_dates_is_permuted(spark):
    """Different dates of one way of writing have different pseudonyms, written and read the same way; none meets another way's."""
    days = spark.sql("SELECT explode(sequence(DATE'2001-01-01', DATE'2003-12-31')) AS d")
    ways = {"MM/dd/yyyy": "true", "dd/MM/yyyy": "day(d) > 12", "M/d/yyyy": "month(d) < 10 OR day(d) < 10", "d/M/yyyy": "day(d) > 12 AND month(d) < 10"}
    parts = [days.where(c).selectExpr(f"'{w}' AS way", f"date_format(d, '{w}') AS text") for w, c in ways.items()]
    docs = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).distinct()
    found = [(r["way"], r["text"]) for r in pseudonymize(docs, KEY).collect()]
    assert len({t for _, t in found}) == len(found) == docs.count()
    for way, text in found:
        a, b, c = text.split("/")
        assert ("0" in (a[0], b[0]) or len(a) + len(b) == 4) == (way in ("MM/dd/yyyy", "dd/MM/yyyy"))
        assert (date_or_none(int(c), int(a), int(b)) is None) == way.startswith("d")


def test_links_and_keys(spark):
    """Equal values have one pseudonym in all documents, another one under another key."""
    docs = spark.createDataFrame([(1, "4111111111111111 4111111111111111", "", 0), (2, "so 4111111111111111", "", 0), (2, "so 4111111111111111", "", 0)], SCHEMA)
    values = [re.findall(r"\d+", r["text"]) for r in pseudonymize(docs, KEY).collect()]
    assert len({v for x in values for v in x}) == 1
    assert {v for r in pseudonymize(docs, "other").collect() for v in re.findall(r"\d+", r["text"])}.isdisjoint(values[0])


def test_clean_texts_stay(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], "", 0) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(None, None, None, None), (1000, "", "", 0), (1001, "z" * 300_000 + " 1.2 3@ @x " * 1000, "", 0)]
    got = pseudonymize(spark.createDataFrame(rows, SCHEMA).repartition(3), KEY).collect()
    texts = {i: t for i, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_replaced"] == 0) == (r["text"] == texts[r["doc_id"]])
        for kind in (r"\+1 \(\d{3}\) \d{3}-\d{4}", r"(?<![\w.])[\w.]+@mail\d\.example\.com"):
            assert not set(re.findall(kind, texts[r["doc_id"]] or "")) & set(re.findall(kind, r["text"] or ""))
    assert pseudonymize(spark.createDataFrame([], SCHEMA), KEY).collect() == []


@pytest.mark.parametrize("part", ["a.", "a-", "1", "@", "a@", "a@a.", ".", "1.", "1-", "(", "+1 ", "4111 ", "25/", "Aa0@.-+() /", "x" * 62 + ".", "+44 ", "1/", "01 ", "DE89", "DE89 3704 "])
def test_long_texts_of_a_pattern(spark, part):
    """Texts of the letters of the patterns, as long as a large page, neither fail nor change."""
    text = ("a@" + part * (1_000_000 // len(part)))[:1_000_000]
    df = spark.createDataFrame([(1, text), (2, "me@" + "a." * 2000), (3, "a@" + "b." * 126 + "com")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in pseudonymize(df, KEY).collect()}
    assert found[2] == "me@" + "a." * 2000 and found[3].endswith("@" + "b." * 126 + "com")
    assert len(found[1]) == len(text)


def test_cards_in_three_groups(spark):
    cards = ["3782 822463 10005", "3782-822463-10005", "3782 822463 10006", "3782 822463-10005"]
    df = spark.createDataFrame([(i, f"pay {c}.") for i, c in enumerate(cards)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in pseudonymize(df, KEY).collect()}
    assert [found[i] for i in range(4)] == [f"pay {card(c)}." for c in cards[:3]] + [f"pay {cards[3]}."]
    assert found[0] != f"pay {cards[0]}."
