"""Pseudonyms against a plain version, and what must hold for every value."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii

KEY = "k"


def keyed(tweak, r, half):
    return hashlib.sha256(f"{KEY}|{tweak}|{r}|{half}".encode()).hexdigest()


def feistel(a, b, na, nb, tweak):
    for r in range(pii.ROUNDS):
        value = int(keyed(tweak, r, b if r % 2 == 0 else a)[:13], 16)
        if r % 2 == 0:
            a = (a + value) % na
        else:
            b = (b + value) % nb
    return a, b


def digits_permuted(digits, tweak):
    n = len(digits)
    u = n // 2
    a, b = feistel(int(digits[:u] or 0), int(digits[u:]), 10**u, 10 ** (n - u), f"{tweak}{n}")
    return (str(a).zfill(u) if u else "") + str(b).zfill(n - u)


def luhn(digits):
    return sum((lambda x: x - 9 * (x > 9))(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(digits))) % 10


def card(value):
    digits = "".join(c for c in value if c.isdigit())
    if luhn(digits):
        return value
    body = digits[0] + digits_permuted(digits[1:-1], "card")
    new = iter(body + str((10 - luhn(body + "0")) % 10))
    return "".join(next(new) if c.isdigit() else c for c in value)


def shift(half, stream):
    out = ""
    for i, c in enumerate(half):
        by = int(stream[i % 32 * 2 : i % 32 * 2 + 2], 16)
        first, n = (48, 10) if c.isdigit() else (97, 26) if "a" <= c <= "z" else (65, 26) if "A" <= c <= "Z" else (0, 0)
        out += chr(first + (ord(c) - first + by) % n) if n else c
    return out


def email(value):
    local, at, domain = value.partition("@")
    a, b = local[: len(local) // 2], local[len(local) // 2 :]
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = shift(a, keyed("email", r, b.lower()))
        else:
            b = shift(b, keyed("email", r, a.lower()))
    return a + b + at + domain


def ipv4(value):
    o = list(map(int, value.split(".")))
    a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def date(value):
    n = (dt.date.fromisoformat(value) - dt.date(1700, 1, 1)).days
    a, b = feistel(n // 773, n % 773, 189, 773, "date")
    return (dt.date(1700, 1, 1) + dt.timedelta(a * 773 + b)).isoformat()


def masked(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    return [(r.text, r.n) for r in pii.pseudonymised(df, KEY, count_col="n").orderBy("doc_id").collect()]


def test_values_against_a_plain_version(spark):
    cases = ["4111 1111 1111 1111", "378282246310005", "4111111111111112", "a.Bc+9@mail.example.com", "x@y.org", "10.0.255.1", "2024-02-29", "1700-01-01", "2099-12-31"]
    want = [card(cases[0]), card(cases[1]), cases[2], email(cases[3]), email(cases[4]), ipv4(cases[5]), date(cases[6]), date(cases[7]), date(cases[8])]
    got = masked(spark, *(f"Ä {c}, end" for c in cases))
    assert [t for t, _ in got] == [f"Ä {w}, end" for w in want]
    assert [n for _, n in got] == [int(c != w) for c, w in zip(cases, want, strict=True)]


def test_formats_stay_valid(spark):
    texts = ["call +1 (383) 555-6083 now", "383-555-6083", "ssn 123-45-6789", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "+49 30 901820", "31.12.1999", "12/31/1999", "31/12/1999", "30.02.1999", "000-45-6789", "version 1.2.3.4.5"]
    got = [t for t, _ in masked(spark, *texts)]
    import re

    assert re.fullmatch(r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} now", got[0])
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(got[0])[1:] == digits(got[1])
    assert re.fullmatch(r"ssn (?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", got[2])
    for t in got[3:5]:
        bare = t.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    assert got[3][:2] == "DE"
    assert [len(x) for x in got[3].split()] == [4, 4, 4, 4, 4, 2]
    assert got[5].startswith("+49 ")
    days = [dt.datetime.strptime(got[6], "%d.%m.%Y"), dt.datetime.strptime(got[7], "%m/%d/%Y")]
    assert days[0] == days[1]
    assert got[9:] == texts[9:]
    assert all(a != b for a, b in zip(got[:9], texts[:9], strict=True))


def test_permutations_are_one_to_one(spark):
    two = spark.range(100).select(pii.digits_permuted(F.lpad(F.col("id").cast("string"), 2, "0"), KEY, "t").alias("x"))
    assert two.distinct().count() == 100
    three = spark.range(1000).select(pii.digits_permuted(F.lpad(F.col("id").cast("string"), 3, "0"), KEY, "t").alias("x"))
    assert three.distinct().count() == 1000
    days = spark.range(3000).select(pii.date(F.date_format(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd"), KEY).alias("x"))
    assert days.distinct().count() == 3000


def test_edges(spark):
    long = "word " * 50_000 + "4111111111111111"
    got = masked(spark, None, "", "   ", "clean text, no values", "@ 12 @", long, "a.b@c.de a.b@c.de", "ü.x@mail.example.com")
    assert got[:5] == [(None, 0), ("", 0), ("   ", 0), ("clean text, no values", 0), ("@ 12 @", 0)]
    assert got[5] == (long[:-16] + card("4111111111111111"), 1)
    a, b = got[6][0].split()
    assert (a, got[6][1]) == (b, 2)
    assert got[7][1] == 1


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert pii.pseudonymised(empty, KEY).columns == ["doc_id", "text", "n_chars"]
    assert pii.pseudonymised(empty, KEY).count() == 0
    df = spark.createDataFrame([(None, "10.0.0.1", "s", 1), (None, "10.0.0.1", "s", 1)], "doc_id long, text string, s string, n int")
    rows = pii.pseudonymised(df, KEY).collect()
    assert [r.text for r in rows] == [ipv4("10.0.0.1")] * 2
    assert [r.n for r in rows] == [1, 1]


@pytest.mark.parametrize("name", ["op1_pii_pseudonyms"])
def test_query_is_native(spark, sf_dir, name):
    from tidemark.llm import queries

    df = queries.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
    assert "Exchange" not in plan
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_values_beside_other_digits_and_capitals(spark):
    c, i = "4111 1111 1111 1111", "PL61109010140000071219812874"
    forms = ["card {} 12/25", "order 12 {}", "{} 123", "7 7 3 1 5 6 2 9 {}", "{}", "9 {} 5500 0000 0000 0004"]
    got = [t for t, _ in masked(spark, *(f.format(c) for f in forms), "order 12 4111111111111111 123", f"{i} EUR", f"AB12 {i}", "12 123-45-6789 55555")]
    want = [f.format(card(c)) for f in forms]
    want[-1] = want[-1].replace("5500 0000 0000 0004", card("5500 0000 0000 0004"))
    assert got[:6] == want
    assert got[6] == f"order 12 {card('4111111111111111')} 123"
    alone = masked(spark, i)[0][0]
    assert alone != i
    assert got[7:9] == [f"{alone} EUR", f"AB12 {alone}"]
    assert got[9] == f"12 {masked(spark, '123-45-6789')[0][0]} 55555"


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    return [(r.text, r.n) for r in pii.pseudonymised(df, KEY, count_col="n").orderBy("i").collect()]


CARDS = ["4111 1111 1111 1111", "5500-0055-5555-5559", "3782 822463 10005", "6011000990139424"]


def test_cards_behind_random_digits_are_found(spark):
    """Of 400 cards behind one to nine random digits at most 1 % lose their pseudonym, and none keeps its last four digits."""
    import random

    draw = random.Random(7)
    rows = [(draw.choice(CARDS), "".join(draw.choices("0123456789", k=draw.randint(1, 9)))) for _ in range(400)]
    found = replaced(spark, [f"order {digits} {number} paid" for number, digits in rows])
    linked = sum(text == f"order {digits} {card(number)} paid" for (number, digits), (text, _) in zip(rows, found, strict=True))
    clear = [text for (number, _), (text, _) in zip(rows, found, strict=True) if number[-4:] + " paid" in text]
    assert linked >= 396
    assert not [x for x in clear if card(x) != x]


def test_cards_after_foreign_numbers(spark):
    for number in CARDS:
        (text, n), (alone, _) = replaced(spark, [f"+49 30 901820 {number}", "+49 30 901820"])
        assert (text, n) == (f"{alone} {card(number)}", 2)
    (text, n), (alone, _) = replaced(spark, ["call +44 20 7946 0958 12.03.1990 or", "call +44 20 7946 0958"])
    assert n == 2 and text.startswith(alone) and "12.03.1990" not in text


@pytest.mark.parametrize("between", ["\u00A0", ".", "\u2013", "  ", "\u202F"])
def test_cards_parted_otherwise(spark, between):
    value = between.join(["4111", "1111", "1111", "1111"])
    digits = card("4111111111111111")
    assert replaced(spark, [f"card {value}, thanks"]) == [(f"card {between.join(digits[i : i + 4] for i in range(0, 16, 4))}, thanks", 1)]


def test_addresses_beyond_ascii(spark):
    values = ["max@müller.de", "Hans.Müller@example.com", "x7@sub_domain.example.com", "łukasz@przykład.pl", "o'neil@example.org"]
    for value, (text, n) in zip(values, replaced(spark, [f"to {x} today" for x in values]), strict=True):
        local, domain = value.split("@")
        found = text.removeprefix("to ").removesuffix(" today")
        assert n == 1 and found.endswith("@" + domain) and found != value and len(found) == len(value), text
    assert "Mü" not in replaced(spark, ["Hans.Müller@example.com"])[0][0]


def plain_iban(value):
    bare = value.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if as_number(bare[4:] + bare[:4]) % 97 != 1:
        return value
    a, b = bare[4 : 4 + (len(bare) - 4) // 2], bare[4 + (len(bare) - 4) // 2 :]
    for r in range(pii.ROUNDS):
        a, b = (shift(a, keyed("iban", r, b.lower())), b) if r % 2 == 0 else (a, shift(b, keyed("iban", r, a.lower())))
    new = iter(f"{bare[:2]}{98 - as_number(a + b + bare[:2] + '00') % 97:02d}{a}{b}")
    return "".join(next(new) if c != " " else c for c in value)


def plain_ssn(value):
    area, group, serial = map(int, value.split("-"))
    a, b = feistel((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn")
    new = a // 99 + 1
    return f"{new + (new > 665):03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def plain_phone(value):
    digits = "".join(c for c in value if c.isdigit())
    part = lambda i, n: int(digits[len(digits) - 10 + i - 1 :][:n])
    a, b = feistel(part(1, 3) * 100 + part(7, 2) - 20000, part(4, 3) * 100 + part(9, 2) - 20000, 80000, 80000, "phone")
    a, b = f"{a + 20000:05d}", f"{b + 20000:05d}"
    new = iter(digits[:-10] + a[:3] + b[:3] + a[3:] + b[3:])
    return "".join(next(new) if c.isdigit() else c for c in value)


def plain_abroad(value):
    digits = "".join(c for c in value if c.isdigit())
    new = iter(digits[:2] + digits_permuted(digits[2:], "abroad"))
    return "".join(next(new) if c.isdigit() else c for c in value)


def test_other_kinds_equal_a_plain_version(spark):
    cases = [(plain_iban, x) for x in ("DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "gb82west12345698765432", "de89 3704 0044 0532 0130 00", "PL61109010140000071219812874")]
    cases += [(plain_ssn, x) for x in ("123-45-6789", "899-99-9999", "001-01-0001", "665-10-2000", "667-10-2000")]
    cases += [(plain_phone, x) for x in ("(212) 555-0123", "+1 415-555-2671", "999.999.9999", "212 555 0100")]
    cases += [(plain_abroad, x) for x in ("+49 30 901820", "+442079460958", "+33 1 42 68 53 00", "+81-3-1234-5678")]
    got = replaced(spark, [f"see {x} there" for _, x in cases])
    assert got == [(f"see {f(x)} there", int(f(x) != x)) for f, x in cases]
    assert all(f(x) != x for f, x in cases)


def test_clashing_columns_and_lengths(spark):
    rows = [(1, "at 192.168.100.200 now", 22, "a", 7), (2, "nothing", 99, "b", 8), (3, None, None, "c", 9)]
    df = spark.createDataFrame(rows, "_made0 int, text string, n_chars long, _made string, n int")
    out = pii.pseudonymised(df, KEY)
    assert out.columns == df.columns
    got = {r._made0: r for r in out.collect()}
    assert got[1].n_chars == len(got[1].text) and (got[2].n_chars, got[3].n_chars) == (99, None)
    assert [(got[i]._made, got[i].n) for i in (1, 2, 3)] == [("a", 7), ("b", 8), ("c", 9)]
