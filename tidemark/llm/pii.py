"""Personal data replaced by format-preserving pseudonyms, with DataFrame functions only.

Card numbers (Luhn), IBANs (mod 97), social security numbers, telephone numbers, IPv4 addresses and calendar dates are
checked and then permuted within their own format by a keyed Feistel network; check digits are made anew. The local part
of an e-mail address is permuted within each character's class. A permutation maps equal values to equal pseudonyms and
different ones to different ones, so links across documents stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# What a value looks like, as patterns for Java.
NAME_CHARS = r"\p{L}\p{M}\p{N}._%+'-"
EMAIL = rf"(?<![{NAME_CHARS}])[{NAME_CHARS}]{{1,64}}@(?:[\p{{L}}\p{{M}}\p{{N}}_-]{{1,63}}\.){{1,8}}[\p{{L}}\p{{M}}]{{2,24}}(?![\p{{L}}\p{{M}}\p{{N}}])"
IBAN = r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?:[ \u00A0]?[A-Za-z0-9]{4}){2,7}(?:[ \u00A0]?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9])(?!\.[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])(?![./-][0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
PHONE_ABROAD = r"(?<![0-9+])\+[1-9](?:[ \u00A0.()-]{0,2}[0-9]){7,40}(?![0-9])"  # what follows the number included
BETWEEN = r"(?:[ \u00A0\u202F\u2010-\u2015-]{0,2}|\.(?=[0-9]{3,6}(?![0-9])))"  # what may part a card number's digits
CARD = rf"(?<![0-9])[0-9](?:{BETWEEN}[0-9]){{12,40}}(?![0-9])"  # what follows the number included
GROUPS = r"(?<=[^0-9])(?=[0-9])"
# Leading digits of issuers with the lengths of their numbers, and how numbers are usually grouped.
ISSUER = (
    r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}|3[47][0-9]{13}"
    r"|(?:6011|64[4-9][0-9]|65[0-9]{2}|35[0-9]{2}|62[0-9]{2})[0-9]{12,15}|(?:30[0-5]|3[689][0-9])[0-9]{11,16}|(?:50|5[6-9]|6[0-9])[0-9]{11,17})$"
)
GROUPED = r"^(?:[0-9]{13,19}|[0-9]{4}[^0-9]+[0-9]{4}[^0-9]+[0-9]{4}[^0-9]+[0-9]{4}(?:[^0-9]+[0-9]{3})?|[0-9]{4}[^0-9]+[0-9]{6}[^0-9]+[0-9]{4,5})$"
KINDS = {"email": EMAIL, "iban": IBAN, "ipv4": IPV4, "date": DATE, "ssn": SSN, "phone": PHONE, "phone_abroad": PHONE_ABROAD, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
FIRST_DAY, DAYS = "1700-01-01", (189, 773)  # 400 years have 146,097 = 189 * 773 days


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once and stands once in the plan."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def keyed(key: str, tweak: Column, number: Column, half: Column) -> Column:
    """The round function: the hex SHA-256 of key, tweak, round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), tweak, number.cast("string"), half), 256)


def feistel(a: Column, b: Column, na: Column, nb: Column, key: str, tweak: Column) -> Column:
    """Permutes pairs of 0 <= a < na and 0 <= b < nb (each at most 10**9): rounds add a keyed function of one half to the other in turn."""

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        value = F.conv(F.substring(keyed(key, tweak, r, F.when(even, s["b"]).otherwise(s["a"]).cast("string")), 1, 13), 16, 10).cast("long")
        return F.struct(F.when(even, (s["a"] + value) % na).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise((s["b"] + value) % nb).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def digits_permuted(digits: Column, key: str, tweak: str) -> Column:
    """Permutes strings of n digits, for each n from 1 to 18."""

    def halves(d: Column) -> Column:
        n = F.length(d)
        left = F.floor(n / 2).cast("int")
        return F.struct(
            n.alias("n"), left.alias("left"), F.pow(F.lit(10), left).cast("long").alias("na"), F.pow(F.lit(10), n - left).cast("long").alias("nb"),
            F.when(left > 0, d.substr(F.lit(1), left)).otherwise("0").cast("long").alias("a"), d.substr(left + 1, n - left).cast("long").alias("b"),
        )

    def joined(h: Column, s: Column) -> Column:
        return F.concat(F.when(h["left"] > 0, F.lpad(s["a"].cast("string"), h["left"], "0")).otherwise(""), F.lpad(s["b"].cast("string"), h["n"] - h["left"], "0"))

    permuted = lambda h: feistel(h["a"], h["b"], h["na"], h["nb"], key, F.concat(F.lit(tweak), h["n"].cast("string")))
    return let(let(digits, halves), lambda h: let(permuted(h), lambda s: joined(h, s)))


def chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def refilled(form: Column, digits: Column, what: str = "[0-9]") -> Column:
    """``form`` with its characters of class ``what`` replaced, in turn, by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        hit = c.rlike(what)
        return F.struct(F.concat(s["out"], F.when(hit, digits.substr(s["at"], F.lit(1))).otherwise(c)).alias("out"), F.when(hit, s["at"] + 1).otherwise(s["at"]).alias("at"))

    return F.aggregate(chars(form), start, step, lambda s: s["out"])


def only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The sum whose last digit is 0 for a valid number."""
    each = F.transform(F.reverse(chars(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda x, y: x + y)


def card_window(pieces: Column) -> Column:
    """The best card number that begins with the first of ``pieces`` (a group of digits and what follows it) and ends with a
    group: rank, length (negative) and text. Rank 0: an issuer's, grouped as usual; 1: an issuer's; 2: any other of 13 to 19
    digits with a valid check digit. Of equal rank the longest. Null if there is none."""
    text = lambda n: F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), n), ""), "[^0-9]+$", "")
    texts = F.transform(F.sequence(F.lit(1), F.least(F.size(pieces), F.lit(19))), text)
    windows = F.transform(texts, lambda x: F.struct(x.alias("text"), only_digits(x).alias("digits")))
    valid = F.filter(windows, lambda w: F.length(w["digits"]).between(13, 19) & (luhn_sum(w["digits"]) % 10 == 0))
    rank = lambda w: F.when(~w["digits"].rlike(ISSUER), 2).when(w["text"].rlike(GROUPED), 0).otherwise(1)
    return F.array_min(F.transform(valid, lambda w: F.struct(rank(w).alias("rank"), (-F.length(w["digits"])).alias("length"), w["text"].alias("text"))))


def later_windows(pieces: Column) -> Column:
    """Of each group but the first: how many pieces stand before it, and the rank of the best card number that begins there."""
    rest = lambda i: F.slice(pieces, i + 1, F.size(pieces))
    places = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: i > 0)
    return F.transform(places, lambda i: F.struct(i.alias("at"), card_window(rest(i))["rank"].alias("rank")))


def card_windows(value: Column) -> Column:
    """The window to replace in a candidate: none if a better number begins inside it, which is then found from there."""
    pieces = F.split(value, GROUPS)

    def kept(x: Column) -> Column:
        own, later = x["own"], x["later"]
        inside = lambda y: F.length(F.array_join(F.slice(x["pieces"], F.lit(1), y["at"]), "")) < F.length(own["text"])
        better = F.exists(later, lambda y: (y["rank"] < own["rank"]) & inside(y))
        return F.when(own.isNull() | better, F.lit("")).otherwise(own["text"])

    parts = F.transform(F.array(pieces), lambda p: F.struct(p.alias("pieces"), card_window(p).alias("own"), later_windows(p).alias("later")))
    return F.transform(parts, kept)


def abroad_windows(value: Column) -> Column:
    """The longest start with 8 to 15 digits that ends with a group and before any other kind that begins with a group."""
    pieces = F.split(value, GROUPS)
    other = "^(?:" + "|".join(f"(?:{p})" for p in (IPV4, DATE, SSN)) + ")"

    def kept(x: Column) -> Column:
        text = lambda n: F.regexp_replace(F.array_join(F.slice(x["pieces"], F.lit(1), n), ""), "[^0-9]+$", "")
        from_here = lambda i: F.array_join(F.slice(x["pieces"], i + 1, F.size(x["pieces"])), "")
        stops = F.filter(x["later"], lambda y: (y["rank"] < 2) | from_here(y["at"]).rlike(other))
        most = F.coalesce(F.array_min(F.transform(stops, lambda y: y["at"])), F.size(x["pieces"]))
        return F.array_max(F.filter(F.transform(F.sequence(F.lit(1), most), text), lambda w: F.length(only_digits(w)).between(8, 15)))

    parts = F.transform(F.array(pieces), lambda p: F.struct(p.alias("pieces"), later_windows(p).alias("later")))
    return F.transform(parts, lambda x: F.coalesce(kept(x), F.lit("")))


def card(value: Column, key: str) -> Column:
    """The first digit (the industry's) stays."""

    def made(digits: Column) -> Column:
        body = F.concat(F.substring(digits, 1, 1), digits_permuted(digits.substr(F.lit(2), F.length(digits) - 2), key, "card"))
        check = lambda b: ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")
        return F.when(luhn_sum(digits) % 10 == 0, let(body, lambda b: refilled(value, F.concat(b, check(b)))))

    return let(only_digits(value), made)


def mod97(s: Column) -> Column:
    numbers = F.transform(chars(s), lambda c: F.when(c.rlike("[0-9]"), c.cast("long")).otherwise(F.ascii(c) - 55))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda x, d: (x * F.when(d > 9, 100).otherwise(10) + d) % 97)


def iban(value: Column, key: str) -> Column:
    """The country stays; letters keep their case."""

    def made(bare: Column) -> Column:
        land, body = F.substring(bare, 1, 2), bare.substr(F.lit(5), F.length(bare) - 4)
        check = lambda new: F.lpad((98 - mod97(F.upper(F.concat(new, land, F.lit("00"))))).cast("string"), 2, "0")
        valid = (mod97(F.upper(F.concat(body, F.substring(bare, 1, 4)))) == 1) & F.length(bare).between(15, 34)
        whole = let(class_permuted(body, key, "iban"), lambda new: refilled(value, F.concat(land, check(new), new), "[A-Za-z0-9]"))
        return F.when(valid, whole)

    return let(F.regexp_replace(value, "[ \u00A0]", ""), made)


def ssn(value: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999: all 898 * 99 * 9999 stay in that range."""
    area, group, serial = (F.split(value, "-")[i].cast("long") for i in range(3))
    s = feistel((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"))
    new = lambda s: F.floor(s["a"] / 99) + 1
    return let(s, lambda s: F.format_string("%03d-%02d-%04d", new(s) + F.when(new(s) > 665, 1).otherwise(0), s["a"] % 99 + 1, s["b"] + 1))


def phone(value: Column, key: str) -> Column:
    """Area code and exchange keep a first digit of 2 to 9; the prefix +1 and all punctuation stay."""

    def made(digits: Column) -> Column:
        start = F.length(digits) - 10
        part = lambda i, n: digits.substr(start + i, F.lit(n)).cast("long")
        half = lambda x: F.format_string("%05d", x + 20000)
        # two halves of 80,000: area and two digits of the line; exchange and the other two
        s = feistel(part(1, 3) * 100 + part(7, 2) - 20000, part(4, 3) * 100 + part(9, 2) - 20000, F.lit(80000), F.lit(80000), key, F.lit("phone"))
        halves = let(s, lambda s: F.struct(half(s["a"]).alias("a"), half(s["b"]).alias("b")))
        new = lambda h: [F.substring(h[c], *at) for at in ((1, 3), (4, 2)) for c in "ab"]
        return let(halves, lambda h: refilled(value, F.concat(digits.substr(F.lit(1), start), *new(h))))

    return let(only_digits(value), made)


def phone_abroad(value: Column, key: str) -> Column:
    """The first two digits (the country's) stay."""
    new = lambda d: F.concat(F.substring(d, 1, 2), digits_permuted(d.substr(F.lit(3), F.length(d) - 2), key, "abroad"))
    return let(only_digits(value), lambda d: refilled(value, new(d)))


def ipv4(value: Column, key: str) -> Column:
    o = [F.split(value, r"\.")[i].cast("long") for i in range(4)]
    s = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, F.lit("ipv4"))
    return let(s, lambda s: F.concat_ws(".", *(x.cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256))))


def date(value: Column, key: str) -> Column:
    """Calendar dates of 1700 to 2099. With slashes the month is first if that gives a date, else the day; with dots the day is first."""
    iso, dots = value.contains("-"), value.contains(".")
    ymd = lambda y, m, d: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    first = F.lit(FIRST_DAY).cast("date")

    def read(part: Column) -> Column:
        month_first = F.when(~iso & ~dots, ymd(part[2], part[0], part[1]))
        day = F.when(iso, ymd(part[0], part[1], part[2])).otherwise(F.coalesce(month_first, ymd(part[2], part[1], part[0])))
        return F.struct(day.alias("day"), month_first.isNotNull().alias("by_month"))

    def shown(new: Column, by_month: Column) -> Column:
        as_form = lambda form: let(new, lambda d: F.date_format(d, form))
        return F.when(iso, as_form("yyyy-MM-dd")).when(dots, as_form("dd.MM.yyyy")).when(by_month, as_form("MM/dd/yyyy")).otherwise(as_form("dd/MM/yyyy"))

    def made(x: Column) -> Column:
        number = F.datediff(x["day"], first).cast("long")
        s = feistel(F.floor(number / DAYS[1]), number % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, F.lit("date"))
        new = let(s, lambda s: shown(F.date_add(first, (s["a"] * DAYS[1] + s["b"]).cast("int")), x["by_month"]))
        return F.when(F.year(x["day"]).between(1700, 2099), new)

    return let(let(F.transform(F.split(value, "[-/.]"), lambda x: x.cast("int")), read), made)


def class_permuted(value: Column, key: str, tweak: str) -> Column:
    """Permutes strings character by character: digits stay digits, letters of each case (those from U+00C0 to U+00F6 among
    themselves) letters of that case; others stay as they are."""
    n = F.length(value)
    left = F.floor(n / 2).cast("int")

    def shifted(half: Column, stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = F.conv(stream.substr(i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            turn = lambda first, n: F.chr(F.lit(first) + (code - first + by) % n)
            plain = F.when(c.rlike("[0-9]"), turn(48, 10)).when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26))
            return plain.when(c.rlike("[\u00e0-\u00f6]"), turn(0xE0, 23)).when(c.rlike("[\u00c0-\u00d6]"), turn(0xC0, 23)).otherwise(c)

        return F.array_join(F.transform(chars(half), one), "")

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        stream = keyed(key, F.lit(tweak), r, F.lower(F.when(even, s["b"]).otherwise(s["a"])))
        return F.struct(F.when(even, shifted(s["a"], stream)).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(shifted(s["b"], stream)).alias("b"))

    halves = F.struct(value.substr(F.lit(1), left).alias("a"), value.substr(left + 1, n - left).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, step, lambda s: F.concat(s["a"], s["b"]))


def email(value: Column, key: str) -> Column:
    at = F.instr(value, "@")
    return F.concat(class_permuted(value.substr(F.lit(1), at - 1), key, "email"), value.substr(at, F.length(value)))


MAKERS = {"email": email, "iban": iban, "ipv4": ipv4, "date": date, "ssn": ssn, "phone": phone, "phone_abroad": phone_abroad, "card": card}


def pseudonym(value: Column, key: str) -> Column:
    """length and text (the pseudonym) of the start of a candidate that is a valid value; null where none is (a number without a valid check digit, no date).

    IBANs end where no digit or letter follows, the longest first; for cards and foreign telephone numbers see their windows.
    """

    def windows(kind: str) -> Column:
        if kind == "card":
            return card_windows(value)
        if kind == "phone_abroad":
            return abroad_windows(value)
        if kind == "iban":
            start, group = r"^[A-Za-z]{2}[0-9]{2}", r"(?:[ \u00A0]?[A-Za-z0-9]{4})"
            tails = (r"(?:[ \u00A0]?[A-Za-z0-9]{1,3})", "")
            return F.array(*(F.regexp_extract(value, rf"{start}{group}{{{n}}}{tail}(?![A-Za-z0-9])", 0) for n in range(7, 1, -1) for tail in tails))
        return F.array(value)

    def first(kind: str) -> Column:
        made = F.transform(F.filter(windows(kind), lambda w: w != ""), lambda w: F.struct(F.length(w).alias("length"), MAKERS[kind](w, key).alias("text")))
        return F.get(F.filter(made, lambda m: m["text"].isNotNull()), F.lit(0))

    cases = [(value.rlike(f"^(?:{p})$"), first(k)) for k, p in KINDS.items()]
    return reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0]))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every valid value in ``text_col`` replaced; rows and other columns stay. No shuffle.

    Candidates are tried at every start, from left to right: where one has a valid value, it is replaced, and the search
    goes on after it; else it goes on at the next start, inside the candidate too.

    ``count_col`` adds how many values were replaced. A null text stays null with count 0, an empty one empty. Repeated
    rows get equal results. A column ``n_chars`` gets the length of a text that changes (IPv4 addresses and dates without
    leading zeros may change it).
    """
    made_col = next(c for c in map("_made{}".format, range(len(docs.columns) + 1)) if c not in docs.columns)
    text = F.col(text_col)
    led = F.concat(F.lit("\n"), text)  # a split has no piece before a match at the very start
    pieces, found = F.split(led, f"(?={ANY})", -1), F.regexp_extract_all(led, F.lit(f"(?=({ANY}))"), F.lit(1))
    start = lambda x: F.struct(F.get(x["p"], F.lit(0)).alias("out"), F.lit(0).alias("skip"), F.lit(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        piece, free, m = x["piece"], s["skip"] == 0, x["m"]
        hit = free & m.isNotNull()
        over = F.when(hit, m["length"]).otherwise(s["skip"])  # how much of the text from here on is replaced
        rest = piece.substr(over + 1, F.length(piece))
        return F.struct(
            F.concat(s["out"], F.when(hit, m["text"]).otherwise(""), rest).alias("out"), F.greatest(over - F.length(piece), F.lit(0)).alias("skip"),
            F.when(hit & (m["text"] != x["value"].substr(F.lit(1), m["length"])), s["n"] + 1).otherwise(s["n"]).alias("n"),
        )

    # transform over one array of a struct, so that pieces and pseudonyms are computed once for both columns
    tried = lambda x: F.zip_with(F.slice(x["p"], F.lit(2), F.size(x["f"])), x["f"], lambda p, v: F.struct(p.alias("piece"), v.alias("value"), pseudonym(v, key).alias("m")))
    walked = F.transform(F.array(F.struct(pieces.alias("p"), found.alias("f"))), lambda x: F.aggregate(tried(x), start(x), step))
    made = F.when(text.rlike("[0-9@]"), F.transform(walked, lambda s: F.struct(s["out"].substr(F.lit(2), F.length(s["out"])).alias("text"), s["n"].alias("n")))[0])
    out = docs.withColumn(made_col, made)
    new, n = F.col(f"{made_col}.text"), F.coalesce(F.col(f"{made_col}.n"), F.lit(0))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(n > 0, F.length(new).cast(kind)).otherwise(F.col("n_chars")))
    if count_col:
        out = out.withColumn(count_col, n)
    return out.withColumn(text_col, F.coalesce(new, text)).drop(made_col)
