"""Format-preserving pseudonyms for personal data, in SQL functions alone.

Numbers that pass their own check (cards by the Luhn digit, social security numbers,
phone numbers, IPv4 addresses) and valid dates are numbered within their format, and that
number is permuted by a keyed Feistel network whose two halves have radices that multiply
to the size of the format. So a pseudonym has the same format, passes the same check, and
equal values have equal pseudonyms in every document, while different values keep
different ones. E-mail addresses and secrets, which have no number, get a keyed digest in
their format.

Found are cards of 13 to 19 digits, in one run or in the groups printed on cards, that begin
with any digit but 7 (of ISO 7812's industries, that of fuel cards); phone numbers of ten
digits as 3, 3 and 4, with points, hyphens, spaces or a bracketed area code, after +1 or
nothing; and those of 8 to 15 digits after a plus, in one run or, after a country code of up
to three digits, with single spaces. Other spellings of phone numbers are not found.

Addresses are found whole: letters of any alphabet, digits and ``._%+-``, apostrophes between
them, of any length, and any number of domain labels, at least two. Other signs end an
address on its left, quoted names and addresses in brackets are not found. Secrets follow
``token``, ``password``, ``passwd``, ``secret``, ``secret_key``, or the like of ``api``, ``access``,
``private`` or ``auth`` key, and a colon or an equals sign, or the word ``bearer`` if they hold a
digit; they have sixteen characters at least (letters, digits, ``+/_~-`` and points) before
any equals sign inside them. Shorter ones, and secrets named otherwise, are not found.

What stays as it is: separators; the first digit of a card, with 15 digits the first two
(its check digit is computed anew); the country code of a phone number; digits that fail their check; dates
outside of the years 1800 to 2199. A date with slashes and the year last is read month
first unless that is no month; there, two readings can give one pseudonym.

Defined results: null text stays null, text without such data stays as it is; repeated
rows stay repeated; other columns are untouched, whatever their names; an empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.llm.common import col

ROUNDS = 8

# Days of the 400 years from 1800 on, 146097, as the product of two radices.
FIRST_DAY, DAY_RADICES = "1800-01-01", (189, 773)

# Letters and digits of addresses: those of ASCII, and other characters but for blocks of punctuation and symbols.
_WORD = "A-Za-z0-9\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u1fff\u2c00-\u2dff\u3040-\ud7ff\uf900-\ufdff\ufe70-\ufefe\uff21-\uff3a\uff41-\uff5a\uff66-\uffdc\U00010000-\U0001efff\U00020000-\U000fffff"
_LOCAL = rf"[{_WORD}._%+-]"
_APOSTROPHE = "['\u2019]"
_LABEL = rf"[{_WORD}-]++"
# What a secret is made of: parts joined by points, then parts joined by equals signs; sixteen characters at least before one of these.
_PART = r"[0-9A-Za-z+/_~-]++(?:\.++[0-9A-Za-z+/_~-]++)*+"
_VALUE = rf"(?=[0-9A-Za-z+/_~.-]{{15}}[0-9A-Za-z+/_~-]){_PART}(?:=++(?:{_PART})?+)*+"
_KEYWORD = (r"(?:token|secret(?:[ _-]?(?:access[ _-]?)?key)?|passw(?:or)?d|(?:api|access|private|secret|auth)[ _-]?key)[\"']? ?[:=] ?[\"']?")
_BEARER = r"bearer +(?=[A-Za-z+/_~.-]*+[0-9])"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Runs are entered at their first character only, or after their keyword only, and are never given back, so that scanning is linear.
KINDS = {
    "secret": rf"(?i:{_KEYWORD}|{_BEARER}){_VALUE}",
    "email": rf"(?<!{_LOCAL})(?<!{_LOCAL}{_APOSTROPHE}){_LOCAL}++(?:{_APOSTROPHE}{_LOCAL}++)*+@{_LABEL}(?:\.{_LABEL})++",
    "phone": r"(?<![0-9])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
             r"|(?<![0-9+])\+[1-9][0-9]{7,14}+"
             r"|(?<![0-9+])(?=\+[0-9]{1,3} )\+[1-9](?: ?[0-9]){7,14}(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9./-])[0-9]{4}([/-])[0-9]{2}\1[0-9]{2}(?![0-9/-])"
            r"|(?<![0-9./-])[0-9]{2}([./])[0-9]{2}\2[0-9]{4}(?![0-9/-])",
    "address": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "card": r"(?<![0-9])(?:[0-689][0-9]{12,18}|[0-689][0-9]{3}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{4}"
            r"|3[47][0-9]{2}([ -])[0-9]{6}\4[0-9]{5})(?![0-9])",
}
# One look at the next character rules out most kinds at most places. Addresses go first: a number that begins one is part of it.
_NUMBERS = "|".join(KINDS[k] for k in ("phone", "ssn", "date", "address", "card"))
ANY_KIND = rf"(?={_LOCAL}){KINDS['email']}|(?=[0-9+(])(?:{_NUMBERS})|(?=[AaBbPpSsTt]){KINDS['secret']}"
# Every kind holds one of these characters; texts without them need no further look.
TRIGGER = "[0-9@:=]"  # a secret after "bearer" has a digit
# Telling apart what was found; the first that fits. Phones and numbers differ in their separators.
_SECRET = rf"^(?i:{_KEYWORD}|bearer +)"
_SHAPES = {
    "secret": _SECRET, "email": "@", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "date": r"^(?:[0-9]{4}[/-][0-9]{2}[/-][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$",
    "address": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", "card": r"^[0-689](?:[ -]?[0-9]){12,18}$",
}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _long(c: Column) -> Column:
    return c.try_cast("bigint")


def _quotient(x: Column, by: Column | int) -> Column:
    """Whole quotient of a bigint; a double would round it."""
    by = F.lit(by).cast("bigint") if isinstance(by, int) else by
    return F.call_function("div", x - F.pmod(x, by), by)


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def feistel(index: Column, a: Column | int, b: Column | int, key: str, tweak: str, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of 0 .. a * b - 1.

    The halves, a digit of radix a and one of radix b, take turns: each adds a keyed
    function of the other. Every round can be undone, so the whole is a permutation.
    """
    a, b = (F.lit(x).cast("bigint") if isinstance(x, int) else x for x in (a, b))

    def mixed(half: Column, turn: Column) -> Column:
        # 60 bits of the digest as a number.
        return _long(F.conv(F.substring(_digest(key, F.lit(tweak), turn, half), 1, 15), 16, 10))

    def step(s: Column, turn: Column) -> Column:
        left = F.when(turn % 2 == 0, F.pmod(s["left"] + mixed(s["right"], turn), a)).otherwise(s["left"])
        right = F.when(turn % 2 == 1, F.pmod(s["right"] + mixed(s["left"], turn), b)).otherwise(s["right"])
        return F.struct(left.alias("left"), right.alias("right"))

    start = _let(index, lambda x: F.struct(_quotient(x, b).alias("left"), F.pmod(x, b).alias("right")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["left"] * b + s["right"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _fill(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, one by one, by those given."""
    def filled(digits: Column) -> Column:
        def put(s: Column, c: Column) -> Column:
            is_digit = c.between("0", "9")
            new = F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)
            return F.struct(F.concat(s["out"], new).alias("out"), (s["at"] + is_digit.cast("int")).alias("at"))

        return F.aggregate(F.split(template, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), put,
                           lambda s: s["out"])

    return _let(digits, filled)


def _pad(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _power(exponent: Column) -> Column:
    return F.round(F.pow(F.lit(10.0), exponent)).cast("bigint")


def _permute_digits(digits: Column, key: str, tweak: str) -> Column:
    """A digit string of up to 17 places permuted among those of its length."""
    def permuted(d: Column) -> Column:
        n = F.length(d)
        low = F.floor(n / 2)
        return _pad(feistel(_long(d), _power(n - low), _power(low), key, tweak), n)

    return _let(digits, permuted)


def check_digit(payload: Column) -> Column:
    """Luhn check digit of a digit string: every other digit, from the last, counts double."""
    def check(payload: Column) -> Column:
        n = F.length(payload)

        def add(total: Column, i: Column) -> Column:
            d = F.substr(payload, n - i + 1, F.lit(1)).try_cast("int")
            double = d * 2
            return total + F.when(i % 2 == 0, d).when(double > 9, double - 9).otherwise(double)

        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
        return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))

    return _let(payload, check)


def _card(m: Column, key: str) -> Column:
    def changed(d: Column) -> Column:
        payload = F.left(d, F.length(d) - 1)
        fixed = F.when(F.length(d) == 15, 2).otherwise(1)
        middle = F.substr(payload, fixed + 1, F.length(payload) - fixed)
        new = _let(F.concat(F.left(d, fixed), _permute_digits(middle, key, "card")),
                   lambda x: F.concat(x, check_digit(x).cast("string")))
        return F.when(check_digit(payload).cast("string") == F.right(d, F.lit(1)), _fill(m, new)).otherwise(m)

    return _let(_digits(m), changed)


def _phone(m: Column, key: str) -> Column:
    """Ten digits after a North American code; else all but two digits after the plus."""
    d = _digits(m)
    fixed = F.when(m.startswith("+") & ~(m.startswith("+1") & (F.length(d) == 11)), F.lit(2)).otherwise(F.length(d) - 10)
    return _fill(m, F.concat(F.left(d, fixed), _permute_digits(F.substr(d, fixed + 1, F.length(d) - fixed), key, "phone")))


def _ssn(m: Column, key: str) -> Column:
    """898 areas (no 000, 666, 9xx), 99 groups, 9999 serial numbers."""
    d = _digits(m)
    area, group, serial = (_long(F.substring(d, *at)) for at in ((1, 3), (4, 2), (6, 4)))
    index = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    def spelled(x: Column) -> Column:
        area = _quotient(x, 99 * 9999)
        return F.concat_ws("-", _pad(area + F.when(area > 664, 2).otherwise(1), 3),
                           _pad(F.pmod(_quotient(x, 9999), F.lit(99)) + 1, 2), _pad(F.pmod(x, F.lit(9999)) + 1, 4))

    return _let(feistel(index, 898 * 99, 9999, key, "ssn"), spelled)


def _address(m: Column, key: str) -> Column:
    part = F.split(m, r"\.")
    index = _long(part[0]) * (1 << 24) + _long(part[1]) * 65536 + _long(part[2]) * 256 + _long(part[3])
    return _let(feistel(index, 65536, 65536, key, "address"), lambda x: F.concat_ws(
        ".", *[F.shiftright(x, 8 * k).bitwiseAND(255).cast("string") for k in (3, 2, 1, 0)]))


def _date(m: Column, key: str) -> Column:
    d, year_first = _digits(m), m.rlike("^[0-9]{4}[/-]")
    month_first = ~year_first & m.contains("/") & (_long(F.left(d, F.lit(2))) <= 12)
    iso = (F.when(year_first, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2)))
           .when(month_first, F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 1, 2), F.substring(d, 3, 2)))
           .otherwise(F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 3, 2), F.substring(d, 1, 2))))
    first = F.lit(FIRST_DAY).cast("date")
    index = F.date_diff(iso.try_cast("date"), first).cast("bigint")
    a, b = DAY_RADICES
    day = F.date_add(first, feistel(index, a, b, key, "date").cast("int"))
    new = _let(day, lambda x: F.when(year_first, F.date_format(x, "yyyyMMdd")).when(
        month_first, F.date_format(x, "MMddyyyy")).otherwise(F.date_format(x, "ddMMyyyy")))
    return F.when(index.between(0, a * b - 1), _fill(m, new)).otherwise(m)


def _email(m: Column, key: str) -> Column:
    address = F.lower(m)
    domain = F.split(address, "@")[1]
    return F.concat(F.lit("u"), F.left(_digest(key, F.lit("user"), address), F.lit(16)),
                    F.lit("@d"), F.left(_digest(key, F.lit("domain"), domain), F.lit(8)), F.lit(".example"))


def _secret(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, _SECRET, 0)
    value = F.substr(m, F.length(head) + 1, F.length(m) - F.length(head))
    first = F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), F.lower(value)), 512)

    def lengthened(first: Column) -> Column:
        """128 hex digits, and further blocks of as many that are digests of the first."""
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(value) - 1) / 128).cast("int")), lambda i: F.when(
            i == 0, first).otherwise(F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), i.cast("string"), first), 512)))
        return F.left(F.array_join(blocks, ""), F.length(value))

    new = _let(first, lengthened)
    return F.concat(head, F.when(value == F.upper(value), F.upper(new)).otherwise(new))


_CHANGE: dict[str, Callable[[Column, str], Column]] = {
    "secret": _secret, "email": _email, "ssn": _ssn, "date": _date, "address": _address, "card": _card}


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of one value that a pattern of KINDS has found."""
    out = None
    for kind, shape in _SHAPES.items():
        fits = m.rlike(shape)
        out = F.when(fits, _CHANGE[kind](m, key)) if out is None else out.when(fits, _CHANGE[kind](m, key))
    return F.coalesce(out.otherwise(_phone(m, key)), m)


def pseudonymise_column(text: Column, key: str) -> Column:
    """The text with every value found replaced; whole text, one pass for gaps and one for values."""
    gaps = F.split(text, ANY_KIND, -1)
    values = F.transform(F.regexp_extract_all(text, F.lit(ANY_KIND), F.lit(0)), lambda m: pseudonym(m, key))
    joined = F.array_join(F.zip_with(gaps, values, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    return F.when(text.rlike(TRIGGER), joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The input with pseudonyms in its text column; all other columns stay as they are."""
    return docs.withColumn(text, pseudonymise_column(col(text), key))
