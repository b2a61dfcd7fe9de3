"""Pseudonyms against a plain Python reading of the definition."""

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyboard.llm import pseudonyms as P, queries

SF = "/root/testdata/sf0.001"
KEY = "a key"


def feistel(index, a, b, tweak, rounds=8):
    left, right = divmod(index, b)
    for r in range(rounds):
        half = left if r % 2 else right
        mixed = int(hashlib.sha256(f"{KEY}|{tweak}|{r}|{half}".encode()).hexdigest()[:15], 16)
        if r % 2:
            right = (right + mixed) % b
        else:
            left = (left + mixed) % a
    return left * b + right


def luhn(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def permute(digits, tweak):
    low = len(digits) // 2
    return str(feistel(int(digits), 10 ** (len(digits) - low), 10 ** low, tweak)).zfill(len(digits))


def fill(template, digits):
    it = iter(digits)
    return "".join(next(it) if c.isascii() and c.isdigit() else c for c in template)


def plain(m):
    d = re.sub("[^0-9]", "", m)
    secret = re.match(P._SECRET, m)
    if secret:
        value = m[secret.end():]
        new = hashlib.sha512(f"{KEY}|secret|{value.lower()}".encode()).hexdigest()[:len(value)]
        return secret[0] + (new.upper() if value == value.upper() else new)
    if "@" in m:
        user = hashlib.sha256(f"{KEY}|user|{m.lower()}".encode()).hexdigest()[:16]
        return f"u{user}@d{hashlib.sha256(f'{KEY}|domain|{m.lower().split('@')[1]}'.encode()).hexdigest()[:8]}.example"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", m):
        area = [a for a in range(1, 900) if a != 666]
        x = feistel((area.index(int(d[:3])) * 99 + int(d[3:5]) - 1) * 9999 + int(d[5:]) - 1, 898 * 99, 9999, "ssn")
        return f"{area[x // 9999 // 99]:03}-{x // 9999 % 99 + 1:02}-{x % 9999 + 1:04}"
    if re.fullmatch(r"\d{4}[/-]\d\d[/-]\d\d|\d\d[./]\d\d[./]\d{4}", m):
        form = "%Y%m%d" if m[4] in "/-" else "%m%d%Y" if "/" in m and int(d[:2]) <= 12 else "%d%m%Y"
        try:
            index = (datetime.datetime.strptime(d, form).date() - datetime.date(1800, 1, 1)).days
        except ValueError:
            return m
        if not 0 <= index < 146097:
            return m
        return fill(m, (datetime.date(1800, 1, 1) + datetime.timedelta(feistel(index, 189, 773, "date"))).strftime(form))
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", m):
        x = feistel(int.from_bytes(map(int, m.split("."))), 65536, 65536, "address")
        return ".".join(map(str, x.to_bytes(4)))
    if re.fullmatch(r"[2-6]([ -]?[0-9]){12,18}", m):
        if luhn(d[:-1]) != d[-1]:
            return m
        fixed = 2 if len(d) == 15 else 1
        new = d[:fixed] + permute(d[fixed:-1], "card")
        return fill(m, new + luhn(new))
    fixed = 2 if re.fullmatch(r"\+[0-9]+", m) and not re.fullmatch(r"\+1[0-9]{10}", m) else len(d) - 10
    return fill(m, d[:fixed] + permute(d[fixed:], "phone"))


def plain_text(text):
    # Python's own engine reads the same pattern, with the group numbers it has there.
    return None if text is None else re.sub(P.ANY_KIND, lambda m: plain(m[0]), text, flags=re.ASCII)


VALUES = [
    "4111 1111 1111 1111", "4111111111111111", "3782-822463-10005", "4222222222222", "6304000000000000000", "378282246310005",
    "+1 (743) 555-3824", "743-555-3824", "(017) 555-7713", "+17435553824", "+4915112345678", "+1 743.555.3824",
    "123-45-6789", "899-99-9999", "001-01-0001", "2001-02-28", "1800-01-01", "2199-12-31", "2020/02/29", "31.12.1999",
    "12/31/1999", "31/12/1999", "01/02/2003", "10.20.30.40", "255.255.255.255", "0.0.0.0", "a.b+c@mail5.example.com",
    "A.B+C@MAIL5.example.com", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
    'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"', "api_key: abcdefghijklmnop1234",
]
UNTOUCHED = ["4111111111111112", "7536784127813050", "000-12-3456", "666-12-3456", "2001-02-30", "0999-01-01", "2300-01-01",
             "256.1.1.1", "1.2.3", "2.0.", "12345", "3.14159", "1.2.3.4.5", "token", "a@b", "12345678901234567890", ""]


def through_spark(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    return [r.text for r in P.pseudonymise(rows, KEY).orderBy("i").collect()]


def test_values_alone_and_in_text(spark):
    texts = VALUES + [f"Say {v}, or {v}!\nThen ({w})" for v, w in zip(VALUES, VALUES[1:])]
    got = through_spark(spark, texts)
    for t, g in zip(texts, got):
        assert g == plain_text(t), t
        assert g != t, t


def test_addresses_that_begin_with_a_number(spark):
    starts = ["4915112345678", "2345678901234", "+4915112345678", "2001-02-03.john", "31.12.1999.x", "123-45-6789.bob", "743-555-3824_k",
              "4111111111111111john", "4111111111111112", "10.20.30.40.anna", "10.20.30.40", "1", "1.2.3.4.5", "7536784127813050x"]
    found = [f"{s}@{d}" for s in starts for d in ("x.com", "t-online.de", "10.20.30.40.example.org")]
    texts = found + [f"Write to <{a}>, or to {b}; token {a}" for a, b in zip(found, found[1:])]
    # Written without the module's pattern: a word around an at sign, and whole words only.
    want = [re.sub(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", lambda m: plain(m[0]), t, flags=re.ASCII) for t in texts]
    assert through_spark(spark, texts) == want
    assert all(a.split("@")[0] not in g for a, g in zip(found, want) if len(a.split("@")[0]) > 9)


def plain_secret(value):
    first = hashlib.sha512(f"{KEY}|secret|{value.lower()}".encode()).hexdigest()
    rest = (hashlib.sha512(f"{KEY}|secret|{i}|{first}".encode()).hexdigest() for i in range(1, len(value) // 128 + 1))
    new = "".join([first, *rest])[:len(value)]
    return new.upper() if value == value.upper() else new


def test_secrets_of_any_length(spark):
    values = [("aB3/_+-x" * 40_000)[:n] for n in (16, 127, 128, 129, 137, 200, 256, 257, 1_000, 300_000)] + ["A1" * 100]
    got = through_spark(spark, [f'token = "{v}" and so on' for v in values])
    assert got == [f'token = "{plain_secret(v)}" and so on' for v in values]
    assert through_spark(spark, ["token=" + "a" * 15]) == ["token=" + "a" * 15]


def test_addresses_are_replaced_whole(spark):
    """Parts of planted addresses, told apart without the module's pattern, are nowhere left."""
    locals_ = ["müller", "o'brien", "o\u2019brien", "jürgen.o'neill-x", "x" * 300, "名前", "иван", "a" * 65 + "'b", "bob%1+2"]
    domains = ["example.de", "müller.de", "a.b.c.d.e.f.g.h.i.j.k.com", "x" * 90 + ".org", "пример.рф", "例え.jp", "sub." * 40 + "net"]
    found = [f"{a}@{d}" for a in locals_ for d in domains]
    for frame in ("{}", "mail <{}>, please", "'{}'", "\"{}\"", "\u201c{}\u201d", "({}).", "**{}**", "x='{}'", "see {}; and\n{}"):
        texts = [frame.format(a, a) for a in found]
        for a, t, g in zip(found, texts, through_spark(spark, texts)):
            new = plain(a)
            assert g == t.replace(a, new), (t, g)
    upper = through_spark(spark, ["MÜLLER@EXAMPLE.DE", "müller@example.de"])
    assert upper[0] == upper[1]


def test_secrets_are_replaced_whole(spark):
    values = ["eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P", "abcd.efgh.ijkl.mnop.1", "QUJDREVGR0hJSktMTU5PU0E==",
              "abcdefghijklmn0p=qrst=uv", "a1b2c3d4e5f6g7h8", "A-b_c~d+e/f.g-H1234"]
    heads = ["token=", "secret_key = ", '"secret_key": "', "SECRET: ", "client_secret=", "aws_secret_access_key = ", "access_token: ", "Authorization: Bearer ",
             "bearer  ", "api key: ", "private-key='", "auth_key: ", "passwd="]
    for v in values:
        texts = [f"x {h}{v}{end}" for h in heads for end in ("", " and so on.", ". Then", '", "b": 1', "\n", ";")]
        for t, g in zip(texts, through_spark(spark, texts)):
            assert g == t.replace(v, plain_secret(v)), (t, g)
    alone = ["bearer responsibilities of all", "token: short", "secret: abcdefghijklmno.", "secretary: abcdefghijklmnopqrst", "the bearer of this"]
    assert through_spark(spark, alone) == alone


def test_cards_of_other_industries_and_spaced_phones(spark):
    cards = [d + luhn(d) for d in ("817200000000001", "820812345678901", "979212345678901", "10000123456789", "000000000000123",
                                   "891012345678901234", "123456789012")]
    cards += [" ".join([d[:4], d[4:8], d[8:12], d[12:]]) for d in cards[:3]]
    for m, g in zip(cards, through_spark(spark, [f"card {m}." for m in cards])):
        d, fixed = m.replace(" ", ""), 2 if len(m) == 15 else 1
        new = d[:fixed] + permute(d[fixed:-1], "card")
        assert g == f"card {fill(m, new + luhn(new))}." and g != f"card {m}."
    phones = [("555 123 4567", 0), ("(555) 123 4567", 0), ("+1 555 123 4567", 1), ("+44 20 7946 0958", 2), ("+49 151 12345678", 2),
              ("+33 1 42 68 53 00", 2), ("+49 30 123456", 2), ("+1 2345 678", 2)]
    for (m, fixed), g in zip(phones, through_spark(spark, [f"Call {m}, 20 times" for m, _ in phones])):
        d = re.sub("[^0-9]", "", m)
        assert g == f"Call {fill(m, d[:fixed] + permute(d[fixed:], 'phone'))}, 20 times" and m not in g
    # A card after a plus is still one; too few digits are no phone.
    card = "4111 1111 1111 1111"
    assert through_spark(spark, [f"+{card}", "+44 20 79", "55 123 4567"]) == [f"+{plain(card)}", "+44 20 79", "55 123 4567"]


def test_untouched(spark):
    texts = UNTOUCHED + [None, " ".join(UNTOUCHED), "nothing here " * 2000]
    assert through_spark(spark, texts) == texts


def test_pseudonyms_keep_their_checks(spark):
    # A pseudonym is found again as the same kind, and is replaced again.
    once = through_spark(spark, VALUES)
    twice = through_spark(spark, once)
    assert all(a != b for a, b in zip(once, twice))
    assert once[0].replace(" ", "") == once[1] and luhn(once[1][:-1]) == once[1][-1]
    assert once[26] == once[27]


@pytest.mark.parametrize(("a", "b"), [(7, 11), (100, 10), (1, 5), (189, 773)])
def test_feistel_is_a_permutation(spark, a, b):
    got = [r[0] for r in spark.range(a * b).select(P.feistel(F.col("id"), a, b, KEY, "t")).collect()]
    assert sorted(got) == list(range(a * b)) and got == [feistel(i, a, b, "t") for i in range(a * b)]


def test_long_texts_are_linear(spark):
    texts = ["a'" * 150_000, "é" * 300_000, "x@" + "a" * 300_000, "bearer " * 40_000, "a@b" * 100_000, "." * 300_000, "secret=" * 40_000,
             "a" * 300_000, "1" * 300_000, "1-" * 150_000, "a@" * 100_000, "1.2.3." * 50_000, "token=" * 50_000]
    assert through_spark(spark, texts) == texts


def test_query_on_all_documents(spark, monkeypatch):
    monkeypatch.setattr(queries, "PSEUDONYM_KEY", KEY)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op2_pseudonyms(spark, SF).collect()}
    assert {i: r.text for i, r in got.items()} == {i: plain_text(t) for i, t in texts.items()}
    assert {i: r.changed for i, r in got.items()} == {i: plain_text(t) != t for i, t in texts.items()}
    assert 0 < sum(r.changed for r in got.values()) < len(got)


def test_plan_has_no_python(spark, plan):
    text = plan(queries.op2_pseudonyms(spark, SF))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_edge_rows(spark, make):
    rows = [(None, "10.20.30.40", "10.20.30.40"), (1, None, None), (1, None, None)]
    out = P.pseudonymise(make(rows, "doc_id bigint, text string, m string"), KEY)
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(None, plain("10.20.30.40"), "10.20.30.40"), (1, None, None), (1, None, None)], key=repr)
    assert P.pseudonymise(make([], "text string, s string"), KEY).count() == 0
