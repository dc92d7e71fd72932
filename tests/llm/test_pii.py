"""Personal data: the base kinds against plain regular expressions, and the added kinds."""

import random
import re

import pytest

from playlab.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def base(text):
    return [s for s in pii.find(text) if s[0] in pii.BASE_KINDS]


@pytest.mark.parametrize("text", [
    "", "a@b", "a@b.c", "x@y.com@z.org", "x@y.com_foo@z.org", "a@b@c.com", "..@a.b..c", "é@b.cd İx@y.zz",
    "1.2.3.4.5.6.7.8", "1.2.3.4.5", "256.1.1.1.1.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111--11111111",
    "4111111111111111 4111111111111111", "+1 (212) 555-0199", "+1", "+1-", "+1 2", "+12", "++1 212 555 0199 9",
    "+1 212 555 0199 +1 212 555 0199", "+4111111111111111", "1.2.3.4 5500 0000 0000 0004", "a" * 5000 + "@b.co",
])
def test_base_kinds(text):
    assert base(text) == brute(text)


def test_base_kinds_random():
    rng = random.Random(7)
    parts = ["@", ".", "+", " ", "-", "(", ")", "1", "9", "25", "255", "4111111111111111", "a", "b.c", "x%", "é", "_", "İ"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        assert base(text) == brute(text), text


def test_added_kinds():
    text = "see https://a.example/x?y=1, IBAN: GB82 WEST 1234 5698 7654 32 and account no. 12345678."
    assert [(k, text[s:e]) for k, s, e in pii.find(text)] == [
        ("url", "https://a.example/x?y=1"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678")]
    assert not pii.iban_valid("GB83WEST12345698765432")


def test_scan_edge_rows(spark):
    rows = [(1, None, "p"), (1, "", "p"), (2, "a@b.co", "p"), (2, "a@b.co", "p"), (None, "+1 212 555 0199", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.pii]) for r in pii.scan(df).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (1, []), (2, [("email", 0, 6)]), (2, [("email", 0, 6)]),
                                           (None, [("phone", 0, 15)])], key=str)
    assert pii.scan(df.limit(0)).count() == 0
