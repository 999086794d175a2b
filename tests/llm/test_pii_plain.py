"""Pseudonyms equal a plain Python version, row by row, on whole texts and planted values."""
import datetime as dt
import hashlib
import random
import re

from helpers import SF, edge_docs

from contrail.llm import pii
from contrail.llm.queries import QUERIES

KEY = pii.DEMO_KEY
FIND = re.compile(pii.ANY)


def keyed(kind, turn, value):
    return hashlib.sha256(f"{KEY}|{kind}|{turn}|{value}".encode()).hexdigest()


def moved(c, by):
    for first, n in (("0", 10), ("a", 26), ("A", 26)):
        if ord(first) <= ord(c) < ord(first) + n:
            return chr((ord(c) - ord(first) + by) % n + ord(first))
    return c


def permuted(text, kind):
    halves = [text[:len(text) // 2], text[len(text) // 2:]]
    for turn in range(8):
        side = turn % 2
        h = keyed(kind, turn, halves[1 - side])
        halves[side] = "".join(moved(c, int(h[j * 3 % 60:j * 3 % 60 + 5], 16)) for j, c in enumerate(halves[side]))
    return "".join(halves)


def permuted_rank(rank, a, b, kind):
    parts, sizes = list(divmod(rank, b)), (a, b)
    for turn in range(8):
        side = turn % 2
        parts[side] = (parts[side] + int(keyed(kind, turn, parts[1 - side])[:13], 16)) % sizes[side]
    return parts[0] * b + parts[1]


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(body):
    total = 0
    for k, d in enumerate(map(int, reversed(body))):
        total += d if k % 2 else sum(divmod(2 * d, 10))
    return str(-total % 10)


def card(m):
    if luhn(digits(m[:-1])) != m[-1] or not 13 <= len(digits(m)) <= 19:
        return None
    body = permuted(m[:-1], "card")
    return body + luhn(digits(body))


def ip(m):
    rank = int.from_bytes(bytes(map(int, m.split("."))), "big")
    return ".".join(map(str, permuted_rank(rank, 65536, 65536, "ip").to_bytes(4, "big")))


def ssn(m):
    area, group, serial = map(int, m.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    areas = [x for x in range(1, 900) if x != 666]
    x = permuted_rank((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn")
    return f"{areas[x // (99 * 9999)]:03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"


def iban_check(country, rest):
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest.replace(' ', '') + country + '00')) % 97:02d}"


def iban(m):
    if iban_check(m[:2], m[4:]) != m[2:4]:
        return None
    rest = permuted(m[4:], "iban")
    return m[:2] + iban_check(m[:2], rest) + rest


def date(m):
    for shape, form in (("[0-9]{4}-", "%Y-%m-%d"), ("[0-9]{4}/", "%Y/%m/%d"), (".*[.]", "%d.%m.%Y"),
                        ("(0[0-9]|1[0-2])/", "%m/%d/%Y"), ("(1[3-9]|[23][0-9])/", "%d/%m/%Y")):
        if re.match(shape, m):
            break
    else:
        return None
    try:
        day = dt.datetime.strptime(m, form).date()
    except ValueError:
        return None
    origin = dt.date(1900, 1, 1)
    number = (day - origin).days
    start, a, b = (36524, 75, 487) if number >= 36524 else (0, 92, 397)
    rank = permuted_rank(number - start, a, b, "date")
    while form == "%d/%m/%Y" and (origin + dt.timedelta(rank + start)).day <= 12:
        rank = permuted_rank(rank, a, b, "date")
    return (origin + dt.timedelta(rank + start)).strftime(form)


def email(m):
    name, at, host = m.partition("@")
    return permuted(name, "email") + at + host


def phone(m):
    if not 8 <= len(digits(m)) <= 15:
        return None
    code = (re.match(r"\+[1-9][0-9]{0,2}(?=[ .(-])", m) or re.match(r"\+?", m)).group()
    return code + permuted(m[len(code):], "phone")


MAKERS = {"email": email, "ip": ip, "card": card, "phone": phone, "ssn": ssn, "iban": iban, "date": date}


def plain(text):
    """(text with pseudonyms, replaced values by kind)."""
    counts = dict.fromkeys(MAKERS, 0)

    def fresh(found):
        m = found.group()
        kind = next(k for k in MAKERS if re.fullmatch(pii.PATTERNS[k], m))
        value = MAKERS[kind](m)
        counts[kind] += value is not None
        return m if value is None else value

    return (None if text is None else FIND.sub(fresh, text)), counts


def check(docs, got):
    want = sorted(str((r.doc_id, *plain(r.text)[:1], *plain(r.text)[1].values())) for r in docs.select("doc_id", "text").collect())
    counts = [f"n_{k}" for k in MAKERS]
    assert sorted(str(tuple(r)) for r in got.select("doc_id", "text", *counts).collect()) == want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, QUERIES["op5_pii_pseudonyms"](spark, SF))
    assert sum(sum(plain(r.text)[1].values()) for r in docs.collect()) > 20


def test_awkward_rows(spark):
    docs = edge_docs(spark)
    check(docs, pii.pseudonymise(docs, counts=True))


def test_planted_values(spark):
    rng = random.Random(5)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    values = ["ES9121000418450200051332 EUR 500", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432,", "XX00 1234 5678",
              "1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "666-12-3456", "899-99-9999", "001-01-0001", "123-00-4567",
              "2024-02-29", "2023-02-29", "31/01/1999", "01/02/1999", "13/13/1999", "29.02.2000", "1999/12/31", "2099-12-31",
              "1900-01-01", "12/31/2024T10:30", "a.b+c@x-y.example.com", "@x.com", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "3782 822463 10005", "+1 555 123 4567", "+1 (555) 123-4567 2024", "+44 20 7946 0958", "(555) 123-4567", "555-123-4567"]
    for _ in range(60):
        body = number(rng.choice((12, 15, 18)))
        values += [body + luhn(body), body + str((int(luhn(body)) + 1) % 10)]
        values.append(f"{number(3)}-{number(2)}-{number(4)}")
        values.append(".".join(str(rng.randrange(300)) for _ in range(4)))
        values.append((dt.date(1900, 1, 1) + dt.timedelta(rng.randrange(73000))).strftime(rng.choice(("%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d"))))
        rest = number(18)
        values.append("DE" + iban_check("DE", rest) + rest)
        values.append(f"+{rng.randrange(1, 999)} {number(3)} {number(4)} {number(3)}")
    rows = [(i, f"{a} sees {v} and {b}, {v}.") for i, v in enumerate(values) for a, b in (("it", "more"), ("EUR", "12"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(docs, pii.pseudonymise(docs, counts=True))
    # Equal values stay linked, whatever stands around them.
    assert all(len({w for w in plain(t)[0].split(" sees ")[1].rstrip(".").rsplit(", ", 1)[1:]}) == 1 for _, t in rows)
