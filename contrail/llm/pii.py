"""Operator 5: format-preserving Feistel pseudonyms for personal data (SQL functions only).

One pattern finds candidates: e-mail and IPv4 addresses, card numbers, phone
numbers, social security numbers, IBANs and dates. Numbers and dates are
validated (Luhn, mod 97, octet and area ranges, the calendar); those that fail
stay as they are. What is valid is permuted, under a key, within its own
format by a Feistel network: over the two halves of its characters (each digit
or letter moves within its class, so lengths and separators stay), or over
two mixed-radix parts of its rank among all valid values (IPv4 addresses,
social security numbers, days of a century). Check digits are computed anew.
A permutation is one-to-one and depends on the key and kind alone, so equal
values stay linked, and different ones apart, in all documents.

Everything is one projection of built-in functions; there is no shuffle.

Edge cases: a null text stays null with no findings; an empty one stays
empty; null or repeated ids stay rows of their own; an empty table gives an
empty result; other columns are kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: The key of the registered queries; a deployment passes its own.
DEMO_KEY = "demo-key"

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_EDGE, _END = "(?<![0-9A-Za-z])", "(?![0-9A-Za-z])"
#: Length of an IBAN -> its countries (the registry of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_shape(n: int, codes: str) -> str:
    """IBANs of ``n`` characters, in groups of four or in one; no country's form runs on into the next word."""
    groups, rest = divmod(n - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


#: Kind -> pattern, in order of preference at one position. Quantifiers over
#: open-ended runs are possessive, so that long tokens take linear time.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "card": _EDGE + "(?:[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})" + _END,
    "phone": (r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])|\+[1-9][0-9]{0,2}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _END),
    "ssn": "(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": _EDGE + "(?:" + "|".join(_iban_shape(n, codes) for n, codes in IBAN_LENGTHS.items())
             # Countries that the registry lacks.
             + "|(?!" + "|".join(IBAN_LENGTHS.values()).replace(" ", "|") + ")[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)" + _END,
    "date": ("(?<![0-9A-Za-z.-])(?:(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|(?:19|20)[0-9]{2}/[01][0-9]/[0-3][0-9]"
             r"|[0-3][0-9]\.[01][0-9]\.(?:19|20)[0-9]{2}|[0-3][0-9]/[0-3][0-9]/(?:19|20)[0-9]{2})"
             "(?![0-9A-SU-Za-z]|T(?![0-9]{2}:?[0-9]{2}))"),
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: What every candidate contains; texts without it are passed through.
HINT = "@|[0-9]{2}|[0-9][.][0-9]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sha(key: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")).cast("binary"), 256)


def _number(hex_text: Column) -> Column:
    return F.conv(hex_text, 16, 10).cast("long")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _shifted(value: Column, other: Column, key: str, kind: str, turn: Column) -> Column:
    """``value`` with each digit and letter moved within its class by a keyed hash of ``other``."""
    def move(c: Column, by: Column) -> Column:
        def within(first: str, n: int) -> Column:
            return F.char((F.ascii(c) - ord(first) + by) % n + ord(first))
        return (F.when(c.between("0", "9"), within("0", 10)).when(c.between("a", "z"), within("a", 26))
                .when(c.between("A", "Z"), within("A", 26)).otherwise(c))

    def chars(h: Column) -> Column:
        return F.array_join(F.transform(F.split(value, ""), lambda c, j: move(
            c, _number(F.substring(h, (j * 3) % 60 + 1, F.lit(5))))), "")

    return F.when(F.length(value) > 0, _let(_sha(key, kind, turn, other), chars)).otherwise(value)


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Feistel network over the halves of a text; other characters than ASCII digits and letters stay."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("a"),
                     F.substring(value, half + 1, F.length(value)).alias("b"))

    def turn(s: Column, k: Column) -> Column:
        return F.when(k % 2 == 0, F.struct(_shifted(s["a"], s["b"], key, kind, k).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), _shifted(s["b"], s["a"], key, kind, k).alias("b")))

    rounds = F.array(*[F.lit(k) for k in range(ROUNDS)])
    return F.aggregate(rounds, start, turn, lambda s: F.concat(s["a"], s["b"]))


def permute_rank(rank: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Feistel network over ``rank`` in [0, a * b), split as (rank div b, rank mod b)."""
    start = F.struct((F.floor(rank / b)).cast("long").alias("a"), (rank % b).cast("long").alias("b"))

    def moved(part: Column, other: Column, k: Column, n: Column) -> Column:
        return ((part + _number(F.substring(_sha(key, kind, k, other), 1, 13)) % n) % n).cast("long")

    def turn(s: Column, k: Column) -> Column:
        return F.when(k % 2 == 0, F.struct(moved(s["a"], s["b"], k, a).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), moved(s["b"], s["a"], k, b).alias("b")))

    rounds = F.array(*[F.lit(k) for k in range(ROUNDS)])
    return F.aggregate(rounds, start, turn, lambda s: s["a"] * b + s["b"])


def _luhn_digit(body: Column) -> Column:
    """The check digit that follows the digits ``body``."""
    def part(c: Column, j: Column) -> Column:
        d = c.cast("int")
        return F.when(j % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), part), F.lit(0), lambda s, x: s + x)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def _card(m: Column, key: str) -> Column:
    body = F.substring(m, F.lit(1), F.length(m) - 1)
    fresh = _let(permute_text(body, key, "card"), lambda x: F.concat(x, _luhn_digit(_digits(x))))
    return F.when((_luhn_digit(_digits(body)) == F.right(m, F.lit(1)))
                  & F.length(_digits(m)).between(13, 19), fresh)


def _ip(m: Column, key: str) -> Column:
    value = F.aggregate(F.split(m, "[.]"), F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    n = F.lit(65536).cast("long")
    return _let(permute_rank(value, n, n, key, "ip"), lambda x: F.concat_ws(
        ".", *[(F.shiftright(x, k) % 256).cast("string") for k in (24, 16, 8, 0)]))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1).cast("long")
    rank = (place * 99 + group - 1) * 9999 + serial - 1

    def text(x: Column) -> Column:
        front = F.floor(x / F.lit(99 * 9999)).cast("long")
        return F.concat_ws("-", F.lpad(F.when(front > 664, front + 2).otherwise(front + 1).cast("string"), 3, "0"),
                           F.lpad((F.floor(x / F.lit(9999)) % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((x % 9999 + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(permute_rank(rank, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "ssn"), text))


def _iban_check(country: Column, rest: Column) -> Column:
    """Check digits for a country code and the characters that follow them."""
    letters = F.split(F.concat(F.regexp_replace(rest, " ", ""), country, F.lit("00")), "")
    left = F.aggregate(letters, F.lit(0), lambda s, c: F.when(
        c.between("0", "9"), (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))
    return F.lpad((F.lit(98) - left).cast("string"), 2, "0")


def _iban(m: Column, key: str) -> Column:
    country, rest = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))
    fresh = _let(permute_text(rest, key, "iban"), lambda x: F.concat(country, _iban_check(country, x), x))
    return F.when(_iban_check(country, rest) == F.substring(m, 3, 2), fresh)


def _moved_day(day: Column, form: str, key: str) -> Column:
    """Days move within their century; its length is the product of the two radices.

    dd/MM/yyyy moves on until its day is above 12 again, so that it never
    looks like the pseudonym of an MM/dd/yyyy date; this stays one-to-one.
    """
    number = F.datediff(day, F.lit("1900-01-01").cast("date"))
    late = number >= 36524
    rank = F.when(late, number - 36524).otherwise(number).cast("long")
    a, b = (F.when(late, F.lit(x)).otherwise(F.lit(y)).cast("long") for x, y in ((75, 92), (487, 397)))
    start = F.when(late, F.lit(36524)).otherwise(F.lit(0))
    if form == "dd/MM/yyyy":
        def turn(x: Column, k: Column) -> Column:
            plain = F.dayofmonth(F.date_add(F.lit("1900-01-01").cast("date"), (x + start).cast("int"))) <= 12
            return F.when((k == 0) | plain, permute_rank(x, a, b, key, "date")).otherwise(x)

        fresh = F.aggregate(F.sequence(F.lit(0), F.lit(80)), rank, turn) + start
    else:
        fresh = permute_rank(rank, a, b, key, "date") + start
    return F.when(day.isNotNull(), F.date_format(
        F.date_add(F.lit("1900-01-01").cast("date"), fresh.cast("int")), form))


def _date(m: Column, key: str) -> Column:
    """MM/dd/yyyy where the first part can be a month, also if both parts can; else dd/MM/yyyy."""
    out = F.lit(None).cast("string")
    for shape, form in (("^[0-9]{4}-", "yyyy-MM-dd"), ("^[0-9]{4}/", "yyyy/MM/dd"), ("[.]", "dd.MM.yyyy"),
                        ("^(0[0-9]|1[0-2])/", "MM/dd/yyyy"), ("^(1[3-9]|[23][0-9])/", "dd/MM/yyyy")):
        def body(day: Column) -> Column:
            return _moved_day(day, form, key)  # noqa: B023 (called at once)

        out = F.when(m.rlike(shape), _let(F.try_to_timestamp(m, F.lit(form)).cast("date"), body)).otherwise(out)
    return out


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(permute_text(name, key, "email"), F.substring(m, F.length(name) + 1, F.length(m)))


def _phone(m: Column, key: str) -> Column:
    """The country code stays; the digits behind it are permuted in place."""
    code = F.regexp_extract(m, r"^\+[1-9][0-9]{0,2}(?=[ .(-])", 0)
    code = F.when(F.length(code) > 0, code).otherwise(F.regexp_extract(m, r"^\+?", 0))
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.when(F.length(_digits(m)).between(8, 15), F.concat(code, permute_text(rest, key, "phone")))


def _entity(m: Column, key: str) -> Column:
    """(kind, pseudonym) of a match; the pseudonym is null where validation fails."""
    makers = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "ssn": _ssn, "iban": _iban, "date": _date}
    kinds = reduce(lambda rest, k: F.when(m.rlike(f"^(?:{PATTERNS[k]})$"), F.struct(
        F.lit(k).alias("kind"), makers[k](m, key).alias("value"))).otherwise(rest), reversed(KINDS),
        F.lit(None).cast("struct<kind: string, value: string>"))
    return kinds


def _replaced(kind: str):
    return lambda e: (e["now"]["kind"] == kind) & e["now"]["value"].isNotNull()


def pseudonymise(docs: DataFrame, key: str = DEMO_KEY, text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; ``counts`` adds ``n_<kind>`` columns."""
    columns = docs.columns
    text = F.col("_text")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(text_col).alias("_text"))
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    held = held.withColumn("_found", found)
    entities = F.transform("_found", lambda m: F.struct(m.alias("was"), _entity(m, key).alias("now")))
    held = held.withColumn("_entities", F.when(F.size("_found") > 0, entities))
    fresh = F.array_join(F.zip_with(F.split(text, ANY), F.transform(
        "_entities", lambda e: F.coalesce(e["now"]["value"], e["was"])),
        lambda between, value: F.concat(between, F.coalesce(value, F.lit("")))), "")
    out = [(F.when(F.col("_entities").isNull(), text).otherwise(fresh) if c == text_col
            else F.col("_row").getField(c)).alias(c) for c in columns]
    if counts:
        out += [F.coalesce(F.size(F.filter("_entities", _replaced(k))), F.lit(0)).cast("long").alias(f"n_{k}")
                for k in KINDS]
    return held.select(*out)
