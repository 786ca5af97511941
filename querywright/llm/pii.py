"""Format-preserving pseudonyms for personal data.

One pattern finds candidates; each is validated by its kind. Values that stand side by side are one candidate, which is split
at its blanks: of its valid runs those told by their shape go first, then the leftmost and longest. Numbers and dates are replaced by a keyed Feistel permutation of
their own format: a bijection on all values of the format, so equal values get equal pseudonyms in every document, and two
values never share one. Separators, signs and widths stay.

| kind | validated by | permuted |
|---|---|---|
| card | 13-19 digits, unbroken or in the groups of a card (``CARD``), not a row of years; Luhn | all but the last digit, which is computed anew |
| iban | ISO 7064 mod 97 | the digits of the account part; the check digits are computed anew |
| ssn | area, group and serial in use | area x group x serial |
| ip | four octets | both halves |
| date | calendar date 1500-2499, ISO, dotted (d.m.y) or slashed (d/m/y, else m/d/y) | day number, in blocks of 73,000 days |
| phone | 9-15 digits in the shape of a phone number (``PHONE``), not a row of years | all digits |
| email | local part, at sign, dotted domain | (no number) keyed digest as local part, reserved domain |

A two-sided Feistel network over a x b needs no equal halves: left gains f(right) modulo a, right gains f(left) modulo b, in
turn, with f from SHA-256 over key, kind, round and half. Everything is a SQL expression over the row; nothing is shuffled.

Edge cases: null stays null; texts without candidates, null ids and repeated rows pass; a candidate of which no run between
blanks is valid is left as it is; other columns pass through unchanged, whatever their names. The key is a parameter and should be secret."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querywright.llm.spans import let

ROUNDS = 8
BLOCK = (365, 200)        # days: a block of 73,000
EPOCH = "1500-01-01"

# Candidate patterns by kind, tried in this order at each place
PATTERNS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    ("date", r"(?<![A-Za-z0-9.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![A-SU-Za-z0-9-]|T(?![0-9]{2}:))"),
    ("ip", r"(?<![A-Za-z0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![A-Za-z0-9]|\.[0-9])"),
    ("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"),
    ("number", r"(?<![A-Za-z0-9])(?:\+|\()?[0-9](?:[\x20().-]{0,2}[0-9]){7,18}(?![A-Za-z0-9])"),
)
# Candidates: numbers, and words beside an IBAN, are taken with all that follow them at a blank, and divided later
_EMAIL, _DAY = r"(?![A-Za-z0-9._%+-]++@)", r"(?![0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
_TOKEN = r"[0-9](?:[().-]{0,2}[0-9]){0,18}(?![A-Za-z0-9])"
_NEXT = r"[().-]?\x20{1,2}" + _EMAIL + _DAY + r"[+().-]?" + _TOKEN
_WORD = r"\x20{1,2}" + _EMAIL + _DAY + r"[A-Z0-9]++(?![A-Za-z0-9]|[.-][A-Za-z0-9])"
RUNS = {
    "number": rf"(?<![A-Za-z0-9])(?=[+(]?[0-9](?:[\x20().+-]{{0,4}}[0-9]){{7}})[+(]?{_TOKEN}(?:{_NEXT})*+",
    "iban": rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?=(?:\x20?[A-Z0-9]){{11}})[A-Z0-9]*+(?![A-Za-z0-9])(?:{_WORD}|{_NEXT})*+",
}
ANY = "|".join(f"(?:{RUNS.get(k, p)})" for k, p in PATTERNS)
PIECE = r"(?<=\x20)(?=[^\x20])"
LONGEST = 34              # characters of an IBAN: no value has more pieces
# values that are told by their shape go before looser ones
STRICT = "^(?:" + "|".join([r"[0-9]{13,19}", r"[0-9]{4}(?:[\x20-][0-9]{4}){3}", r"[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}", r"[A-Z]{2}[0-9]{2}[A-Z0-9\x20]*",
                            r"(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}",
                            *(p for k, p in PATTERNS if k in ("date", "ip", "ssn"))]) + ")$"
# Shapes of phone numbers. Digits that blanks alone part are taken for numbers of a table or a sentence, save in these shapes.
PHONE = "^(?:" + "|".join([
    r"\+[1-9][0-9\x20().-]*",                                                              # country code
    r"(?:1[\x20.-]?)?\([0-9]{2,5}\)[\x20.-]?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}",       # area in parentheses
    r"(?:1[\x20.-])?[2-9][0-9]{2}[\x20.-][0-9]{3}[\x20.-][0-9]{4}",                         # three, three and four digits
    r"0[0-9]{1,4}[\x20.-][0-9]{2,8}(?:[\x20.-][0-9]{2,8}){0,4}",                            # trunk zero or 00
    r"[0-9]{2,4}(?:-[0-9]{2,4}){2,4}"]) + ")$"                                              # hyphens
# Shapes of card numbers: unbroken, groups of four, or 4-6-4 and 4-6-5
CARD = r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2,3}(?:[\x20-][0-9]{1,4})?|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5})$"
YEARS = r"^(?:(?:1[5-9]|2[0-4])[0-9]{2}[^0-9]{1,2})*(?:1[5-9]|2[0-4])[0-9]{2}$"
KINDS = ("email", "iban", "date", "ip", "ssn", "card", "phone")


def _keyed(key: str, kind: str, turn: Column, half: Column) -> Column:
    """Sixty bits that depend on key, kind, round and half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """(l, r): a permutation of the pairs 0 <= left < a, 0 <= right < b."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")),
        lambda s, i: F.struct(
            F.when(i % 2 == 1, F.pmod(s["l"] + _keyed(key, kind, i, s["r"]), a)).otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 0, F.pmod(s["r"] + _keyed(key, kind, i, s["l"]), b)).otherwise(s["r"]).alias("r")))


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of all digit strings of one length (2 to 34)."""
    def body(d: Column) -> Column:
        n = F.char_length(d)
        half = F.floor(n / 2).cast("int")
        power = lambda k: F.pow(F.lit(10.0), k.cast("double")).cast("long")
        made = feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, n - half), power(half), power(n - half), key, kind)
        return let(made, lambda m: F.concat(F.lpad(m["l"].cast("string"), half, "0"), F.lpad(m["r"].cast("string"), n - half, "0")))
    return let(digits, body)


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits`` in order."""
    def body(pair: Column) -> Column:
        return F.aggregate(
            F.split(pair["value"], ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
            lambda s, c: F.when((c >= "0") & (c <= "9"), F.struct(
                F.concat(s["out"], F.substring(pair["digits"], s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
            .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
            lambda s: s["out"])
    return let(F.struct(value.alias("value"), digits.alias("digits")), body)


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum from the right; ``doubled_first``: the last digit is doubled (a check digit is still missing)."""
    def term(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == (0 if doubled_first else 1), twice).otherwise(d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda acc, v: acc + v)


def card(value: Column, key: str) -> Column:
    """The pseudonym of a card number, or null."""
    def body(d: Column) -> Column:
        fresh = let(permuted_digits(F.substring(d, F.lit(1), F.char_length(d) - 1), key, "card"), lambda p: F.concat(
            p, F.pmod(10 - luhn_sum(p, True) % 10, F.lit(10)).cast("string")))
        shaped = value.rlike(CARD) & ~value.rlike(YEARS)
        return F.when(F.char_length(d).between(13, 19) & shaped & (luhn_sum(d, False) % 10 == 0), refilled(value, fresh))
    return let(only_digits(value), body)


def phone(value: Column, key: str) -> Column:
    def body(d: Column) -> Column:
        shaped_ssn = value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
        shaped = value.rlike(PHONE) & ~value.rlike(YEARS) & ~shaped_ssn
        return F.when(F.char_length(d).between(9, 15) & shaped, refilled(value, permuted_digits(d, key, "phone")))
    return let(only_digits(value), body)


def ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, *at).cast("int") for at in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    # areas 1-899 without 666 are numbered 0-897
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    made = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def shown(m: Column) -> Column:
        row = F.floor(m["l"] / 99)
        back = F.when(row + 1 >= 666, row + 2).otherwise(row + 1)
        return F.format_string("%03d-%02d-%04d", back.cast("long"), (m["l"] % 99 + 1).cast("long"), m["r"] + 1)
    return F.when(valid, let(made, shown))


def ip(value: Column, key: str) -> Column:
    def body(o: Column) -> Column:
        n = lambda k: o[k].cast("long")
        made = feistel(n(0) * 256 + n(1), n(2) * 256 + n(3), F.lit(65536), F.lit(65536), key, "ip")
        return let(made, lambda m: F.concat_ws(".", *[x.cast("long").cast("string") for x in (
            F.floor(m["l"] / 256), m["l"] % 256, F.floor(m["r"] / 256), m["r"] % 256)]))
    return let(F.split(value, r"\."), body)


def _moved_day(day: Column, key: str) -> Column:
    """The pseudonym of a date, in its block of days."""
    block = BLOCK[0] * BLOCK[1]

    def body(n: Column) -> Column:
        inside = F.pmod(n, F.lit(block))
        made = feistel(F.floor(inside / BLOCK[1]), inside % BLOCK[1], F.lit(BLOCK[0]), F.lit(BLOCK[1]), key, "date")
        return let(made, lambda m: F.date_add(F.lit(EPOCH).cast("date"), (
            F.floor(n / block) * block + m["l"] * BLOCK[1] + m["r"]).cast("int")))
    return let(F.date_diff(day, F.lit(EPOCH).cast("date")), body)


def date(value: Column, key: str) -> Column:
    part = lambda p, k: F.regexp_extract(value, p, k).try_cast("int")
    ymd, other = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})$", r"^([0-9]{1,2})[./]([0-9]{1,2})[./]([0-9]{4})$"
    real = lambda y, m, d: F.when((m.between(1, 12)) & d.between(1, 31) & y.between(1500, 2499),
                                  F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd"))
    iso = real(part(ymd, 1), part(ymd, 2), part(ymd, 3))
    first, second, year = part(other, 1), part(other, 2), part(other, 3)
    day_first = real(year, second, first)
    month_first = F.when(value.contains("/"), real(year, first, second))
    # a part is written with as many digits as it had, or with what it needs
    wide = lambda part_no, n: F.lpad(n.cast("string"), F.greatest(F.char_length(F.regexp_extract(value, other, part_no)),
                                                                   F.char_length(n.cast("string"))), "0")
    mark = F.when(value.contains("/"), F.lit("/")).otherwise(F.lit("."))

    def joined(d: Column, day_at: int) -> Column:
        one, two = (F.dayofmonth(d), F.month(d)) if day_at == 1 else (F.month(d), F.dayofmonth(d))
        return F.concat(wide(1, one), mark, wide(2, two), mark, F.lpad(F.year(d).cast("string"), 4, "0"))
    return (F.when(iso.isNotNull(), F.date_format(_moved_day(iso, key), "yyyy-MM-dd"))
            .when(day_first.isNotNull(), let(_moved_day(day_first, key), lambda d: joined(d, 1)))
            .when(month_first.isNotNull(), let(_moved_day(month_first, key), lambda d: joined(d, 2))))


def iban(value: Column, key: str) -> Column:
    def rest97(text: Column) -> Column:
        return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, c: F.when(
            c <= "9", (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))

    def body(v: Column) -> Column:
        account = F.substring(v, F.lit(5), F.char_length(v) - 4)
        valid = F.char_length(v).between(15, 34) & (rest97(F.concat(account, F.substring(v, 1, 4))) == 1)
        inner = only_digits(account)
        fresh = F.when(F.char_length(inner) > 1, refilled(account, permuted_digits(inner, key, "iban"))).otherwise(account)
        checked = let(fresh, lambda a: F.concat(
            F.substring(v, 1, 2), F.lpad((98 - rest97(F.concat(a, F.substring(v, 1, 2), F.lit("00")))).cast("string"), 2, "0"), a))
        # blanks stay where they were: the characters are dealt out again
        spread = let(checked, lambda c: F.aggregate(
            F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
            lambda s, x: F.when(x == " ", F.struct(F.concat(s["out"], x).alias("out"), s["at"].alias("at"))).otherwise(
                F.struct(F.concat(s["out"], F.substring(c, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))),
            lambda s: s["out"]))
        return F.when(valid, spread)
    return let(F.replace(value, F.lit(" "), F.lit("")), body)


def email(value: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256)
    return F.concat(F.lit("user-"), F.substring(digest, 1, 16), F.lit("@mail.invalid"))


def pseudonym(value: Column, key: str) -> Column:
    """(kind, value): the pseudonym of a candidate; kind is null where it is left as it is."""
    of = lambda name: value.rlike(f"^(?:{dict(PATTERNS)[name]})$")
    makers = {"email": (email, "email"), "iban": (iban, "iban"), "date": (date, "date"), "ip": (ip, "ip"), "ssn": (ssn, "ssn"),
              "card": (card, "number"), "phone": (phone, "number")}

    def named(kind: str):
        return lambda v: F.when(v.isNotNull(), F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    tries = F.array_compact(F.array(*[let(F.when(of(pattern), make(value, key)), named(kind))
                                      for kind, (make, pattern) in makers.items()]))
    return F.coalesce(F.get(tries, F.lit(0)), F.struct(F.lit(None).cast("string").alias("kind"), value.alias("value")))


def pieces(value: Column, key: str) -> Column:
    """[(kind, value)]: a candidate in its parts. Runs of its pieces are valid or not; shapes go first, then from the left, then
    the longest."""
    def divided(p: Column) -> Column:
        n = F.size(p)
        runs = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST), n - i)), lambda k: F.struct(
                i.alias("at"), k.alias("k"), F.array_join(F.slice(p, i + 1, k), "").alias("raw")))))
        short = F.transform(F.filter(runs, lambda r: F.char_length(r["raw"]) <= 3 * LONGEST), lambda r: F.struct(
            r["at"].alias("at"), r["k"].alias("k"), F.regexp_extract(r["raw"], r"[^A-Za-z0-9]*$", 0).alias("tail"),
            F.regexp_extract(r["raw"], r"^(.*?)[^A-Za-z0-9]*$", 1).alias("value")))
        tried = F.filter(F.transform(short, lambda r: F.struct(
            F.when(r["value"].rlike(STRICT), 0).otherwise(1).alias("loose"), r["at"].alias("at"), (-r["k"]).alias("less"),
            r["tail"].alias("tail"), pseudonym(r["value"], key).alias("made"))), lambda r: r["made"]["kind"].isNotNull())
        none = F.expr("CAST(array() AS array<struct<loose: int, at: int, less: int, tail: string, made: struct<kind: string, value: string>>>)")
        taken = F.aggregate(F.array_sort(tried), none, lambda acc, r: F.when(
            F.exists(acc, lambda t: (t["at"] < r["at"] - r["less"]) & (r["at"] < t["at"] - t["less"])), acc).otherwise(F.array_append(acc, r)))

        def dealt(took: Column) -> Column:
            return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: let(
                F.filter(took, lambda t: (t["at"] <= i) & (i < t["at"] - t["less"])), lambda over: F.when(
                    F.size(over) == 0, F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.get(p, i).alias("value"))))
                .when(over[0]["at"] == i, F.array(F.struct(over[0]["made"]["kind"].alias("kind"), F.concat(
                    over[0]["made"]["value"], over[0]["tail"]).alias("value"))))
                .otherwise(F.expr("CAST(array() AS array<struct<kind: string, value: string>>)")))))
        return let(taken, dealt)
    return F.when(value.contains(" "), let(F.split(value, PIECE, -1), divided)).otherwise(F.array(pseudonym(value, key)))


def pseudonymised(text: Column, key: str) -> Column:
    """(text, kinds): the text with its personal data replaced, and the kind of each replacement in order."""
    values = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    made = F.transform(values, lambda v: pieces(v, key))

    def joined(m: Column) -> Column:
        parts = F.transform(F.arrays_zip(F.split(text, ANY, -1).alias("gap"), F.transform(
            m, lambda c: F.array_join(F.transform(c, lambda x: x["value"]), "")).alias("value")),
                            lambda z: F.concat(z["gap"], F.coalesce(z["value"], F.lit(""))))
        return F.struct(F.array_join(parts, "").alias("text"),
                        F.filter(F.transform(F.flatten(m), lambda x: x["kind"]), lambda k: k.isNotNull()).alias("kinds"))
    none = F.struct(text.alias("text"), F.expr("CAST(array() AS array<string>)").alias("kinds"))
    # most texts hold no digit and no at sign, which is cheaper to see than the absence of a match
    return F.when(text.rlike("[0-9@]") & text.rlike(ANY), let(made, joined)).otherwise(none)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(row, out): every row of ``docs`` as a struct, the new text and the kinds replaced."""
    return docs.select(F.struct("*").alias("row"), pseudonymised(F.col(text), key).alias("out"))


def clean_rows(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with their text replaced; other columns unchanged."""
    out = pseudonymise(docs, key, text)
    return out.select(*[(F.col("out.text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
