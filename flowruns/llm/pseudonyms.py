"""Format-preserving Feistel pseudonyms for private numbers, dates and mail names.

Found and validated: payment card numbers (Luhn), bank account numbers (IBAN, by their country's length and
mod 97), international phone numbers, US social security numbers, IPv4 addresses, dates (ISO, within ``FIRST_DAY`` and
``DAYS``) and mail addresses (the part before ``@``). Each is permuted by a keyed Feistel network within its own format: the characters that vary are
numbers below a radix (digits 10, letters 26, octets 256, ...), cut into two halves; in every round each
number of one half is moved by a keyed digest of the other half, modulo its radix. That is a
permutation of the format's values, so equal values stay equal in all documents, different ones stay
different, and lengths, separators, letter case and check digits stay valid. With the key
``reveal=True`` inverts it.

All of it is DataFrame functions; texts without a digit or ``@`` skip it. Values are found in the
document's own row, so nothing is shuffled.

Where a phone number ends is decided by the number alone, so other digits beside it neither change it nor are changed:
countries whose numbers all have one length end there (``PHONE_DIGITS``); elsewhere a number ends with the group of digits that
holds its tenth digit, country code included, and has 15 digits at most. Shorter ones are not taken for phone numbers. The country code
(``TWO_DIGIT_CODES``; 1 and 7; else three digits) stays, in any spelling of the number.

Defined cases: null texts stay null; what does not validate (a wrong check digit, an octet above 255, an
impossible date) stays as it is; repeated rows get equal results; an empty table gives an empty
result; whole texts are searched; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowruns.llm.common import table

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 270 * 270  # a square number of days: two numbers below 270
# The country codes of two digits.
TWO_DIGIT_CODES = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                   "81 82 84 86 90 91 92 93 94 95 98").split()
# Digits after the country code -> the country codes whose numbers all have so many.
PHONE_DIGITS = {10: "1 7 30 44 52 57 63 90 91 92 98", 9: "33 34 48 375 380 420 421 994 995 998"}
# Length of an IBAN -> its countries.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS",
                23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY HU LB PL",
                29: "BR QA UA", 31: "MT"}
GAP = "[ .()-]{0,2}"
#: What is looked for, in this order at each place.
PATTERNS = {
    "mail": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9.-]{0,253}\.[A-Za-z]{2,24}",
    "iban": "(?<![0-9A-Za-z])(?:" + "|".join(f"(?:{of.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}" for n, of in IBAN_LENGTHS.items())
            + ")(?![0-9A-Za-z])",
    "phone": r"\+(?:" + "|".join(f"(?:{of.replace(' ', '|')})(?:{GAP}[0-9]){{{n}}}(?![0-9])" for n, of in PHONE_DIGITS.items())
             + f"|[0-9](?:{GAP}[0-9]){{9}}[0-9]{{0,5}}(?![0-9]))",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def bind(value: Column, f) -> Column:
    return F.element_at(F.transform(F.array(value), f), 1)


def feistel(values: Column, radices: Column, key: str, kind: str, reveal: bool) -> Column:
    """Permute an array of numbers, each below its radix. Even rounds move the first half by the second."""
    def step(v, r):
        r = F.lit(ROUNDS - 1) - r if reveal else r
        half = F.floor(F.size(v) / 2).cast("int")
        first = (r % 2) == 0
        other = F.array_join(F.transform(F.when(first, F.slice(v, half + 1, F.size(v) - half)).otherwise(F.slice(v, F.lit(1), half)),
                                         lambda x: x.cast("string")), ",")
        def moved(head):
            def one(x, i):
                digest = F.substring(F.sha2(F.concat(head, i.cast("string")), 256), 1, 12)
                by = F.conv(digest, 16, 10).cast("long") % F.get(radices, i)
                now = F.pmod(x - by if reveal else x + by, F.get(radices, i).cast("long")).cast("int")
                return F.when((i < half) == first, now).otherwise(x)
            return F.transform(v, one)
        return bind(F.concat(F.lit(f"{key}|{kind}|"), F.size(v).cast("string"), F.lit("|"), r.cast("string"), F.lit("|"), other, F.lit("|")), moved)
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, step)


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def put_back(shape: Column, values: Column, letters: bool) -> Column:
    """``shape`` (array of characters) with its digits (and letters) replaced by ``values`` in turn."""
    def varies(c):
        return c.rlike("^[0-9A-Za-z]$" if letters else "^[0-9]$")
    def char(c, v):
        at = lambda alphabet: F.substring(F.lit(alphabet), v + 1, F.lit(1))
        out = at(DIGITS)
        return F.when(c.rlike("^[a-z]$"), at(LOWER)).when(c.rlike("^[A-Z]$"), at(UPPER)).otherwise(out) if letters else out
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))
    step = lambda a, c: F.struct(F.concat(a["s"], F.when(varies(c), char(c, F.get(values, a["k"]))).otherwise(c)).alias("s"),
                                 (a["k"] + F.when(varies(c), 1).otherwise(0)).alias("k"))
    return F.aggregate(shape, start, step, lambda a: a["s"])


def digits_of(text: Column) -> Column:
    return F.transform(chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("int"))


def luhn(digits: Column) -> Column:
    """The sum that is a multiple of ten for a valid number."""
    def part(d, i):
        twice = d * 2
        return F.when((F.size(digits) - i) % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.transform(digits, part), F.lit(0), lambda a, x: a + x)


def mod97(characters: Column) -> Column:
    """The number that the characters spell, letters as 10 to 35, modulo 97."""
    digit = lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1
    return F.aggregate(characters, F.lit(0), lambda a, c: ((a * F.when(digit(c) > 9, 100).otherwise(10) + digit(c)) % 97).cast("int"))


def same(n: Column, radix: int) -> Column:
    return F.array_repeat(F.lit(radix), n)


def pseudonym(m: Column, key: str, reveal: bool) -> Column:
    """The pseudonym of a found string, or the string itself if it does not validate."""
    full = lambda name: m.rlike("^(?:" + PATTERNS[name].replace(r"(?<![0-9.])", "").replace(r"(?<![0-9-])", "").replace("(?<![0-9])", "").replace("(?<![0-9A-Za-z])", "") + ")$")
    run = lambda v, r, kind: feistel(v, r, key, kind, reveal)

    def mail(x):
        local = F.substring_index(x, "@", 1)
        def work(c):
            kept = F.filter(c, lambda y: y.rlike("^[0-9A-Za-z]$"))
            value = F.transform(kept, lambda y: (F.when(y.rlike("[a-z]"), F.instr(F.lit(LOWER), y)).when(
                y.rlike("[A-Z]"), F.instr(F.lit(UPPER), y)).otherwise(F.instr(F.lit(DIGITS), y)) - 1).cast("int"))
            radix = F.transform(kept, lambda y: F.when(y.rlike("[0-9]"), 10).otherwise(26))
            kind = F.array_join(F.transform(kept, lambda y: F.when(y.rlike("[0-9]"), "9").when(y.rlike("[a-z]"), "a").otherwise("A")), "")
            return put_back(c, run(value, radix, "mail"), True)
        return F.concat(bind(chars(local), work), F.substring(x, F.length(local) + 1, F.length(x)))

    def card(x):
        def work(d):
            moved = run(F.slice(d, F.lit(1), F.size(d) - 1), same(F.size(d) - 1, 10), "card")
            check = lambda p: F.concat(p, F.array((F.lit(10) - luhn(F.concat(p, F.array(F.lit(0)))) % 10) % 10))
            return F.when(luhn(d) % 10 == 0, put_back(chars(x), bind(moved, check), False)).otherwise(x)
        return bind(digits_of(x), work)

    def iban(x):
        """Country and layout stay; the check digits are those of the moved number."""
        def work(c):
            country, own = F.slice(c, 1, 2), F.slice(c, F.lit(5), F.size(c) - 4)
            checked = lambda o: F.split(F.lpad((98 - mod97(F.concat(o, country, F.array(F.lit("0"), F.lit("0"))))).cast("string"), 2, "0"), "")
            is_digit = lambda y: y.rlike("[0-9]")
            number = lambda y: (F.when(is_digit(y), F.instr(F.lit(DIGITS), y)).otherwise(F.instr(F.lit(UPPER), y)) - 1).cast("int")
            radix = F.transform(own, lambda y: F.when(is_digit(y), 10).otherwise(26))
            def back(v):
                spelt = F.zip_with(own, v, lambda y, k: F.substring(F.when(is_digit(y), F.lit(DIGITS)).otherwise(F.lit(UPPER)), k + 1, F.lit(1)))
                check = F.transform(F.slice(checked(spelt), 1, 2), number)
                return put_back(chars(x), F.concat(F.transform(country, number), check, v), True)
            good = F.array_join(F.slice(c, 3, 2), "") == F.array_join(checked(own), "")
            return F.when(good, bind(run(F.transform(own, number), radix, "iban"), back)).otherwise(x)
        return bind(chars(F.replace(x, F.lit(" "), F.lit(""))), work)

    def phone(x):
        """The digits after the country code vary; the first of them stays above 1 or below 2."""
        def work(d):
            head = F.array_join(F.slice(d, 1, 2), "")
            code = F.when(head.rlike("^[17]"), 1).when(head.isin(TWO_DIGIT_CODES), 2).otherwise(3)
            own = F.slice(d, code + 1, F.size(d) - code)
            high = F.get(own, 0) >= 2
            shifted = F.transform(own, lambda y, i: F.when((i == 0) & high, y - 2).otherwise(y))
            radix = F.transform(own, lambda y, i: F.when((i == 0) & high, 8).when((i == 0), 2).otherwise(10))
            back = lambda v: F.transform(v, lambda y, i: F.when((i == 0) & high, y + 2).otherwise(y))
            kind = F.when(high, "phone2").otherwise("phone0")
            return put_back(chars(x), F.concat(F.slice(d, F.lit(1), code), bind(run(shifted, radix, "phone"), back)), False)
        return bind(digits_of(x), work)

    def ip(x):
        def work(o):
            good = F.forall(o, lambda y: y < 256)
            return F.when(good, F.array_join(F.transform(run(o, same(F.lit(4), 256), "ip"), lambda y: y.cast("string")), ".")).otherwise(x)
        return bind(F.transform(F.split(x, r"\."), lambda y: y.cast("int")), work)

    def date(x):
        day = F.datediff(F.try_to_date(x, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
        def work(n):
            moved = bind(run(F.array(F.floor(n / 270).cast("int"), (n % 270).cast("int")), same(F.lit(2), 270), "date"),
                         lambda v: F.get(v, 0) * 270 + F.get(v, 1))
            return F.when((n >= 0) & (n < DAYS), F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), moved), "yyyy-MM-dd")).otherwise(x)
        return bind(day, work)

    def ssn(x):
        """Area 1 to 899 without 666, group 1 to 99, serial 1 to 9999."""
        def work(p):
            area, group, serial = (F.get(p, k) for k in range(3))
            good = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
            value = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)
            def back(v):
                a = F.get(v, 0) + 1
                return F.concat_ws("-", *[F.lpad((c).cast("string"), n, "0") for c, n in (
                    (a + F.when(a >= 666, 1).otherwise(0), 3), (F.get(v, 1) + 1, 2), (F.get(v, 2) + 1, 4))])
            return F.when(good, bind(run(value, F.array(F.lit(898), F.lit(99), F.lit(9999)), "ssn"), back)).otherwise(x)
        return bind(F.transform(F.split(x, "-"), lambda y: y.cast("int")), work)

    out = m
    for name, f in reversed([("mail", mail), ("iban", iban), ("phone", phone), ("ip", ip), ("date", date), ("ssn", ssn), ("card", card)]):
        out = F.when(full(name), F.coalesce(f(m), m)).otherwise(out)
    return out


def pseudonymized(docs: DataFrame, key: str, text: str = "text", reveal: bool = False) -> DataFrame:
    """(row, text, n_found, n_changed) of every row of ``docs``."""
    if not key:
        raise ValueError("a key is needed")
    out = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    t = F.col("row")[text]
    found = F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    out = out.select("row", F.coalesce(found, F.array().cast("array<string>")).alias("found"))
    out = out.withColumn("new", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(m, key, reveal))))
    between = F.split(t, ANY, -1)
    joined = F.array_join(F.zip_with(between, F.concat("new", F.array(F.lit(""))), lambda b, n: F.concat(b, n)), "")
    changed = F.size(F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda x: x))
    return out.select("row", F.when(F.size("found") > 0, joined).otherwise(t).alias("text"), F.size("found").alias("n_found"),
                      F.when(F.size("found") > 0, changed).otherwise(0).alias("n_changed"))


def op3_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """Every document with its private values replaced."""
    out = pseudonymized(table(spark, sf_dir, "documents").select("doc_id", "text"), key="flowruns-demo-key")
    return out.select("row.doc_id", "text", "n_found", "n_changed")
