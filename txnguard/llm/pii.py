"""Format-preserving pseudonyms for personal data, with SQL functions only.

One regular expression finds every place where a value may start, also inside another candidate.
There each kind's candidates, the longer ones first, are validated, and the first valid one is
replaced by a keyed permutation of it within its format, so the same value becomes the same
pseudonym in every document and different values stay different. From left to right, a place that a
replaced value covers is passed over. What fails validation stays as it is, and hides nothing.

    card    13 to 19 digits that pass the Luhn check: first digit kept, check digit made anew
    iban    as long as its country's are, passes the mod-97 check: country kept, check digits made
            anew (another length, or a country not in the registry: as far as the check passes)
    phone   North American (area and exchange from 200): permuted among valid numbers;
            other international numbers of 8 to 15 digits: digits after the country code
    ssn     valid area, group and serial: permuted among valid numbers
    ip      four octets: permuted among all addresses
    date    valid days from 1700 to 2099 in five numeric styles, also before the time of a
            timestamp: permuted among those days; with slashes or dashes the month comes first
            unless only day first is valid; a one-digit day or month gives one without zero
    email   letters and digits of the local part, each within its kind; the domain is kept

The permutations are Feistel networks whose round function is SHA-256 of key, kind, round and the
other half. Numbers use halves in mixed radix (a value of a * b possibilities is a pair from a and
b), so every result is valid without retries. Texts use two halves of characters, each shifted
within its alphabet.

Everything is a projection over one row: no shuffle, whatever the skew. Null texts stay null;
empty ones stay empty; the other columns, repeated rows and row order within a file don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import under_safe_names

ROUNDS = 10
# Possessive and bounded, so that the work per start has a bound whatever the text: local parts have
# at most 64 characters, labels 63, and a domain 32 labels.
EMAIL = (r"[A-Za-z0-9._%+\-]{1,64}+@(?<=[A-Za-z0-9]@)[A-Za-z0-9\-]{1,63}"
         r"(?:\.[A-Za-z0-9\-]{1,63}){0,30}\.[A-Za-z]{2,63}")
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
CARD = r"\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{13,19}"
PHONE = r"(?:\+?1[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\+1\d{10}"
SSN = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
DATE = (r"\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}"
        r"|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4}")
# a value may be followed by the time of a timestamp, or by a hyphen and another whole value
WHOLE = rf"(?:{DATE}|{SSN}|{PHONE}|{CARD}|{IP})(?![\p{{L}}\p{{N}}_])(?![.\-]\d)"
END = (r"(?:(?![\p{L}\p{N}_])|(?<=\d{4}[\-/]\d{2}[\-/]\d{2})(?=[Tt]\d))"
       rf"(?!\.\d|-(?!{WHOLE})\d)")
# 8 to 15 digits lie behind; with those, a number ends where another value follows
DIGIT = r"[ .\-()]{0,3}\d"                           # Java's lookbehind wants it written out
ENOUGH = rf"(?<=\+{DIGIT * 8}{f'(?:{DIGIT})?' * 7}\)?)"
FOLLOWER = rf"[ \-](?:{DATE}|{SSN}|(?:{CARD})(?! \d{{4}})|{IP}|\(\d{{3}}\) ?\d{{3}}[ .\-]\d{{4}}){END}"
ABROAD = (rf"\+[2-9]\d{{0,2}}(?:(?!{ENOUGH}{FOLLOWER})[ .\-]?\(?\d{{1,4}}\)?){{2,5}}{ENOUGH}")
NUMBERS = (DATE, SSN, PHONE, ABROAD, CARD, IP)
# where a value may start (after a digit and a hyphen: if a value ends there); group 1 is an e-mail address or what the other kinds need to see
START = (rf"(?<![\p{{L}}\p{{N}}_])(?<!\d\.)(?=((?:{EMAIL}){END}|(?=(?:"
         + "|".join((IBAN, *NUMBERS)) + rf"){END})[\s\S]{{1,96}}))")
# lengths of the IBAN registry
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
STEP = 256                                           # pieces of text that are joined at once
FIRST_DAY, DAYS = "1700-01-01", (27, 5411)           # 400 years are 27 * 5411 days


def _noise(key: str, kind: str, round_no, *parts) -> Column:
    """60 bits of the keyed hash of a round and its inputs."""
    told = F.concat_ws("|", F.lit(key), F.lit(kind), round_no.cast("string"),
                       *[x.cast("string") for x in parts])
    return F.conv(F.substring(F.sha2(told, 256), 1, 15), 16, 10).cast("long")


def permuted_number(x: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A keyed permutation of the numbers 0 to a * b - 1."""
    def step(s, i):
        left = F.pmod(s["l"] + F.pmod(_noise(key, kind, i, s["r"]), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(_noise(key, kind, i, s["l"]), F.lit(b)), F.lit(b))
        return F.struct(F.when(i % 2 == 0, left).otherwise(s["l"]).cast("long").alias("l"),
                        F.when(i % 2 == 1, right).otherwise(s["r"]).cast("long").alias("r"))

    x = x.cast("long")
    start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"),
                     F.pmod(x, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda s: s["l"] * F.lit(b) + s["r"])


def _characters(s: Column, fn) -> Column:
    """`s` with each character replaced by fn(character, position from 1)."""
    return F.when(F.length(s) == 0, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(s)), lambda p: fn(F.substring(s, p, F.lit(1)), p)), ""))


def _shifted(c: Column, by: Column) -> Column:
    code = F.ascii(c)

    def within(first: int, size: int) -> Column:
        return F.char((F.lit(first) + F.pmod(code - first + by, F.lit(size))).cast("long"))

    return (F.when(code.between(48, 57), within(48, 10)).when(code.between(97, 122), within(97, 26))
            .when(code.between(65, 90), within(65, 26)).otherwise(c))


def permuted_text(s: Column, key: str, kind: str) -> Column:
    """A keyed permutation of ASCII letters and digits, each within its alphabet."""
    def shift(half, other, i):
        return _characters(half, lambda c, p: _shifted(c, _noise(key, kind, i, p, other)))

    def step(x, i):
        return F.struct(F.when(i % 2 == 0, shift(x["l"], x["r"], i)).otherwise(x["l"]).alias("l"),
                        F.when(i % 2 == 1, shift(x["r"], x["l"], i)).otherwise(x["r"]).alias("r"))

    cut = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), cut).alias("l"),
                     F.substring(s, cut + 1, F.length(s)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda x: F.concat(x["l"], x["r"]))


def _only(s: Column, what: str = "0-9") -> Column:
    return F.regexp_replace(s, f"[^{what}]", "")


def _refilled(form: Column, new: Column, what: str = "0-9") -> Column:
    """`form` with its characters of the class replaced by those of `new`, in order."""
    def one(c, p):
        nth = F.length(_only(F.substring(form, F.lit(1), p), what))
        return F.when(c.rlike(f"[{what}]"), F.substring(new, nth, F.lit(1))).otherwise(c)
    return _characters(form, one)


def _pad(x: Column, width: int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _int(s: Column) -> Column:
    return s.cast("long")


def luhn_digit(body: Column) -> Column:
    """The digit that makes `body` followed by it pass the Luhn check."""
    def add(s, p):
        d = _int(F.substring(F.reverse(body), p, F.lit(1)))
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return s + F.when(p % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0).cast("long"), add)
    return F.pmod(-total, F.lit(10)).cast("string")


def _mod97(s: Column) -> Column:
    def add(r, p):
        code = F.ascii(F.substring(s, p, F.lit(1))).cast("long")
        return F.pmod(F.when(code >= 65, r * 100 + code - 55).otherwise(r * 10 + code - 48),
                      F.lit(97))
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0).cast("long"), add)


def _rest(s: Column, start: int, less: int = 0) -> Column:
    """From character `start` on, without the last `less`."""
    return F.substring(s, F.lit(start), F.length(s) - (start - 1 + less))


def _card(m: Column, key: str) -> Column:
    digits = _only(m)
    body = F.concat(F.substring(digits, 1, 1),
                    permuted_text(_rest(digits, 2, 1), key, "card"))
    return F.when(F.call_function("luhn_check", digits),
                  _refilled(m, F.concat(body, luhn_digit(body))))


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, bban = F.substring(plain, 1, 2), _rest(plain, 5)
    ok = (F.length(plain).between(15, 34)
          & (_mod97(F.concat(bban, F.substring(plain, 1, 4))) == 1))
    new = permuted_text(bban, key, "iban")
    check = _pad(98 - _mod97(F.concat(new, country, F.lit("00"))), 2)
    return F.when(ok, _refilled(m, F.concat(country, check, new), "A-Z0-9"))


def _phone(m: Column, key: str) -> Column:
    digits = _only(m)
    ten = F.substring(digits, -10, 10)
    area, exchange = _int(F.substring(ten, 1, 3)), _int(F.substring(ten, 4, 3))
    x = permuted_number((area - 200) * 8_000_000 + (exchange - 200) * 10_000
                        + _int(F.substring(ten, 7, 4)), 80_000, 80_000, key, "phone")
    new = F.concat((F.floor(x / 8_000_000) + 200).cast("string"),
                   (F.pmod(F.floor(x / 10_000), F.lit(800)) + 200).cast("string"),
                   _pad(F.pmod(x, F.lit(10_000)), 4))
    kept = F.substring(digits, F.lit(1), F.length(digits) - 10)
    return F.when((area >= 200) & (exchange >= 200),
                  _refilled(m, F.concat(kept, new)))


def _abroad(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^\+(\d{1,2})", 1)
    digits = _only(m)
    new = F.concat(code, permuted_text(
        F.substring(digits, F.length(code) + 1, F.length(digits)), key, "abroad"))
    return F.when(F.length(digits).between(8, 15), _refilled(m, new))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (_int(F.substring(m, a, n)) for a, n in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")          # among the 898 valid areas
    x = permuted_number((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    there = F.floor(x / (99 * 9999))
    new = F.concat(_pad(there + 1 + (there >= 665).cast("long"), 3), F.lit("-"),
                   _pad(F.pmod(F.floor(x / 9999), F.lit(99)) + 1, 2), F.lit("-"),
                   _pad(F.pmod(x, F.lit(9999)) + 1, 4))
    return F.when(ok, new)


def _ip(m: Column, key: str) -> Column:
    octets = [_int(F.split_part(m, F.lit("."), F.lit(i))) for i in (1, 2, 3, 4)]
    ok = (octets[0] < 256) & (octets[1] < 256) & (octets[2] < 256) & (octets[3] < 256)
    value = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    x = permuted_number(value, 1 << 16, 1 << 16, key, "ip")
    new = F.concat_ws(".", *[F.pmod(F.floor(x / (1 << s)), F.lit(256)).cast("string")
                             for s in (24, 16, 8, 0)])
    return F.when(ok & ~m.rlike(r"(^|\.)0\d"), new)


def _date(m: Column, key: str) -> Column:
    def in_order(year: int, month: int, day: int) -> Column:
        """With those places of the three fields."""
        def field(i):
            return F.get(F.split(m, "[./-]"), F.lit(i))

        told = F.concat_ws("-", field(year), F.lpad(field(month), 2, "0"),
                           F.lpad(field(day), 2, "0"))
        number = F.datediff(F.try_to_timestamp(told, F.lit("yyyy-MM-dd")).cast("date"),
                            F.lit(FIRST_DAY).cast("date"))
        moved = F.date_add(F.lit(FIRST_DAY).cast("date"),
                           permuted_number(number, *DAYS, key, "date").cast("int"))

        def new(d):
            def short(part, i):
                return F.when(F.length(field(i)) == 1, part.cast("string")).otherwise(_pad(part, 2))
            parts = {year: _pad(F.year(d), 4), month: short(F.month(d), month),
                     day: short(F.day(d), day)}
            by = F.regexp_extract(m, "[./-]", 0)
            return F.concat(parts[0], by, parts[1], by, parts[2])

        return F.when(number.between(0, DAYS[0] * DAYS[1] - 1),
                      F.get(F.transform(F.array(moved), new), F.lit(0)))

    return (F.when(m.rlike(r"^\d{4}"), in_order(0, 1, 2))
            .when(m.rlike(r"\."), in_order(2, 1, 0))
            .otherwise(F.coalesce(in_order(2, 0, 1), in_order(2, 1, 0))))


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    plain = _only(local, "A-Za-z0-9")
    return F.concat(_refilled(local, permuted_text(plain, key, "email"), "A-Za-z0-9"),
                    F.lit("@"), F.substring_index(m, "@", -1))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate; null if it is not valid."""
    return (F.when(F.contains(m, F.lit("@")), _email(m, key))
            .when(m.rlike(r"^[A-Z]"), _iban(m, key))
            .when(m.rlike(f"^(?:{DATE})$"), _date(m, key))
            .when(m.rlike(f"^(?:{SSN})$"), _ssn(m, key))
            .when(m.rlike(f"^(?:{PHONE})$"), _phone(m, key))
            .when(m.rlike(r"^\+"), _abroad(m, key))
            .when(m.rlike(f"^(?:{CARD})$"), _card(m, key))
            .otherwise(_ip(m, key)))


def _ibans() -> list[str]:
    """Patterns of an IBAN at one place: its country's length, then the longest run; where the
    country is not in the registry, then the shorter ones."""
    def run(four: int, more: str) -> str:
        return rf"\d{{2}}(?: ?[A-Z0-9]{{4}}){{{four}}}{more}"

    known = [rf"(?:{names.replace(' ', '|')})" + run((n - 4) // 4, rf"(?: ?[A-Z0-9]{{{(n - 4) % 4}}})"
             if n % 4 else "") for n, names in IBAN_LENGTHS.items()]
    other = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}"
    return ["|".join(known), IBAN] + [other + run(four, more) for four in range(7, 1, -1)
                                      for more in ("(?: ?[A-Z0-9]{1,3})", "")]


def _candidates(w: Column) -> Column:
    """What may be a value at the start of `w`, in the order of trial."""
    def first(*patterns):
        return F.array_distinct(F.filter(F.array(*[
            F.regexp_extract(w, rf"^(?:{x}){END}", 0) for x in patterns]), lambda m: m != ""))

    return (F.when(F.contains(w, F.lit("@")) & w.rlike(rf"^(?:{EMAIL})\z"), F.array(w))
            .when(w.rlike("^[A-Z]"), first(*_ibans())).otherwise(first(*NUMBERS)))


def _replaced(pieces: Column) -> Column:
    """`pieces` (p: text from a start to the next, size, hyphen: ends with it after a digit, v: the
    value there or null) as one text and the number of values changed."""
    def step(s, x):
        taken = ((s["skip"] == 0) & x["v"].isNotNull() & (~s["hyphen"] | s["joined"]))
        over = F.when(taken, x["v"]["size"]).otherwise(s["skip"])
        rest = F.substring(x["p"], over + 1, x["size"])
        return F.struct(
            F.concat(s["out"], F.when(taken, F.array(x["v"]["new"], rest)).otherwise(F.array(rest)))
            .alias("out"), F.greatest(over - x["size"], F.lit(0)).alias("skip"),
            x["hyphen"].alias("hyphen"), ((over > 0) & (rest == "-")).alias("joined"),
            F.when(taken, s["n"] + (x["v"]["new"] != x["v"]["old"]).cast("int"))
            .otherwise(s["n"]).alias("n"))

    def state(out, of):
        return F.struct(out.alias("out"), *[of[x].alias(x)
                                            for x in ("skip", "hyphen", "joined", "n")])

    def some(s, part):                            # few arrays grow long: linear in long texts
        return F.aggregate(part, state(none, s), step, lambda r: state(
            F.concat(s["out"], F.array(F.array_join(r["out"], ""))), r))

    none = F.array().cast("array<string>")
    begin = {"skip": F.lit(0), "hyphen": F.lit(False), "joined": F.lit(False), "n": F.lit(0)}

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / STEP).cast("int")),
                        lambda i: F.slice(pieces, i * STEP + 1, F.lit(STEP)))
    return F.aggregate(parts, state(none, begin), some, lambda s: F.struct(
        F.array_join(s["out"], "").alias("text"), s["n"].alias("n")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with pseudonyms in `text` and n_private, the number of values replaced (a column of
    that name, in any case, is replaced)."""
    return under_safe_names(docs, [text], ("n_private",),
                            lambda safe, t: _pseudonymise(safe, key, t))


def _pseudonymise(docs: DataFrame, key: str, text: str) -> DataFrame:
    seen = F.regexp_extract_all(F.col(text), F.lit(START), F.lit(1))
    likely = F.col(text).rlike("[@0-9]")          # most texts have no candidate at all

    def valid(tried):
        return F.get(F.filter(F.transform(tried, lambda m: F.struct(
            m.alias("old"), F.length(m).alias("size"), pseudonym(m, key).alias("new"))),
            lambda v: v["new"].isNotNull()), F.lit(0))

    out = docs.withColumn("__llm_found", F.when(likely, F.transform(
        F.transform(seen, _candidates), valid)))
    any_found = F.exists("__llm_found", lambda v: v.isNotNull())
    # a start at the very beginning has no piece before it
    pieces = F.split(F.col(text), START, -1)
    out = out.withColumn("__llm_pieces", F.when(any_found, pieces))
    found = F.when(F.size("__llm_pieces") > F.size("__llm_found"), F.concat(
        F.array(F.get("__llm_found", F.lit(-1))), F.col("__llm_found"))).otherwise(
        F.col("__llm_found"))
    out = out.withColumn("__llm_pieces", F.zip_with("__llm_pieces", found, lambda p, v: F.struct(
        p.alias("p"), F.length(p).alias("size"), F.substring(p, -2, 2).rlike(r"^\d-$")
        .alias("hyphen"), v.alias("v"))))
    out = out.withColumn("__llm_new", F.when(F.size("__llm_pieces") > 0,
                                             _replaced(F.col("__llm_pieces"))))
    return out.withColumns({
        text: F.coalesce(F.col("__llm_new.text"), F.col(text)),
        "n_private": F.coalesce(F.col("__llm_new.n"), F.lit(0))
    }).drop("__llm_found", "__llm_pieces", "__llm_new")
