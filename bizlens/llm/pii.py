"""Format-preserving pseudonyms for personal data (operator 6). DataFrame functions only, one map: no shuffle.

Values found by pattern and validated (octets of addresses, check digits of cards, calendar dates, numbering rules) are
written as a list of symbols, each with its own radix, and permuted by an alternating Feistel network: in each round
the symbols of one half are shifted, modulo their radices, by keyed hashes of the other half. So a value maps to one
valid value of the same format, always the same under one key: equal values stay linked across documents, different
values stay different. A card's check digit is computed anew; dates are day numbers of a 400-year cycle (146,097 =
189 x 773 days, so no value falls outside).

Found: e-mail addresses, IPv4 and IPv6 addresses (whole or with one ::; the digits of each group are permuted, so one
address has one pseudonym in each way of writing it, upper and lower case alike), phone numbers (behind +country any number
of 8 to 15 digits with the usual separators, its national digits permuted in place; without it the North American shape and
the French one in pairs of digits), card numbers, IBANs (of the countries and lengths below, mod 97), US social security
numbers, French social security numbers and Spanish DNI and NIE (by their check digits or letters, which are computed anew),
dates (ISO, 12.03.1999, 12/03/1999, and with English, German, French or Spanish month names; one date has one pseudonym
in all of these but the slashed form, whose order is unknown: there the numbers stay dates in the readings they had, so
the 29th of February, and days from 29 and 31 on, stay such), access keys, keys known by their first letters (ghp_, sk-,
xoxb-, ...) and bearer tokens, and values of token/password/secret/api_key
assignments (the characters _ - . / + = inside a value stay; of a value beyond 4,096 characters the first 4,096 count).

Defined results: a null text stays null with no finds; empty texts stay empty; repeated rows get the same text; an empty
table gives no rows; a very long text takes time in proportion, whatever runs of letters, digits or labels it holds; all
other columns are kept as they are, but for one that has the name of the count, which the count replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bizlens.llm.work import unused

ROUNDS = 8
#: Fixed value: days of the Gregorian cycle 1800-01-01 to 2199-12-31, as a product of two radices.
DATE_RADICES = (189, 773)
FIRST_DAY = "1800-01-01"

#: Fixed values (RFC 1035, RFC 5321): a local part has at most 64 characters, a label 63. Quantifiers are bounded or
#: possessive and an address starts only where a run of letters and digits does: matching is linear, without recursion.
LETTERS = r"A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
LABEL = r"[A-Za-z0-9]{1,63}+(?:-{1,61}+[A-Za-z0-9]{1,61}+){0,31}+"
EMAIL = rf"(?<![{LETTERS}])[{LETTERS}][{LETTERS}._%+-]{{0,63}}+(?<=[{LETTERS}])@{LABEL}(?:\.{LABEL}){{1,9}}+"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
DATE = r"(?<![0-9-])(?:1[89]|2[01])[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
#: Month names as they are written (English, short, German, French, Spanish).
MONTHS = ("January February March April May June July August September October November December "
          "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec "
          "Januar Februar März April Mai Juni Juli August September Oktober November Dezember "
          "janvier février mars avril mai juin juillet août septembre octobre novembre décembre "
          "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre").split()
YEAR, DAY, NAME = "(?:1[89]|2[01])[0-9]{2}", "(?:0?[1-9]|[12][0-9]|3[01])", "|".join(sorted(set(MONTHS), key=lambda x: (-len(x), x)))
DOTTED = rf"(?<![0-9.]){DAY}\.(?:0?[1-9]|1[0-2])\.{YEAR}(?![0-9]|\.[0-9])"
SLASHED = rf"(?<![0-9/]){DAY}/{DAY}/{YEAR}(?![0-9/])"
NAME_FIRST = rf"(?<![A-Za-z])(?=[JFMASOND])(?:{NAME})\.? {DAY},? {YEAR}(?![0-9])"
DAY_FIRST = rf"(?<![0-9.,]){DAY}(?:\. ?| | de )(?:{NAME})\.?(?: | de ){YEAR}(?![0-9])"
WORDED = rf"{NAME_FIRST}|{DAY_FIRST}"
#: Fixed value: months of 31 days.
LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)
#: Country codes (ITU-T E.164; any other is taken as up to three digits) and the usual separators.
COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})"
SEPARATOR = r"[ \u00a0\u202f./\u2010\u2011\u2013-]"
#: Digits behind the country code where the plan has one length; they say where a number ends.
NATIONAL = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "47": 8, "48": 9, "52": 10, "61": 9,
            "91": 10, "351": 9}


def _phone() -> str:
    """Numbers with a country code: those of a known length, else 8 to 15 digits; no other value starts inside."""
    opened = "|".join(rf"(?<=\([0-9]{{{k}}})" for k in range(1, 6))
    lead = rf"{SEPARATOR}{{0,3}}(?:\(0\){SEPARATOR}{{0,3}})?\(?"
    gap = rf"(?:(?:{opened})\))?{SEPARATOR}{{0,3}}"
    more = rf"{gap}(?!{IP}|{SSN}|{DATE}|{CARD})[0-9]"
    known = [rf"{c}{lead}[0-9](?:{gap}[0-9]){{{n - 1}}}" for c, n in NATIONAL.items()]
    other = [rf"[0-9]{{{k}}}{lead}[0-9](?:{gap}[0-9]){{{7 - k}}}(?:{more}){{0,7}}" for k in (3, 2, 1)]
    start = rf"(?<![0-9])\+(?!{IP}|{DATE}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}(?![0-9]))"
    return rf"{start}(?:(?:{'|'.join(known)})(?![0-9])|(?:{'|'.join(other)})(?![0-9]))"


#: Without a country code only the North American shape is a number (area and exchange code start with 2 to 9).
LOCAL = (r"(?<![0-9A-Za-z+.-])(?:1[ .-])?(?:\([2-9][0-9]{2}\)[ .-]?[2-9][0-9]{2}[ .-]|[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-])"
         r"[0-9]{4}(?![0-9]|[.-][0-9])")
PHONE = rf"{_phone()}|{LOCAL}"
#: What stands before a number's national digits, with a trunk zero in brackets.
BEFORE_NATIONAL = rf"^(?:\+0{{0,3}}{COUNTRY}{SEPARATOR}{{0,3}}(?:\(0\))?|1)"
KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET = (r"(?<![A-Za-z0-9])(?i:token|password|passwd|secret|api[_-]?key)[\"']?[ ]?[=:][ ]?[\"']?"
          r"[A-Za-z0-9_./+=-]{7,4095}[A-Za-z0-9]")
#: What keys and tokens of known services start with; it stays.
PREFIX = r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|[rs]k_(?:live|test)_|AIza|[Bb]earer )"
TOKEN = rf"(?<![A-Za-z0-9]){PREFIX}(?=[A-Za-z_./+~=-]{{0,63}}[0-9])[A-Za-z0-9_./+~=-]{{15,4095}}[A-Za-z0-9]"
SECRET_START = rf"^(?:{PREFIX}|[^=:]*[=:][ ]?[\"']?{PREFIX}?)"
#: Lengths of the IBANs of European countries.
IBAN_LENGTHS = {"NO": 15, "BE": 16, "DK": 18, "FI": 18, "NL": 18, "SI": 19, "AT": 20, "EE": 20, "LT": 20, "LU": 20, "CH": 21,
                "HR": 21, "LI": 21, "LV": 21, "BG": 22, "DE": 22, "GB": 22, "IE": 22, "AD": 24, "CZ": 24, "ES": 24, "RO": 24,
                "SE": 24, "SK": 24, "PT": 25, "IS": 26, "FR": 27, "GR": 27, "IT": 27, "MC": 27, "SM": 27, "CY": 28, "HU": 28,
                "PL": 28, "MT": 31}


def _iban() -> str:
    """IBANs in groups of four or without blanks."""
    forms = []
    for n in sorted(set(IBAN_LENGTHS.values())):
        codes = "|".join(c for c, m in IBAN_LENGTHS.items() if m == n)
        last = rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else ""
        forms.append(rf"(?:{codes})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}{last})")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


IBAN = _iban()
#: Eight groups, or fewer around one double colon (_kind counts them); a digit stands in it.
GROUP = "[0-9A-Fa-f]{1,4}"
IPV6 = (rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]{{0,38}}[0-9])(?:{GROUP}(?::{GROUP}){{7}}|{GROUP}(?::{GROUP}){{0,5}}::{GROUP}"
        rf"(?::{GROUP}){{0,5}})(?![0-9A-Za-z:]|\.[0-9A-Za-z])")
#: The letters of Spanish identity numbers by the number modulo 23.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
DNI = r"(?<![A-Za-z0-9-])(?:[0-9]|[XYZ]-?)[0-9]{7}-?[A-HJ-NP-TV-Z](?![A-Za-z0-9-])"
#: French social security numbers: sex, year, month, department, commune, order, key.
NIR = (r"(?<![0-9])[12](?: [0-9]{2} (?:0[1-9]|1[0-2]) (?:0[1-9]|[1-8][0-9]|9[0-5]) [0-9]{3} [0-9]{3} [0-9]{2}"
       r"|[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[1-8][0-9]|9[0-5])[0-9]{6} ?[0-9]{2})(?![0-9])")
#: French phone numbers without a country code, in pairs of digits.
PAIRS = "|".join(rf"(?<![0-9A-Za-z+./-])0[1-9](?:{c}[0-9]{{2}}){{4}}(?![0-9]|[ ./-][0-9])" for c in (" ", r"\.", "-"))
#: All of them; the first character is looked at before the patterns are tried.
NO_EMAIL = "|".join((rf"(?=[APSTapst])(?:{SECRET}|{KEY})", rf"(?=[ABGRXbgrsx])(?:{TOKEN})", rf"(?=[A-Z])(?:{IBAN})",
                     rf"(?=[0-9A-Fa-f]{{1,4}}:)(?:{IPV6})", rf"(?=[0-9XYZ])(?:{DNI})",
                     rf"(?=[0-9+(])(?:{IP}|{PHONE}|{PAIRS}|{SSN}|{DATE}|{DOTTED}|{SLASHED}|{DAY_FIRST}|{NIR}|{CARD})",
                     NAME_FIRST))
ANY = f"{EMAIL}|{NO_EMAIL}"
#: Marks around finds; a text's own are escaped first. (Noncharacters: they stand in no pattern.)
MARK, ESCAPE, MARKED = "\ufdd0", "\ufdd1", "\ufdd2"

KINDS = ("email", "ip", "ipv6", "phone", "pairs", "ssn", "nir", "dni", "iban", "date", "slash", "card", "key", "secret")


#: Place, length, smallest value and number of values of a French number's parts.
NIR_PARTS = ((1, 1, 1, 2), (2, 2, 0, 100), (4, 2, 1, 12), (6, 2, 1, 95), (8, 3, 0, 1000), (11, 3, 0, 1000))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Sum of the digits, every second one doubled (less nine beyond nine), counted from the right."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((i % 2 == 0) == F.lit(double_last), twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def mod_97(text: Column) -> Column:
    """Remainder modulo 97 of a number written in digits and capital letters (A is 10, Z is 35)."""

    def add(rest, c):
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(_chars(text), F.lit(0), add)


def _iban_rest(country_and_check: Column, account: Column) -> Column:
    return mod_97(F.concat(account, country_and_check))


def _dni_letter(m: Column, digits: Column) -> Column:
    """The letter that belongs to the digits, with the first letter of a NIE as a digit before them."""
    first = F.translate(F.regexp_extract(m, "^([XYZ]?)", 1), "XYZ", "012")
    return F.substring(F.lit(DNI_LETTERS), (F.concat(first, digits).try_cast("int") % 23 + 1), F.lit(1))


def _nir_key(digits: Column) -> Column:
    return 97 - F.substring(digits, 1, 13).try_cast("long") % 97


def _class(char: Column) -> Column:
    """(symbol, radix) of a character: digits, small and capital letters keep their class, others stay."""
    code = F.ascii(char)
    return (F.when(char.rlike("^[0-9]$"), F.struct((code - 48).alias("s"), F.lit(10).alias("r")))
            .when(char.rlike("^[a-z]$"), F.struct((code - 97).alias("s"), F.lit(26).alias("r")))
            .when(char.rlike("^[A-Z]$"), F.struct((code - 65).alias("s"), F.lit(26).alias("r")))
            .otherwise(F.struct(F.lit(0).alias("s"), F.lit(1).alias("r"))))


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: the element of a one-element array (lambdas read it as a variable)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def permute(symbols: Column, radices: Column, form: Column, key: str) -> Column:
    """Alternating Feistel network over symbols (array<int>) of the given radices (a bound array); ``form`` names the
    format."""
    n = F.size(radices)
    half = F.ceil(n / 2).cast("int")

    def one(state, rnd):
        left = rnd % 2 == 0
        other = F.array_join(F.when(left, F.slice(state, half + 1, n)).otherwise(
            F.slice(state, F.lit(1), half)).cast("array<string>"), ",")
        hashed = F.sha2(F.concat_ws("|", F.lit(key), form, rnd.cast("string"), other), 256)

        def shifted(digest):
            def shift(s, i):
                turn = F.sha2(F.concat_ws("|", digest, i.cast("string")), 256)
                by = F.conv(F.substring(turn, 1, 15), 16, 10).cast("long")
                moves = F.when(left, i < half).otherwise(i >= half)
                return F.when(moves, F.pmod(s + by, F.get(radices, i).cast("long")).cast("int")).otherwise(s)

            return F.transform(state, shift)

        # The other half is read once a round, however long the value.
        return _bind(hashed, shifted)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, one)


def _iso(m: Column) -> Column:
    """A date of any form but the slashed as year-month-day."""
    name = F.regexp_extract(m, rf"(?<![A-Za-z])({NAME})(?![a-z])", 1)
    month = (F.array_position(F.split(F.lit(" ".join(MONTHS)), " "), name) - 1) % 12 + 1
    day = F.regexp_extract(m, rf"(?<![0-9])({DAY})(?![0-9])", 1)
    return (F.when(m.rlike(f"^(?:{DATE})$"), m)
            .when(m.rlike(f"^(?:{DOTTED})$"), F.regexp_replace(m, r"^([0-9]+)\.([0-9]+)\.([0-9]+)$", "$3-$2-$1"))
            .when(m.rlike(f"^(?:{WORDED})$"), F.concat_ws("-", F.substring(m, -4, 4), month.cast("string"), day)))


def _slashed(m: Column) -> tuple[Column, Column, Column, Column]:
    """(day, month, year, day first) of a slashed date; day first where both readings are dates."""
    a, b, year = (F.get(F.split(m, "/"), F.lit(k)).try_cast("int") for k in range(3))
    first = b <= 12
    return F.when(first, a).otherwise(b), F.when(first, b).otherwise(a), year, first


def _kind(m: Column) -> Column:
    plain = F.when(m.contains("@"), "email").when(m.rlike(f"^(?:{IP})$"), "ip").when(
        m.startswith("+") | m.rlike(f"^(?:{LOCAL})$"), "phone")
    plain = plain.when(m.rlike(f"^(?:{SSN})$"), "ssn")
    plain = plain.when(m.rlike(f"^(?:{DATE})$"), F.when(m.try_cast("date").isNotNull(), "date"))
    plain = plain.when(m.rlike(f"^(?:{DOTTED}|{WORDED})$"), F.when(_iso(m).try_cast("date").isNotNull(), "date"))
    day, month, year, _ = _slashed(m)
    plain = plain.when(m.rlike(f"^(?:{SLASHED})$"), F.when(
        F.concat_ws("-", year.cast("string"), month.cast("string"), day.cast("string")).try_cast("date").isNotNull(), "slash"))
    plain = plain.when(m.rlike(f"^(?:{IBAN})$"), F.when(
        _iban_rest(F.substring(m, 1, 4), F.substring(F.replace(m, F.lit(" "), F.lit("")), 5, 30)) == 1, "iban"))
    groups = F.size(F.filter(F.split(m, ":"), lambda g: g != ""))
    plain = plain.when(m.rlike(f"^(?:{IPV6})$"), F.when(~m.contains("::") | (groups < 8), "ipv6"))
    plain = plain.when(m.rlike(f"^(?:{DNI})$"), F.when(_dni_letter(m, _digits(m)) == F.substring(m, -1, 1), "dni"))
    plain = plain.when(m.rlike(f"^(?:{PAIRS})$"), "pairs")
    plain = plain.when(m.rlike(f"^(?:{NIR})$") & (_nir_key(_digits(m)) == F.substring(_digits(m), 14, 2).try_cast("int")), "nir")
    plain = plain.when(m.rlike(f"^(?:{NIR})$") & ~m.rlike(f"^(?:{CARD})$"), None)
    plain = plain.when(m.rlike("^[0-9]"), F.when(luhn_sum(_digits(m), False) % 10 == 0, "card"))
    return plain.when(m.rlike("^AKIA[0-9A-Z]{16}$"), "key").otherwise("secret")


def _varying(m: Column, kind: Column) -> Column:
    """The characters of a value that are permuted, without separators and fixed parts."""
    return (F.when(kind == "email", F.regexp_extract(m, r"^(.*)\.[^.]*$", 1))
            .when(kind == "phone", _digits(F.regexp_replace(m, BEFORE_NATIONAL, "")))
            .when(kind == "card", 
                  F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 1))
            .when(kind == "key", F.substring(m, 5, 16))
            .when(kind == "iban", F.substring(F.replace(m, F.lit(" "), F.lit("")), 5, 30))
            .when(kind == "ipv6", F.lower(m))
            .when(kind == "dni", _digits(m))
            .when(kind == "pairs", F.substring(_digits(m), 2, 9))
            .otherwise(F.regexp_replace(m, SECRET_START, "")))


def _padded(m: Column, number: Column) -> Column:
    """A day or month number, of two digits unless the value has one of one digit."""
    short = m.rlike("(?:^|[./ ])[0-9](?:[^0-9]|$)")
    return F.when(short, number.cast("string")).otherwise(F.lpad(number.cast("string"), 2, "0"))


def _written(m: Column, date: Column) -> Column:
    """The date in the form in which ``m`` is written, month names in its language."""
    day, month, year = _padded(m, F.dayofmonth(date)), F.month(date), F.date_format(date, "yyyy")
    name = F.regexp_extract(m, rf"(?<![A-Za-z])({NAME})(?![a-z])", 1)
    names = F.split(F.lit(" ".join(MONTHS)), " ")
    at = F.array_position(names, name) - 1
    german = m.rlike(r"^[0-9]+\.") & F.array_contains(F.slice(names, 25, 12), name)
    tongue = F.when(german, 2).otherwise(F.floor(at / 12)).cast("int")
    worded = F.regexp_replace(F.regexp_replace(m, F.lit("[0-9]{4}$"), year), F.lit("(?<![0-9])[0-9]{1,2}(?![0-9])"), F.when(
        m.rlike("(?<![0-9])0[0-9](?![0-9])"), day).otherwise(F.dayofmonth(date).cast("string")))
    return (F.when(m.rlike(f"^(?:{DATE})$"), F.date_format(date, "yyyy-MM-dd"))
            .when(m.rlike(f"^(?:{DOTTED})$"), F.concat_ws(".", day, _padded(m, month), year))
            .otherwise(F.regexp_replace(worded, F.lit(rf"(?<![A-Za-z])(?:{NAME})(?![a-z])"),
                                        F.get(names, tongue * 12 + month - 1))))


def _leap_years() -> Column:
    """The 97 leap years of 1800 to 2199."""
    return F.filter(F.sequence(F.lit(1804), F.lit(2196), F.lit(4)), lambda v: ~v.isin(1900, 2100))


def _written_slashed(m: Column, out: Column) -> Column:
    day, month, _, first = _slashed(m)
    x, y = F.get(out, F.lit(0)), F.get(out, F.lit(1))
    year = F.element_at(out, -1) + 1800
    leap = F.get(_leap_years(), x)
    new_day = F.when(day <= 28, x + 13).when(day == 31, 31).when(month == 2, 29).otherwise(x + 29)
    new_month = (F.when(day <= 28, y + 1).when(day == 31, F.get(F.array(*map(F.lit, LONG_MONTHS)), x))
                 .when(month == 2, 2).otherwise(F.when(y == 0, 1).otherwise(y + 2)))
    a = F.when(day <= 12, x + 1).when(first, new_day).otherwise(new_month)
    b = F.when(day <= 12, y + 1).when(first, new_month).otherwise(new_day)
    return F.concat_ws("/", _padded(m, a), _padded(m, b), F.when(
        (day == 29) & (month == 2), leap).otherwise(year).cast("string"))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a found value, or the value itself if it is not valid."""

    def by_kind(kind: Column) -> Column:
        return _bind(_varying(m, kind), lambda text: _bind(
            (kind == "ipv6") | ((kind == "secret") & text.rlike("^[0-9a-f_./+=-]+$")), lambda hexed: of_kind(kind, text, hexed)))

    def of_kind(kind: Column, text: Column, hexed: Column) -> Column:
        numbers = F.when(kind.isin("ip", "ssn"), F.split(m, "[.-]")).cast("array<int>")
        area = F.get(numbers, F.lit(0))
        day = F.datediff(_iso(m).try_cast("date"), F.lit(FIRST_DAY).cast("date"))
        # Digits of a phone number that may not take every value.
        local = (kind == "phone") & ~m.startswith("+")
        # A single digit in brackets (0 is the trunk's), and the first of the pairs.
        single = (kind == "pairs") | ((kind == "phone") & m.rlike(r"^\+[^(]*\([1-9]\)"))
        as_chars = F.transform(_chars(text), lambda c, i: F.when(
            hexed & c.rlike("[0-9a-f]"), F.struct(F.conv(F.when(hexed, c), 16, 10).cast("int").alias("s"), F.lit(16).alias("r"))
        ).when(local & i.isin(0, 3), F.struct((F.ascii(c) - 50).alias("s"), F.lit(8).alias("r"))
               ).when(single & (i == 0), F.struct((F.ascii(c) - 49).alias("s"), F.lit(9).alias("r"))
                      ).otherwise(_class(c)))

        def pairs(*both):
            return F.array(*[F.struct(F.lit(s).cast("int").alias("s") if isinstance(s, int) else
                                      s.cast("int").alias("s"), F.lit(r).alias("r")) for s, r in both])

        # Slashed dates are permuted within sets that are dates in the same readings as before.
        sd, sm, sy, day_first = _slashed(m)
        years = (sy - 1800, 400)
        leap = F.array_position(_leap_years(), sy) - 1
        slash = (F.when(sd <= 12, pairs((F.when(day_first, sd).otherwise(sm) - 1, 12),
                                        (F.when(day_first, sm).otherwise(sd) - 1, 12), years))
                 .when(sd <= 28, pairs((sd - 13, 16), (sm - 1, 12), years))
                 .when(sd == 31, pairs((F.array_position(F.array(*map(F.lit, LONG_MONTHS)), sm) - 1, 7), years))
                 .when(sm == 2, pairs((leap, 97)))
                 .otherwise(pairs((sd - 29, 2), (F.when(sm == 1, 0).otherwise(sm - 2), 11), years)))

        symbols = (F.when(kind == "ip", F.transform(numbers, lambda x: F.struct(x.alias("s"), F.lit(256).alias("r"))))
                   .when(kind == "ssn", pairs((area - F.when(area > 666, 2).otherwise(1), 898),
                                              (F.get(numbers, F.lit(1)) - 1, 99), (F.get(numbers, F.lit(2)) - 1, 9999)))
                   .when(kind == "nir", pairs(*[(_digits(m).substr(at, n).try_cast("int") - low, radix)
                                                for at, n, low, radix in NIR_PARTS]))
                   .when(kind == "date", pairs((F.floor(day / DATE_RADICES[1]), DATE_RADICES[0]),
                                               (day % DATE_RADICES[1], DATE_RADICES[1])))
                   .when(kind == "slash", slash)
                   .otherwise(as_chars))

        def shown(sr: Column) -> Column:
            def permuted(radices: Column) -> Column:
                form = F.concat_ws(":", kind, F.array_join(radices.cast("array<string>"), ","))
                return permute(F.transform(sr, lambda x: x["s"]), radices, form, key)

            return _bind(_bind(F.transform(sr, lambda x: x["r"]), permuted), rendered)

        def rendered(out: Column) -> Column:
            chars = F.transform(_chars(text), lambda c, i: F.when(
                hexed & c.rlike("[0-9a-f]"), F.lower(F.conv(F.get(out, i).cast("string"), 10, 16)))
                .when(local & i.isin(0, 3), F.char(F.get(out, i) + 50))
                .when(single & (i == 0), F.char(F.get(out, i) + 49))
                .when(c.rlike("[0-9]"), F.char(F.get(out, i) + 48)).when(c.rlike("[a-z]"), F.char(F.get(out, i) + 97))
                .when(c.rlike("[A-Z]"), F.char(F.get(out, i) + 65)).otherwise(c))
            joined = F.array_join(chars, "")
            check = F.pmod(-luhn_sum(joined, True), F.lit(10)).cast("string")
            nir = F.concat(*[F.lpad((F.get(out, F.lit(k)) + low).cast("string"), n, "0")
                             for k, (_, n, low, _) in enumerate(NIR_PARTS)])
            digits = F.when(kind == "card", F.concat(joined, check)).when(
                kind == "nir", F.concat(nir, F.lpad(_nir_key(nir).cast("string"), 2, "0"))).otherwise(
                F.concat(F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - F.length(joined)), joined))
            spread = F.array_join(F.transform(_chars(m), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(
                digits, F.length(_digits(F.substring(m, F.lit(1), i))) + 1, F.lit(1))).otherwise(c)), "")
            iban = F.concat(F.substring(m, 1, 2), F.lpad((98 - _iban_rest(F.concat(
                F.substring(m, 1, 2), F.lit("00")), joined)).cast("string"), 2, "0"), joined)
            grouped = F.array_join(F.transform(_chars(m), lambda c, i: F.when(c == " ", c).otherwise(F.substring(
                iban, F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(" "), F.lit(""))) + 1, F.lit(1)))), "")
            a, g, s = (F.get(out, F.lit(k)) for k in range(3))
            a = F.when(a >= 665, a + 2).otherwise(a + 1)
            return (F.when(kind == "ip", F.array_join(out.cast("array<string>"), "."))
                    .when(kind == "ssn", F.format_string("%03d-%02d-%04d", a, g + 1, s + 1))
                    .when(kind == "date", _written(m, F.date_add(
                        F.lit(FIRST_DAY).cast("date"), F.get(out, F.lit(0)) * DATE_RADICES[1] + F.get(out, F.lit(1)))))
                    .when(kind == "slash", _written_slashed(m, out))
                    .when(kind.isin("phone", "pairs", "card", "nir"), spread)
                    .when(kind == "iban", grouped)
                    .when(kind == "ipv6", F.when((m == F.upper(m)) & m.rlike("[A-F]"), F.upper(joined)).otherwise(joined))
                    .when(kind == "dni", F.concat(F.substring(spread, F.lit(1), F.length(m) - 1), _dni_letter(m, joined)))
                    .when(kind == "email", F.concat(joined, F.regexp_extract(m, r"(\.[^.]*)$", 1)))
                    .when(kind == "key", F.concat(F.lit("AKIA"), joined))
                    .otherwise(F.concat(F.regexp_extract(m, f"({SECRET_START})", 1), joined)))

        return _bind(symbols, shown)

    return _bind(_kind(m), lambda k: F.when(k.isNull(), m).otherwise(by_kind(k)))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_pii") -> DataFrame:
    """Replaces every found value in ``text_col`` by its pseudonym; ``count_col`` gets the number of valid finds."""
    text = F.col(text_col)
    p = unused(docs, "_p")
    own = text.contains(MARK) | text.contains(ESCAPE)
    escaped = F.when(own, F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), F.lit(MARK),
                                    F.lit(ESCAPE + MARKED))).otherwise(text)
    # One pass finds and marks; without an @ the pattern of addresses is not tried.
    marked = F.when(text.contains("@"), F.regexp_replace(escaped, f"({ANY})", f"{MARK}$1{MARK}")).otherwise(
        F.regexp_replace(escaped, f"({NO_EMAIL})", f"{MARK}$1{MARK}"))
    df = docs.withColumn(p + "k", marked)
    # Every second part is a find.
    df = df.withColumn(p + "s", F.when(F.col(p + "k").contains(MARK), F.split(p + "k", MARK, -1)))
    parts, found = F.col(p + "s"), lambda i: i % 2 == 1
    new = F.array_join(F.transform(parts, lambda x, i: F.when(found(i), pseudonym(x, key)).otherwise(x)), "")
    plain = F.replace(F.replace(new, F.lit(ESCAPE + MARKED), F.lit(MARK)), F.lit(ESCAPE * 2), F.lit(ESCAPE))
    if count_col:
        valid = F.size(F.filter(parts, lambda x, i: found(i) & _kind(x).isNotNull()))
        df = df.withColumn(p + "c", F.when(parts.isNull(), F.lit(0)).otherwise(valid).cast("long"))
    df = df.withColumn(p + "t", F.when(parts.isNull(), text).when(own, plain).otherwise(new))
    kept = [F.col(p + "t").alias(c) if c == text_col else F.col(c) for c in docs.columns if c != count_col]
    return df.select(*kept, *([F.col(p + "c").alias(count_col)] if count_col else []))
