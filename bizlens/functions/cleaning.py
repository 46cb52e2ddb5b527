"""Column cleaning builders (all native Spark expressions, no Python UDFs).

Each builder takes and returns a ``Column`` so it composes inside ``select``/``withColumn`` and stays
inside whole-stage codegen. Semantics follow the pandas cleaning of the monthly report extracts.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from bizlens.functions.common import col_of

# Fixed values that must equal the source behaviour (defaults written into cleaned columns).
NOT_IDENTIFIED_CLIENT = "NAO IDENTIFICADO"
NOT_IDENTIFIED_PROFESSIONAL = "NÃO IDENTIFICADO"
NOT_INFORMED_UPPER = "NÃO INFORMADO"
NOT_INFORMED_UNACCENTED = "NAO INFORMADO"
NOT_INFORMED_TITLE = "Não Informado"
UNKNOWN_KEY = "UNKNOWN"
UNKNOWN_SERVICE_KEY_SOURCE = "SERVICO DESCONHECIDO"
UNKNOWN_SERVICE_DISPLAY = "Servico Desconhecido"
DEFAULT_SERVICE_GROUP = "Geral"
UNKNOWN_OCCUPANCY_PROFESSIONAL = "Desconhecido"
NULL_LITERALS_UPPER = ("", "NAN", "NONE")
NULL_LITERALS_LOWER = ("", "nan", "none")
NULL_LITERALS_TITLE = ("", "Nan", "None")

#: Names that stand for nobody, as :func:`member_key` reads them: null literals and the defaults of all reports.
UNKNOWN_NAMES = (*NULL_LITERALS_UPPER, NOT_IDENTIFIED_CLIENT, NOT_IDENTIFIED_PROFESSIONAL, NOT_INFORMED_UPPER,
                 NOT_INFORMED_UNACCENTED, UNKNOWN_OCCUPANCY_PROFESSIONAL.upper())

# What a text-to-double cast would take beyond a plain number: suffixes, inf, nan and hexadecimal letters, and blanks and
# control characters around it. Turned into a sign that no number holds, the cast gives null.
_NO_NUMBER = "dDfFnNiIxX" + "".join(map(chr, range(0x21)))
# A plain decimal number as Python's float() reads it (no inf/nan: documented deviation); for SQL text.
_NUMERIC_CAPTURE = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)$"
# Caseless control character used as a temporary word boundary by title_case.
_TITLE_MARK = "\u0001"
# Text that is wrapped in parentheses once stripped (accounting negative); for SQL text.
_PARENTHESISED = r"(?Us)^\s*\(.*\)\s*$"
# The characters Python's str.strip() removes (str.isspace), as one trim set.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                 "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


# ---------------------------------------------------------------------------------------------- text basics
def py_strip(c) -> Column:
    """Python ``str.strip()``: removes all Unicode whitespace (plain ``trim`` removes only spaces)."""
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def safe_double(c) -> Column:
    """String -> double only when it is a plain number; anything else -> null (never raises). One pass, no regex."""
    return F.translate(col_of(c), _NO_NUMBER, "#" * len(_NO_NUMBER)).try_cast("double")


def nullif_literals(c, literals=NULL_LITERALS_LOWER) -> Column:
    c = col_of(c)
    return F.when(c.isin(*literals), F.lit(None).cast("string")).otherwise(c)


def default_if(c, default: str, literals) -> Column:
    c = col_of(c)
    return F.when(c.isNull() | c.isin(*literals), F.lit(default)).otherwise(c)


def title_case(c) -> Column:
    """Python ``str.title()``: the first letter after any non-letter is title-cased, all other letters lowered.

    ``initcap`` alone only starts words after spaces (wrong for ``D'Avila``, ``Pé+Mão``). Here every non-letter is
    followed by a caseless marker and a space, ``initcap`` runs, and the marker pairs are removed again. The
    removal is exact for any input: each inserted pair sits right after its own non-letter, so a left-to-right
    match of marker+space only ever hits inserted pairs. A text of letters and spaces only needs ``initcap`` alone. Plain
    expressions only (no lambda), so it stays in generated code.
    """
    text = col_of(c)
    marked = F.regexp_replace(text, r"(\P{L})", "$1" + _TITLE_MARK + " ")
    return F.when(text.rlike(r"[^\p{L} ]"), F.replace(F.initcap(marked), F.lit(_TITLE_MARK + " "), F.lit(""))) \
            .otherwise(F.initcap(text))


def normalized_key(c) -> Column:
    """Join/hash key of a name: ``UPPER(TRIM(x))`` (SQL trim, as the view layer)."""
    return F.upper(F.trim(col_of(c)))


def md5_key(c) -> Column:
    """Surrogate key md5(UPPER(TRIM(x))); null stays null."""
    return F.md5(normalized_key(c))


# ---------------------------------------------------------------------------------------------- B1 names
#: Characters a column name loses, and the runs that part its words.
_DROPPED = dict.fromkeys(map(ord, "().%"))
_BETWEEN_WORDS = re.compile(r"[\s/_-]+")


def clean_column_name(name: str) -> str:
    """Column header as a name: the accent-free lower-case words joined by ``_`` (driver side, over ``df.columns``)."""
    letters = filter(lambda ch: unicodedata.category(ch) != "Mn", unicodedata.normalize("NFKD", name).lower())
    words = _BETWEEN_WORDS.split("".join(letters).translate(_DROPPED))
    return "_".join(word for word in words if word)


def sanitize_columns(df, renames: dict | None = None):
    """Rename every column with :func:`clean_column_name`; ``renames`` applies first (raw header -> name).
    Internal columns (leading ``_``, such as the row position) pass through unchanged."""
    renames = renames or {}
    return df.toDF(*[c if c.startswith("_") else (renames.get(c) or clean_column_name(c)) for c in df.columns])


# ---------------------------------------------------------------------------------------------- B2 currency
def clean_currency(c) -> Column:
    """pt-BR money text -> double.

    strip; ``(x)`` marks a negative; drop ``R $ % whitespace ( )``; every ``.`` is a thousands separator
    (so ``10.5`` -> 105); ``,`` is the decimal mark; invalid -> null.

    One ``translate`` drops, swaps and guards all characters; no regex. Only texts with a parenthesis are stripped to look
    for the accounting negative.
    """
    text = col_of(c).cast("string")
    bad = "".join(ch for ch in _NO_NUMBER if ch not in PY_WHITESPACE)
    number = F.translate(text, "," + bad + ".R$%()" + PY_WHITESPACE, "." + "#" * len(bad)).try_cast("double")
    negative = text.contains("(") & py_strip(text).startswith("(") & py_strip(text).endswith(")")
    return F.when(negative, -number).otherwise(number)


# ---------------------------------------------------------------------------------------------- B3 / B19 dates
def clean_date(c, input_type: str = "string") -> Column:
    """Strict day-first ``d/M/yyyy`` parse; invalid or padded -> null; date/timestamp inputs pass through."""
    if input_type in ("date", "timestamp", "timestamp_ntz"):
        return F.to_date(col_of(c))
    return F.try_to_date(col_of(c), "d/M/yyyy")


#: A time of day behind a date.
TIME_OF_DAY = r"[ T]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"


def lenient_date(c) -> Column:
    """Day-first date with an ordered fallback list of formats (``d/M/yyyy`` then ISO); a time of day is ignored."""
    c = F.regexp_replace(col_of(c), TIME_OF_DAY, "")
    return F.coalesce(F.try_to_date(c, "d/M/yyyy"), F.try_to_date(c, "yyyy-MM-dd"))


# ---------------------------------------------------------------------------------------------- B4 hours
def hours_decimal(c, input_type: str = "string") -> Column:
    """``HH:MM[:SS]`` -> hours + minutes/60 (seconds ignored, >24h allowed); plain number -> itself; else 0. A time or
    timestamp gives its hour + minute/60, a number itself, also one that is stored as such."""
    if input_type.startswith(("timestamp", "time")):
        return F.coalesce(F.hour(col_of(c)) + F.minute(col_of(c)) / F.lit(60.0), F.lit(0.0))
    if input_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or input_type.startswith("decimal"):
        return F.coalesce(F.nanvl(col_of(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    s = py_strip(col_of(c).cast("string"))
    parts = F.split(s, ":")
    h = safe_double(py_strip(F.get(parts, 0)))
    m = safe_double(py_strip(F.get(parts, 1)))
    clock = F.when(h.isNotNull() & m.isNotNull(), h + m / F.lit(60.0))
    value = F.when(F.size(parts) >= 2, clock).otherwise(safe_double(s))
    return F.coalesce(value, F.lit(0.0))


# ---------------------------------------------------------------------------------------------- B5-B7 text ids
def clean_text_field(c) -> Column:
    return F.upper(py_strip(F.coalesce(col_of(c).cast("string"), F.lit(NOT_INFORMED_UPPER))))


def clean_cpf(c) -> Column:
    s = F.regexp_replace(py_strip(F.coalesce(col_of(c).cast("string"), F.lit(""))), r"[.-]", "")
    return default_if(s, NOT_INFORMED_UPPER, ("", "nan", "None"))


def generate_id(c) -> Column:
    """md5 of an already normalised name; blank or the not-informed default -> ``UNKNOWN``."""
    c = col_of(c)
    return F.when(c.isNull() | (c == "") | (c == NOT_INFORMED_UPPER), F.lit(UNKNOWN_KEY)).otherwise(F.md5(c))


# ---------------------------------------------------------------------------------------------- B8-B10 keys
def ticket_key(number, day) -> Column:
    """Ticket key of the sales table: md5(number || yyyy-MM-dd), null date -> 1900-01-01."""
    day_text = F.coalesce(F.to_date(col_of(day)).cast("string"), F.lit("1900-01-01"))
    return F.md5(F.concat(col_of(number).cast("string"), day_text))


def visit_key(day, number, client) -> Column:
    """Visit key of the sales view: md5(date || number || coalesce(client, '')); null parts -> null."""
    return F.md5(F.concat(col_of(day).cast("string"), col_of(number).cast("string"),
                          F.coalesce(col_of(client), F.lit(""))))


# ---------------------------------------------------------------------------------------------- member keys
def member_name(c) -> Column:
    """A name as members are told apart: stripped, upper case, without trailing dots."""
    return py_strip(F.rtrim(F.upper(py_strip(col_of(c).cast("string"))), F.lit(".")))


def is_unknown(c) -> Column:
    """True for a name that stands for nobody: null, blank, a null literal or a report's default."""
    name = member_name(c)
    return name.isNull() | name.isin(*UNKNOWN_NAMES)


def member_key(c) -> Column:
    """The one key of a member in dimensions and facts: ``UNKNOWN`` for names that stand for nobody, else the md5 of the
    name as members are told apart."""
    return F.when(is_unknown(c), F.lit(UNKNOWN_KEY)).otherwise(F.md5(member_name(c)))


# ---------------------------------------------------------------------------------------------- B11-B13 contact
def clean_phone(c) -> Column:
    digits = F.regexp_replace(col_of(c).cast("string"), r"(?U)\D", "")
    return F.when(F.length(digits) >= 8, digits)


def clean_email(c) -> Column:
    return nullif_literals(F.lower(py_strip(col_of(c).cast("string"))), NULL_LITERALS_LOWER)


def clean_name(c, default: str = NOT_IDENTIFIED_CLIENT, strip_dots: bool = True) -> Column:
    """strip -> upper -> drop trailing dots (then strip again, so keys join) -> null literals -> default."""
    s = F.upper(py_strip(col_of(c).cast("string")))
    if strip_dots:
        s = py_strip(F.rtrim(s, F.lit(".")))
    return default_if(s, default, NULL_LITERALS_UPPER)


# ---------------------------------------------------------------------------------------------- B14-B18 misc
def text_default(c, default: str = NOT_INFORMED_TITLE) -> Column:
    """null or blank-after-strip -> default."""
    s = py_strip(col_of(c).cast("string"))
    return F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(s)


def money_or_zero(c) -> Column:
    return F.coalesce(col_of(c), F.lit(0.0))


def int_coerce(c) -> Column:
    """``to_numeric(errors='coerce').fillna(0).astype(int)``: truncates toward zero. Plain digits, as many as a double holds
    exactly, are read at once."""
    text = col_of(c).cast("string")
    number = safe_double(py_strip(text)).try_cast("bigint")
    return F.when(text.rlike(r"\A[0-9]{1,15}\z"), text.try_cast("bigint")) \
            .otherwise(F.coalesce(number, F.lit(0).cast("bigint")))


def first_non_blank(*cols) -> Column:
    """``COALESCE(NULLIF(TRIM(a),''), ..., last)``: the last argument is taken as is."""
    *head, last = cols
    return F.coalesce(*[F.nullif(F.trim(col_of(c)), F.lit("")) for c in head], col_of(last))


def text_excludes(c, terms) -> Column:
    """True unless ``upper(c)`` contains one of ``terms`` (null text counts as not containing)."""
    pattern = "|".join(re.escape(t) for t in terms)
    return ~F.coalesce(F.upper(col_of(c)).rlike(pattern), F.lit(False))
