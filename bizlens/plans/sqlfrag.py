"""SQL fragments (DuckDB dialect) used by the oracle side of the query registry.

They mirror the Column builders in ``functions`` so the oracle computes the same values independently of Spark.
"""

from __future__ import annotations

import datetime as dt

from bizlens.functions import dates as D


def lit_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def periods_values(start: dt.date, end: dt.date) -> str:
    rows = ", ".join(f"({i}, '{p.name}', {lit_date(p.start)}, {lit_date(p.end)})"
                     for i, p in enumerate(D.comparison_periods(start, end)))
    return f"SELECT * FROM (VALUES {rows}) AS t(ordem, periodo, inicio, fim)"


def plain(absx: str, d: int) -> str:
    return f"replace(format('{{:.{d}f}}', CAST({absx} AS DOUBLE)), '.', ',')"


def grouped(absx: str, d: int) -> str:
    return f"translate(format('{{:,.{d}f}}', CAST({absx} AS DOUBLE)), ',.', '.,')"


def currency(x: str, show_sign: bool = False) -> str:
    x = f"CAST({x} AS DOUBLE)"
    body = grouped(f"abs({x})", 2)
    plus = f"WHEN {x} > 0 THEN 'R$ +' || {body} " if show_sign else ""
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN 'R$ 0,00' WHEN {x} < 0 THEN 'R$ -' || {body} "
            f"{plus}ELSE 'R$ ' || {body} END)")


def percentage(x: str, d: int = 1, show_sign: bool = False, scale: float = 100.0) -> str:
    v = f"(CAST({x} AS DOUBLE) * {scale!r})"
    body = plain(f"abs({v})", d)
    plus = f"WHEN {v} > 0 THEN '+' || {body} || '%' " if show_sign else ""
    null_text = "0" + ("," + "0" * d if d else "") + "%"
    return (f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN '{null_text}' WHEN {v} < 0 THEN '-' || {body} || '%' "
            f"{plus}ELSE {body} || '%' END)")


def compact(x: str) -> str:
    v = f"CAST({x} AS DOUBLE)"
    a = f"abs({v})"
    unit = (f"CASE WHEN {a} >= 1e9 THEN {plain(f'({a} / 1e9)', 1)} || 'B' "
            f"WHEN {a} >= 1e6 THEN {plain(f'({a} / 1e6)', 1)} || 'M' "
            f"WHEN {a} >= 1e3 THEN {plain(f'({a} / 1e3)', 1)} || 'K' ELSE {plain(a, 0)} END")
    return (f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN '0' "
            f"ELSE (CASE WHEN {v} < 0 THEN '-' ELSE '' END) || ({unit}) END)")


def number_br(x: str, d: int = 0) -> str:
    v = f"CAST({x} AS DOUBLE)"
    body = grouped(f"abs({v})", d)
    return f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN '0' WHEN {v} < 0 THEN '-' || {body} ELSE {body} END)"


def signed_fixed(x: str, d: int = 1) -> str:
    v = f"CAST({x} AS DOUBLE)"
    return f"((CASE WHEN {v} < 0 THEN '-' ELSE '+' END) || {plain(f'abs({v})', d)})"


def delta_tag(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN 'normal' WHEN {x} < 0 THEN 'inverse' ELSE 'off' END)"


def delta_text(pop: str, yoy: str, suffix: str = "%") -> str:
    p = f"{signed_fixed(pop)} || '{suffix} (Mês)'"
    return f"(CASE WHEN {yoy} IS NULL THEN {p} ELSE {signed_fixed(yoy)} || '{suffix} (Ano) | ' || {p} END)"


def share_text(x: str) -> str:
    return f"({plain(f'CAST({x} AS DOUBLE)', 1)} || '%')"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+'), "
            f"lambda y: upper(y[1]) || lower(y[2:])), '')")


def md5_key(x: str) -> str:
    return f"md5(UPPER(TRIM({x})))"


def first_non_blank(*xs: str) -> str:
    *head, last = xs
    return "COALESCE(" + ", ".join([f"NULLIF(TRIM({x}), '')" for x in head] + [last]) + ")"


def weekday_short(monday0: str) -> str:
    names = ", ".join(f"'{n}'" for n in D.WEEKDAY_SHORT_MONDAY_FIRST)
    return f"[{names}][{monday0} + 1]"


def month_abbr(month: str) -> str:
    names = ", ".join(f"'{n}'" for n in D.MONTH_ABBR_PT)
    return f"[{names}][{month}]"


def weekday_long(day: str) -> str:
    names = ", ".join(f"'{n}'" for n in D.WEEKDAY_NAMES_SUNDAY_FIRST)
    return f"[{names}][dayofweek({day}) + 1]"


def week_ending_monday(day: str) -> str:
    return f"CAST({day} + CAST((8 - isodow({day})) % 7 AS INTEGER) AS DATE)"


def bucket(day: str, grain: str) -> str:
    if grain == "D":
        return day
    if grain == "W":
        return week_ending_monday(day)
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def bucket_step(grain: str) -> str:
    return {"D": "INTERVAL 1 DAY", "W": "INTERVAL 7 DAY", "M": "INTERVAL 1 MONTH"}[grain]


def bucket_label(b: str, grain: str) -> str:
    if grain == "M":
        return f"({month_abbr(f'month({b})')} || '/' || CAST(year({b}) AS VARCHAR))"
    return f"strftime({b}, '%d/%m')"


# ---------------------------------------------------------------------------------------------- cleaning (SQL side)
NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def safe_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{NUMERIC_RE}') THEN TRY_CAST({x} AS DOUBLE) END)"


def clean_currency(x: str) -> str:
    s = f"trim({x})"
    body = f"replace(replace(regexp_replace({s}, '[R$%\\s()]', '', 'g'), '.', ''), ',', '.')"
    v = safe_double(body)
    return f"(CASE WHEN {s} LIKE '(%' AND {s} LIKE '%)' THEN -{v} ELSE {v} END)"


def clean_date(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') "
            f"THEN CAST(try_strptime({x}, '%d/%m/%Y') AS DATE) END)")


def lenient_date(x: str) -> str:
    x = f"regexp_replace({x}, '[ T]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$', '')"
    iso = (f"(CASE WHEN regexp_matches({x}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') "
           f"THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) END)")
    return f"COALESCE({clean_date(x)}, {iso})"


def hours_decimal(x: str) -> str:
    s = f"trim({x})"
    parts = f"string_split({s}, ':')"
    h, m = safe_double(f"trim({parts}[1])"), safe_double(f"trim({parts}[2])")
    return (f"COALESCE(CASE WHEN len({parts}) >= 2 THEN {h} + {m} / 60.0 ELSE {safe_double(s)} END, 0.0)")


def clean_phone(x: str) -> str:
    d = f"regexp_replace({x}, '\\D', '', 'g')"
    return f"(CASE WHEN length({d}) >= 8 THEN {d} END)"


def clean_email(x: str) -> str:
    e = f"lower(trim({x}))"
    return f"(CASE WHEN {e} IN ('', 'nan', 'none') THEN NULL ELSE {e} END)"


def clean_name(x: str, default: str = "NAO IDENTIFICADO") -> str:
    n = f"trim(regexp_replace(upper(trim({x})), '\\.+$', ''))"
    return f"(CASE WHEN {n} IS NULL OR {n} IN ('', 'NAN', 'NONE') THEN '{default}' ELSE {n} END)"


def clean_text_field(x: str) -> str:
    return f"upper(trim(COALESCE({x}, 'NÃO INFORMADO')))"


def clean_cpf(x: str) -> str:
    c = f"regexp_replace(trim(COALESCE({x}, '')), '[.-]', '', 'g')"
    return f"(CASE WHEN {c} IN ('', 'nan', 'None') THEN 'NÃO INFORMADO' ELSE {c} END)"


def generate_id(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = '' OR {x} = 'NÃO INFORMADO' THEN 'UNKNOWN' ELSE md5({x}) END)"


def int_coerce(x: str) -> str:
    return f"COALESCE(TRY_CAST(trunc({safe_double(f'trim({x})')}) AS BIGINT), 0)"


def text_default(x: str, default: str = "Não Informado") -> str:
    t = f"trim({x})"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN '{default}' ELSE {t} END)"


def default_if(x: str, default: str, literals: tuple[str, ...]) -> str:
    lits = ", ".join(f"'{v}'" for v in literals)
    return f"(CASE WHEN {x} IS NULL OR {x} IN ({lits}) THEN '{default}' ELSE {x} END)"
