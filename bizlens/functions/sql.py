"""The cleaning and formatting functions as temporary SQL functions: plain SQL expressions, no Python.

``register_sql(spark)`` makes them callable in ``spark.sql``; each gives what the Column builder of the same name gives.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from bizlens.functions import cleaning as C


def _chars(text: str) -> str:
    return "'" + "".join(f"\\u{ord(ch):04x}" for ch in text) + "'"


def _among(literals: tuple[str, ...]) -> str:
    return ", ".join(f"'{x}'" for x in literals)


#: name -> (parameters, result type, expression); later ones may use earlier ones.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "py_strip": ("x STRING", "STRING", f"trim(BOTH {_chars(C.PY_WHITESPACE)} FROM x)"),
    "safe_double": ("x STRING", "DOUBLE", f"try_cast(regexp_extract(x, r'{C._NUMERIC_CAPTURE}', 1) AS DOUBLE)"),
    "title_case": ("x STRING", "STRING", r"replace(initcap(regexp_replace(x, r'(\P{L})', concat('$1', '\u0001', ' '))), '\u0001 ', '')"),
    "clean_currency": ("x STRING", "DOUBLE",
                       r"safe_double(translate(regexp_replace(x, r'(?U)[R$%\s()]', ''), ',.', '.')) "
                       rf"* CASE WHEN x RLIKE r'{C._PARENTHESISED}' THEN -1.0D ELSE 1.0D END"),
    "clean_date": ("x STRING", "DATE", "CAST(try_to_timestamp(x, 'd/M/yyyy') AS DATE)"),
    "hours_decimal": ("x STRING", "DOUBLE",
                      "coalesce(CASE WHEN size(split(x, ':')) >= 2 THEN safe_double(py_strip(get(split(x, ':'), 0))) "
                      "+ safe_double(py_strip(get(split(x, ':'), 1))) / 60.0D ELSE safe_double(py_strip(x)) END, 0.0D)"),
    "clean_phone": ("x STRING", "STRING",
                    r"CASE WHEN length(regexp_replace(x, r'(?U)\D', '')) >= 8 THEN regexp_replace(x, r'(?U)\D', '') END"),
    "clean_email": ("x STRING", "STRING", f"CASE WHEN lower(py_strip(x)) NOT IN ({_among(C.NULL_LITERALS_LOWER)}) "
                                          "THEN lower(py_strip(x)) END"),
    "name_text": ("x STRING", "STRING", r"py_strip(regexp_replace(upper(py_strip(x)), r'\.+$', ''))"),
    "clean_name": ("x STRING", "STRING", f"CASE WHEN name_text(x) IS NULL OR name_text(x) IN ({_among(C.NULL_LITERALS_UPPER)}) "
                                         f"THEN '{C.NOT_IDENTIFIED_CLIENT}' ELSE name_text(x) END"),
    "member_key": ("x STRING", "STRING", f"CASE WHEN name_text(x) IS NULL OR name_text(x) IN ({_among(C.UNKNOWN_NAMES)}) "
                                         f"THEN '{C.UNKNOWN_KEY}' ELSE md5(name_text(x)) END"),
    "format_currency": ("v DOUBLE", "STRING",
                        "CASE WHEN v IS NULL OR isnan(v) THEN 'R$ 0,00' ELSE concat(CASE WHEN v < 0 THEN 'R$ -' ELSE 'R$ ' END, "
                        "translate(format_number(abs(v), 2), ',.', '.,')) END"),
}


def register_sql(spark: SparkSession) -> list[str]:
    """Registers every function for the session; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
