"""Raw report text derived from the input tables (test fixtures for the cleaning functions and transforms).

Each derivation is one portable SQL expression (CASE / concat / lpad / replace / CAST ... AS STRING) that Spark
and DuckDB evaluate identically, so both engines start from the same dirty strings. ``%`` picks a variant per row
(a formatting choice, not a row filter: every row of the table is kept).
"""

from __future__ import annotations

MONEY_TEXT = "replace(CAST(CAST({x} AS DECIMAL(18,2)) AS STRING), '.', ',')"
DMY = ("concat(lpad(CAST(day({d}) AS STRING), 2, '0'), '/', lpad(CAST(month({d}) AS STRING), 2, '0'), '/', "
       "CAST(year({d}) AS STRING))")
DMY_SHORT = "concat(CAST(day({d}) AS STRING), '/', CAST(month({d}) AS STRING), '/', CAST(year({d}) AS STRING))"
ISO = ("concat(CAST(year({d}) AS STRING), '-', lpad(CAST(month({d}) AS STRING), 2, '0'), '-', "
       "lpad(CAST(day({d}) AS STRING), 2, '0'))")

# lineitem -> money text (pt-BR, parentheses, percent, dotted, suffixed, junk, null)
CURRENCY_RAW = f"""CASE l_linenumber % 7
  WHEN 0 THEN concat('R$ ', {MONEY_TEXT.format(x='l_extendedprice')})
  WHEN 1 THEN concat('(', {MONEY_TEXT.format(x='l_extendedprice')}, ')')
  WHEN 2 THEN concat({MONEY_TEXT.format(x='l_discount * 100')}, '%')
  WHEN 3 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)
  WHEN 4 THEN concat('-R$ ', CAST(l_partkey AS STRING), ',', lpad(CAST(l_suppkey % 100 AS STRING), 2, '0'))
  WHEN 5 THEN concat(CAST(l_orderkey AS STRING), 'd')
  ELSE NULL END"""

# lineitem -> day-first date text (padded, unpadded, leading blank, impossible day, ISO, null)
DATE_RAW = f"""CASE l_linenumber % 6
  WHEN 0 THEN {DMY.format(d='l_shipdate')}
  WHEN 1 THEN {DMY_SHORT.format(d='l_shipdate')}
  WHEN 2 THEN concat(' ', {DMY.format(d='l_shipdate')})
  WHEN 3 THEN concat('31/02/', CAST(year(l_shipdate) AS STRING))
  WHEN 4 THEN {ISO.format(d='l_shipdate')}
  ELSE NULL END"""

# lineitem -> durations (H:MM, H:MM:SS, negative, decimal text, junk, null)
HOURS_RAW = """CASE l_linenumber % 6
  WHEN 0 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), ':', lpad(CAST(l_partkey % 60 AS STRING), 2, '0'))
  WHEN 1 THEN concat(CAST(CAST(l_quantity AS BIGINT) * 7 AS STRING), ':', lpad(CAST(l_suppkey % 60 AS STRING), 2, '0'), ':59')
  WHEN 2 THEN concat('-', CAST(l_linenumber AS STRING), ':30')
  WHEN 3 THEN CAST(CAST(l_discount * 100 AS DECIMAL(18,2)) AS STRING)
  WHEN 4 THEN concat(CAST(l_linenumber AS STRING), ':xx')
  ELSE NULL END"""

# lineitem -> integer text (integral, fractional, negative fractional, junk, null)
INT_RAW = """CASE l_linenumber % 5
  WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING)
  WHEN 1 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) + CAST(l_discount AS DECIMAL(18,2)) AS STRING)
  WHEN 2 THEN concat('-', CAST(CAST(l_tax AS DECIMAL(18,2)) + 3 AS STRING))
  WHEN 3 THEN concat('n', CAST(l_partkey AS STRING))
  ELSE NULL END"""

# part -> mixed-case names with punctuation for title casing
TITLE_RAW = """CASE p_partkey % 5
  WHEN 0 THEN upper(p_name)
  WHEN 1 THEN concat(p_name, ' d', chr(39), lower(p_type))
  WHEN 2 THEN concat(lower(p_brand), '+', p_name, '/', CAST(p_size AS STRING), 'ª via')
  WHEN 3 THEN concat('  ', p_type, '-', p_name, ' ')
  ELSE NULL END"""

# customer -> phones, emails, names, CPF-like ids
PHONE_RAW = """CASE c_custkey % 5
  WHEN 0 THEN concat('(', lpad(CAST(c_nationkey AS STRING), 2, '0'), ') 9', lpad(CAST(c_custkey AS STRING), 4, '0'), '-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))
  WHEN 1 THEN concat('+55 ', CAST(c_custkey AS STRING))
  WHEN 2 THEN 'abc'
  WHEN 3 THEN lpad(CAST(c_custkey AS STRING), 11, '1')
  ELSE NULL END"""
EMAIL_RAW = """CASE c_custkey % 5
  WHEN 0 THEN concat(' ', upper(replace(c_name, '#', '.')), '@Mail.COM ')
  WHEN 1 THEN 'nan'
  WHEN 2 THEN '  '
  WHEN 3 THEN 'None'
  ELSE NULL END"""
NAME_RAW = """CASE c_custkey % 6
  WHEN 0 THEN concat(' ', lower(c_name), '.')
  WHEN 1 THEN concat(c_name, ' ..')
  WHEN 2 THEN 'nan'
  WHEN 3 THEN '   '
  WHEN 4 THEN concat(c_mktsegment, ' S .')
  ELSE NULL END"""
CPF_RAW = """CASE c_custkey % 5
  WHEN 0 THEN concat(lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '.', lpad(CAST(c_nationkey AS STRING), 3, '0'), '.',
                     lpad(CAST(c_custkey % 977 AS STRING), 3, '0'), '-', lpad(CAST(c_custkey % 97 AS STRING), 2, '0'))
  WHEN 1 THEN concat(' 0', CAST(c_custkey AS STRING), ' ')
  WHEN 2 THEN 'nan'
  WHEN 3 THEN ''
  ELSE NULL END"""

# supplier -> professional names (null, blank, padded lower case, plain)
SUPPLIER_NAME_RAW = """CASE s_suppkey % 6
  WHEN 0 THEN NULL
  WHEN 1 THEN ''
  WHEN 2 THEN concat('  ', lower(s_name), ' ')
  ELSE s_name END"""


def money_text(x: str) -> str:
    """Decimal -> pt-BR text without grouping; negatives in parentheses for every other row."""
    return (f"CASE WHEN {x} < 0 THEN concat('(', replace(CAST(abs({x}) AS STRING), '.', ','), ')') "
            f"ELSE concat('R$ ', replace(CAST({x} AS STRING), '.', ',')) END")


def dmy(d: str) -> str:
    return DMY.format(d=d)
