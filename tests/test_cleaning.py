"""Column cleaning builders: vectors, and property tests against plain-Python models of the rules."""

import datetime as dt
import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from bizlens.functions import cleaning as C
from conftest import col_values


def test_clean_column_name():
    names = {"Preço Médio": "preco_medio", "Início/Fim": "inicio_fim", "% Desconto (R$)": "desconto_r$",
             "a - b": "a_b", "__Já  é__": "ja_e", "Nº": "no", "Olá!": "ola!", "": ""}
    assert {x: C.clean_column_name(x) for x in names} == names


def test_clean_currency_vectors(spark):
    vals = ["R$ 2.345,60", "7,25", "(48)", "n/d", None, ""]
    assert col_values(spark, C.clean_currency, vals) == [2345.6, 7.25, -48.0, None, None, None]


def test_clean_currency_edge_vectors(spark):
    vals = ["10.5", "(-100)", "(100", "1 000,00", "1.2.3,4", "1,2,3", "5d", "-R$ 9,99", "R$ 1.234,56"]
    assert col_values(spark, C.clean_currency, vals) == [105.0, 100.0, 100.0, 1000.0, 123.4, None, None, -9.99,
                                                         1234.56]


def test_clean_date_vectors(spark):
    vals = ["01/01/2023", "30/12/2022", "inv", None, "1/2/2023", "31/02/2023", " 01/01/2023"]
    assert col_values(spark, C.clean_date, vals) == [dt.date(2023, 1, 1), dt.date(2022, 12, 30), None, None,
                                                     dt.date(2023, 2, 1), None, None]


def test_lenient_date(spark):
    day = dt.date(2021, 3, 5)
    vals = ["05/03/2021", "2021-03-05", "x", "05/03/2021 14:30", "5/3/2021 09:05:59", "2021-03-05T08:00", "05/03/2021 25:00"]
    assert col_values(spark, C.lenient_date, vals) == [day, day, None, day, day, day, None]


def test_hours_vectors(spark):
    vals = ["01:30", "00:45", "1:30", "1.5", None, "Invalid", "160:15:59", "-1:30", "1:xx", ""]
    assert col_values(spark, C.hours_decimal, vals) == [1.5, 0.75, 1.5, 1.5, 0.0, 0.0, 160.25, -0.5, 0.0, 0.0]


def test_title_case_vectors(spark):
    vals = ["D'AVILA", "pé+mão", "3ª via", "corte/escova", "MARIA DA SILVA", "abc1def"]
    assert col_values(spark, C.title_case, vals) == [v.title() for v in vals]


def test_names_phones_emails(spark):
    assert col_values(spark, C.clean_name, ["maria s.", "MARIA S .", " nan ", None, "ana"]) == [
        "MARIA S", "MARIA S", "NAO IDENTIFICADO", "NAO IDENTIFICADO", "ANA"]
    assert col_values(spark, C.clean_phone, ["11-8888-7777", "abc", None, "1234567"]) == ["1188887777", None, None,
                                                                                           None]
    assert col_values(spark, C.clean_email, [" JOAO@TEST.COM ", "nan", "", None]) == ["joao@test.com", None, None,
                                                                                      None]


def test_cpf_and_ids(spark):
    assert col_values(spark, C.clean_cpf, ["012.345.678-90", None, "nan", " 00123 "]) == [
        "01234567890", "NÃO INFORMADO", "NÃO INFORMADO", "00123"]
    assert col_values(spark, C.generate_id, ["NÃO INFORMADO", "", "ANA"]) == [
        "UNKNOWN", "UNKNOWN", hashlib.md5(b"ANA").hexdigest()]


def test_int_coerce(spark):
    assert col_values(spark, C.int_coerce, ["12", "12.9", "-3.7", "x", None]) == [12, 12, -3, 0, 0]


# ---------------------------------------------------------------------------------------------- property tests
NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")
#: What happens to a character of the number: marks and thousands separators go, the comma is the point.
MARKS = str.maketrans(",", ".", "R$%().")


def money_by_rule(text):
    if text is None:
        return None
    bare = "".join(text.split())
    number = bare.translate(MARKS)
    sign = -1 if (bare[:1], bare[-1:]) == ("(", ")") else 1
    return sign * float(number) if NUMBER.fullmatch(number) else None


money_text = st.one_of(
    st.none(),
    st.builds(lambda a, b, pre, paren: (("(" if paren else "") + pre + f"{a:,}".replace(",", ".") + "," + f"{b:02d}"
                                        + (")" if paren else "")),
              st.integers(0, 10**9), st.integers(0, 99), st.sampled_from(["", "R$ ", "R$", "-R$ ", " "]), st.booleans()),
    st.text(alphabet="0123456789.,()R$% -abc", max_size=12),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(money_text, min_size=1, max_size=40))
def test_currency_matches_python_model(spark, values):
    assert col_values(spark, C.clean_currency, values) == [money_by_rule(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abcdeABCDEéÉãÃçÇ '-+/1ª ", max_size=15), min_size=1, max_size=30))
def test_title_matches_python(spark, values):
    assert col_values(spark, C.title_case, values) == [v.title() for v in values]
