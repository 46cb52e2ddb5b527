"""Report transforms: raw monthly report rows (all strings) -> typed warehouse tables.

One public function per report, plus ``TRANSFORMS`` (report id -> function) and :func:`transform` (the router).
Raw frames may carry the report headers (``Cliente``, ``E-mail`` ...) or already sanitised names; headers are
sanitised first. ``seq_cols`` name the arrival order (month, file, row) used wherever "first" or "last seen"
decides, so results never depend on task scheduling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.operators import frames as FR


class MissingColumns(ValueError):
    """A report arrived without a column its transform cannot do without."""


def _require(df: DataFrame, cols: list[str], report: str, on_missing: str) -> DataFrame | None:
    missing = [c for c in cols if c not in df.columns]
    if not missing:
        return None
    if on_missing == "empty":
        return df.sparkSession.createDataFrame([], df.schema).limit(0)
    raise MissingColumns(f"report {report} lacks {missing}; columns: {df.columns}")


# ---------------------------------------------------------------------------------------------- L1 0387 ledger
LEDGER_COLUMNS = ["data_movimento", "tipo", "id_categoria", "id_entidade", "categoria", "fornecedor_cliente", "valor",
                  "conta_bancaria", "centro_de_custos", "observacoes", "titulo"]
LEDGER_SCHEMA = ", ".join(f"{c} {({'data_movimento': 'date', 'valor': 'double'}).get(c, 'string')}" for c in LEDGER_COLUMNS)
_LEDGER_VALUE_ALIASES = ("valor", "valor_pago", "valor_previsto")
_LEDGER_TEXT = ["categoria", "fornecedor_cliente", "centro_de_custos", "conta_bancaria", "observacoes", "titulo"]


def _ledger_stream(raw: DataFrame, stream: str, keep: list[str]) -> DataFrame:
    df = C.sanitize_columns(raw)
    date_col, other = ("pagamento", "competencia") if stream == "Caixa" else ("competencia", "pagamento")
    value = next((c for c in _LEDGER_VALUE_ALIASES if c in df.columns), None)
    return df.select(
        *keep, (F.col(date_col) if date_col in df.columns else F.lit(None).cast("string")).alias("data_movimento"),
        (F.col(value) if value else F.lit(None).cast("string")).alias("valor"),
        *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in _LEDGER_TEXT
          if c != "observacoes"],
        (F.col("observacoes") if "observacoes" in df.columns else F.lit(C.NOT_INFORMED_TITLE)).alias("observacoes"),
        F.lit(stream).alias("tipo"))


def ledger(raw_cash: DataFrame | None, raw_accrual: DataFrame | None, keep: list[str] | None = None) -> DataFrame:
    """Cash and accrual streams -> one ledger: the stream's own date becomes ``data_movimento``; money parsed
    (null -> 0); text defaults; category upper, names title-cased; md5 keys of category and counterparty. Without any
    stream the ledger is empty, with its columns. ``keep`` names internal columns of the raw rows that go along."""
    keep = list(keep or [])
    streams = [_ledger_stream(r, s, keep) for r, s in ((raw_cash, "Caixa"), (raw_accrual, "Competencia")) if r is not None]
    if not streams:
        return SparkSession.active().createDataFrame([], LEDGER_SCHEMA)
    df = FR.stack(streams)
    text = {c: C.text_default(c) for c in _LEDGER_TEXT}
    text["categoria"] = C.text_default(F.upper(C.py_strip(F.coalesce(F.col("categoria"), F.lit(C.NOT_INFORMED_TITLE)))))
    for c in ("fornecedor_cliente", "centro_de_custos", "conta_bancaria", "titulo"):
        text[c] = C.text_default(C.title_case(C.text_default(c)))
    df = df.select(*keep, C.clean_date("data_movimento").alias("data_movimento"), "tipo",
                   F.coalesce(C.clean_currency("valor"), F.lit(0.0)).alias("valor"),
                   *[e.alias(c) for c, e in text.items()])
    df = df.withColumn("id_categoria", F.md5(F.upper(C.py_strip("categoria")))) \
           .withColumn("id_entidade", F.md5(F.upper(C.py_strip("fornecedor_cliente"))))
    return df.select(*LEDGER_COLUMNS, *keep)


# ---------------------------------------------------------------------------------------------- L2 0186 sales
SALES_COLUMNS = ["data", "id_comanda", "comanda", "id_profissional", "profissional", "id_cliente", "cliente",
                 "id_servico", "servico", "grupo_servico", "valor", "desconto", "qtd", "custo", "comissao", "liquido"]
_SALES_MONEY = ["valor", "desconto", "custo", "comissao", "liquido"]


def sales_lines(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Sales lines: names upper-cased for keys, service/group title-cased for display, dates and money parsed,
    integer coercion, md5 keys and the ticket key md5(number || yyyy-MM-dd)."""
    df = C.sanitize_columns(raw, {"Comissão (%)": "comissao_pct", "Comissao (%)": "comissao_pct"})
    col = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    service = "item" if "item" in df.columns else "servico"
    prof = C.default_if(F.upper(C.py_strip(col("profissional"))), C.NOT_IDENTIFIED_PROFESSIONAL, C.NULL_LITERALS_UPPER)
    client = C.clean_name(col("cliente"), C.NOT_IDENTIFIED_CLIENT, strip_dots=True)
    service_key = C.default_if(F.upper(C.py_strip(col(service))), C.UNKNOWN_SERVICE_KEY_SOURCE, C.NULL_LITERALS_UPPER)
    service_name = C.default_if(C.title_case(C.py_strip(col(service))), C.UNKNOWN_SERVICE_DISPLAY,
                                C.NULL_LITERALS_TITLE)
    group = C.default_if(C.title_case(C.py_strip(col("categoria"))), C.DEFAULT_SERVICE_GROUP, C.NULL_LITERALS_TITLE)
    day = C.clean_date(col("data"), dict(df.dtypes).get("data", "string"))
    out = df.select(
        *(keep or []),
        day.alias("data"), C.int_coerce(col("comanda")).alias("comanda"),
        prof.alias("profissional"), client.alias("cliente"), service_key.alias("_service_key"),
        service_name.alias("servico"), group.alias("grupo_servico"),
        *[F.coalesce(C.clean_currency(col(m)), F.lit(0.0)).alias(m) for m in _SALES_MONEY],
        C.int_coerce(col("qtd")).alias("qtd"))
    out = out.select(
        *(keep or []), "data", C.ticket_key("comanda", "data").alias("id_comanda"), "comanda",
        F.md5("profissional").alias("id_profissional"), "profissional", F.md5("cliente").alias("id_cliente"),
        "cliente", F.md5("_service_key").alias("id_servico"), "servico", "grupo_servico", "valor", "desconto", "qtd",
        "custo", "comissao", "liquido")
    return out


# ---------------------------------------------------------------------------------------------- L3 0002 clients
CLIENT_COLUMNS = ["id_cliente", "cliente", "email", "celular", "data_nascimento", "sexo"]
_CLIENT_HEADERS = {"Cliente": "cliente", "Celular": "celular", "E-mail": "email",
                   "Data de Nascimento": "data_nascimento", "Sexo": "sexo"}


def clients(raw: DataFrame, seq_cols: list[str]) -> DataFrame:
    """Clients: one best record per cleaned name (phone 10 + email 5 + birth date 1; ties -> latest arrival),
    md5 id of the name, plus the unknown member row."""
    df = raw.withColumnsRenamed({k: v for k, v in _CLIENT_HEADERS.items() if k in raw.columns})
    if "cliente" not in df.columns:
        raise MissingColumns(f"report 0002 lacks 'Cliente'; columns: {raw.columns}")
    df = FR.ensure_columns(df, {c: (None, "string") for c in _CLIENT_HEADERS.values()})
    df = df.select(*seq_cols, C.clean_name("cliente").alias("cliente"), C.clean_email("email").alias("email"),
                   C.clean_phone("celular").alias("celular"), F.col("data_nascimento").cast("string"),
                   F.col("sexo").cast("string"))
    filled = lambda c: (F.col(c).isNotNull() & (F.col(c) != "")).cast("int")
    score = filled("celular") * 10 + filled("email") * 5 + filled("data_nascimento")
    best = FR.best_record(df, ["cliente"], score, seq_cols)
    best = best.select(F.md5("cliente").alias("id_cliente"), "cliente", "email", "celular", "data_nascimento", "sexo")
    return FR.append_member(best, {"id_cliente": C.UNKNOWN_KEY, "cliente": C.NOT_IDENTIFIED_CLIENT,
                                   "celular": C.NOT_INFORMED_UNACCENTED, "email": C.NOT_INFORMED_UNACCENTED,
                                   "sexo": C.NOT_INFORMED_UNACCENTED})


# ---------------------------------------------------------------------------------------------- L4 0126 occupancy
def occupancy(raw: DataFrame, on_missing: str = "raise") -> DataFrame:
    """Booked hours per professional and month (``HH:MM`` -> decimal hours)."""
    df = C.sanitize_columns(raw)
    empty = _require(df, ["data_competencia", "total_agendado"], "0126", on_missing)
    if empty is not None:
        return empty.select(F.lit(None).cast("date").alias("data_competencia"),
                            F.lit(None).cast("string").alias("profissional"),
                            F.lit(None).cast("double").alias("horas_agendadas_decimal"))
    prof = F.col("profissional") if "profissional" in df.columns else F.lit(None).cast("string")
    name = C.default_if(C.title_case(C.py_strip(prof)), C.UNKNOWN_OCCUPANCY_PROFESSIONAL, C.NULL_LITERALS_TITLE)
    return df.select("data_competencia", name.alias("profissional"),
                     C.hours_decimal("total_agendado", dict(df.dtypes)["total_agendado"]).alias("horas_agendadas_decimal"))


# ---------------------------------------------------------------------------------------------- L5 0188 card fees
CARD_FEE_COLUMNS = ["data_competencia", "bandeira", "valor_faturado", "valor_liquido"]


def card_fees(raw: DataFrame) -> DataFrame:
    """Card fees: brand title-cased (null -> not identified), gross and net money parsed (null -> 0)."""
    df = C.sanitize_columns(raw)
    if "valor" in df.columns and "valor_liquido" not in df.columns:
        df = df.withColumnRenamed("valor", "valor_liquido")
    df = FR.ensure_columns(df, {c: (None, "string") for c in CARD_FEE_COLUMNS})
    brand = C.title_case(C.py_strip(F.coalesce(F.col("bandeira").cast("string"), F.lit(C.NOT_IDENTIFIED_PROFESSIONAL))))
    return df.select(C.clean_date("data_competencia", dict(df.dtypes)["data_competencia"]).alias("data_competencia"),
                     brand.alias("bandeira"),
                     F.coalesce(C.clean_currency("valor_faturado"), F.lit(0.0)).alias("valor_faturado"),
                     F.coalesce(C.clean_currency("valor_liquido"), F.lit(0.0)).alias("valor_liquido"))


# ---------------------------------------------------------------------------------------------- L6 0007 returns
def returns(raw: DataFrame) -> DataFrame:
    """Return list: keeps every column (sanitised), parses the last visit, title-cases the name, lower-cases the
    email and upper-cases sex (null literals -> null)."""
    df = C.sanitize_columns(raw)
    if "e_mail" in df.columns:
        df = df.withColumnRenamed("e_mail", "email")
    upd = {}
    if "ultima_visita" in df.columns:
        upd["ultima_visita"] = C.clean_date("ultima_visita", dict(df.dtypes)["ultima_visita"])
    if "cliente" in df.columns:
        upd["cliente"] = C.py_strip(C.title_case("cliente"))
    if "email" in df.columns:
        upd["email"] = C.clean_email("email")
    if "sexo" in df.columns:
        upd["sexo"] = C.nullif_literals(C.py_strip(F.upper("sexo")), C.NULL_LITERALS_UPPER)
    return df.withColumns(upd) if upd else df


# ---------------------------------------------------------------------------------------------- L7 0229 professionals
PROFESSIONAL_COLUMNS = ["id_profissional", "nome", "apelido", "cargo", "cpf", "especialidade", "data_cadastro"]


def latest_snapshot(df: DataFrame, period_col: str = "data_competencia") -> DataFrame:
    """Rows of the latest snapshot only (the newest period), found with a scalar subquery."""
    if period_col not in df.columns:
        return df
    latest = df.select(F.max(period_col)).scalar()
    return df.where(F.col(period_col) == latest)


def professionals(raw: DataFrame, seq_cols: list[str], on_missing: str = "raise") -> DataFrame:
    """Professionals: latest snapshot, names normalised and deduplicated (first arrival wins), CPF digits kept
    as text, lenient registration date, md5 id (blank -> UNKNOWN), unknown member first."""
    df = latest_snapshot(C.sanitize_columns(raw))
    if _require(df, ["nome"], "0229", on_missing) is not None:
        types = ", ".join(f"{c} {'date' if c == 'data_cadastro' else 'string'}" for c in PROFESSIONAL_COLUMNS)
        return df.sparkSession.createDataFrame([], types)
    df = df.withColumn("nome", C.clean_text_field("nome"))
    df = FR.keep_first(df, ["nome"], seq_cols)
    text = lambda c: C.clean_text_field(c) if c in df.columns else F.lit(C.NOT_INFORMED_TITLE)
    out = df.select(
        C.generate_id("nome").alias("id_profissional"), "nome", text("apelido").alias("apelido"),
        text("cargo").alias("cargo"),
        (C.clean_cpf("cpf") if "cpf" in df.columns else F.lit(C.NOT_INFORMED_TITLE)).alias("cpf"),
        text("especialidade").alias("especialidade"),
        (C.lenient_date("data_cadastro") if "data_cadastro" in df.columns else F.lit(None).cast("date"))
        .alias("data_cadastro"))
    return FR.append_member(out, {"id_profissional": C.UNKNOWN_KEY, "nome": C.NOT_IDENTIFIED_PROFESSIONAL,
                                  "apelido": "N/I", "cargo": C.NOT_INFORMED_UPPER, "cpf": C.NOT_INFORMED_UPPER,
                                  "especialidade": C.NOT_INFORMED_UPPER}, first=True)


# ---------------------------------------------------------------------------------------------- L0 router
TRANSFORMS = {
    "0387": ledger,
    "0186": sales_lines,
    "0002": clients,
    "0126": occupancy,
    "0188": card_fees,
    "0007": returns,
    "0229": professionals,
}


def transform(report_id: str, *args, **kwargs) -> DataFrame:
    """Route a report id to its transform; an unknown id is an error."""
    try:
        fn = TRANSFORMS[report_id]
    except KeyError:
        raise ValueError(f"no transform for report {report_id!r}") from None
    return fn(*args, **kwargs)
