"""SQL twins of ``sources.bindings`` (portable SQL, run by DuckDB in the correctness check).

Each entry is a CTE body; ``with_ctes`` stitches the ones a query needs in front of its SELECT.
"""

from __future__ import annotations

V = """
SELECT CAST(o.o_orderdate AS DATE) AS data, l.l_orderkey AS comanda,
  CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE c.c_name END AS cliente, s.s_name AS profissional, p.p_name AS servico,
  CASE WHEN p.p_size % 10 = 0 THEN ' ' ELSE p.p_type END AS grupo_servico,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS desconto,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS comissao,
  CAST(p.p_retailprice AS DECIMAL(18,2)) AS custo, CAST(l.l_quantity AS BIGINT) AS qtd,
  l.l_linenumber, l.l_partkey, l.l_suppkey,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) - CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS liquido,
  md5(UPPER(TRIM(p.p_name))) AS id_servico
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""

P = """
SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 10 = 0 THEN concat('Cadastro ', s_name)
    WHEN s_suppkey % 4 = 1 THEN concat('  ', lower(s_name), ' ') ELSE s_name END AS nome,
  CASE WHEN s_suppkey % 5 <> 0 THEN concat(' cargo ', CAST(s_suppkey % 7 AS VARCHAR)) END AS cargo,
  CASE s_suppkey % 6 WHEN 0 THEN 'nan' WHEN 1 THEN NULL
    ELSE concat(lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), '-', lpad(CAST(s_suppkey AS VARCHAR), 2, '3')) END AS cpf,
  CASE WHEN s_suppkey % 3 <> 0 THEN concat('apelido ', CAST(s_suppkey AS VARCHAR)) END AS apelido, 'Estética ' AS especialidade,
  CASE s_suppkey % 4 WHEN 0 THEN '15/03/2021 08:30' WHEN 1 THEN '2020-02-29' WHEN 2 THEN '31/02/2021' END AS data_cadastro
FROM supplier
"""

G = """
SELECT CAST(o_orderdate AS DATE) AS data_movimento, CASE WHEN o_orderstatus = 'O' THEN 'Caixa' ELSE 'Competencia' END AS tipo,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 11 = 0 THEN 'Profissionais - Comissões'
       WHEN o_orderkey % 7 = 0 THEN concat(' ', lower(o_orderpriority)) ELSE o_orderpriority END AS categoria,
  CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderpriority IN ('2-HIGH','3-MEDIUM') THEN -1 ELSE 1 END AS valor,
  CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE concat('Lançamento ', CAST(o_orderkey AS VARCHAR)) END AS titulo,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE c_name END AS fornecedor_cliente,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('obs ', o_orderstatus) END AS observacoes, o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey
"""

S = """
SELECT * FROM (VALUES ('1-URGENT','1. Receita Bruta','Serviços',false),('2-HIGH','3. Custos Variáveis','Produtos',false),
  ('Profissionais - Comissões','3. Custos Variáveis','Comissões',false),('3-MEDIUM','4. Despesas Operacionais','Fixas',true),
  ('4-NOT SPECIFIED','5. Resultado Financeiro','Juros',false)) AS t(categoria, nivel_1, nivel_2, excluir_dre)
"""

C = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS data_competencia, l_returnflag AS bandeira,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS valor_faturado,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)))) AS valor_liquido
FROM lineitem GROUP BY 1, 2
"""

O = """
SELECT data_competencia, profissional, CASE WHEN m % 13 = 0 THEN 'Invalid'
  ELSE concat(CAST(CAST((m - m % 60) / 60 AS BIGINT) AS VARCHAR), ':', lpad(CAST(m % 60 AS VARCHAR), 2, '0')) END AS total_agendado
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS data_competencia, s_name AS profissional,
        CAST(SUM(l_quantity) AS BIGINT) AS m
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) q
"""

K = """
SELECT c_custkey AS seq,
  CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 10 < 3 THEN concat(' cliente ', CAST(c_custkey % 100 AS VARCHAR), '.') ELSE c_name END AS cliente,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('(11) 9', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) WHEN 2 THEN 'abc'
       ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '1') END AS celular,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN concat(' USER', CAST(c_custkey AS VARCHAR), '@Mail.com') ELSE 'nan' END AS email,
  CASE WHEN c_custkey % 2 = 0 THEN '01/02/1990' ELSE NULL END AS data_nascimento
FROM customer
"""

R = """
SELECT c_name AS cliente, concat(lpad(CAST(day(d) AS VARCHAR), 2, '0'), '/', lpad(CAST(month(d) AS VARCHAR), 2, '0'), '/', CAST(year(d) AS VARCHAR)) AS ultima_visita,
  CASE k % 3 WHEN 1 THEN concat(' USER', CAST(k AS VARCHAR), '@Mail.com ') WHEN 2 THEN 'nan' END AS email,
  concat('(11) ', lpad(CAST(k AS VARCHAR), 8, '3')) AS telefone,
  CASE WHEN k % 4 <> 0 THEN concat('9', lpad(CAST(k AS VARCHAR), 8, '8')) END AS celular,
  CASE k % 4 WHEN 1 THEN ' f ' WHEN 2 THEN 'nan' WHEN 3 THEN 'M' END AS sexo
FROM (SELECT c_name, MAX(CAST(o_orderdate AS DATE)) AS d, MIN(c_custkey) AS k FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name) q
"""

BINDINGS = {"v": V, "p": P, "g": G, "s": S, "c": C, "o": O, "k": K, "r": R}


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH a AS (...), b AS (...) body``; a name from BINDINGS may be given with an empty text."""
    parts = [f"{name} AS ({text or BINDINGS[name]})" for name, text in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body
