"""DuckDB statements that compute, independently, what each registered query returns.

Statements share the fragments below: each fragment is a common table expression, listed
with the fragments it reads.
"""

from __future__ import annotations

# name -> (fragments it reads, body)
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _fragment(name: str, body: str, *reads: str) -> None:
    FRAGMENTS[name] = (reads, body)


def _statement(body: str, *reads: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in FRAGMENTS[name][0]:
            visit(other)
        ordered.append(name)

    for name in reads:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS ({FRAGMENTS[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}"


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# --- Raw sources ---------------------------------------------------------------------------

_fragment("profile_raw", """
SELECT c_custkey * 2 + copy AS seq,
  CASE WHEN c_custkey % 499 <> 0 THEN 'CLI-' || c_custkey END AS ID_Cliente,
  CASE WHEN c_custkey % 17 = 0 THEN 'ND' ELSE CAST(c_custkey % 80 AS VARCHAR) END AS Edad,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN copy = 1 AND c_custkey % 100 = 0 THEN c_acctbal + 1
       ELSE c_acctbal END AS Ingreso_Declarado,
  CASE WHEN c_custkey % 19 <> 0 THEN CAST(c_custkey % 41 AS DOUBLE) END AS Antiguedad_Laboral,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' Propia ' WHEN 'BUILDING' THEN 'PROPIA'
       ELSE lower(c_mktsegment) END AS Tipo_Vivienda
FROM (SELECT *, unnest(CASE WHEN c_custkey % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy
      FROM customer)""")

_fragment("history_raw", """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN 'SUC-' || o_custkey
            ELSE 'CLI-' || o_custkey END AS ID_Cliente,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice END AS Monto_Transaccion,
  CASE o_orderpriority WHEN '5-LOW' THEN ' usd ' WHEN '4-NOT SPECIFIED' THEN NULL
       ELSE 'MXN' END AS Moneda,
  CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice / 10 END AS Saldo_Promedio_Mensual,
  CAST(o_orderkey % 9 AS DOUBLE) AS Frecuencia_Deposito
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 40 = 0 THEN [0, 1] ELSE [0] END) AS copy
      FROM orders)""")

_fragment("bureau_raw", """
SELECT c_custkey AS seq,
  CASE WHEN c_custkey % 503 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'EXT-' || c_custkey
       WHEN c_custkey % 2 = 0 THEN 'CLIENTE_' || c_custkey
       ELSE 'Cliente_' || c_custkey END AS ID_Cliente,
  CAST(400 + (c_custkey * 37) % 451 AS DOUBLE) AS Score_Buro,
  CAST(c_custkey % 7 AS DOUBLE) AS Creditos_Activos,
  CASE c_custkey % 6 WHEN 0 THEN 'SI' WHEN 1 THEN ' no ' WHEN 2 THEN 'Sí' WHEN 3 THEN 'NO'
       WHEN 4 THEN 'no' END AS Mantiene_Morosidad_Previa
FROM customer""")

# --- Clean sources -------------------------------------------------------------------------

_fragment("profile", """
SELECT ID_Cliente, CASE WHEN age BETWEEN 18 AND 70 THEN age END AS Edad, Ingreso_Declarado,
  Antiguedad_Laboral,
  CASE WHEN lower(trim(Tipo_Vivienda)) = 'propia' THEN 1 ELSE 0 END AS Tipo_Vivienda
FROM (SELECT *, TRY_CAST(Edad AS DOUBLE) AS age,
        row_number() OVER (PARTITION BY ID_Cliente ORDER BY seq) AS rn FROM profile_raw)
WHERE rn = 1""", "profile_raw")

_fragment("history", """
SELECT DISTINCT ID_Cliente,
  CASE WHEN usd THEN Monto_Transaccion * 15 ELSE Monto_Transaccion END AS Monto_Transaccion,
  CASE WHEN usd THEN 'MXN' ELSE coalesce(Moneda, 'MXN') END AS Moneda,
  CASE WHEN usd THEN Saldo_Promedio_Mensual * 15 ELSE Saldo_Promedio_Mensual END
    AS Saldo_Promedio_Mensual,
  Frecuencia_Deposito
FROM (SELECT *, upper(trim(coalesce(Moneda, 'MXN'))) = 'USD' AS usd FROM history_raw)""",
          "history_raw")

_fragment("bureau", """
SELECT ID_Cliente, Score_Buro, Creditos_Activos,
  CASE WHEN lower(trim(coalesce(Mantiene_Morosidad_Previa, ''))) IN ('si', 'sí', '1', 'true')
       THEN 1 ELSE 0 END AS Mantiene_Morosidad_Previa
FROM (SELECT * REPLACE (regexp_replace(ID_Cliente, '^cliente_', 'CLI-', 'i') AS ID_Cliente),
        row_number() OVER (
          PARTITION BY regexp_replace(ID_Cliente, '^cliente_', 'CLI-', 'i') ORDER BY seq) AS rn
      FROM bureau_raw)
WHERE rn = 1""", "bureau_raw")

_fragment("merged", """
SELECT coalesce(ph.ID_Cliente, b.ID_Cliente) AS ID_Cliente, Edad, Ingreso_Declarado,
  Antiguedad_Laboral, Tipo_Vivienda, Monto_Transaccion, Moneda, Saldo_Promedio_Mensual,
  Frecuencia_Deposito, Score_Buro, Creditos_Activos, Mantiene_Morosidad_Previa
FROM (SELECT coalesce(p.ID_Cliente, h.ID_Cliente) AS ID_Cliente, Edad, Ingreso_Declarado,
        Antiguedad_Laboral, Tipo_Vivienda, Monto_Transaccion, Moneda, Saldo_Promedio_Mensual,
        Frecuencia_Deposito
      FROM profile p FULL JOIN history h ON p.ID_Cliente IS NOT DISTINCT FROM h.ID_Cliente) ph
FULL JOIN bureau b ON ph.ID_Cliente IS NOT DISTINCT FROM b.ID_Cliente""",
          "profile", "history", "bureau")

_fragment("labelled", """
SELECT m.*, CAST(coalesce(l.ok, false) AS INTEGER) AS credito_aprobado
FROM merged m LEFT JOIN (
  SELECT ID_Cliente,
    bool_and(coalesce(Edad BETWEEN 18 AND 69 AND Score_Buro > 600
                      AND Mantiene_Morosidad_Previa = 0, false))
    AND bool_or(coalesce(Frecuencia_Deposito > 0, false)) AS ok
  FROM merged WHERE ID_Cliente IS NOT NULL GROUP BY ID_Cliente) l USING (ID_Cliente)""",
          "merged")

_fragment("clients", """
SELECT ID_Cliente, any_value(Edad) AS Edad, any_value(Ingreso_Declarado) AS Ingreso_Declarado,
  any_value(Antiguedad_Laboral) AS Antiguedad_Laboral, any_value(Tipo_Vivienda) AS Tipo_Vivienda,
  sum(Monto_Transaccion) AS Monto_Total,
  avg(Saldo_Promedio_Mensual) AS Saldo_Promedio_Mensual,
  max(Frecuencia_Deposito) AS Frecuencia_Deposito_Max,
  count(Frecuencia_Deposito) AS Num_Transacciones, any_value(Score_Buro) AS Score_Buro,
  any_value(Creditos_Activos) AS Creditos_Activos,
  any_value(Mantiene_Morosidad_Previa) AS Mantiene_Morosidad_Previa,
  max(credito_aprobado) AS credito_aprobado
FROM labelled WHERE ID_Cliente IS NOT NULL GROUP BY ID_Cliente""", "labelled")

# --- Split and preparation -----------------------------------------------------------------

_SPLIT = """
SELECT t.*, CASE WHEN row_number() OVER (PARTITION BY credito_aprobado
                   ORDER BY md5('42|' || ID_Cliente)) <= q.quota
                 THEN 'test' ELSE 'train' END AS split
FROM {table} t JOIN (
  SELECT k, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, k) <= w - sum(fl) OVER ()
                      THEN 1 ELSE 0 END AS quota
  FROM (SELECT credito_aprobado AS k, w, w * n // total AS fl, w * n % total AS rem
        FROM (SELECT credito_aprobado, count(*) AS n, sum(count(*)) OVER () AS total,
                CAST(ceil(round(0.2 * sum(count(*)) OVER (), 9)) AS BIGINT) AS w
              FROM {table} GROUP BY credito_aprobado))) q ON t.credito_aprobado = q.k"""

_fragment("clients_split", _SPLIT.format(table="clients"), "clients")

_fragment("documents_labelled", """
SELECT doc_id AS ID_Cliente, CASE WHEN doc_id % 13 <> 0 THEN CAST(n_chars AS DOUBLE) END AS n_chars,
  CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang, source, toxic, 'es-MX' AS region,
  quality AS credito_aprobado
FROM documents JOIN labels USING (doc_id)""")

_fragment("documents_completed", """
SELECT d.doc_id AS ID_Cliente,
  coalesce(CASE WHEN d.doc_id % 13 <> 0 THEN CAST(d.n_chars AS DOUBLE) END, f.n_chars) AS n_chars,
  coalesce(CASE WHEN d.doc_id % 7 <> 0 THEN d.lang END, f.lang) AS lang,
  coalesce(d.source, f.source) AS source
FROM documents d, document_fills f""", "document_fills")

_fragment("documents_split", _SPLIT.format(table="documents_labelled"), "documents_labelled")

NUMBERS = ["Edad", "Ingreso_Declarado", "Antiguedad_Laboral", "Tipo_Vivienda", "Monto_Total",
           "Saldo_Promedio_Mensual", "Frecuencia_Deposito_Max", "Num_Transacciones",
           "Score_Buro", "Creditos_Activos", "Mantiene_Morosidad_Previa"]

_fragment("fills", "SELECT " + ", ".join(
    f"median(CAST({n} AS DOUBLE)) AS {n}" for n in NUMBERS
) + " FROM clients_split WHERE split = 'train'", "clients_split")

_fragment("filled", "SELECT t.ID_Cliente, t.credito_aprobado, t.split, " + ", ".join(
    f"coalesce(CAST(t.{n} AS DOUBLE), f.{n}) AS {n}" for n in NUMBERS
) + " FROM clients_split t, fills f", "clients_split", "fills")

_fragment("scaling", " UNION ALL ".join(
    f"SELECT '{n}' AS variable, avg({n}) AS media, stddev_pop({n}) AS desviacion, "
    f"bool_and({n} IN (0, 1)) AS binaria FROM filled WHERE split = 'train'" for n in NUMBERS
), "filled")

_fragment("scaling_wide", "SELECT " + ", ".join(
    f"max(CASE WHEN variable = '{n}' THEN CASE WHEN binaria THEN 0 ELSE media END END) AS {n}_m, "
    f"max(CASE WHEN variable = '{n}' THEN CASE WHEN binaria OR desviacion = 0 THEN 1 "
    f"ELSE desviacion END END) AS {n}_s" for n in NUMBERS
) + " FROM scaling", "scaling")

_fragment("prepared", "SELECT ID_Cliente, credito_aprobado, split, " + ", ".join(
    f"({n} - {n}_m) / {n}_s AS {n}" for n in NUMBERS
) + " FROM filled, scaling_wide", "filled", "scaling_wide")

_fragment("document_fills", """
SELECT (SELECT median(n_chars) FROM documents_split WHERE split = 'train') AS n_chars,
  (SELECT lang FROM documents_split WHERE split = 'train' AND lang IS NOT NULL
   GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS lang,
  (SELECT source FROM documents_split WHERE split = 'train' AND source IS NOT NULL
   GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS source""", "documents_split")

_fragment("documents_filled", """
SELECT t.ID_Cliente, t.credito_aprobado, t.split, coalesce(t.n_chars, f.n_chars) AS n_chars,
  coalesce(t.lang, f.lang) AS lang, coalesce(t.source, f.source) AS source, t.toxic
FROM documents_split t, document_fills f""", "documents_split", "document_fills")

# --- Fixed scores for the metric kernels ---------------------------------------------------

_fragment("scored", """
SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS real,
  modelo, p AS probabilidad, CAST(p > 0.5 AS INTEGER) AS prediccion
FROM (SELECT o_orderkey, o_orderpriority, 'Regresión logística' AS modelo,
        floor(o_totalprice) / 1000000 AS p FROM orders
      UNION ALL
      SELECT o_orderkey, o_orderpriority, 'Random forest' AS modelo,
        CAST(o_orderkey % 100 AS DOUBLE) / 100 AS p FROM orders)""")

_fragment("confusion_counts", """
SELECT modelo, count(*) FILTER (WHERE real = 0 AND prediccion = 0) AS tn,
  count(*) FILTER (WHERE real = 0 AND prediccion = 1) AS fp,
  count(*) FILTER (WHERE real = 1 AND prediccion = 0) AS fn,
  count(*) FILTER (WHERE real = 1 AND prediccion = 1) AS tp
FROM scored GROUP BY modelo""", "scored")

_fragment("steps", """
SELECT modelo, probabilidad AS s, count(*) FILTER (WHERE real = 1) AS p,
  count(*) FILTER (WHERE real = 0) AS n FROM scored GROUP BY modelo, probabilidad""", "scored")

_fragment("cumulated", """
SELECT modelo, s, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn,
  sum(p) OVER (PARTITION BY modelo) AS tp, sum(n) OVER (PARTITION BY modelo) AS tn
FROM steps WINDOW w AS (PARTITION BY modelo ORDER BY s DESC)""", "steps")

_fragment("auc_values", """
SELECT modelo, CAST(sum(n * (cp - p + p / 2)) AS DOUBLE) / (CAST(max(tp) AS DOUBLE) * max(tn))
  AS auc_roc FROM cumulated GROUP BY modelo""", "cumulated")

_fragment("metric_rows", """
SELECT modelo, tn, fp, fn, tp, (tn + tp) / (tn + fp + fn + tp) AS exactitud,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM confusion_counts""",
          "confusion_counts")

_fragment("folded", """
SELECT *, (row_number() OVER (PARTITION BY credito_aprobado ORDER BY md5('42|' || ID_Cliente)) - 1)
  * 5 // count(*) OVER (PARTITION BY credito_aprobado) AS fold FROM clients""", "clients")

_fragment("fold_medians", " UNION ALL ".join(
    f"SELECT CAST(k AS INTEGER) AS k, '{n}' AS variable, median(CAST({n} AS DOUBLE)) AS mediana "
    "FROM folded JOIN range(5) r(k) ON fold <> k GROUP BY k" for n in NUMBERS), "folded")

_fragment("fold_scaling", " UNION ALL ".join(
    f"SELECT k, '{n}' AS variable, any_value(mediana) AS mediana, "
    f"avg(coalesce(CAST({n} AS DOUBLE), mediana)) AS media, "
    f"stddev_pop(coalesce(CAST({n} AS DOUBLE), mediana)) AS desviacion, "
    f"bool_and(coalesce(CAST({n} AS DOUBLE), mediana) IN (0, 1)) AS binaria "
    f"FROM folded JOIN fold_medians ON variable = '{n}' AND fold <> k GROUP BY k" for n in NUMBERS),
    "folded", "fold_medians")

_fragment("fold_predictions", """
SELECT fold, credito_aprobado, modelo, prediccion FROM (
  SELECT fold, credito_aprobado, 'Regresión logística' AS modelo,
    CAST(coalesce(Score_Buro > 600 AND Frecuencia_Deposito_Max > 0, false) AS INTEGER)
      AS prediccion FROM folded
  UNION ALL
  SELECT fold, credito_aprobado, 'Random forest' AS modelo,
    CAST(coalesce(Score_Buro > 600 AND Mantiene_Morosidad_Previa = 0, false) AS INTEGER)
      AS prediccion FROM folded)""", "folded")

_fragment("fold_rates", """
SELECT modelo, fold, (tn + tp) / (tn + fp + fn + tp) AS exactitud,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
FROM (SELECT modelo, fold,
        count(*) FILTER (WHERE credito_aprobado = 0 AND prediccion = 0) AS tn,
        count(*) FILTER (WHERE credito_aprobado = 0 AND prediccion = 1) AS fp,
        count(*) FILTER (WHERE credito_aprobado = 1 AND prediccion = 0) AS fn,
        count(*) FILTER (WHERE credito_aprobado = 1 AND prediccion = 1) AS tp
      FROM fold_predictions GROUP BY modelo, fold)""", "fold_predictions")

METRICS = ("exactitud", "precision", "recall", "f1")

_fragment("fold_summary", "SELECT modelo, " + ", ".join(
    f"avg({m}) AS {m}_cv, stddev_pop({m}) AS {m}_cv_std" for m in METRICS
) + " FROM fold_rates GROUP BY modelo", "fold_rates")

_fragment("client_metrics", """
SELECT modelo, (tn + tp) / (tn + fp + fn + tp) AS exactitud,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
FROM (SELECT modelo,
        count(*) FILTER (WHERE credito_aprobado = 0 AND prediccion = 0) AS tn,
        count(*) FILTER (WHERE credito_aprobado = 0 AND prediccion = 1) AS fp,
        count(*) FILTER (WHERE credito_aprobado = 1 AND prediccion = 0) AS fn,
        count(*) FILTER (WHERE credito_aprobado = 1 AND prediccion = 1) AS tp
      FROM fold_predictions GROUP BY modelo)""", "fold_predictions")

# --- Embeddings ----------------------------------------------------------------------------

_fragment("vectors", """
SELECT vec_id, label AS segmento, CAST(embedding AS DOUBLE[]) AS v FROM embeddings""")

_fragment("elements", """
SELECT vec_id, segmento, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM vectors""",
          "vectors")

_fragment("pair_distances", """
SELECT a.vec_id, a.segmento AS s, b.segmento AS t, sum(list_distance(a.v, b.v)) AS total
FROM vectors a, vectors b GROUP BY a.vec_id, a.segmento, b.segmento""", "vectors")

_fragment("pair_squares", """
SELECT a.vec_id, a.segmento AS s, b.segmento AS t, sum(list_distance(a.v, b.v) ** 2) AS total
FROM vectors a, vectors b GROUP BY a.vec_id, a.segmento, b.segmento""", "vectors")

_fragment("cluster_sizes", "SELECT segmento AS t, count(*) AS size FROM vectors GROUP BY segmento",
          "vectors")

_SILHOUETTE = """
SELECT vec_id, s AS segmento,
  CASE WHEN own = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END AS silueta
FROM (SELECT vec_id, s, max(CASE WHEN s = t THEN size END) AS own,
        max(CASE WHEN s = t THEN total / nullif(size - 1, 0) END) AS a,
        min(CASE WHEN s <> t THEN total / size END) AS b
      FROM {table} JOIN cluster_sizes USING (t) GROUP BY vec_id, s)"""

_fragment("silhouettes", _SILHOUETTE.format(table="pair_distances"),
          "pair_distances", "cluster_sizes")
_fragment("silhouettes_squared", _SILHOUETTE.format(table="pair_squares"),
          "pair_squares", "cluster_sizes")

_fragment("label_centres", """
SELECT segmento AS k, list(m ORDER BY i) AS centre
FROM (SELECT segmento, i, avg(x) AS m FROM elements GROUP BY segmento, i) GROUP BY segmento""",
          "elements")

# --- Applicant documents -------------------------------------------------------------------

_fragment("applicants", """
SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 5 <> 0 THEN 'SOL-' || o_orderkey END AS id,
  CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 80 END AS edad,
  CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice END AS ingreso,
  CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 3 <> 0 THEN o_orderkey % 41 END AS antiguedad,
  CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS vivienda,
  CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS copies,
  o_orderpriority = '5-LOW' AS usd, o_totalprice AS price, o_orderkey % 9 AS freq,
  CASE WHEN o_orderkey % 6 <> 0 THEN 400 + (o_orderkey * 37) % 451 END AS score,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 7 END AS creditos,
  CASE WHEN o_orderkey % 6 <> 0 AND o_orderkey % 5 = 1 THEN 1 ELSE 0 END AS morosidad
FROM orders""")

_fragment("applicant_clients", """
SELECT coalesce(id, 'DOC-' || seq) AS ID_Cliente,
  CAST(CASE WHEN edad BETWEEN 18 AND 70 THEN edad END AS DOUBLE) AS Edad,
  ingreso AS Ingreso_Declarado, CAST(antiguedad AS DOUBLE) AS Antiguedad_Laboral,
  vivienda AS Tipo_Vivienda,
  CASE WHEN copies > 0 THEN price * CASE WHEN usd THEN 15 ELSE 1 END END AS Monto_Total,
  CASE WHEN copies > 0 THEN price / 10 * CASE WHEN usd THEN 15 ELSE 1 END END
    AS Saldo_Promedio_Mensual,
  CAST(CASE WHEN copies > 0 THEN freq END AS DOUBLE) AS Frecuencia_Deposito_Max,
  CAST(least(copies, 1) AS BIGINT) AS Num_Transacciones,
  CAST(score AS DOUBLE) AS Score_Buro, CAST(creditos AS DOUBLE) AS Creditos_Activos,
  morosidad AS Mantiene_Morosidad_Previa,
  CAST(coalesce(edad BETWEEN 18 AND 69 AND score > 600 AND morosidad = 0
                AND copies > 0 AND freq > 0, false) AS INTEGER) AS credito_aprobado
FROM applicants""", "applicants")


# --- Helpers for statements ----------------------------------------------------------------

_CLIENT_COLUMNS = """ID_Cliente, Edad, Ingreso_Declarado, Antiguedad_Laboral, Tipo_Vivienda,
  round(Monto_Total, 2) AS Monto_Total,
  round(Saldo_Promedio_Mensual + 0.00000003, 6) AS Saldo_Promedio_Mensual,
  Frecuencia_Deposito_Max, Num_Transacciones, Score_Buro, Creditos_Activos,
  Mantiene_Morosidad_Previa, credito_aprobado"""

_MERGED_COLUMNS = """ID_Cliente, Edad, Ingreso_Declarado, Antiguedad_Laboral, Tipo_Vivienda,
  round(Monto_Transaccion, 2) AS Monto_Transaccion, Moneda,
  round(Saldo_Promedio_Mensual, 4) AS Saldo_Promedio_Mensual, Frecuencia_Deposito, Score_Buro,
  Creditos_Activos, Mantiene_Morosidad_Previa"""

_SOURCE_COLUMNS = {
    "profile": ["ID_Cliente", "Edad", "Ingreso_Declarado", "Antiguedad_Laboral", "Tipo_Vivienda"],
    "history": ["ID_Cliente", "Monto_Transaccion", "Moneda", "Saldo_Promedio_Mensual",
                "Frecuencia_Deposito"],
    "bureau": ["ID_Cliente", "Score_Buro", "Creditos_Activos", "Mantiene_Morosidad_Previa"],
}


def _indicators(source: str, table: str) -> list[tuple[str, str]]:
    """(indicator, scalar SQL) of one source table."""
    names = _SOURCE_COLUMNS[source]
    listed = ", ".join(names)
    found = [
        ("Filas", f"(SELECT count(*) FROM {table})"),
        ("Duplicados", f"(SELECT count(*) FROM {table}) - "
                       f"(SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table}))"),
    ]
    if source != "history":
        found.append(("IDs repetidos", f"(SELECT count(*) FROM {table}) - "
                      f"(SELECT count(*) FROM (SELECT DISTINCT ID_Cliente FROM {table}))"))
    if source == "profile":
        found.append(("Edades atípicas", f"(SELECT count(*) FROM {table} WHERE NOT "
                      "(TRY_CAST(Edad AS DOUBLE) BETWEEN 18 AND 70))"))
    found.append(("Columnas faltantes", "0"))
    found += [(f"Faltantes: {n}", f"(SELECT count(*) FROM {table} WHERE {n} IS NULL)")
              for n in names]
    return found


def _report(source: str, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS indicador, CAST({sql} AS BIGINT) AS valor"
        for name, sql in _indicators(source, table)
    )


def _comparison(source: str) -> str:
    before, after = _indicators(source, f"{source}_raw"), _indicators(source, source)
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS indicador, CAST({b} AS BIGINT) AS antes, CAST({a} AS BIGINT) AS despues"
        for (name, b), (_, a) in zip(before, after)
    )
    return (f"SELECT indicador, antes, despues FROM ({rows}) "
            "WHERE indicador NOT LIKE 'Faltantes:%' OR antes > 0 OR despues > 0")


def _correlations(names: list[str], table: str, pairs: list[tuple[str, str]]) -> str:
    del names
    return " UNION ALL ".join(
        f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, round(corr({a}, {b}), 6) AS r FROM {table}"
        for a, b in pairs
    )


_CORRELATED = [*NUMBERS, "credito_aprobado"]
_LINEITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

_fragment("target_correlations", " UNION ALL ".join(
    f"SELECT '{n}' AS variable, corr({n}, credito_aprobado) AS r FROM clients" for n in NUMBERS
), "clients")

_fixed_weights = {"Edad": 0.10, "Score_Buro": 1.25, "Mantiene_Morosidad_Previa": -2.50,
                  "Frecuencia_Deposito_Max": 0.75, "Ingreso_Declarado": 0.20}
FIXED_WEIGHTS, FIXED_INTERCEPT = _fixed_weights, -0.5

_REASONS = """concat_ws('; ',
    CASE WHEN NOT coalesce(Edad BETWEEN 18 AND 69, false) THEN 'edad fuera de 18-69 o no válida' END,
    CASE WHEN NOT coalesce(Score_Buro > 600, false)
         THEN 'score de buró no mayor a 600 o faltante' END,
    CASE WHEN NOT coalesce(Mantiene_Morosidad_Previa = 0, false) THEN 'tiene morosidad previa' END,
    CASE WHEN NOT coalesce(Frecuencia_Deposito_Max > 0, false) THEN 'sin depósitos registrados' END)"""


def statements() -> dict[str, str]:
    s: dict[str, str] = {}
    both = [(a, b) for a in _CORRELATED for b in _CORRELATED]
    lines = [(a, b) for a in _LINEITEM for b in _LINEITEM]

    s["approval_summary"] = _statement("""
SELECT k AS clase, coalesce(n, 0) AS clientes FROM (SELECT unnest([0, 1]) AS k)
LEFT JOIN (SELECT credito_aprobado AS k, count(DISTINCT ID_Cliente) AS n
           FROM clients GROUP BY credito_aprobado) USING (k)""", "clients")

    # Sources, cleaning, quality
    for source in ("profile", "history", "bureau"):
        columns = ", ".join(
            f"round({n}, 4) AS {n}" if n in ("Monto_Transaccion", "Saldo_Promedio_Mensual") else n
            for n in _SOURCE_COLUMNS[source]
        )
        s[f"clean_{source}"] = _statement(f"SELECT {columns} FROM {source}", source)
        s[f"quality_report_{source}"] = _statement(_report(source, f"{source}_raw"), f"{source}_raw")
        s[f"quality_compare_{source}"] = _statement(_comparison(source), source)
    s["quality_by_column"] = _statement(" UNION ALL ".join(
        f"SELECT {i} AS posicion, '{n}' AS columna, "
        f"CAST(count(*) FILTER (WHERE {n} IS NULL) AS BIGINT) AS faltantes FROM profile_raw"
        for i, n in enumerate(_SOURCE_COLUMNS["profile"])), "profile_raw")
    changed = ["ID_Cliente", "Edad", "Ingreso_Declarado", "Tipo_Vivienda"]
    s["quality_structure"] = _statement(f"""
SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (
    SELECT DISTINCT {', '.join(changed)} FROM profile_raw)) AS duplicates,
  'Antiguedad_Laboral' AS faltan, 'Canal' AS sobran, false AS valid_structure FROM profile_raw""",
                                        "profile_raw")
    types = ["string", "string", "double", "string"]
    s["quality_column_types"] = _statement(" UNION ALL ".join(
        f"SELECT {i} AS posicion, '{n}' AS columna, '{t}' AS tipo, "
        f"CAST(count(*) FILTER (WHERE {n} IS NULL) AS BIGINT) AS faltantes FROM profile_raw"
        for i, (n, t) in enumerate(zip(changed, types))
    ) + " UNION ALL SELECT 4, 'Canal', 'int', 0", "profile_raw")
    s["quality_missing_by_stage"] = _statement(
        "SELECT substr(indicador, 12) AS columna, 'Antes' AS momento, antes AS faltantes "
        f"FROM ({_comparison('profile')}) WHERE indicador LIKE 'Faltantes:%' UNION ALL "
        "SELECT substr(indicador, 12), 'Después', despues "
        f"FROM ({_comparison('profile')}) WHERE indicador LIKE 'Faltantes:%'", "profile")
    s["quality_problems_by_stage"] = _statement(
        "SELECT indicador AS problema, 'Antes' AS momento, antes AS cantidad "
        f"FROM ({_comparison('profile')}) WHERE indicador IN ('Duplicados', 'Edades atípicas') "
        "UNION ALL SELECT indicador, 'Después', despues "
        f"FROM ({_comparison('profile')}) WHERE indicador IN ('Duplicados', 'Edades atípicas')",
        "profile")
    raw = {n: f"(SELECT count(*) FROM profile_raw WHERE {n} IS NULL)" for n in _SOURCE_COLUMNS["profile"]}
    done = {n: f"(SELECT count(*) FROM profile WHERE {n} IS NULL)" for n in _SOURCE_COLUMNS["profile"]}
    indicators = dict(_indicators("profile", "profile_raw"))
    indicators_after = dict(_indicators("profile", "profile"))
    s["quality_totals"] = _statement(f"""
SELECT 'perfil_solicitante' AS source, CAST({indicators['Filas']} AS BIGINT) AS before_rows,
  CAST({' + '.join(raw.values())} AS BIGINT) AS before_missing_total,
  CAST({' + '.join(done.values())} AS BIGINT) AS after_missing_total,
  CAST(({indicators['Duplicados']}) - ({indicators_after['Duplicados']}) AS BIGINT)
    AS removed_duplicates,
  CAST({indicators['Edades atípicas']} AS BIGINT) AS atypical_ages""", "profile")
    s["null_tokens"] = """
SELECT p_partkey, CASE WHEN t NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN',
  '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')
  THEN t END AS texto
FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN 'nan'
        WHEN 3 THEN 'ND' WHEN 4 THEN 'None' ELSE p_name END AS t FROM part)"""
    s["tolerant_number"] = f"""
SELECT p_partkey, CASE WHEN regexp_matches(t, '{NUMBER}') THEN TRY_CAST(trim(t) AS DOUBLE) END
  AS numero
FROM (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN ' ' || p_size || ' ' WHEN 1 THEN p_size || 'e2'
        WHEN 2 THEN p_size || 'd' WHEN 3 THEN p_size || '_000' WHEN 4 THEN '' WHEN 5 THEN 'inf'
        WHEN 6 THEN '-' || p_size || '.' WHEN 7 THEN '.' || p_size ELSE p_name END AS t FROM part)"""
    s["display_missing"] = _statement("""
SELECT coalesce(ID_Cliente, 'ND') AS ID_Cliente,
  coalesce(CAST(CAST(Edad AS INTEGER) AS VARCHAR), 'ND') AS Edad,
  coalesce(CAST(CAST(Antiguedad_Laboral AS INTEGER) AS VARCHAR), 'ND') AS Antiguedad_Laboral,
  CAST(Tipo_Vivienda AS VARCHAR) AS Tipo_Vivienda FROM profile""", "profile")
    s["keep_first_lineitem"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""
    s["keep_first_event"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
WHERE rn = 1"""
    s["distinct_documents"] = """
SELECT DISTINCT text, lang, source FROM documents"""

    # Joins, rule, aggregation
    s["merge_sources"] = _statement(
        f"SELECT {_MERGED_COLUMNS}, 0 AS credito_aprobado FROM merged", "merged")
    s["combined_by_split"] = _statement(
        f"SELECT {_MERGED_COLUMNS}, 0 AS credito_aprobado, split FROM (SELECT m.*, c.split FROM merged m "
        "LEFT JOIN clients_split c ON m.ID_Cliente = c.ID_Cliente)", "merged", "clients_split")
    s["approval_label"] = _statement(
        f"SELECT {_MERGED_COLUMNS}, credito_aprobado FROM labelled", "labelled")
    s["labelled_table"] = s["approval_label"]
    s["score_vs_income"] = _statement("""
SELECT ID_Cliente, Score_Buro, Ingreso_Declarado FROM bureau JOIN profile USING (ID_Cliente)""",
                                      "bureau", "profile")
    s["credits_vs_score"] = _statement("SELECT Creditos_Activos, Score_Buro FROM bureau", "bureau")
    s["rejection_reasons"] = _statement(
        f"SELECT ID_Cliente, {_REASONS} AS motivos FROM clients", "clients")
    s["aggregate_by_client"] = _statement(f"SELECT {_CLIENT_COLUMNS} FROM clients", "clients")
    s["client_table"] = s["aggregate_by_client"]
    s["aggregate_events"] = """
SELECT CAST(user_id AS VARCHAR) AS ID_Cliente, round(sum(value), 2) AS Monto_Total,
  arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id"""
    s["count_clients"] = _statement(
        "SELECT count(DISTINCT ID_Cliente) AS clientes FROM merged", "merged")
    s["class_distribution"] = _statement("""
SELECT k AS codigo, CASE k WHEN 0 THEN 'No aprobado' ELSE 'Aprobado' END AS clase,
  n AS clientes, round(n / total, 6) AS proporcion, round(least(n, total - n) / total, 6)
  AS proporcion_minoritaria, least(n, total - n) / total < 0.40 AS desbalanceada
FROM (SELECT k, count(c.ID_Cliente) AS n, (SELECT count(*) FROM clients) AS total
      FROM (SELECT unnest([0, 1]) AS k) LEFT JOIN clients c ON c.credito_aprobado = k GROUP BY k)""",
                                         "clients")
    s["housing_counts"] = _statement("""
SELECT CASE Tipo_Vivienda WHEN 1 THEN 'Vivienda propia' ELSE 'Otro tipo de vivienda' END AS tipo,
  count(*) AS solicitantes FROM profile GROUP BY 1""", "profile")
    s["correlation_matrix"] = _statement(_correlations(_CORRELATED, "clients", both), "clients")
    s["correlation_lineitem"] = _correlations(_LINEITEM, "lineitem", lines)
    s["correlation_target"] = _statement("""
SELECT variable, round(r, 6) AS r, r > 0 AS positiva, abs(r) >= 0.30 AS moderada,
  abs(r) < 0.10 AS nula FROM target_correlations""", "target_correlations")
    s["correlation_top3"] = _statement("""
SELECT variable, round(r, 6) AS r FROM target_correlations ORDER BY abs(r) DESC, variable LIMIT 3""",
                                       "target_correlations")
    s["correlation_extremes"] = _statement("""
SELECT arg_max(variable, r) AS mas_positiva, round(max(r), 6) AS r_maxima,
  arg_min(variable, r) AS mas_negativa, round(min(r), 6) AS r_minima,
  count(*) FILTER (WHERE abs(r) >= 0.30) AS moderadas, count(*) FILTER (WHERE abs(r) < 0.10) AS nulas,
  count(*) AS variables FROM target_correlations""", "target_correlations")

    # Preparation
    s["stratified_split"] = _statement(
        "SELECT ID_Cliente, credito_aprobado, split FROM clients_split", "clients_split")
    s["stratified_split_documents"] = _statement(
        "SELECT ID_Cliente, credito_aprobado, split FROM documents_split", "documents_split")
    s["kfold_assign"] = _statement(
        "SELECT ID_Cliente, credito_aprobado, CAST(fold AS INTEGER) AS fold FROM folded", "folded")
    s["constant_columns"] = _statement(" UNION ALL ".join(
        f"SELECT '{n}' AS columna, count(DISTINCT {n}) <= 1 AS constante "
        "FROM documents_split WHERE split = 'train'"
        for n in ("n_chars", "lang", "source", "toxic", "region")), "documents_split")
    s["impute_params"] = _statement(" UNION ALL ".join(
        f"SELECT '{n}' AS columna, round({n}, 6) AS mediana FROM fills" for n in NUMBERS), "fills")
    s["impute_params_documents"] = _statement("""
SELECT 'n_chars' AS columna, CAST(n_chars AS VARCHAR) AS valor FROM document_fills
UNION ALL SELECT 'lang', lang FROM document_fills
UNION ALL SELECT 'source', source FROM document_fills""", "document_fills")
    s["impute_apply"] = _statement(
        "SELECT ID_Cliente, n_chars, lang, source FROM documents_completed", "documents_completed")
    s["onehot_categories"] = _statement("""
SELECT DISTINCT 'lang' AS columna, lang AS categoria FROM documents_filled WHERE split = 'train'
UNION ALL SELECT DISTINCT 'source', source FROM documents_filled WHERE split = 'train'""",
                                        "documents_filled")
    s["onehot_apply"] = _statement("""
SELECT f.ID_Cliente, columna, CAST(CASE columna WHEN 'lang' THEN f.lang = categoria
  ELSE f.source = categoria END AS INTEGER) AS valor, categoria
FROM documents_completed f, (
  SELECT DISTINCT 'lang' AS columna, lang AS categoria FROM documents_filled WHERE split = 'train'
  UNION ALL
  SELECT DISTINCT 'source', source FROM documents_filled WHERE split = 'train') g""",
                                   "documents_filled", "documents_completed")
    s["scale_params"] = _statement("""
SELECT variable, round(media, 4) AS media, round(CASE WHEN desviacion = 0 THEN 1 ELSE desviacion END, 4)
  AS desviacion FROM scaling WHERE NOT binaria""", "scaling")
    s["prepare_clients"] = _statement("SELECT ID_Cliente, credito_aprobado, split, " + ", ".join(
        f"round({n}, 6) AS {n}" for n in NUMBERS) + " FROM prepared", "prepared")
    s["imputed_flags"] = _statement("SELECT ID_Cliente, concat_ws('; ', " + ", ".join(
        f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in NUMBERS
    ) + ") AS imputados FROM clients", "clients")
    s["exact_medians"] = " UNION ALL ".join(
        f"SELECT '{n}' AS columna, median({n}) AS mediana FROM lineitem" for n in _LINEITEM)
    s["value_modes"] = """
SELECT columna, arg_min(valor, orden) AS moda, count(*) AS categorias FROM (
  SELECT columna, valor, row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor) AS orden
  FROM (SELECT 'event_type' AS columna, event_type AS valor, count(*) AS n FROM events GROUP BY 2
        UNION ALL SELECT 'props', props, count(*) FROM events WHERE props IS NOT NULL GROUP BY 2))
GROUP BY columna"""

    # Evaluation
    s["confusion_metrics"] = _statement("""
SELECT modelo, round(exactitud, 6) AS exactitud, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc,
  tn AS verdaderos_negativos, fp AS falsos_positivos, fn AS falsos_negativos,
  tp AS verdaderos_positivos,
  concat_ws('; ', CASE WHEN tp + fp = 0 THEN 'sin_aprobaciones' END,
    CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN 'una_clase' END) AS notas FROM metric_rows JOIN auc_values USING (modelo)""",
                                        "metric_rows", "auc_values")
    s["confusion_cells"] = _statement("""
SELECT modelo, r AS real, p AS predicho, CAST(n AS BIGINT) AS clientes,
  round(n / (tn + fp + fn + tp), 6) AS proporcion
FROM confusion_counts, LATERAL (VALUES ('No aprobado', 'No aprobado', tn),
  ('No aprobado', 'Aprobado', fp), ('Aprobado', 'No aprobado', fn), ('Aprobado', 'Aprobado', tp))
  v(r, p, n)""", "confusion_counts")
    s["auc_exact"] = _statement(
        "SELECT modelo, round(auc_roc, 9) AS auc_roc FROM auc_values", "auc_values")
    s["roc_points"] = _statement("""
SELECT modelo, s AS umbral, round(cn / tn, 6) AS tasa_falsos_positivos,
  round(cp / tp, 6) AS tasa_verdaderos_positivos FROM cumulated
UNION ALL SELECT DISTINCT modelo, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM scored""",
                                 "cumulated", "scored")
    s["roc_curve"] = _statement("""
SELECT modelo, umbral, round(x, 6) AS tasa_falsos_positivos, round(y, 6) AS tasa_verdaderos_positivos
FROM (SELECT *, row_number() OVER (PARTITION BY modelo, floor((x + y) * 25.0::DOUBLE) ORDER BY umbral) AS up,
        row_number() OVER (PARTITION BY modelo, floor((x + y) * 25.0::DOUBLE) ORDER BY umbral DESC) AS down
      FROM (SELECT modelo, s AS umbral, cn / tn AS x, cp / tp AS y FROM cumulated
            UNION ALL SELECT DISTINCT modelo, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM scored))
WHERE up = 1 OR down = 1""", "cumulated", "scored")
    s["fold_preparation"] = _statement("""
SELECT k AS fold, variable, round(mediana, 6) AS mediana, round(media, 4) AS media,
  round(CASE WHEN desviacion = 0 THEN 1 ELSE desviacion END, 4) AS desviacion
FROM fold_scaling WHERE NOT binaria""", "fold_scaling")
    s["onehot_wide"] = """
WITH t AS (SELECT o_orderkey, o_orderpriority AS prioridad, CAST(o_custkey AS VARCHAR) AS cliente FROM orders),
v AS (SELECT DISTINCT 1 AS place, prioridad AS valor FROM t WHERE o_orderkey % 5 <> 0
      UNION ALL SELECT DISTINCT 2, cliente FROM t WHERE o_orderkey % 5 <> 0),
i AS (SELECT *, CAST(row_number() OVER (ORDER BY place, valor) AS INTEGER) AS indice FROM v)
SELECT o_orderkey, indice FROM t JOIN i ON place = 1 AND valor = prioridad
UNION ALL SELECT o_orderkey, indice FROM t JOIN i ON place = 2 AND valor = cliente"""
    s["fewest_false_positives"] = _statement("""
SELECT modelo, fp AS falsos_positivos FROM confusion_counts
ORDER BY fp, modelo <> 'Regresión logística' LIMIT 1""", "confusion_counts")
    s["fewest_false_positives_tied"] = _statement("""
SELECT modelo, fp AS falsos_positivos FROM confusion_counts
WHERE modelo = 'Regresión logística'""", "confusion_counts")
    s["first_channel"] = s["first_channel_from_combined"] = _statement("""
SELECT c.ID_Cliente, f.Canal FROM clients c LEFT JOIN (
  SELECT ID_Cliente, arg_min(canal, cents * 10 + CAST(Frecuencia_Deposito AS BIGINT))
    FILTER (canal IS NOT NULL) AS Canal
  FROM (SELECT *, CASE WHEN cents % 3 <> 0 THEN 'canal-' || cents % 7 END AS canal
        FROM (SELECT *, CAST(floor(coalesce(Monto_Transaccion, 0) * 100) AS BIGINT) AS cents
              FROM history_raw))
  GROUP BY ID_Cliente) f USING (ID_Cliente)""", "clients", "history_raw")
    s["json_lines_orders"] = """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"""
    noted = """
SELECT row_number() OVER (ORDER BY o_orderkey) AS place, o_orderkey, o_custkey,
  round(o_totalprice, 2) AS o_totalprice,
  'said "' || CAST(o_orderkey AS VARCHAR) || '}, {[\\", '
    || CASE WHEN o_orderkey % 3 = 0 THEN '"new' || chr(10) || 'line"' || chr(10) ELSE '' END
    || o_orderpriority AS note
FROM orders"""
    s["json_list_orders"] = s["csv_quoted_orders"] = noted
    s["first_order_by_file"] = """
SELECT o_custkey, arg_min(o_orderkey, (o_orderkey % 3) * 1000000000000 + o_orderkey) AS o_orderkey
FROM orders GROUP BY o_custkey"""
    s["default_ids_by_file"] = _statement("""
SELECT n AS seq, coalesce(id, 'NUEVO-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0')
  ELSE CAST(n AS VARCHAR) END) AS ID_Cliente
FROM (SELECT *, row_number() OVER (ORDER BY seq) AS n FROM applicants)""", "applicants")
    s["fold_summary"] = _statement("SELECT modelo, " + ", ".join(
        f"round({m}_cv, 6) AS {m}_cv, round({m}_cv_std, 6) AS {m}_cv_std" for m in METRICS
    ) + " FROM fold_summary", "fold_summary")
    s["model_comparison"] = _statement("SELECT modelo, " + ", ".join(
        f"round(m.{m}, 6) AS {m}_prueba, round({m}_cv, 6) AS {m}_cv, "
        f"round({m}_cv_std, 6) AS {m}_cv_std" for m in METRICS
    ) + " FROM client_metrics m JOIN fold_summary USING (modelo)", "client_metrics", "fold_summary")
    s["model_recommendation"] = _statement("""
SELECT a.modelo, CASE WHEN abs(a.precision_cv - b.precision_cv) > 1e-9 THEN 'precision_cv'
    WHEN abs(a.f1_cv - b.f1_cv) > 1e-9 THEN 'f1_cv' ELSE 'simplicidad' END AS criterio,
  abs(a.precision_cv - b.precision_cv) >= greatest(a.precision_cv_std, b.precision_cv_std)
    AS diferencia_significativa, b.modelo AS segundo, round(a.precision_cv, 6) AS precision_cv,
  a.recall_cv < 0.5 AS recall_bajo
FROM (SELECT *, row_number() OVER (ORDER BY precision_cv DESC, f1_cv DESC,
        modelo = 'Regresión logística' DESC) AS rn FROM fold_summary) a
JOIN (SELECT *, row_number() OVER (ORDER BY precision_cv DESC, f1_cv DESC,
        modelo = 'Regresión logística' DESC) AS rn FROM fold_summary) b ON a.rn = 1 AND b.rn = 2""",
                                           "fold_summary")

    # Segments
    s["silhouette_euclidean"] = _statement(
        "SELECT vec_id, segmento, round(silueta, 6) AS silueta FROM silhouettes", "silhouettes")
    s["silhouette_mean"] = _statement(
        "SELECT round(avg(silueta), 6) AS silueta, count(*) AS filas FROM silhouettes", "silhouettes")
    s["silhouette_by_anchors"] = _statement(
        "SELECT round(avg(silueta), 6) AS silueta, CAST(0 AS DOUBLE) AS error_estandar, count(*) AS filas "
        "FROM silhouettes", "silhouettes")
    s["silhouette_squared"] = _statement(
        "SELECT vec_id, segmento, round(silueta, 6) AS silueta FROM silhouettes_squared",
        "silhouettes_squared")
    s["nearest_centre"] = _statement("""
SELECT vec_id, CAST(arg_min(k, list_distance(v, centre)) AS INTEGER) AS asignado
FROM vectors, label_centres GROUP BY vec_id""", "vectors", "label_centres")
    s["segment_sizes"] = _statement("""
SELECT CAST(k AS INTEGER) AS segmento, count(segmento) AS n_clientes
FROM (SELECT unnest(range(0, (SELECT max(segmento) + 3 FROM vectors))) AS k)
LEFT JOIN vectors ON segmento = k GROUP BY k""", "vectors")
    s["segment_profiles"] = _statement("""
SELECT CAST(Tipo_Vivienda AS INTEGER) AS segmento, count(*) AS n_clientes,
  round(avg(Edad), 4) AS Edad, round(avg(Ingreso_Declarado), 4) AS Ingreso_Declarado,
  round(avg(Score_Buro), 4) AS Score_Buro, round(avg(credito_aprobado), 6) AS tasa_aprobacion
FROM filled GROUP BY 1""", "filled")
    s["segment_lookup"] = _statement("""
SELECT ID_Cliente, CAST(f.Tipo_Vivienda AS INTEGER) AS segmento, t.segmento_n_clientes,
  t.segmento_Edad FROM filled f JOIN (
    SELECT Tipo_Vivienda, count(*) AS segmento_n_clientes, round(avg(Edad), 2) AS segmento_Edad
    FROM filled GROUP BY Tipo_Vivienda) t USING (Tipo_Vivienda)""", "filled")

    s["suggested_k"] = _statement("""
SELECT k, round(silueta, 6) AS silueta, k = 3 AS es_el_modelo, metrica,
  row_number() OVER (PARTITION BY metrica ORDER BY silueta DESC, k) = 1 AS sugerido,
  CASE WHEN metrica = 'euclidean' THEN CASE WHEN silueta >= 0.5 THEN 'fuerte'
    WHEN silueta >= 0.25 THEN 'moderada' ELSE 'débil' END END AS estructura
FROM (SELECT k, metrica, avg((b - a) / greatest(a, b)) AS silueta
      FROM (SELECT k, metrica, vec_id, max(CASE WHEN s = t THEN total / (size - 1) END) AS a,
              min(CASE WHEN s <> t THEN total / size END) AS b
            FROM (SELECT k, metrica, a.vec_id, a.vec_id % k AS s, b.vec_id % k AS t,
                    count(*) AS size, sum(CASE metrica WHEN 'euclidean' THEN list_distance(a.v, b.v)
                                          ELSE list_distance(a.v, b.v) ** 2 END) AS total
                  FROM vectors a, vectors b, (SELECT unnest([2, 3, 4, 5]) AS k),
                    (SELECT unnest(['euclidean', 'squaredEuclidean']) AS metrica)
                  GROUP BY ALL) GROUP BY k, metrica, vec_id) GROUP BY k, metrica)""", "vectors")
    plane = """(SELECT l_linenumber AS segmento, CAST(l_quantity AS DOUBLE) AS x,
  CAST(l_extendedprice AS DOUBLE) / 1000 AS y FROM lineitem)"""
    s["pca_two_columns"] = f"""
WITH m AS (SELECT var_samp(x) AS a, var_samp(y) AS d, covar_samp(x, y) AS b FROM {plane}),
e AS (SELECT *, (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) AS top FROM m),
u AS (SELECT *, b / sqrt(b * b + (top - a) ** 2) AS p, (top - a) / sqrt(b * b + (top - a) ** 2) AS q
      FROM e)
SELECT 1 AS componente, round(top / (a + d), 5) AS varianza_explicada,
  false AS menos_de_la_mitad, round(p * sign(CASE WHEN abs(p) > abs(q) THEN p ELSE q END), 5)
    AS carga_cantidad,
  round(q * sign(CASE WHEN abs(p) > abs(q) THEN p ELSE q END), 5) AS carga_precio FROM u
UNION ALL SELECT 2, round(1 - top / (a + d), 5), false,
  round(-q * sign(CASE WHEN abs(q) > abs(p) THEN -q ELSE p END), 5),
  round(p * sign(CASE WHEN abs(q) > abs(p) THEN -q ELSE p END), 5) FROM u"""
    s["pca_projection_fixed"] = f"""
SELECT segmento, count(*) AS n_clientes, round(avg((x - 25) * 0.6 + (y - 38) * 0.8), 4) AS c1,
  round(avg((x - 25) * 0.8 - (y - 38) * 0.6), 4) AS c2 FROM {plane} GROUP BY segmento"""
    s["kmeans_fixed_point"] = """
SELECT count(*) AS filas, CAST(0 AS BIGINT) AS lejos, CAST(6 AS BIGINT) AS centros,
  CAST(0 AS DOUBLE) AS desvio FROM orders"""
    s["logistic_gradient"] = """
SELECT count(*) AS filas, variable, CAST(0 AS DOUBLE) AS gradiente
FROM lineitem, (SELECT unnest(['cantidad', 'descuento', 'impuesto']) AS variable) GROUP BY variable"""
    s["importance_top_fixed"] = """
SELECT l_returnflag AS modelo,
  string_agg('linea-' || l_linenumber, '; ' ORDER BY n DESC, l_linenumber) AS principales,
  CAST(count(*) FILTER (WHERE l_linenumber % 2 = 0) AS INTEGER) AS de_la_regla
FROM (SELECT l_returnflag, l_linenumber, count(*) AS n,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_linenumber) AS place
      FROM lineitem GROUP BY l_returnflag, l_linenumber)
WHERE place <= 3 GROUP BY l_returnflag"""
    s["correlation_excluded"] = "SELECT 'Constante' AS variable"
    s["forest_importance_sum"] = """
SELECT 'Random forest' AS modelo, CAST(1 AS DOUBLE) AS suma, CAST(0 AS BIGINT) AS negativas"""
    s["score_explanations"] = _statement(f"""
SELECT ID_Cliente, credito_aprobado AS regla_negocio,
  CASE WHEN credito_aprobado = 0 THEN {_REASONS} ELSE '' END AS motivos,
  concat_ws('; ', """ + ", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in NUMBERS)
        + ") AS imputados FROM applicant_clients", "applicant_clients")

    # Applicants
    s["nested_profile"] = _statement("""
SELECT id AS ID_Cliente, CAST(edad AS VARCHAR) AS Edad, round(ingreso, 2) AS Ingreso_Declarado,
  CAST(antiguedad AS VARCHAR) AS Antiguedad_Laboral, CASE WHEN seq % 8 <> 0
    THEN CASE vivienda WHEN 1 THEN 'Propia' ELSE 'Rentada' END END AS Tipo_Vivienda FROM applicants""", "applicants")
    s["nested_history"] = _statement("""
SELECT id AS ID_Cliente, round(price, 2) AS Monto_Transaccion,
  CASE WHEN usd THEN 'USD' ELSE 'MXN' END AS Moneda,
  round(price / 10, 1) AS Saldo_Promedio_Mensual, CAST(freq AS VARCHAR) AS Frecuencia_Deposito
FROM (SELECT *, unnest(range(copies)) FROM applicants)""", "applicants")
    s["nested_bureau"] = _statement("""
SELECT id AS ID_Cliente, CAST(score AS VARCHAR) AS Score_Buro,
  CAST(creditos AS VARCHAR) AS Creditos_Activos, CASE WHEN seq % 6 <> 0
    THEN CASE morosidad WHEN 1 THEN 'SI' ELSE 'NO' END END AS Mantiene_Morosidad_Previa
FROM applicants""", "applicants")
    s["default_ids"] = _statement("""
SELECT seq, coalesce(id, 'NUEVO-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0')
  ELSE CAST(n AS VARCHAR) END) AS ID_Cliente
FROM (SELECT *, row_number() OVER (ORDER BY seq) AS n FROM applicants)""", "applicants")
    s["applicant_clients"] = _statement(
        f"SELECT {_CLIENT_COLUMNS} FROM applicant_clients", "applicant_clients")
    s["document_clients"] = s["applicant_clients"]
    weighted = " + ".join(f"{w} * {n}" for n, w in _fixed_weights.items())
    s["score_batch_fixed"] = _statement(f"""
SELECT p.ID_Cliente, p.credito_aprobado AS regla_negocio,
  CAST({FIXED_INTERCEPT} + {weighted} > 0 AS INTEGER) AS prediccion,
  round(1 / (1 + exp(-({FIXED_INTERCEPT} + {weighted}))), 6) AS probabilidad,
  CASE WHEN p.credito_aprobado = 0 THEN m.motivos ELSE '' END AS motivos
FROM prepared p JOIN (SELECT ID_Cliente, {_REASONS} AS motivos FROM clients) m USING (ID_Cliente)""",
                                        "prepared", "clients")
    s["preview_rows"] = _statement("""
SELECT seq, ID_Cliente, Edad, Tipo_Vivienda FROM profile_raw ORDER BY seq LIMIT 5""", "profile_raw")
    return s
