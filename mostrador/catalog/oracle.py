"""The same results in SQL over the same tables, for comparison by another engine."""

from __future__ import annotations

from mostrador import schema as S
from mostrador.catalog.tables import CHANNEL_CYCLE, CUSTOMER_PREFIX

_CHANNEL = "CASE l_orderkey % 6 " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(CHANNEL_CYCLE)
) + " END"

_VENTAS = f"""
ventas0 AS (
  SELECT o_orderdate AS fecha, {_CHANNEL} AS canal, l_partkey AS sku, p_name AS producto,
    CASE WHEN (l_orderkey*7+l_linenumber) % 97 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS unidades,
    CASE WHEN (l_orderkey+l_linenumber) % 10 = 0 THEN NULL ELSE l_discount END AS porcentaje_descuento,
    CASE WHEN (l_orderkey*3+l_linenumber) % 101 = 0 THEN NULL
         WHEN l_orderkey % 500 = 1 THEN l_extendedprice * 50 ELSE l_extendedprice END AS monto_aplicado,
    l_orderkey AS boleta,
    CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_suppkey END AS local,
    concat('{CUSTOMER_PREFIX}', lpad(CAST(o_custkey AS VARCHAR), 12, '0')) AS codigo_cliente,
    concat(CAST(o_custkey AS VARCHAR), '-K') AS run_cliente,
    concat('NOMBRE ', CAST(o_custkey AS VARCHAR)) AS nombres,
    concat('APELLIDO ', CAST(o_custkey AS VARCHAR)) AS apellidos,
    CASE WHEN o_custkey % 20 = 0 THEN NULL
         ELSE CAST(DATE '1880-01-01' + CAST((o_custkey*37) % 44000 AS INT) AS DATE) END AS fecha_nacimiento,
    CASE WHEN o_custkey % 5 = 4 THEN NULL ELSE o_custkey % 5 END AS genero,
    l_orderkey*7+l_linenumber AS plant
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
),
ventas1 AS (
  SELECT *, CAST(year(fecha) - year(fecha_nacimiento)
      - CASE WHEN month(fecha)*100+day(fecha) < month(fecha_nacimiento)*100+day(fecha_nacimiento)
             THEN 1 ELSE 0 END AS DOUBLE) AS anos
  FROM ventas0
),
ventas AS (
  SELECT * EXCLUDE (anos), anos, CASE WHEN anos BETWEEN 0 AND 110 THEN anos END AS edad,
    monto_aplicado / nullif(unidades, 0) AS monto_por_unidad
  FROM ventas1
)"""

_STATS = """round(coalesce(sum({m}), 0), 2) AS suma, count({m}) AS conteo,
  round(coalesce(sum({m}) / nullif(count({m}), 0), 0), 4) AS promedio,
  round(coalesce(min({m}), 0), 2) AS minimo, round(coalesce(max({m}), 0), 2) AS maximo,
  round(coalesce(quantile_cont({m}, 0.5), 0), 4) AS mediana,
  round(coalesce(stddev_samp({m}), 0), 4) AS desviacion_estandar"""


def _with(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([_VENTAS.strip(), *[m.strip() for m in more]]) + "\n" + body.strip()


def _where(condition: str, show: str) -> str:
    return _with(f"SELECT boleta, sku, {show}, monto_aplicado FROM ventas WHERE {condition}")


def _summary(condition: str = "TRUE") -> str:
    return _with(f"SELECT {_STATS.format(m='monto_aplicado')} FROM ventas WHERE {condition}")


# The raw text of the extract, and what a reader should make of it.
_TEXTO = """
texto AS (
  SELECT replace(CAST(fecha AS VARCHAR), ' ', 'T') AS fecha, canal,
    CAST(sku AS VARCHAR) || CASE WHEN plant % 11 = 0 THEN '.0' ELSE '' END AS sku,
    coalesce(producto, '') || CASE WHEN plant % 29 = 0 THEN '; oferta' ELSE '' END AS producto,
    CASE WHEN plant % 1019 = 0 THEN 'tres' ELSE CAST(unidades AS VARCHAR) END AS unidades,
    CASE WHEN porcentaje_descuento IS NOT NULL THEN CAST(CAST(porcentaje_descuento AS DECIMAL(9,2)) AS VARCHAR)
         WHEN plant % 3 = 1 THEN 'NA' WHEN plant % 3 = 2 THEN 'null' END AS porcentaje_descuento,
    CASE WHEN plant % 1009 = 0 THEN 'inf' WHEN plant % 1013 = 0 THEN '-Infinity'
         ELSE CAST(CAST(monto_aplicado AS DECIMAL(18,2)) AS VARCHAR) END AS monto_aplicado,
    CAST(boleta AS VARCHAR) AS boleta, CAST(local AS VARCHAR) AS local,
    codigo_cliente, run_cliente, nombres, apellidos,
    CASE WHEN fecha_nacimiento IS NULL THEN NULL
         WHEN plant % 13 = 0 THEN CAST(fecha_nacimiento AS VARCHAR) || ' 05:30:00'
         WHEN plant % 17 = 0 THEN 'sin fecha'
         WHEN plant % 19 = 0 THEN concat_ws('-', year(fecha_nacimiento), month(fecha_nacimiento), day(fecha_nacimiento))
         ELSE CAST(fecha_nacimiento AS VARCHAR) END AS fecha_nacimiento,
    CASE WHEN plant % 43 <> 0 THEN CAST(genero AS VARCHAR) END AS genero, CAST(genero AS VARCHAR) AS genero_escrito,
    plant
  FROM ventas
),
buenas AS (SELECT * FROM texto WHERE plant % 31 <> 0 AND plant % 37 <> 0 AND plant % 41 <> 0)"""

# Typed again: the good lines of the extract, with the values a strict reader keeps.
_TIPADAS = """
tipadas AS (
  SELECT fecha, canal, sku, producto || CASE WHEN plant % 29 = 0 THEN '; oferta' ELSE '' END AS producto,
    CASE WHEN plant % 1019 <> 0 THEN unidades END AS unidades, porcentaje_descuento,
    CASE WHEN plant % 1009 = 0 THEN CAST('inf' AS DOUBLE) WHEN plant % 1013 = 0 THEN CAST('-inf' AS DOUBLE)
         ELSE CAST(CAST(monto_aplicado AS DECIMAL(18,2)) AS DOUBLE) END AS monto_aplicado,
    boleta, local, codigo_cliente, run_cliente, nombres, apellidos,
    CASE WHEN plant % 13 <> 0 AND plant % 17 <> 0 THEN fecha_nacimiento END AS fecha_nacimiento,
    CASE WHEN plant % 43 <> 0 THEN genero END AS genero, plant
  FROM ventas WHERE plant % 31 <> 0 AND plant % 37 <> 0 AND plant % 41 <> 0
)"""

_FRECUENCIA = """
frecuencia AS (SELECT codigo_cliente, count(DISTINCT boleta) AS frecuencia_compra
               FROM ventas WHERE codigo_cliente IS NOT NULL GROUP BY codigo_cliente)"""

_PARAMS = """
params AS (
  SELECT quantile_cont(porcentaje_descuento, 0.5) AS med,
    quantile_cont(monto_aplicado, 0.25) AS m1, quantile_cont(monto_aplicado, 0.75) AS m3,
    quantile_cont(CAST(unidades AS DOUBLE), 0.25) AS u1, quantile_cont(CAST(unidades AS DOUBLE), 0.75) AS u3
  FROM ventas
),
limpias AS (
  SELECT ventas.* EXCLUDE (porcentaje_descuento),
    coalesce(porcentaje_descuento, med) AS porcentaje_descuento,
    coalesce(monto_aplicado < m1 - 1.5*(m3-m1) OR monto_aplicado > m3 + 1.5*(m3-m1), FALSE) AS monto_aplicado_es_outlier,
    coalesce(unidades < u1 - 1.5*(u3-u1) OR unidades > u3 + 1.5*(u3-u1), FALSE) AS unidades_es_outlier
  FROM ventas, params
)"""


def _features(fitted_on: str) -> str:
    return _with(
        """
        SELECT boleta, sku, monto_por_unidad, edad, frecuencia_compra,
          round((monto_aplicado - am) / sm, 6) AS monto_aplicado_std,
          round((unidades - au) / su, 6) AS unidades_std,
          round((porcentaje_descuento - ad) / sd, 6) AS porcentaje_descuento_std
        FROM limpias LEFT JOIN frecuencia USING (codigo_cliente), escala
        """,
        _PARAMS,
        _FRECUENCIA,
        f"""escala AS (SELECT avg(monto_aplicado) AS am, stddev_samp(monto_aplicado) AS sm,
              avg(unidades) AS au, stddev_samp(unidades) AS su,
              avg(porcentaje_descuento) AS ad, stddev_samp(porcentaje_descuento) AS sd FROM {fitted_on})""",
    )


_FACT_SELECT = """
  fecha, canal, sku, producto, unidades, {d} AS porcentaje_descuento, monto_aplicado,
  {p} AS monto_por_unidad, boleta, local, codigo_cliente, run_cliente, nombres, apellidos,
  fecha_nacimiento, genero, {e} AS edad, frecuencia_compra"""

_EDAD_TIPADA = """CASE WHEN year(fecha) - year(fecha_nacimiento)
      - CASE WHEN month(fecha)*100+day(fecha) < month(fecha_nacimiento)*100+day(fecha_nacimiento) THEN 1 ELSE 0 END
      BETWEEN 0 AND 110 THEN CAST(year(fecha) - year(fecha_nacimiento)
      - CASE WHEN month(fecha)*100+day(fecha) < month(fecha_nacimiento)*100+day(fecha_nacimiento) THEN 1 ELSE 0 END AS DOUBLE) END"""

_MANN_WHITNEY = """
valores AS (SELECT monto_aplicado AS v, count(*) FILTER (porcentaje_descuento IS NULL) AS nm,
              count(*) AS t FROM ventas WHERE monto_aplicado IS NOT NULL GROUP BY 1),
rangos AS (SELECT *, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + (t + 1) / 2.0 AS r FROM valores),
sumas AS (SELECT CAST(sum(nm) AS DOUBLE) AS n1, CAST(sum(t - nm) AS DOUBLE) AS n2, CAST(sum(nm * r) AS DOUBLE) AS r1,
            sum(CAST(t AS DOUBLE)*t*t - t) AS ties FROM rangos),
prueba AS (SELECT n1, n2, greatest(r1 - n1*(n1+1)/2, n1*n2 - (r1 - n1*(n1+1)/2)) AS u,
            n1*n2/12 * ((n1+n2+1) - ties/((n1+n2)*(n1+n2-1))) AS s2 FROM sumas),
puntaje AS (SELECT n1, n2, u, (u - n1*n2/2 - 0.5)/sqrt(s2) AS z FROM prueba)"""

# Two-sided tail of the standard normal by the power series of the error function.
_P_VALUE = """
serie AS (SELECT n, CAST(1 AS DOUBLE) AS unused FROM range(0, 120) t(n)),
valor_p AS (SELECT 1 - 2/sqrt(pi()) * sum(CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END
              * exp((2*n+1)*ln(z/sqrt(2)) - lgamma(n+1)) / (2*n+1)) AS p FROM puntaje, serie)"""

_NULLS = ("PORCENTAJE_DESCUENTO", "MONTO_APLICADO", "LOCAL", "FECHA_NACIMIENTO", "GENERO")


def _per_column(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(C=c, c=c.lower()) for c in columns)


_REQUEST_BOUNDS = f"""
pedidos AS (
  SELECT concat('s', CAST(s_suppkey AS VARCHAR)) AS request_id, s_suppkey AS k, s_suppkey % 8 AS kind FROM supplier
),
limites AS (
  SELECT request_id,
    CASE WHEN kind IN (0, 1) THEN k END AS q_local,
    CASE WHEN kind = 1 THEN 'WEB' END AS q_canal,
    CASE WHEN kind = 2 THEN CAST(k % 90 AS DOUBLE) END AS q_edad,
    CASE WHEN kind = 3 THEN concat('{CUSTOMER_PREFIX}', lpad(CAST(k AS VARCHAR), 12, '0')) END AS q_cliente,
    CASE WHEN kind = 4 THEN k END AS q_sku,
    CASE WHEN kind = 6 THEN 2 END AS q_genero,
    CASE WHEN kind = 2 THEN TIMESTAMP '1997-01-01' WHEN kind = 6 THEN TIMESTAMP '1996-03-01' END AS q_desde,
    CASE WHEN kind = 4 THEN TIMESTAMP '1999-06-30 12:00:00' WHEN kind = 6 THEN TIMESTAMP '1996-12-31' END AS q_hasta,
    kind <> 7 AS posible
  FROM pedidos
)"""

_PARSED = """
SELECT concat('s', CAST(s_suppkey AS VARCHAR)) AS request_id,
  CASE WHEN consulta IS NULL THEN 'sin_filtros' ELSE 'con_filtros' END AS status, position, consulta, valor
FROM (
  SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS t, s_suppkey % 8 AS kind FROM supplier
), LATERAL (
  SELECT position, consulta, valor FROM (VALUES
    (0, 0, 'LOCAL', t), (1, 0, 'LOCAL', t), (1, 1, 'CANAL', 'web'),
    (2, 0, 'EDAD', CAST(s_suppkey % 90 AS VARCHAR)), (2, 1, 'FECHA_DESDE', '1997-01-01'),
    (3, 0, 'ID_PERSONA', concat('{', upper('@@'), lpad(t, 12, '0'), '}')),
    (4, 0, 'CODIGO_PRODUCTO', t), (4, 1, 'FECHA_HASTA', '1999-06-30T12:00:00'),
    (5, NULL, NULL, NULL),
    (6, 0, 'GENERO', 'Femenino'), (6, 1, 'FECHA_DESDE', '1996-01-01'),
    (6, 2, 'FECHA_DESDE', '1996-03-01'), (6, 3, 'FECHA_HASTA', '1996-12-31'),
    (7, 0, 'LOCAL', t), (7, 1, 'LOCAL', CAST(s_suppkey + 1 AS VARCHAR))
  ) AS f(k, position, consulta, valor) WHERE f.k = kind
)
UNION ALL
SELECT concat('c', CAST(c_custkey AS VARCHAR)), CASE WHEN kind < 6 THEN 'error' ELSE 'con_filtros' END, position, consulta, valor
FROM (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS t, c_custkey % 13 AS kind FROM customer
), LATERAL (
  SELECT position, consulta, valor FROM (VALUES
    (0, NULL, NULL, NULL), (1, NULL, NULL, NULL), (2, NULL, NULL, NULL),
    (3, NULL, NULL, NULL), (4, NULL, NULL, NULL), (5, NULL, NULL, NULL),
    (6, 0, 'COLOR', t), (7, 0, 'GENERO', concat('x', t)), (8, 0, 'CANAL', 'TELEFONO'),
    (9, 0, 'CANAL', 'POS'), (9, 1, 'EDAD', concat(t, '.0')), (10, 0, 'FECHA_DESDE', '05/01/2026'),
    (11, 0, 'ID_PERSONA', concat('no-', t)), (12, 0, 'LOCAL', ''), (12, 1, 'CODIGO_PRODUCTO', 'abc')
  ) AS f(k, position, consulta, valor) WHERE f.k = kind
)""".replace("@@", CUSTOMER_PREFIX)


def _sql_text(template: str, *parts: str) -> str:
    """A message template as an SQL concatenation."""
    pieces = template.split("{}")
    out = []
    for i, piece in enumerate(pieces):
        if i:
            out.append(parts[i - 1])
        if piece:
            out.append("'" + piece.replace("'", "''") + "'")
    return "concat(" + ", ".join(out) + ")"


def _malformed(reason: str) -> str:
    return "'" + S.MSG_MALFORMED_REQUEST.replace("{}", reason).replace("'", "''") + "'"


def _readable(name: str) -> str:
    return "'" + S.READABLE_NAMES[name] + "'"


_EMPTY = "'" + S.MSG_EMPTY_REQUEST.replace("'", "''") + "'"
_VALIDATION = f"""
SELECT concat('c', t) AS request_id, 'VF' AS error_code, 'Validación Fallida' AS error_label,
  CASE kind
    WHEN 0 THEN {_EMPTY} WHEN 1 THEN {_EMPTY}
    WHEN 2 THEN {_malformed("'consultas' debe ser una lista")}
    WHEN 3 THEN {_malformed("cada consulta requiere los textos 'consulta' y 'valor'")}
    WHEN 4 THEN {_malformed("cada consulta requiere los textos 'consulta' y 'valor'")}
    WHEN 5 THEN {_malformed("JSON no válido")}
    WHEN 6 THEN {_sql_text(S.MSG_UNKNOWN_FILTER, "'COLOR'")}
    WHEN 7 THEN {_sql_text(S.MSG_GENDER, "concat('x', t)")}
    WHEN 8 THEN {_sql_text(S.MSG_CHANNEL, "'TELEFONO'")}
    WHEN 9 THEN {_sql_text(S.MSG_INTEGER, "concat(t, '.0')", _readable("EDAD"))}
    WHEN 10 THEN {_sql_text(S.MSG_DATE, "'05/01/2026'", _readable("FECHA_DESDE"))}
    WHEN 11 THEN {_sql_text(S.MSG_UUID, "concat('no-', t)", _readable("ID_PERSONA"))}
    ELSE {_sql_text(S.MSG_INTEGER, "''", _readable("LOCAL"))}
  END AS detail
FROM (SELECT CAST(c_custkey AS VARCHAR) AS t, c_custkey % 13 AS kind FROM customer)"""

_CLEANED = "boleta, sku, porcentaje_descuento, monto_aplicado_es_outlier, unidades_es_outlier"
_RAW_LOWER = ", ".join(c.lower() for c in S.STANDARD_COLUMNS)
_QUANTILES = """SELECT '{C}' AS "column", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.99), 4) AS q99 FROM ventas"""
_FENCES = """SELECT '{C}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3,
  round(q1 - 1.5*(q3-q1), 4) AS low, round(q3 + 1.5*(q3-q1), 4) AS high
  FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM ventas)"""
_SCALE = """SELECT '{C}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd FROM ventas"""
_OUTLIERS = """SELECT '{C}' AS "column", count(*) FILTER ({c}_es_outlier) AS outliers, count(*) AS rows,
  round(100.0 * count(*) FILTER ({c}_es_outlier) / count(*), 6) AS percent FROM limpias"""
_MONTH = "strftime(fecha, '%Y-%m')"

ORACLE: dict[str, str] = {
    "csv_scan": _with(f"SELECT {_RAW_LOWER} FROM buenas", _TEXTO),
    "input_manifest": _with(
        """SELECT CAST(sum(1 + added + octet_length(encode(concat_ws(';', fecha, coalesce(canal, ''), sku, '"' || producto || '"', unidades,
             coalesce(porcentaje_descuento, ''), coalesce(monto_aplicado, ''), boleta, coalesce(local, ''),
             coalesce(codigo_cliente, ''), coalesce(run_cliente, ''), coalesce(nombres, ''), coalesce(apellidos, ''),
             coalesce(fecha_nacimiento, ''), CASE WHEN added > 0 OR plant % 43 <> 0 THEN coalesce(genero_escrito, '') END)))) AS BIGINT) AS data_bytes
           FROM (SELECT *, CASE WHEN plant % 31 = 0 THEN 6 WHEN plant % 37 = 0 THEN 1 WHEN plant % 41 = 0 THEN 2 ELSE 0 END AS added FROM texto)""",
        _TEXTO,
    ),
    "schema_check": "SELECT missing FROM (VALUES ('GENERO'), ('LOCAL')) AS t(missing)",
    "csv_malformed_rows": _with(
        """SELECT count(*) FILTER (NOT larga) AS kept, count(*) FILTER (larga) AS skipped
           FROM (SELECT plant % 31 = 0 OR plant % 37 = 0 OR plant % 41 = 0 AS larga FROM ventas)"""
    ),
    "rename_standard": _with(
        """SELECT boleta AS "BOLETA", porcentaje_descuento AS "PORCENTAJE_DESCUENTO",
             monto_aplicado AS "MONTO_APLICADO", codigo_cliente AS "CODIGO_CLIENTE",
             run_cliente AS "RUN_CLIENTE", fecha_nacimiento AS "FECHA_NACIMIENTO" FROM buenas""",
        _TEXTO,
    ),
    "typed_cast": _with(
        """SELECT fecha, sku, unidades, porcentaje_descuento, boleta, local, genero,
             CASE WHEN isfinite(monto_aplicado) THEN monto_aplicado END AS monto_finito,
             CASE WHEN plant % 1019 = 0 THEN 'UNIDADES' ELSE '' END AS rechazo FROM tipadas""",
        _TIPADAS,
    ),
    "coerce_birth_date": _with("SELECT boleta, codigo_cliente, fecha_nacimiento FROM tipadas", _TIPADAS),
    "channel_domain": _with("SELECT DISTINCT canal FROM tipadas ORDER BY canal", _TIPADAS),
    "json_scan": _with(f"SELECT {_RAW_LOWER} FROM ventas"),
    "infinite_counts": _with(
        """SELECT 'MONTO_APLICADO' AS "column", count(*) FILTER (isinf(monto_aplicado)) AS infinite FROM tipadas
           UNION ALL SELECT 'PORCENTAJE_DESCUENTO', count(*) FILTER (isinf(porcentaje_descuento)) FROM tipadas
           UNION ALL SELECT 'UNIDADES', 0""",
        _TIPADAS,
    ),
    "type_conformance": _with(
        """SELECT 'SKU' AS "column", CAST(0 AS BIGINT) AS non_numeric
           UNION ALL SELECT 'UNIDADES', count(*) FILTER (unidades = 'tres') FROM buenas
           UNION ALL SELECT c, 0 FROM (VALUES ('PORCENTAJE_DESCUENTO'), ('MONTO_APLICADO'), ('LOCAL'), ('GENERO')) t(c)
           UNION ALL SELECT 'FECHA_NACIMIENTO', count(fecha_nacimiento) FROM buenas""",
        _TEXTO,
    ),
    "month_pruned_scan": _with(
        f"""SELECT fecha, boleta, sku, monto_aplicado, {_MONTH} AS ym FROM ventas
            WHERE fecha BETWEEN TIMESTAMP '1996-02-10' AND TIMESTAMP '1996-05-20'"""
    ),
    "ingest_projection": _with(
        "SELECT"
        + _FACT_SELECT.format(d="porcentaje_descuento", p="monto_por_unidad", e="edad")
        + " FROM limpias LEFT JOIN frecuencia USING (codigo_cliente)",
        _PARAMS,
        _FRECUENCIA,
    ),
    "month_partition": _with(
        """SELECT DISTINCT strftime(fecha, 'ventas_y%Ym%m') AS nombre,
             CAST(date_trunc('month', fecha) AS TIMESTAMP) AS inicio,
             CAST(date_trunc('month', fecha) + INTERVAL 1 MONTH AS TIMESTAMP) AS fin FROM ventas"""
    ),
    "months_present": _with(f"SELECT DISTINCT {_MONTH} AS ym FROM ventas"),
    "partitioned_write": _with(
        f"SELECT fecha, boleta, sku, canal, edad, monto_aplicado, {_MONTH} AS ym FROM ventas"
    ),
    "ingest_end_to_end": _with(
        "SELECT"
        + _FACT_SELECT.format(
            d="coalesce(porcentaje_descuento, (SELECT quantile_cont(porcentaje_descuento, 0.5) FROM cargadas))",
            p="monto_aplicado / nullif(unidades, 0)",
            e=_EDAD_TIPADA,
        )
        + " FROM cargadas LEFT JOIN compras USING (codigo_cliente)",
        _TIPADAS,
        "cargadas AS (SELECT * FROM tipadas WHERE plant % 1019 <> 0)",
        """compras AS (SELECT codigo_cliente, count(DISTINCT boleta) AS frecuencia_compra
                       FROM cargadas GROUP BY codigo_cliente)""",
    ),
    "ingest_log": _with(
        """SELECT (SELECT count(*) FROM cargadas) AS rows, largas AS skipped, largas AS kept_long,
             (SELECT count(*) FROM tipadas WHERE plant % 1019 = 0) AS rejected, (SELECT count(*) FROM tipadas WHERE plant % 1019 = 0) AS kept_misfits
           FROM (SELECT count(*) FILTER (plant % 31 = 0 OR plant % 37 = 0 OR plant % 41 = 0) AS largas FROM ventas)""",
        _TIPADAS,
        "cargadas AS (SELECT * FROM tipadas WHERE plant % 1019 <> 0)",
    ),
    "null_profile": _with(
        'SELECT * FROM ('
        + _per_column(_NULLS, """SELECT '{C}' AS "column", count(*) - count({c}) AS nulls FROM ventas""")
        + ") WHERE nulls > 0"
    ),
    "exact_quantiles": _with(_per_column(S.SCALED_COLUMNS, _QUANTILES)),
    "impute_median": _with("SELECT boleta, sku, porcentaje_descuento FROM limpias", _PARAMS),
    "mcar_mann_whitney": _with(
        "SELECT CAST(n1 AS BIGINT) AS n_missing, CAST(n2 AS BIGINT) AS n_present, u, round(z, 6) AS z FROM puntaje",
        _MANN_WHITNEY,
    ),
    "iqr_bounds": _with(_per_column(S.OUTLIER_COLUMNS, _FENCES)),
    "outliers_iqr": _with("SELECT boleta, sku, monto_aplicado, monto_aplicado_es_outlier FROM limpias", _PARAMS),
    "outliers_zscore": _with(
        """SELECT boleta, sku, monto_aplicado,
             coalesce(abs((monto_aplicado - a) / nullif(s, 0)) > 3, FALSE) AS monto_aplicado_es_outlier
           FROM ventas, (SELECT avg(monto_aplicado) AS a, stddev_samp(monto_aplicado) AS s FROM ventas)"""
    ),
    "outlier_counts": _with(_per_column(S.OUTLIER_COLUMNS, _OUTLIERS), _PARAMS),
    "clean_dataset": _with(f"SELECT {_CLEANED} FROM limpias", _PARAMS),
    "apply_cleaning": _with(f"SELECT {_CLEANED} FROM limpias", _PARAMS),
    "global_cleaning_stats": _with(
        """SELECT (SELECT count(*) FROM ventas) AS rows,
             (SELECT count(*) - count(porcentaje_descuento) FROM ventas) AS nulls_porcentaje_descuento,
             (SELECT count(*) - count(monto_aplicado) FROM ventas) AS nulls_monto_aplicado,
             (SELECT count(*) - count(unidades) FROM ventas) AS nulls_unidades,
             round(med, 4) AS median_porcentaje_descuento,
             round(m1 - 1.5*(m3-m1), 4) AS low_monto_aplicado, round(m3 + 1.5*(m3-m1), 4) AS high_monto_aplicado,
             round(u1 - 1.5*(u3-u1), 4) AS low_unidades, round(u3 + 1.5*(u3-u1), 4) AS high_unidades
           FROM params""",
        _PARAMS,
    ),
    "cleaning_report": _with(
        """SELECT 'rows_before' AS metric, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS VARCHAR) AS value FROM ventas
           UNION ALL SELECT 'rows_after', NULL, CAST(count(*) AS VARCHAR) FROM ventas
           UNION ALL SELECT 'missing_before', c, CAST(n AS VARCHAR) FROM ("""
        + _per_column(_NULLS, "SELECT '{C}' AS c, count(*) - count({c}) AS n FROM ventas")
        + f""") WHERE n > 0
           UNION ALL SELECT 'missing_treatment', 'PORCENTAJE_DESCUENTO', printf('{S.TREATMENT_MEDIAN}', med) FROM params
           UNION ALL SELECT 'missing_treatment', 'FECHA_NACIMIENTO', '{S.TREATMENT_NONE}'
           UNION ALL SELECT 'outliers_detected', 'MONTO_APLICADO', CAST(count(*) FILTER (monto_aplicado_es_outlier) AS VARCHAR) FROM limpias
           UNION ALL SELECT 'outliers_detected', 'UNIDADES', CAST(count(*) FILTER (unidades_es_outlier) AS VARCHAR) FROM limpias
           UNION ALL SELECT 'outliers_treatment', c, '{S.TREATMENT_FLAGGED}' FROM (VALUES ('MONTO_APLICADO'), ('UNIDADES')) t(c)
           UNION ALL SELECT 'mcar_test_pvalue', 'PORCENTAJE_DESCUENTO', printf('%.6f', p) FROM valor_p""",
        _PARAMS,
        _MANN_WHITNEY,
        _P_VALUE,
    ),
    "unit_price": _with("SELECT boleta, sku, unidades, monto_por_unidad FROM ventas"),
    "unit_price_quality": _with(
        """SELECT count(*) FILTER (unidades = 0) AS zero_units, round(avg(monto_por_unidad), 4) AS mean,
             round(quantile_cont(monto_por_unidad, 0.5), 4) AS median FROM ventas"""
    ),
    "age_at_purchase": _with("SELECT boleta, fecha, fecha_nacimiento, edad FROM ventas"),
    "age_quality": _with(
        """SELECT count(*) FILTER (anos < 0 OR anos > 110) AS invalid, round(avg(edad), 6) AS mean,
             count(edad) AS valid, count(*) AS rows FROM ventas"""
    ),
    "purchase_frequency": _with("SELECT codigo_cliente, frecuencia_compra FROM frecuencia", _FRECUENCIA),
    "purchase_frequency_summary": _with(
        """SELECT count(*) AS customers, round(avg(frecuencia_compra), 6) AS mean,
             max(frecuencia_compra) AS largest FROM frecuencia""",
        _FRECUENCIA,
    ),
    "frequency_join": _with(
        """SELECT boleta, sku, codigo_cliente, frecuencia_compra
           FROM ventas LEFT JOIN frecuencia USING (codigo_cliente)""",
        _FRECUENCIA,
    ),
    "standardize": _with(
        """SELECT boleta, sku, round((monto_aplicado - am) / sm, 6) AS monto_aplicado_std,
             round((unidades - au) / su, 6) AS unidades_std,
             round((porcentaje_descuento - ad) / sd, 6) AS porcentaje_descuento_std
           FROM ventas, (SELECT avg(monto_aplicado) AS am, stddev_samp(monto_aplicado) AS sm,
             avg(unidades) AS au, stddev_samp(unidades) AS su,
             avg(porcentaje_descuento) AS ad, stddev_samp(porcentaje_descuento) AS sd FROM ventas)"""
    ),
    "scaling_parameters": _with(_per_column(S.SCALED_COLUMNS, _SCALE)),
    "engineer_features": _features("limpias"),
    "apply_features": _features("ventas"),
    "global_feature_stats": _with(
        "SELECT t.*, (SELECT count(*) FROM frecuencia) AS customers FROM ("
        + _per_column(S.SCALED_COLUMNS, _SCALE)
        + ") t",
        _FRECUENCIA,
    ),
    "filter_gender": _where("genero = 2", "genero"),
    "filter_age": _where("edad = 31", "edad"),
    "filter_channel": _where("canal = 'WEB'", "canal"),
    "filter_product": _where("sku = 28", "canal"),
    "filter_customer": _where(f"codigo_cliente = '{CUSTOMER_PREFIX}000000000042'", "codigo_cliente"),
    "filter_store": _where("local = 7", "local"),
    "filter_date_from": _where("fecha >= TIMESTAMP '1999-11-15'", "fecha"),
    "filter_date_to": _where("fecha <= TIMESTAMP '1996-02-29'", "fecha"),
    "filter_combined": _where(
        "genero = 3 AND canal = 'APP' AND fecha >= TIMESTAMP '1996-01-01' AND fecha <= TIMESTAMP '1998-12-31'", "fecha"
    ),
    "filter_contradiction": _where("local = 7 AND local = 8", "local"),
    "summary_all": _summary(),
    "summary_filtered": _summary("genero = 2 AND edad = 31 AND canal = 'POS'"),
    "summary_single_row": _summary(f"codigo_cliente = '{CUSTOMER_PREFIX}000000000020' AND sku = 28"),
    "summary_empty": _summary("local = 555555"),
    "summary_processed_frame": _summary("canal = 'WEB' AND genero = 1"),
    "row_counts": _with("SELECT count(*) AS rows_before, count(*) AS rows_after FROM ventas"),
    "request_parse": _PARSED,
    "request_validation": _VALIDATION,
    "batch_summary": _with(
        f"""SELECT request_id, {_STATS.format(m='monto_aplicado')}
            FROM limites LEFT JOIN ventas ON posible
              AND (q_local IS NULL OR local = q_local) AND (q_canal IS NULL OR canal = q_canal)
              AND (q_edad IS NULL OR edad = q_edad) AND (q_cliente IS NULL OR codigo_cliente = q_cliente)
              AND (q_sku IS NULL OR sku = q_sku) AND (q_genero IS NULL OR genero = q_genero)
              AND (q_desde IS NULL OR fecha >= q_desde) AND (q_hasta IS NULL OR fecha <= q_hasta)
            GROUP BY request_id""",
        _REQUEST_BOUNDS,
    ),
    "batch_summary_dates": _with(
        f"""SELECT request_id, {_STATS.format(m='monto_aplicado')}
            FROM rangos LEFT JOIN ventas ON (desde IS NULL OR fecha >= desde) AND (hasta IS NULL OR fecha <= hasta)
            GROUP BY request_id""",
        """rangos AS (
            SELECT 'd' || s_suppkey AS request_id, CASE WHEN s_suppkey % 10 <> 2 THEN inicio END AS desde,
              CASE WHEN s_suppkey % 10 <> 1 THEN inicio + to_days(CAST(s_suppkey * 53 % 900 - 20 AS INT))
                + CASE WHEN s_suppkey % 3 = 0 THEN INTERVAL '11:30:00' ELSE INTERVAL '0' DAY END END AS hasta
            FROM (SELECT s_suppkey, CAST(DATE '1995-01-01' + CAST(s_suppkey * 37 % 1700 AS INT) AS TIMESTAMP) AS inicio FROM supplier))""",
    ),
    "summary_large_offset": _with(
        """SELECT 'monto' AS "column", count(monto_aplicado) AS n, round(stddev_samp(monto_aplicado), 3) AS deviation FROM ventas
           UNION ALL SELECT 'resto', count(*), round(stddev_samp(boleta % 7), 3) FROM ventas"""
    ),
}
ORACLE["report_export"] = ORACLE["cleaning_report"]
