"""Names, types and vocabularies of the sales data.

Everything in this file is a fixed value: input files, stored tables and
requests are written against these names, so they must stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: delimited input -----------------------------------------
SEPARATOR = ";"
QUOTE = '"'

RAW_COLUMNS = (
    "FECHA",
    "CANAL",
    "SKU",
    "PRODUCTO",
    "UNIDADES",
    "PORCENTAJE DESCUENTO",
    "MONTO APLICADO",
    "BOLETA",
    "LOCAL",
    "CODIGO CLIENTE",
    "RUN CLIENTE",
    "NOMBRES",
    "APELLIDOS",
    "FECHA NACIMIENTO",
    "GENERO",
)
STANDARD_NAMES = {raw: raw.replace(" ", "_") for raw in RAW_COLUMNS}
STANDARD_COLUMNS = tuple(STANDARD_NAMES.values())

# Texts that a delimited file uses for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- Fixed values: column types --------------------------------------------
INTEGER_COLUMNS = ("SKU", "UNIDADES", "BOLETA", "LOCAL", "GENERO")
DECIMAL_COLUMNS = ("PORCENTAJE_DESCUENTO", "MONTO_APLICADO")
TEXT_COLUMNS = ("CANAL", "PRODUCTO", "CODIGO_CLIENTE", "RUN_CLIENTE", "NOMBRES", "APELLIDOS")
SALE_TIME = "FECHA"
BIRTH_DATE = "FECHA_NACIMIENTO"

# --- Fixed values: roles in cleaning and features --------------------------
MEASURE = "MONTO_APLICADO"
MEDIAN_IMPUTED = ("PORCENTAJE_DESCUENTO",)
NEVER_IMPUTED = ("FECHA_NACIMIENTO",)
OUTLIER_COLUMNS = ("MONTO_APLICADO", "UNIDADES")
SCALED_COLUMNS = ("MONTO_APLICADO", "UNIDADES", "PORCENTAJE_DESCUENTO")
UNIT_PRICE = "MONTO_POR_UNIDAD"
AGE = "EDAD"
FREQUENCY = "FRECUENCIA_COMPRA"
OUTLIER_SUFFIX = "_ES_OUTLIER"
SCALED_SUFFIX = "_STD"
AGE_RANGE = (0, 110)
FENCE_FACTOR = 1.5
ZSCORE_THRESHOLD = 3.0

# --- Fixed values: stored fact table ---------------------------------------
FACT_TABLE = "ventas"
FACT_SCHEMA = T.StructType(
    [
        T.StructField("fecha", T.TimestampNTZType()),
        T.StructField("canal", T.StringType()),
        T.StructField("sku", T.LongType()),
        T.StructField("producto", T.StringType()),
        T.StructField("unidades", T.LongType()),
        T.StructField("porcentaje_descuento", T.DoubleType()),
        T.StructField("monto_aplicado", T.DoubleType()),
        T.StructField("monto_por_unidad", T.DoubleType()),
        T.StructField("boleta", T.LongType()),
        T.StructField("local", T.LongType()),
        T.StructField("codigo_cliente", T.StringType()),
        T.StructField("run_cliente", T.StringType()),
        T.StructField("nombres", T.StringType()),
        T.StructField("apellidos", T.StringType()),
        T.StructField("fecha_nacimiento", T.DateType()),
        T.StructField("genero", T.LongType()),
        T.StructField("edad", T.DoubleType()),
        T.StructField("frecuencia_compra", T.LongType()),
    ]
)
FACT_COLUMNS = tuple(FACT_SCHEMA.names)

# --- Fixed values: filter vocabularies -------------------------------------
GENDER_CODES = {
    "no especificado": 0,
    "masculino": 1,
    "femenino": 2,
    "otro": 3,
}
GENDER_LABELS = ("No especificado", "Masculino", "Femenino", "Otro")
CHANNELS = ("APP", "APR", "CCT", "POS", "WEB", "WPR")
FILTER_NAMES = (
    "GENERO",
    "EDAD",
    "CANAL",
    "CODIGO_PRODUCTO",
    "ID_PERSONA",
    "LOCAL",
    "FECHA_DESDE",
    "FECHA_HASTA",
)

# Wording of the rejection messages.
READABLE_NAMES = {
    "GENERO": "el género",
    "EDAD": "la edad",
    "CANAL": "el canal de venta",
    "CODIGO_PRODUCTO": "el código de producto",
    "ID_PERSONA": "el identificador de persona (UUID)",
    "LOCAL": "el ID de tienda",
    "FECHA_DESDE": "la fecha desde",
    "FECHA_HASTA": "la fecha hasta",
}
MSG_UNKNOWN_FILTER = (
    "El filtro '{}' no es uno de los valores permitidos. Los filtros permitidos son: "
    + ", ".join(FILTER_NAMES)
    + "."
)
MSG_GENDER = (
    "El valor '{}' no es un género válido. Los valores permitidos son: "
    + ", ".join(GENDER_LABELS)
    + "."
)
MSG_CHANNEL = (
    "El valor '{}' no es un canal válido. Los valores permitidos son: "
    + ", ".join(CHANNELS)
    + "."
)
MSG_INTEGER = "El valor '{}' no es un número entero válido para {}."
MSG_DATE = "El valor '{}' no es una fecha ISO-8601 válida para {}."
MSG_UUID = "El valor '{}' no es un UUID válido para {}."
MSG_EMPTY_REQUEST = (
    "El campo 'consultas' no puede ser nulo ni una lista vacía. "
    "Omita el campo por completo (o envíe un body `{}`) para consultar sin filtros, "
    "o envíe una lista con uno o más filtros."
)
MSG_MISSING_REQUEST_ID = "La solicitud no tiene identificador."
MSG_REPEATED_REQUEST = "El identificador de la solicitud está repetido."
MSG_MALFORMED_REQUEST = "El cuerpo de la solicitud no tiene el formato esperado: {}."

# Wording of the cleaning report.
TREATMENT_MEDIAN = "imputacion_mediana(valor=%.4f)"
TREATMENT_NONE = "sin_imputacion(se_excluye_fila_a_fila_solo_en_analisis_que_la_requieran)"
TREATMENT_FLAGGED = "marcado_en_columna_ES_OUTLIER_sin_eliminacion"
