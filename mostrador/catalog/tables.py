"""Sales lines, extracts and requests derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.session import release_shuffles, shared_folder

# Channel by order key modulo 6.
CHANNEL_CYCLE = ("POS", "WEB", "APP", "CCT", "APR", "WPR")
CUSTOMER_PREFIX = "550e8400-e29b-41d4-a716-"
# A row's number for planting defects in the text extracts.
PLANT = "_plant"


# Lines to a file of a staged text: a compressed file is read by one task.
FILE_LINES = 500_000
# Staged texts are read once or twice, so little time goes into packing them.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(FILE_LINES)}

# Columns used of each given table. Stating them saves a job per read that would
# open files only to find the schema.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string",
    "supplier": "s_suppkey bigint",
    "customer": "c_custkey bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _joined_lines(spark: SparkSession, sf_dir: str, product: bool) -> DataFrame:
    """Lines with their order and, if wanted, the name of the product."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    if product:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        rows = rows.join(part, rows.l_partkey == part.p_partkey, "left").drop("p_partkey")
    return rows


def _stored_lines(spark: SparkSession, sf_dir: str, product: bool) -> DataFrame:
    joined = _joined_lines(spark, sf_dir, product)

    def build(folder: str) -> str:
        joined.write.parquet(folder)
        return folder

    folder = staged_once(spark, sf_dir, "lineas-producto" if product else "lineas", build)
    return spark.read.schema(joined.schema).parquet(folder)


def sales(spark: SparkSession, sf_dir: str, product: bool = False, plant: bool = False, stored: bool = False) -> DataFrame:
    """Sales lines in the standard columns. ``product`` adds the name, at the cost of one more join.

    With ``stored`` the tables are joined once and kept, for flows that read their sales several times.
    """
    rows = (_stored_lines if stored else _joined_lines)(spark, sf_dir, product)
    order, line, customer = F.col("l_orderkey"), F.col("l_linenumber"), F.col("o_custkey")
    channel = F.lit(CHANNEL_CYCLE[-1])
    for i, name in reversed(list(enumerate(CHANNEL_CYCLE[:-1]))):
        channel = F.when(order % 6 == i, name).otherwise(channel)
    amount = F.when(order % 500 == 1, F.col("l_extendedprice") * 50).otherwise(F.col("l_extendedprice"))
    birth = F.date_add(F.lit("1880-01-01").cast("date"), (customer * 37 % 44000).cast("int"))
    columns: dict[str, Column] = {
        "FECHA": F.col("o_orderdate"),
        "CANAL": channel,
        "SKU": F.col("l_partkey"),
        "UNIDADES": F.when((order * 7 + line) % 97 == 0, F.lit(0)).otherwise(F.col("l_quantity")).cast("bigint"),
        "PORCENTAJE_DESCUENTO": F.when((order + line) % 10 != 0, F.col("l_discount")),
        "MONTO_APLICADO": F.when((order * 3 + line) % 101 != 0, amount),
        "BOLETA": order,
        "LOCAL": F.when(F.col("l_suppkey") % 50 != 0, F.col("l_suppkey")),
        "CODIGO_CLIENTE": F.concat(F.lit(CUSTOMER_PREFIX), F.lpad(customer.cast("string"), 12, "0")),
        "RUN_CLIENTE": F.concat(customer.cast("string"), F.lit("-K")),
        "NOMBRES": F.concat(F.lit("NOMBRE "), customer.cast("string")),
        "APELLIDOS": F.concat(F.lit("APELLIDO "), customer.cast("string")),
        "FECHA_NACIMIENTO": F.when(customer % 20 != 0, birth),
        "GENERO": F.when(customer % 5 != 4, customer % 5),
    }
    if product:
        columns["PRODUCTO"] = F.col("p_name")
    if plant:
        columns[PLANT] = order * 7 + line
    names = [c for c in (*S.STANDARD_COLUMNS, PLANT) if c in columns]
    return rows.select(*[columns[c].alias(c) for c in names])


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as raw text columns, some values spelled in awkward ways."""
    rows = sales(spark, sf_dir, product=True, plant=True)
    plant = F.col(PLANT)

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    discount = F.when(
        F.col("PORCENTAJE_DESCUENTO").isNull(),
        F.when(plant % 3 == 0, "").when(plant % 3 == 1, "NA").otherwise("null"),
    ).otherwise(F.col("PORCENTAJE_DESCUENTO").cast("decimal(9,2)").cast("string"))
    amount = (
        F.when(plant % 1009 == 0, "inf")
        .when(plant % 1013 == 0, "-Infinity")
        .otherwise(F.coalesce(F.col("MONTO_APLICADO").cast("decimal(18,2)").cast("string"), F.lit("")))
    )
    birth = F.col("FECHA_NACIMIENTO")
    born = (
        F.when(birth.isNull(), "")
        .when(plant % 13 == 0, F.concat(birth.cast("string"), F.lit(" 05:30:00")))
        .when(plant % 17 == 0, "sin fecha")
        .when(plant % 19 == 0, F.concat_ws("-", F.year(birth), F.month(birth), F.dayofmonth(birth)))
        .otherwise(birth.cast("string"))
    )
    values = {
        "FECHA": F.replace(text("FECHA"), F.lit(" "), F.lit("T")),
        "CANAL": F.col("CANAL"),
        "SKU": F.concat(text("SKU"), F.when(plant % 11 == 0, ".0").otherwise("")),
        "PRODUCTO": F.concat(text("PRODUCTO"), F.when(plant % 29 == 0, "; oferta").otherwise("")),
        "UNIDADES": F.when(plant % 1019 == 0, "tres").otherwise(text("UNIDADES")),
        "PORCENTAJE DESCUENTO": discount,
        "MONTO APLICADO": amount,
        "BOLETA": text("BOLETA"),
        "LOCAL": text("LOCAL"),
        "CODIGO CLIENTE": F.col("CODIGO_CLIENTE"),
        "RUN CLIENTE": F.col("RUN_CLIENTE"),
        "NOMBRES": F.col("NOMBRES"),
        "APELLIDOS": F.col("APELLIDOS"),
        "FECHA NACIMIENTO": born,
        "GENERO": text("GENERO"),
    }
    return rows.select(*[values[c].alias(c) for c in S.RAW_COLUMNS], PLANT)


def _write_lines(lines: DataFrame, header: str, folder: str, packed: bool = True) -> str:
    """Lines as they are, with ``header`` as the first line of every file."""
    # A separator that no line contains and no quoting leave the text untouched.
    (
        lines.toDF(header)
        .write.option("header", "true")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .options(**(_PACKED if packed else {}))
        .csv(folder)
    )
    return folder


_staged: dict[tuple[str, str, str], str] = {}


def staged_once(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    """Stage a derived input one time per session: several queries read the same extract."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _staged:
        _staged[key] = build(shared_folder(spark, kind))
        release_shuffles(spark)
    return _staged[key]


def csv_extract(spark: SparkSession, sf_dir: str, packed: bool = True) -> str:
    """A delimited extract of all sales, with too long and too short lines planted; not ``packed``, the files are as long as their text."""

    def build(folder: str) -> str:
        plant = F.col(PLANT)
        fields = [F.col(f"`{c}`") for c in S.RAW_COLUMNS]
        position = S.RAW_COLUMNS.index("PRODUCTO")
        fields[position] = F.concat(F.lit('"'), fields[position], F.lit('"'))
        whole = F.concat_ws(S.SEPARATOR, *fields)
        line = (
            F.when(plant % 31 == 0, F.concat(whole, F.lit(";sobra")))
            .when(plant % 37 == 0, F.concat(whole, F.lit(";")))
            .when(plant % 41 == 0, F.concat(whole, F.lit(";;")))
            .when(plant % 43 == 0, F.concat_ws(S.SEPARATOR, *fields[:-1]))
            .otherwise(whole)
        )
        return _write_lines(raw_text(spark, sf_dir).select(line), S.SEPARATOR.join(S.RAW_COLUMNS), folder, packed)

    return staged_once(spark, sf_dir, "extracto" if packed else "extracto-llano", build)


def csv_extract_incomplete(spark: SparkSession, sf_dir: str) -> str:
    """A delimited extract whose files lack two of the required columns."""

    def build(folder: str) -> str:
        kept = [c for c in S.RAW_COLUMNS if c not in ("LOCAL", "GENERO")]
        whole = F.concat_ws(S.SEPARATOR, *[F.col(f"`{c}`") for c in kept])
        return _write_lines(raw_text(spark, sf_dir).select(whole), S.SEPARATOR.join(kept), folder)

    return staged_once(spark, sf_dir, "extracto-incompleto", build)


def json_extract(spark: SparkSession, sf_dir: str) -> str:
    """All sales as JSON objects with the raw names, numbers as numbers."""

    def build(folder: str) -> str:
        rows = sales(spark, sf_dir, product=True)
        raw = {standard: raw for raw, standard in S.STANDARD_NAMES.items()}
        moment = F.replace(F.col("FECHA").cast("string"), F.lit(" "), F.lit("T"))
        rows.withColumn("FECHA", moment).withColumnsRenamed(raw).write.options(**_PACKED).json(folder)
        return folder

    return staged_once(spark, sf_dir, "muestra", build)


def _filters(*pairs: tuple[str, Column | str]) -> Column:
    """A request body with the given filters."""
    items = [
        F.struct(F.lit(n).alias("consulta"), (v if isinstance(v, Column) else F.lit(v)).alias("valor"))
        for n, v in pairs
    ]
    return F.to_json(F.struct(F.array(*items).alias("consultas")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request documents: sound ones by supplier, defective ones by customer segment of keys."""
    key = F.col("s_suppkey")
    number = key.cast("string")
    person = F.concat(F.upper(F.lit(CUSTOMER_PREFIX)), F.lpad(number, 12, "0"))
    kinds = [
        _filters(("LOCAL", number)),
        _filters(("local ", number), ("CANAL", "web")),
        _filters(("EDAD", (key % 90).cast("string")), ("FECHA_DESDE", "1997-01-01")),
        _filters(("ID_PERSONA", F.concat(F.lit("{"), person, F.lit("}")))),
        _filters(("CODIGO_PRODUCTO", number), ("FECHA_HASTA", "1999-06-30T12:00:00")),
        F.lit("{}"),
        _filters(("GENERO", "Femenino"), ("FECHA_DESDE", "1996-01-01"), ("FECHA_DESDE", "1996-03-01"), ("FECHA_HASTA", "1996-12-31")),
        _filters(("LOCAL", number), ("LOCAL", (key + 1).cast("string"))),
    ]
    body = kinds[-1]
    for i, kind in reversed(list(enumerate(kinds[:-1]))):
        body = F.when(key % 8 == i, kind).otherwise(body)
    sound = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), number).alias("request_id"), body.alias("body"))

    ckey = F.col("c_custkey")
    text = ckey.cast("string")
    defects = [
        F.lit('{"consultas": []}'),
        F.lit('{"consultas": null}'),
        F.concat(F.lit('{"consultas": '), text, F.lit("}")),
        F.concat(F.lit('{"consultas": [{"consulta": "EDAD", "valor": '), text, F.lit("}]}")),
        F.lit('{"consultas": [{"consulta": "EDAD"}]}'),
        F.lit('{"consultas": ['),
        _filters(("COLOR", text)),
        _filters(("GENERO", F.concat(F.lit("x"), text))),
        _filters(("CANAL", "TELEFONO")),
        _filters(("CANAL", "POS"), ("EDAD", F.concat(text, F.lit(".0")))),
        _filters(("FECHA_DESDE", "05/01/2026")),
        _filters(("ID_PERSONA", F.concat(F.lit("no-"), text))),
        _filters(("LOCAL", ""), ("CODIGO_PRODUCTO", "abc")),
    ]
    bad = defects[-1]
    for i, kind in reversed(list(enumerate(defects[:-1]))):
        bad = F.when(ckey % 13 == i, kind).otherwise(bad)
    defective = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), text).alias("request_id"), bad.alias("body"))
    return sound.unionByName(defective)


def date_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range of dates per supplier, without other filters; some are open at one end, some empty, some end within a day."""
    key = F.col("s_suppkey").cast("int")
    start = F.date_add(F.lit("1995-01-01").cast("date"), key * 37 % 1700)
    end = F.date_add(start, key * 53 % 900 - 20)
    starts = start.cast("string")
    ends = F.concat(end.cast("string"), F.when(key % 3 == 0, "T11:30:00").otherwise(""))
    body = (
        F.when(key % 10 == 1, _filters(("FECHA_DESDE", starts)))
        .when(key % 10 == 2, _filters(("FECHA_HASTA", ends)))
        .otherwise(_filters(("FECHA_DESDE", starts), ("FECHA_HASTA", ends)))
    )
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("request_id"), body.alias("body"))
