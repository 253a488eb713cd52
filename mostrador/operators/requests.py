"""A table of filter requests, parsed and validated in one job (``batch`` answers them)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.errors import FilterError
from mostrador.operators.filters import BOUNDS, EQUALITIES, accepted_value, filter_name, refusal

_STATUS_NONE, _STATUS_FILTERS, _STATUS_ERROR = "sin_filtros", "con_filtros", "error"


def _text_field(element: Column, name: str) -> Column:
    """A field of a JSON object if it is text, else NULL (numbers are not text)."""
    kind = F.schema_of_variant(F.try_variant_get(element, f"$.{name}", "variant"))
    return F.when(kind == "STRING", F.try_variant_get(element, f"$.{name}", "string"))


def parse_requests(requests: DataFrame) -> DataFrame:
    """(request_id, status, filters, detail) from (request_id, body).

    No body, a JSON null and an object without ``consultas`` mean no filter. An
    explicit null or empty list, anything that is not a list, and a list element
    without both texts are errors.
    """
    doc = F.try_parse_json("body")
    item = F.try_variant_get("doc", "$.consultas", "variant")
    parsed = requests.select("request_id", "body", doc.alias("doc")).select(
        "request_id",
        F.col("body").isNull().alias("no_body"),
        F.schema_of_variant("doc").alias("doc_kind"),
        F.schema_of_variant(item).alias("list_kind"),
        F.transform(
            F.try_variant_get("doc", "$.consultas", "array<variant>"),
            lambda e: F.struct(
                filter_name(_text_field(e, "consulta")).alias("consulta"),
                _text_field(e, "valor").alias("valor"),
            ),
        ).alias("filters"),
    )
    malformed = F.lit(S.MSG_MALFORMED_REQUEST)

    def problem(reason: str) -> Column:
        return F.replace(malformed, F.lit("{}"), F.lit(reason))

    is_object = F.col("doc_kind").startswith("OBJECT")
    is_list = F.col("list_kind").startswith("ARRAY")
    incomplete = F.exists("filters", lambda f: f.consulta.isNull() | f.valor.isNull())
    unfiltered = F.col("no_body") | (F.col("doc_kind") == "VOID") | (is_object & F.col("list_kind").isNull())
    detail = (
        F.when(unfiltered, None)
        .when(F.col("doc_kind").isNull(), problem("JSON no válido"))
        .when(~is_object, problem("se esperaba un objeto"))
        .when(F.col("list_kind") == "VOID", F.lit(S.MSG_EMPTY_REQUEST))
        .when(~is_list, problem("'consultas' debe ser una lista"))
        .when(F.size("filters") == 0, F.lit(S.MSG_EMPTY_REQUEST))
        .when(incomplete, problem("cada consulta requiere los textos 'consulta' y 'valor'"))
    )
    status = (
        F.when(unfiltered, _STATUS_NONE).when(F.col("detail").isNotNull(), _STATUS_ERROR).otherwise(_STATUS_FILTERS)
    )
    return parsed.withColumn("detail", detail).select(
        "request_id",
        status.alias("status"),
        F.when(status == _STATUS_FILTERS, F.col("filters")).alias("filters"),
        "detail",
    )


def parsed_filters(parsed: DataFrame) -> DataFrame:
    """(request_id, status, position, consulta, valor): one row per filter, one for no filter."""
    return parsed.select("request_id", "status", F.posexplode_outer("filters").alias("position", "f")).select(
        "request_id", "status", "position", "f.consulta", "f.valor"
    )


def validate_requests(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``detail`` also set for requests whose filters are not acceptable.

    As with a single request, the first unacceptable filter is the one reported.
    Requests that share an identifier cannot be answered under it and are all rejected,
    and so is each request without one.
    """
    messages = F.transform("filters", lambda f: refusal(f.consulta, f.valor))
    first = F.get(F.filter(messages, lambda m: m.isNotNull()), F.lit(0))
    # Without an identifier there is nothing to compare, so these stay out of the window.
    nameless = parsed.where("request_id is null").withColumn("detail", F.lit(S.MSG_MISSING_REQUEST_ID))
    checked = parsed.where("request_id is not null").withColumn("detail", F.coalesce("detail", first))
    # The count also keeps later filters on the message from being computed below it a second time.
    copies = F.count(F.lit(1)).over(Window.partitionBy("request_id"))
    repeated = F.when(F.col("copies") > 1, F.lit(S.MSG_REPEATED_REQUEST)).otherwise(F.col("detail"))
    return checked.withColumn("copies", copies).withColumn("detail", repeated).drop("copies").unionByName(nameless)


def request_errors(validated: DataFrame) -> DataFrame:
    """(request_id, error_code, error_label, detail) of the rejected requests."""
    return validated.where("detail is not null").select(
        "request_id",
        F.lit(FilterError.code).alias("error_code"),
        F.lit(FilterError.label).alias("error_label"),
        "detail",
    )


def request_bounds(validated: DataFrame) -> DataFrame:
    """One row per valid request: a key per equality filter, two time bounds, ``possible``.

    A filter repeated with different values, or a number no column can hold,
    makes the request impossible: its answer is the empty one.
    """
    name, text = F.col("name"), F.col("text")
    key = F.lit(None).cast("string")
    for which, spec in EQUALITIES.items():
        key = F.when(name == which, spec.value(text).cast("string")).otherwise(key)
    entries = (
        validated.select("request_id", "detail", F.explode_outer("filters").alias("f"))
        .select("request_id", "detail", F.col("f.consulta").alias("name"), accepted_value(F.col("f.consulta"), F.col("f.valor")).alias("text"))
        .select("request_id", "detail", "name", key.alias("key"), F.when(name.isin(*BOUNDS), text.try_cast("timestamp_ntz")).alias("at"))
    )
    lowest, agree = [], F.lit(True)
    for name in EQUALITIES:
        mine = F.when(F.col("name") == name, F.col("key"))
        lowest.append(F.min(mine).alias(name))
        agree = agree & F.coalesce(F.min(mine) == F.max(mine), F.lit(True))
    unknown = F.count_if(F.col("name").isin(*EQUALITIES) & F.col("key").isNull())
    # Rejected requests leave after the aggregation: a filter on the message before
    # it would make Spark validate every request a second time.
    bounds = entries.groupBy("request_id").agg(
        F.max("detail").alias("detail"),
        *lowest,
        F.max(F.when(F.col("name") == "FECHA_DESDE", F.col("at"))).alias("desde"),
        F.min(F.when(F.col("name") == "FECHA_HASTA", F.col("at"))).alias("hasta"),
        (agree & (unknown == 0)).alias("possible"),
    )
    return bounds.where("detail is null").drop("detail")
