"""One callable per operator: (spark, sf_dir) to the operator's result over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.catalog import tables
from mostrador.operators import batch, cleaning, features, missingness, quality, quantiles, requests
from mostrador.operators.filters import Filter, apply_filters
from mostrador.operators.histogram import melt
from mostrador.operators.summary import summary
from mostrador.plans import flows
from mostrador.session import shared_folder
from mostrador.sources import extract, facts, json_sample, load_log
from mostrador.sources.reports import save_report

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_FILTERS: tuple[Filter, ...] = (("GENERO", "Femenino"), ("EDAD", "31"), ("CANAL", "POS"))
_LINE = ("boleta", "sku")


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _stats(df: DataFrame) -> DataFrame:
    """Rounding for comparison: sums of doubles depend on the order of addition."""
    df = _rounded(df, 2, "suma", "minimo", "maximo")
    return _rounded(df, 4, "promedio", "mediana", "desviacion_estandar")


def _aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_age(tables.sales(spark, sf_dir))


def _filtered(*filters: Filter, show: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = apply_filters(_aged(spark, sf_dir), filters)
        return _lower(kept).select(*_LINE, show, "monto_aplicado")

    return query


def _summarised(*filters: Filter) -> Query:
    return lambda spark, sf_dir: _stats(summary(_aged(spark, sf_dir), filters))


# --- sources ---------------------------------------------------------------
def _good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = extract.skip_malformed(extract.read_rows(spark, tables.csv_extract(spark, sf_dir)))
    return good


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.cast_columns(extract.rename_standard(_good_lines(spark, sf_dir)))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(_good_lines(spark, sf_dir))


def input_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of data in the extract's files: their lengths less a header line each, however many files there are."""
    files = extract.input_manifest(spark, tables.csv_extract(spark, sf_dir, packed=False))
    header = len(f"{S.SEPARATOR.join(S.RAW_COLUMNS)}\n".encode())
    return files.agg((F.sum("length") - F.count("*") * header).alias("data_bytes"))


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.schema_check(spark, tables.csv_extract_incomplete(spark, sf_dir))
    return found.select("missing").distinct()


def csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.malformed_counts(extract.read_rows(spark, tables.csv_extract(spark, sf_dir)))


def rename_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.rename_standard(_good_lines(spark, sf_dir)).select(
        "BOLETA", "PORCENTAJE_DESCUENTO", "MONTO_APLICADO", "CODIGO_CLIENTE", "RUN_CLIENTE", "FECHA_NACIMIENTO"
    )


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _lower(_typed(spark, sf_dir))
    return typed.select(
        "fecha", "sku", "unidades", "porcentaje_descuento", "boleta", "local", "genero",
        F.when(~F.col("monto_aplicado").isin(float("inf"), float("-inf")), F.col("monto_aplicado")).alias("monto_finito"),
        F.array_join(extract.REJECTED, ",").alias("rechazo"),
    )


def coerce_birth_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(_typed(spark, sf_dir)).select("boleta", "codigo_cliente", "fecha_nacimiento")


def channel_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(quality.channel_domain(_typed(spark, sf_dir)))


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = json_sample.read_json(spark, tables.json_extract(spark, sf_dir))
    return facts.to_fact_columns(extract.accepted(typed))


def infinite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.infinite_counts(
        _typed(spark, sf_dir), ["MONTO_APLICADO", "PORCENTAJE_DESCUENTO", "UNIDADES", "AUSENTE"]
    )


def type_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.type_conformance(
        extract.rename_standard(_good_lines(spark, sf_dir)),
        ["SKU", "UNIDADES", "PORCENTAJE_DESCUENTO", "MONTO_APLICADO", "LOCAL", "GENERO", "FECHA_NACIMIENTO"],
    )


# --- sinks -----------------------------------------------------------------
def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "ventas")
    facts.write_facts(facts.to_fact_columns(_aged(spark, sf_dir)), folder)
    return facts.read_facts(spark, folder)


def _stored_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(folder: str) -> str:
        facts.write_facts(facts.to_fact_columns(_aged(spark, sf_dir)), folder)
        return folder

    return facts.read_facts(spark, tables.staged_once(spark, sf_dir, "hechos", build))


def month_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = apply_filters(_stored_once(spark, sf_dir), [("FECHA_DESDE", "1996-02-10"), ("FECHA_HASTA", "1996-05-20")])
    return kept.select("fecha", *_LINE, "monto_aplicado", facts.MONTH_COLUMN)


def ingest_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.to_fact_columns(flows.two_pass(tables.sales(spark, sf_dir, product=True, stored=True)))


def month_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.month_partitions(tables.sales(spark, sf_dir))


def months_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.months_present(tables.sales(spark, sf_dir))


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).select("fecha", *_LINE, "canal", "edad", "monto_aplicado", facts.MONTH_COLUMN)


def ingest_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "carga")
    flows.ingest(spark, tables.csv_extract(spark, sf_dir), root, strict=False)
    flows.ingest(spark, tables.csv_extract(spark, sf_dir), root, strict=False)  # finds the finished load
    return flows.published_facts(spark, root).drop(*facts.LAYOUT_COLUMNS)


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of the load: lines loaded, skipped for their length, rejected for their values; and the lines kept."""
    root = shared_folder(spark, "carga")
    flows.ingest(spark, tables.csv_extract(spark, sf_dir), root, strict=False)
    left_out = flows.rejected_lines(spark, root).agg(
        F.count("linea").alias("kept_long"), F.count_if(F.size("columnas") > 0).alias("kept_misfits")
    )
    return load_log.load_log(spark, root).where("completed").select("rows", "skipped", "rejected").join(left_out)


# --- quality and cleaning --------------------------------------------------
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(tables.sales(spark, sf_dir))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.sales(spark, sf_dir)
    before = quality.row_count(rows).withColumnRenamed("rows", "rows_before")
    after = quality.row_count(cleaning.clean(rows.select("MONTO_APLICADO", "UNIDADES", "PORCENTAJE_DESCUENTO")))
    return before.withColumn("rows_after", after.scalar())


def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantiles.column_quantiles(
        tables.sales(spark, sf_dir), S.SCALED_COLUMNS, {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99}
    )
    return _rounded(found, 4, "q25", "q50", "q75", "q99")


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(cleaning.impute_median(tables.sales(spark, sf_dir))).select(*_LINE, "porcentaje_descuento")


def mcar_mann_whitney(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = missingness.mann_whitney(tables.sales(spark, sf_dir), "PORCENTAJE_DESCUENTO", S.MEASURE)
    return _rounded(found, 6, "z")


def iqr_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cleaning.fences(tables.sales(spark, sf_dir)), 4, "q1", "q3", "low", "high")


def outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = cleaning.mark_outliers(tables.sales(spark, sf_dir), S.MEASURE, "iqr")
    return _lower(marked).select(*_LINE, "monto_aplicado", "monto_aplicado_es_outlier")


def outliers_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = cleaning.mark_outliers(tables.sales(spark, sf_dir), S.MEASURE, "zscore")
    return _lower(marked).select(*_LINE, "monto_aplicado", "monto_aplicado_es_outlier")


def outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cleaning.outlier_counts(cleaning.clean(tables.sales(spark, sf_dir))), 6, "percent")


_CLEANED = (*_LINE, "porcentaje_descuento", "monto_aplicado_es_outlier", "unidades_es_outlier")


def clean_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(cleaning.clean(tables.sales(spark, sf_dir))).select(*_CLEANED)


def apply_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.sales(spark, sf_dir)
    params = cleaning.fit_cleaning(rows.select("PORCENTAJE_DESCUENTO", "MONTO_APLICADO", "UNIDADES"))
    return _lower(cleaning.apply_cleaning(rows, params)).select(*_CLEANED)


def global_cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.sales(spark, sf_dir)
    found = _lower(cleaning.fit_cleaning(rows.select("PORCENTAJE_DESCUENTO", "MONTO_APLICADO", "UNIDADES")))
    numbers = [c for c in found.columns if c.startswith(("median_", "low_", "high_"))]
    return _rounded(found, 4, *numbers)


def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.sales(spark, sf_dir)
    return cleaning.cleaning_report(rows, missingness.mcar_report(rows))


def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning report as it is written to, and read again from, its JSON file."""
    folder = shared_folder(spark, "reportes")
    report = cleaning_report(spark, sf_dir)
    save_report(report, folder, "reporte_limpieza")
    return spark.read.schema(report.schema).json(f"{folder}/reporte_limpieza.json")


# --- features --------------------------------------------------------------
def unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(features.add_unit_price(tables.sales(spark, sf_dir))).select(*_LINE, "unidades", "monto_por_unidad")


def unit_price_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.unit_price_quality(tables.sales(spark, sf_dir)), 4, "mean", "median")


def age_at_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(_aged(spark, sf_dir)).select("boleta", "fecha", "fecha_nacimiento", "edad")


def age_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.age_quality(tables.sales(spark, sf_dir)), 6, "mean")


def purchase_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(features.purchase_frequency(tables.sales(spark, sf_dir)))


def purchase_frequency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.purchase_frequency_summary(tables.sales(spark, sf_dir)), 6, "mean")


def frequency_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lower(features.add_frequency(tables.sales(spark, sf_dir))).select(
        *_LINE, "codigo_cliente", "frecuencia_compra"
    )


_SCALED = tuple((c + S.SCALED_SUFFIX).lower() for c in S.SCALED_COLUMNS)


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled, _ = features.standardize(tables.sales(spark, sf_dir))
    return _rounded(_lower(scaled), 6, *_SCALED).select(*_LINE, *_SCALED)


def scaling_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.scaling_parameters(tables.sales(spark, sf_dir)), 6, "mean", "sd")


_FEATURES = (*_LINE, "monto_por_unidad", "edad", "frecuencia_compra", *_SCALED)


def engineer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploratory flow: scales are fitted on the imputed data."""
    return _rounded(_lower(flows.one_pass(tables.sales(spark, sf_dir, stored=True))), 6, *_SCALED).select(*_FEATURES)


def apply_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production flow: scales are fitted on the data as it came."""
    return _rounded(_lower(flows.two_pass(tables.sales(spark, sf_dir, stored=True))), 6, *_SCALED).select(*_FEATURES)


def global_feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.sales(spark, sf_dir)
    scales = features.scaling_parameters(rows)
    customers = features.purchase_frequency_summary(rows).select("customers").scalar()
    return _rounded(scales.withColumn("customers", customers), 6, "mean", "sd")


# --- summaries and requests ------------------------------------------------
def summary_processed_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary over the result of the exploratory flow instead of the stored table."""
    processed = flows.one_pass(tables.sales(spark, sf_dir), with_frequency=False)
    return _stats(summary(processed, [("CANAL", "web"), ("GENERO", " masculino ")]))


def summary_large_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations of values that lie far from zero for their spread."""
    shifted = tables.sales(spark, sf_dir).select(
        (F.col("MONTO_APLICADO") + 1e9).alias("monto"), (F.lit(1e12) + F.col("BOLETA") % 7).alias("resto")
    )
    found = quantiles.group_summary(melt(shifted, ["monto", "resto"]), ["column"], few_groups=True)
    return _rounded(found.select("column", "n", "deviation"), 3, "deviation")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.parse_requests(tables.requests(spark, sf_dir))


def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.parsed_filters(_parsed(spark, sf_dir))


def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_errors(requests.validate_requests(_parsed(spark, sf_dir)))


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = requests.validate_requests(_parsed(spark, sf_dir))
    return _stats(batch.batch_summary(_aged(spark, sf_dir), validated))


def batch_summary_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates per supplier, all of them over the same sales and overlapping each other."""
    validated = requests.validate_requests(requests.parse_requests(tables.date_requests(spark, sf_dir)))
    return _stats(batch.batch_summary(_aged(spark, sf_dir), validated))


def _person(key: int) -> str:
    return f"{tables.CUSTOMER_PREFIX}{key:012d}"


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "input_manifest": input_manifest,
    "schema_check": schema_check,
    "csv_malformed_rows": csv_malformed_rows,
    "rename_standard": rename_standard,
    "typed_cast": typed_cast,
    "coerce_birth_date": coerce_birth_date,
    "channel_domain": channel_domain,
    "json_scan": json_scan,
    "infinite_counts": infinite_counts,
    "type_conformance": type_conformance,
    "month_pruned_scan": month_pruned_scan,
    "ingest_projection": ingest_projection,
    "month_partition": month_partition,
    "months_present": months_present,
    "partitioned_write": partitioned_write,
    "ingest_end_to_end": ingest_end_to_end,
    "ingest_log": ingest_log,
    "null_profile": null_profile,
    "exact_quantiles": exact_quantiles,
    "impute_median": impute_median,
    "mcar_mann_whitney": mcar_mann_whitney,
    "iqr_bounds": iqr_bounds,
    "outliers_iqr": outliers_iqr,
    "outliers_zscore": outliers_zscore,
    "outlier_counts": outlier_counts,
    "clean_dataset": clean_dataset,
    "cleaning_report": cleaning_report,
    "report_export": report_export,
    "global_cleaning_stats": global_cleaning_stats,
    "apply_cleaning": apply_cleaning,
    "unit_price": unit_price,
    "unit_price_quality": unit_price_quality,
    "age_at_purchase": age_at_purchase,
    "age_quality": age_quality,
    "purchase_frequency": purchase_frequency,
    "purchase_frequency_summary": purchase_frequency_summary,
    "frequency_join": frequency_join,
    "standardize": standardize,
    "scaling_parameters": scaling_parameters,
    "engineer_features": engineer_features,
    "global_feature_stats": global_feature_stats,
    "apply_features": apply_features,
    "filter_gender": _filtered(("GENERO", "Femenino"), show="genero"),
    "filter_age": _filtered(("EDAD", "31"), show="edad"),
    "filter_channel": _filtered(("canal", " web "), show="canal"),
    "filter_product": _filtered(("CODIGO_PRODUCTO", "28"), show="canal"),
    "filter_customer": _filtered(("ID_PERSONA", "{" + _person(42).upper() + "}"), show="codigo_cliente"),
    "filter_store": _filtered(("LOCAL", "+7"), show="local"),
    "filter_date_from": _filtered(("FECHA_DESDE", "1999-11-15T00:00:00"), show="fecha"),
    "filter_date_to": _filtered(("FECHA_HASTA", "1996-02-29"), show="fecha"),
    "filter_combined": _filtered(
        ("GENERO", "Otro"), ("CANAL", "APP"), ("FECHA_DESDE", "1996-01-01"), ("FECHA_HASTA", "1998-12-31"), show="fecha"
    ),
    "filter_contradiction": _filtered(("LOCAL", "7"), ("LOCAL", "8"), show="local"),
    "summary_all": _summarised(),
    "summary_filtered": _summarised(*FLAGSHIP_FILTERS),
    "summary_single_row": _summarised(("ID_PERSONA", _person(20)), ("CODIGO_PRODUCTO", "28")),
    "summary_empty": _summarised(("LOCAL", "555555")),
    "summary_processed_frame": summary_processed_frame,
    "summary_large_offset": summary_large_offset,
    "row_counts": row_counts,
    "request_parse": request_parse,
    "request_validation": request_validation,
    "batch_summary": batch_summary,
    "batch_summary_dates": batch_summary_dates,
}
