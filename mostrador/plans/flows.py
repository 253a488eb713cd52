"""From an extract to something that can be queried."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mostrador.errors import UnreadableInputError
from mostrador.operators.cleaning import apply_cleaning, clean, cleaning_report, settled_bounds
from mostrador.operators.features import (
    FeatureParams,
    apply_features,
    engineer_features,
    fit_frequency,
    fit_scales,
    scaling_parameters,
)
from mostrador.operators.missingness import mcar_report
from mostrador.session import PACKED, remove_folder, subfolders
from mostrador.sources import load_log
from mostrador.sources.extract import REJECTED, TOO_LONG, accepted, stage_extract
from mostrador.sources.facts import read_facts, to_fact_columns, write_facts
from mostrador.sources.reports import save_report

# Rows of a load that are in shuffle files at the same time, while the facts are written.
TURN_ROWS = 80_000_000


def _stage(spark: SparkSession, source: str, folder: str, strict: bool) -> tuple[DataFrame, dict[str, int]]:
    """Parse the text once and keep it as Parquet: the accepted rows, and how many were loaded, skipped and rejected.

    Every later pass reads this one snapshot, column by column, and a lost
    executor costs a re-read of its blocks instead of a re-parse of the text.
    The counts are taken while it is written.
    """
    seen = Observation(f"lineas-{uuid.uuid4().hex}")
    staged = stage_extract(spark, source, f"{folder}/texto")
    long, misfit = F.col(TOO_LONG).isNotNull(), F.size(REJECTED) > 0
    counted = staged.observe(
        seen,
        F.count_if(~long & ~misfit).alias("loaded"),
        F.count_if(long).alias("skipped"),
        F.count_if(~long & misfit).alias("rejected"),
        F.min(F.when(~long & misfit, F.array_join(REJECTED, ", "))).alias("misfits"),
    )
    counted.write.mode("errorifexists").options(**PACKED).parquet(f"{folder}/filas")
    remove_folder(spark, f"{folder}/texto")
    counts = seen.get
    if not counts["loaded"] + counts["rejected"]:
        raise UnreadableInputError(f"'{source}' was parsed but has no rows")
    if strict and counts["rejected"]:
        raise UnreadableInputError(f"values do not fit columns {counts['misfits'].split(', ')}")
    staged = spark.read.parquet(f"{folder}/filas")
    return accepted(staged.where(F.col(TOO_LONG).isNull()).drop(TOO_LONG)), counts


def _keep_rejects(spark: SparkSession, folder: str, target: str) -> None:
    """The lines a load left out, each with its reason: the text of a line that is too long, or the columns that misfit."""
    staged = spark.read.parquet(f"{folder}/filas")
    values = [c for c in staged.columns if c not in (TOO_LONG, REJECTED)]
    left_out = staged.where(F.col(TOO_LONG).isNotNull() | (F.size(REJECTED) > 0))
    left_out.select(
        F.col(TOO_LONG).alias("linea"),
        F.when(F.col(TOO_LONG).isNull(), F.col(REJECTED)).alias("columnas"),
        F.when(F.col(TOO_LONG).isNull(), F.to_json(F.struct(*values))).alias("valores"),
    ).write.mode("errorifexists").options(**PACKED).parquet(target)


def two_pass(sales: DataFrame, with_frequency: bool = True) -> DataFrame:
    """Fit everything on the given data, then apply it: the production flow.

    Scales are fitted on the data as it came, before imputation. The data is read four times: by one aggregate for
    means and deviations, one histogram for all quantiles, one frequency table, and to apply them. The three fits
    do not need each other, so Spark gets them at the same time.
    """
    with ThreadPoolExecutor(2) as pool:
        scales = pool.submit(inheritable_thread_target(sales.sparkSession)(lambda: fit_scales(sales)))
        bounds = pool.submit(inheritable_thread_target(sales.sparkSession)(lambda: settled_bounds(sales)))
        table = fit_frequency(sales) if with_frequency else None
    cleaned = sales if bounds.result() is None else apply_cleaning(sales, bounds.result())
    return apply_features(cleaned, FeatureParams(scales.result(), table))


def one_pass(sales: DataFrame, with_frequency: bool = True) -> DataFrame:
    """Clean, then fit the features on the cleaned data: the exploratory flow."""
    return engineer_features(clean(sales), with_frequency)


def _clear_unfinished(spark: SparkSession, root: str) -> None:
    """Remove what interrupted loads left behind. One load at a time writes under a root."""
    kept = {f.rsplit("/", 2)[-2] for f in load_log.published_folders(spark, root)}
    for name in subfolders(spark, f"{root}/cargas"):
        if name not in kept:
            remove_folder(spark, f"{root}/cargas/{name}")


def ingest(
    spark: SparkSession, source: str, root: str, with_frequency: bool = True, strict: bool = True
) -> load_log.LoadState:
    """Load an extract into the fact table under ``root``, once.

    A finished load is left alone. Anything else starts over in a new folder,
    which becomes visible only when the log names it after the last row is
    written, so an interrupted load can neither be seen nor be counted twice.
    Its folders go before the next load; the snapshot goes when the load is
    published, and the lines left out stay beside the facts (``rejected_lines``).
    """
    state = load_log.load_state(spark, root)
    if state.completed:
        return state
    root = root.rstrip("/")
    _clear_unfinished(spark, root)
    run = f"{root}/cargas/{uuid.uuid4().hex}"
    sales, counts = _stage(spark, source, f"{run}/origen", strict)
    facts = f"{run}/ventas"
    turns = max(1, -(-counts["loaded"] // TURN_ROWS))
    rows = write_facts(to_fact_columns(two_pass(sales, with_frequency)), facts, turns)
    _keep_rejects(spark, f"{run}/origen", f"{run}/rechazos")
    load_log.mark_complete(spark, root, rows, facts, counts["skipped"], counts["rejected"])
    remove_folder(spark, f"{run}/origen")
    return load_log.load_state(spark, root)


def published_facts(spark: SparkSession, root: str) -> DataFrame:
    """The fact table of the latest finished load."""
    state = load_log.load_state(spark, root)
    if not state.completed:
        raise RuntimeError(f"no finished load under '{root}'")
    return read_facts(spark, state.folder)


def rejected_lines(spark: SparkSession, root: str) -> DataFrame:
    """(linea, columnas, valores) of the lines the latest finished load left out."""
    state = load_log.load_state(spark, root)
    if not state.completed:
        raise RuntimeError(f"no finished load under '{root}'")
    return spark.read.parquet(f"{state.folder.rsplit('/', 1)[0]}/rechazos")


def explore(spark: SparkSession, source: str, work: str, with_frequency: bool = True) -> DataFrame:
    """The one-pass flow over an extract, with its two JSON reports under ``work``."""
    sales, _ = _stage(spark, source, f"{work.rstrip('/')}/origen", strict=True)
    cleaned = clean(sales)
    save_report(cleaning_report(sales, mcar_report(sales)), work, "reporte_limpieza")
    save_report(scaling_parameters(cleaned), work, "parametros_estandarizacion")
    return engineer_features(cleaned, with_frequency)
