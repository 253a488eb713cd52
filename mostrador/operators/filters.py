"""The eight named filters: one table of specifications, compiled to a predicate and to columns.

A specification says which column a filter reads, what its text is accepted as, and with which
message it is refused. The acceptance is a column expression. A table of requests applies it
to its own columns; a single request applies the same expression to its texts as one literal row,
which the optimiser answers without a job, so both forms accept the same texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.errors import FilterError
from mostrador.functions.casting import BLANKS, ascii_digits, iso_instant
from mostrador.functions.keys import canonical_uuid

Filter = tuple[str, str]
# Further columns of the stored table: the month of the sale, and the customer in
# lower case. They repeat what other columns say in a form the scan can skip by.
MONTH_COLUMN = "ym"
CUSTOMER_KEY = "cliente_clave"
_INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*\z"


class FilterSpec(NamedTuple):
    column: str  # of the sales
    kind: str  # type both sides are compared in
    accepted: Callable[[Column], Column]  # stripped text to the text of the value; NULL if it is refused
    message: str  # with the text as given, and where asked for the readable name
    compare: Callable[[Column, Column], Column] = Column.__eq__
    stored: Callable[[Column], tuple[Column, Column]] | None = None  # of the value: further column, and what it is held against
    prepared: Callable[[Column], Column] = lambda c: c  # of the sales' column

    @property
    def is_bound(self) -> bool:
        return self.compare is not Column.__eq__

    def value(self, text: Column) -> Column:
        """What an accepted text stands for; NULL if the column's type cannot hold it."""
        if self.kind == "double":  # whole numbers that a bigint holds
            return text.try_cast("bigint").cast("double")
        return text.try_cast(self.kind)


def _integer(text: Column) -> Column:
    plain = ascii_digits(text)
    return F.when(plain.rlike(_INTEGER), F.replace(plain, F.lit("_"), F.lit("")))


def _gender(text: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in S.GENDER_CODES.items() for x in pair])
    return F.try_element_at(codes, F.lower(text)).cast("string")


def _channel(text: Column) -> Column:
    return F.when(F.upper(text).isin(*S.CHANNELS), F.upper(text))


def _customer(text: Column) -> Column:
    return canonical_uuid(ascii_digits(text))


def _instant(text: Column) -> Column:
    # Sale times carry no zone, so a text with an offset is refused: it has nothing to be converted to.
    return iso_instant(text).cast("string")


def _month(value: Column) -> tuple[Column, Column]:
    # Follows from the bound itself; it is what skips monthly folders.
    return F.col(MONTH_COLUMN), F.substring(value, 1, 7)


def _number(column: str, kind: str) -> FilterSpec:
    return FilterSpec(column, kind, _integer, S.MSG_INTEGER)


FILTERS: dict[str, FilterSpec] = {
    "GENERO": FilterSpec("genero", "bigint", _gender, S.MSG_GENDER),
    "EDAD": _number("edad", "double"),
    "CANAL": FilterSpec("canal", "string", _channel, S.MSG_CHANNEL),
    "CODIGO_PRODUCTO": _number("sku", "bigint"),
    "ID_PERSONA": FilterSpec(
        "codigo_cliente", "string", _customer, S.MSG_UUID, stored=lambda v: (F.col(CUSTOMER_KEY), v), prepared=F.lower
    ),
    "LOCAL": _number("local", "bigint"),
    "FECHA_DESDE": FilterSpec("fecha", "timestamp_ntz", _instant, S.MSG_DATE, Column.__ge__, _month),
    "FECHA_HASTA": FilterSpec("fecha", "timestamp_ntz", _instant, S.MSG_DATE, Column.__le__, _month),
}
EQUALITIES = {name: spec for name, spec in FILTERS.items() if not spec.is_bound}
BOUNDS = {name: spec for name, spec in FILTERS.items() if spec.is_bound}


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def filter_name(c: Column) -> Column:
    return F.upper(stripped(c))


def accepted_value(name: Column, value: Column) -> Column:
    """The text of the value a filter stands for; NULL if the name or the text is refused."""
    text = stripped(value)
    result = F.lit(None).cast("string")
    for accepted in dict.fromkeys(spec.accepted for spec in FILTERS.values()):
        names = [which for which, spec in FILTERS.items() if spec.accepted is accepted]
        result = F.when(name.isin(*names), accepted(text)).otherwise(result)
    return result


def refusal(name: Column, value: Column) -> Column:
    """The message for a refused filter, NULL for an accepted one."""

    def message(template: str, *parts: Column) -> Column:
        holes = template.count("{}")
        return F.format_string(template.replace("%", "%%").replace("{}", "%s"), *parts[:holes])

    wrong = F.lit(None).cast("string")
    for which, spec in FILTERS.items():
        wrong = F.when(name == which, message(spec.message, value, F.lit(S.READABLE_NAMES[which]))).otherwise(wrong)
    unknown = F.when(~name.isin(*FILTERS), message(S.MSG_UNKNOWN_FILTER, name))
    return unknown.when(accepted_value(name, value).isNull(), wrong)


def _read(filters: Iterable[Filter]) -> list[tuple[FilterSpec, Column]]:
    """The specification of each filter and its value, by the expressions a table of requests is read by."""
    named = [(str(name).strip().upper(), str(value)) for name, value in filters]
    texts = [FILTERS[name].accepted(stripped(F.lit(value))) for name, value in named if name in FILTERS]
    accepted = iter(SparkSession.active().sql("VALUES (1)").select(F.array(*texts)).first()[0] if texts else [])
    out = []
    for name, value in named:
        spec = FILTERS.get(name)
        if spec is None:
            raise FilterError(S.MSG_UNKNOWN_FILTER.format(name))
        text = next(accepted)
        if text is None:
            raise FilterError(spec.message.format(value, S.READABLE_NAMES[name]))
        out.append((spec, F.lit(text)))
    return out


def filter_predicate(filters: Iterable[Filter], stored: bool = False) -> Column:
    """All filters joined by AND; no filter is TRUE. Raises before any data is read.

    ``stored`` says that the data has the further columns of the stored table.
    """
    parts: list[Column] = []
    for spec, value in _read(filters):
        parts.append(spec.compare(spec.prepared(F.col(spec.column)), spec.value(value)))
        if stored and spec.stored is not None:
            further, against = spec.stored(value)
            parts.append(spec.compare(further, against))
    return reduce(and_, parts) if parts else F.lit(True)


def apply_filters(df: DataFrame, filters: Iterable[Filter]) -> DataFrame:
    """Rows that satisfy every filter."""
    return df.where(filter_predicate(filters, stored={MONTH_COLUMN, CUSTOMER_KEY} <= set(df.columns)))
