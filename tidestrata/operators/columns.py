"""Finding and flattening columns of varying layouts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def spellings(path: str) -> tuple[str, str]:
    """A nested field's flat names: dotted, and with double underscores."""
    return path, path.replace(".", "__")


def first_present(columns: Sequence[str], candidates: Iterable[str]) -> str | None:
    present = set(columns)
    return next((name for name in candidates if name in present), None)


def missing(columns: Sequence[str], wanted: Iterable[str]) -> list[str]:
    return sorted(set(wanted) - set(columns))


def leaves(schema: StructType, trail: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*trail, field.name)
        if isinstance(field.dataType, StructType):
            yield from leaves(field.dataType, here)
        else:
            yield here


def flatten(frame: DataFrame) -> DataFrame:
    """Every struct field as a column with a dotted name; arrays stay whole."""
    chosen = []
    for head, *rest in leaves(frame.schema):
        value = quoted(head)
        for name in rest:
            value = value.getField(name)
        chosen.append(value.alias(".".join((head, *rest))))
    return frame.select(*chosen)
