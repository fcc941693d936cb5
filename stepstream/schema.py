"""Run-time row schemas: parallel lists of column names, type names and values."""

from __future__ import annotations

import dataclasses
import typing
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAP_COLUMN = "map"
MAP_ROW = T.StructType([T.StructField(MAP_COLUMN, T.MapType(T.StringType(), T.StringType()))])

# The Spark type that stands for each Python annotation of a record.
RECORD_TYPES = {str: "string", int: "bigint", float: "double", bool: "boolean", bytes: "binary"}


@dataclasses.dataclass(frozen=True)
class StepSchema:
    """Column names, Spark type names and default values, in declared order.

    Values are text, as in a string-map row; ``None`` stands for NULL. A type is
    any name that Spark's DDL accepts (``Integer``, ``Decimal(10,2)``, ...).
    """

    names: Sequence[str]
    types: Sequence[str]
    values: Sequence[str | None] | None = None

    def __post_init__(self):
        names, types = tuple(self.names), tuple(self.types)
        values = (None,) * len(names) if self.values is None else tuple(self.values)
        if not names:
            raise ValueError("a step schema needs at least one column")
        if not len(names) == len(types) == len(values):
            raise ValueError(
                f"unequal lengths: {len(names)} names, {len(types)} types, {len(values)} values"
            )
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"duplicate column names: {', '.join(repeated)}")
        object.__setattr__(self, "names", names)
        object.__setattr__(self, "types", types)
        object.__setattr__(self, "values", values)

    @classmethod
    def from_record(cls, record: type, values: Sequence[str | None] | None = None) -> StepSchema:
        """Schema of a dataclass; ``X | None`` counts as ``X``, as all columns are nullable."""
        hints = typing.get_type_hints(record)
        fields = [f.name for f in dataclasses.fields(record)]
        kinds = []
        for name in fields:
            options = [a for a in typing.get_args(hints[name]) if a is not type(None)]
            kind = options[0] if options else hints[name]
            if kind not in RECORD_TYPES:
                raise TypeError(f"no Spark type for field {name}: {hints[name]}")
            kinds.append(RECORD_TYPES[kind])
        return cls(fields, kinds, values)

    def struct_type(self) -> T.StructType:
        """Nullable ``StructType`` in declared order (needs an active session to parse types)."""
        return T.StructType(
            [T.StructField(n, T.DataType.fromDDL(t)) for n, t in zip(self.names, self.types)]
        )

    def row_map(self, values: Sequence[str | None] | None = None) -> dict[str, str | None]:
        """One string-map row; trailing columns without a value are left out and read as NULL."""
        given = self.values if values is None else tuple(values)
        if len(given) > len(self.names):
            raise ValueError(f"{len(given)} values for {len(self.names)} columns")
        return dict(zip(self.names, given))

    def map_column(self) -> Column:
        """The default row as a literal ``MAP<STRING, STRING>`` column."""
        return F.map_from_arrays(
            F.array(*[F.lit(n) for n in self.names]),
            F.array(*[F.lit(v).cast("string") for v in self.values]),
        )

    def default_columns(self, mode: str = "permissive") -> list[Column]:
        """The default row as typed literal columns."""
        return [
            convert(F.lit(v).cast("string"), t, mode).alias(n)
            for n, t, v in zip(self.names, self.types, self.values)
        ]


def convert(column: Column, type_name: str, mode: str) -> Column:
    """Text to a typed value: ``permissive`` gives NULL where it does not parse, ``strict`` casts."""
    if mode == "permissive":
        return column.try_cast(type_name)
    if mode == "strict":
        return column.cast(type_name)
    raise ValueError(f"mode must be 'permissive' or 'strict', not {mode!r}")
