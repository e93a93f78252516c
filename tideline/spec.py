"""Dataset declarations: what a table is called, how it is shaped, checked and laid out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.quality import Rule


@dataclass(frozen=True)
class Dataset:
    """A named table with its rules and physical layout.

    ``schema`` is the declared output (DDL text or StructType); ``generated`` maps a column to
    the SQL expression that fills it. ``partition_by`` gives directories, ``cluster_by`` the
    sort order inside them. ``inputs`` and ``properties`` are recorded in the event log.
    """

    name: str
    comment: str = ""
    schema: str | StructType | None = None
    generated: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    inputs: tuple[str, ...] = ()
    properties: Mapping[str, str] = field(default_factory=dict)

    def shape(self, df: DataFrame) -> DataFrame:
        """Add generated columns, then select and cast to the declared schema."""
        for name, expression in self.generated.items():
            df = df.withColumn(name, F.expr(expression))
        if self.schema is not None:
            declared = (self.schema if isinstance(self.schema, StructType)
                        else StructType.fromDDL(self.schema))
            self._require(declared.fieldNames(), df)
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                             for f in declared.fields])
        self._require(self.partition_by + self.cluster_by, df)
        return df

    def _require(self, wanted, df: DataFrame) -> None:
        missing = [name for name in wanted if name not in df.columns]
        if missing:
            raise ValueError(f"dataset {self.name}: no column {', '.join(missing)}")
