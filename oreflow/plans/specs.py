"""What the tables look like and where they live."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from oreflow.schemas import BRONZE_COLUMNS, GOLD_COLUMNS, SILVER_COLUMNS
from oreflow.session import FILE_SETTINGS


_DAYS = re.compile(r"days\((\w+)\)")
_DAY_SUFFIX = "_day"


@dataclass(frozen=True)
class TableSpec:
    """A table by name: its columns, layout and place.

    A partition field is a column, or ``days(column)`` for the day of a timestamp.  Iceberg knows the
    latter; other formats get a date column of their own for it, which readers of the table's
    columns never see.

    ``retired_partitions`` are partition fields of earlier layouts which a table may still
    have; only Iceberg can drop them in place.  ``key`` names the columns that tell one row
    from every other, where there are such.
    """

    name: str
    columns: Mapping[str, str]
    partition_by: tuple[str, ...] = ("ticker",)
    format: str = "parquet"
    location: str | None = None
    namespace_location: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    retired_partitions: tuple[str, ...] = ()
    key: tuple[str, ...] = ()

    @property
    def namespace(self) -> str:
        return self.name.rpartition(".")[0]

    @property
    def is_iceberg(self) -> bool:
        return self.format == "iceberg"

    @property
    def file_options(self) -> dict[str, str]:
        """Options of a stream that writes the table's files, as ``FILE_SETTINGS`` are those of a batch."""
        return {"compression": FILE_SETTINGS["spark.sql.parquet.compression.codec"]} if self.format == "parquet" else {}

    @property
    def day_columns(self) -> dict[str, str]:
        """Date columns kept for ``days(...)`` partition fields, with the timestamps they are the days of."""
        found = {} if self.is_iceberg else {name: _DAYS.fullmatch(name) for name in self.partition_by}
        return {f"{m.group(1)}{_DAY_SUFFIX}": m.group(1) for m in found.values() if m}

    @property
    def partition_columns(self) -> tuple[str, ...]:
        """The columns that name the folders of a partition."""
        days = {f"days({source})": name for name, source in self.day_columns.items()}
        return tuple(days.get(name, name) for name in self.partition_by)

    def partition_field(self, column: str) -> str:
        """The partition field that a folder column stands for."""
        source = column.removesuffix(_DAY_SUFFIX)
        return f"days({source})" if column not in self.columns and source in self.columns else column


@dataclass(frozen=True)
class Warehouse:
    """The three layers below one root, each in a namespace and folder of its own.

    ``roots`` places a layer elsewhere, such as in a bucket of its own; ``suffix`` sets the
    namespaces of one run apart from those of another.  ``generation`` counts how often the state of
    the silver stream was laid out anew (``repartition_state``); each has checkpoints of its own and, where a
    folder takes the files of one checkpoint only, a silver table of its own.
    """

    root: str
    format: str = "parquet"
    catalog: str | None = None
    suffix: str = ""
    checkpoints: str | None = None
    roots: Mapping[str, str] = field(default_factory=dict)
    generation: int = 1

    def folder(self, layer: str) -> str:
        return self.roots.get(layer, f"{self.root.rstrip('/')}/{layer}").rstrip("/")

    def checkpoint(self, job: str) -> str:
        """Where a job keeps its progress.  Use a new name when its grouping changes."""
        base = self.checkpoints or f"{self.folder(job.partition('_')[0])}/checkpoints"
        later = self.generation > 1 and not job.startswith("bronze")
        return f"{base.rstrip('/')}/{job}{f'_g{self.generation}' if later else ''}"

    def _spec(self, layer: str, table: str, columns: Mapping[str, str], **more: tuple[str, ...]) -> TableSpec:
        namespace = ".".join(filter(None, (self.catalog, f"{layer}{self.suffix}")))
        location = f"{self.folder(layer)}/{table}"
        iceberg = {"format-version": "2", "write.data.path": f"{location}/data"}
        return TableSpec(
            name=f"{namespace}.{table}",
            columns=columns,
            format=self.format,
            location=location,
            namespace_location=self.folder(layer),
            properties=iceberg if self.format == "iceberg" else {},
            **more,
        )

    @property
    def bronze(self) -> TableSpec:
        return self._spec("bronze", "trades", BRONZE_COLUMNS, retired_partitions=("days(ingest_timestamp)",))

    @property
    def silver(self) -> TableSpec:
        later = self.generation > 1 and self.format != "iceberg"
        table = f"trades_g{self.generation}" if later else "trades"
        return self._spec("silver", table, SILVER_COLUMNS, retired_partitions=("days(trade_timestamp)",), key=("trade_id",))

    @property
    def silver_tables(self) -> list[TableSpec]:
        """The tables that hold the trades of all generations, oldest first."""
        specs = [replace(self, generation=g).silver for g in range(1, self.generation + 1)]
        return specs[-1:] if self.format == "iceberg" else specs

    @property
    def gold(self) -> TableSpec:
        return self._spec("gold", "portfolio_positions", GOLD_COLUMNS, key=("portfolio_id", "ticker"))
