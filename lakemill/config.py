"""Run parameters and table naming."""

from __future__ import annotations

from dataclasses import dataclass

WRITE_MODES = ("overwrite", "append")


def qualified(*parts: str) -> str:
    """Join the non-empty parts of a table or schema name, catalog first."""
    return ".".join(part for part in parts if part)


@dataclass(frozen=True)
class RetailRun:
    """Parameters of one bronze, silver, gold (and optionally quality) run.

    ``bronze_mode="append"`` with ``dedupe_sales=False`` keeps every load of the
    sales files, so ingesting the same files twice doubles revenue; either switch
    makes a re-run harmless.
    """

    landing: str
    catalog: str = ""
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    table_format: str = "parquet"
    bronze_mode: str = "append"
    infer_schema: bool = False
    dedupe_sales: bool = False
    run_quality: bool = False

    def __post_init__(self) -> None:
        if self.bronze_mode not in WRITE_MODES:
            raise ValueError(f"bronze_mode must be one of {WRITE_MODES}, not {self.bronze_mode!r}")

    def schema_of(self, layer: str) -> str:
        return qualified(self.catalog, getattr(self, layer))

    def table(self, layer: str, name: str) -> str:
        return qualified(self.schema_of(layer), name)

    @property
    def results_table(self) -> str:
        return self.table("silver", "dq_results")


@dataclass(frozen=True)
class MissionRun:
    """Parameters of one load of flat mission rows into an external table."""

    parquet_path: str
    root_path: str
    catalog: str = ""
    schema: str = "missions"
    table: str = "missions_people"
    mode: str = "overwrite"
    table_format: str = "parquet"
    trim_names: bool = False

    def __post_init__(self) -> None:
        for name in ("parquet_path", "root_path", "catalog", "schema", "table"):
            object.__setattr__(self, name, getattr(self, name).strip())
        object.__setattr__(self, "root_path", self.root_path.rstrip("/"))
        object.__setattr__(self, "mode", self.mode.strip().lower())
        if self.mode not in WRITE_MODES:
            raise ValueError(f"mode must be one of {WRITE_MODES}, not {self.mode!r}")

    @property
    def full_schema(self) -> str:
        return qualified(self.catalog, self.schema)

    @property
    def full_table(self) -> str:
        return qualified(self.full_schema, self.table)

    @property
    def storage_path(self) -> str:
        return f"{self.root_path}/{self.table}"

    @property
    def curated_view(self) -> str:
        return qualified(self.full_schema, f"vw_{self.table}")

    @property
    def quality_view(self) -> str:
        return qualified(self.full_schema, f"vw_{self.table}_quality")
