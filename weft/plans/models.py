"""A registry of models: named plans over tables, each built from sources and other models.

Views stay plans and are inlined by the optimizer where they are used; tables can be written sorted by their key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[["Project"], DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    build: Build
    materialized: str = "view"
    order_by: tuple[str, ...] = ()


@dataclass
class Project:
    """Models by name, resolved when asked for; a cycle is an error."""

    spark: SparkSession
    source: Callable[[str], DataFrame]
    models: dict[str, Model] = field(default_factory=dict)
    _open: list[str] = field(default_factory=list)
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def add(self, *models: Model) -> "Project":
        self.models |= {m.name: m for m in models}
        return self

    def ref(self, name: str) -> DataFrame:
        if name in self._open:
            raise ValueError("models refer to each other in a circle: " + " -> ".join([*self._open, name]))
        if name not in self._built:
            self._open.append(name)
            try:
                self._built[name] = self.models[name].build(self)
            finally:
                self._open.pop()
        return self._built[name]

    def publish(self, names: list[str] | None = None, *, partitions: int | None = None) -> list[str]:
        """Views as temporary views, tables as saved tables in global order of their key."""
        done = []
        for name in names or list(self.models):
            m, df = self.models[name], self.ref(name)
            if m.materialized == "view":
                df.createOrReplaceTempView(name)
            else:
                if m.order_by:
                    n = [partitions] if partitions else []
                    df = df.repartitionByRange(*n, *m.order_by).sortWithinPartitions(*m.order_by)
                df.write.mode("overwrite").saveAsTable(name)
            done.append(name)
        return done


CAPACITY = [
    "catchment_population", "number_of_inpatient_beds", "number_of_maternity_beds", "number_of_emergency_beds", "number_of_opd_rooms", "number_of_ipd_rooms",
    "number_of_laboratory_rooms", "number_of_imaging_rooms", "number_of_mch_rooms", "number_of_icu_rooms",
]


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named columns, under their new names."""
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def fact_facility_capacity(p: Project) -> DataFrame:
    """Each facility with its capacity and what it is linked to: its own reference first, then the judged link."""
    m, k = p.ref("stg_mfr_facilities"), p.ref("stg_facility_linkage")
    own, judged = F.nullif(F.col("existing_dhis2_id"), F.lit("")), F.col("llm_dhis2_uid")
    status = F.when(own.isNotNull(), "linked_original").when(judged.isNotNull(), "linked_llm").otherwise("unlinked")
    return m.join(k, "mfr_id", "left").select(
        "mfr_id", "facility_name", "facility_type", "ownership", "region", "zone", "woreda", *CAPACITY,
        F.coalesce(own, judged).alias("dhis2_uid"), status.alias("linkage_status"), "llm_confidence", "llm_reason",
    )


def star_schema(spark: SparkSession, source: Callable[[str], DataFrame]) -> Project:
    """Staging views, the three dimensions and the capacity fact."""
    dim = lambda cols, known: lambda p: p.ref("stg_mfr_facilities").where(F.col(known).isNotNull()).select(*cols).distinct()
    return Project(spark, source).add(
        Model("stg_mfr_facilities", lambda p: p.source("stg_mfr_facilities")),
        Model("stg_dhis2_facilities", lambda p: p.source("stg_dhis2_facilities")),
        Model("stg_facility_linkage", lambda p: renamed(p.source("facility_linkage"), {"mfr_id": "mfr_id", "dhis2_uid": "llm_dhis2_uid", "confidence": "llm_confidence", "reason": "llm_reason"})),
        Model("dim_region", dim(["region"], "region"), "table", ("region",)),
        Model("dim_ownership_type", dim(["ownership"], "ownership"), "table", ("ownership",)),
        Model("dim_zone_woreda", dim(["region", "zone", "woreda"], "zone"), "table", ("region", "zone", "woreda")),
        Model("fact_facility_capacity", fact_facility_capacity, "table", ("mfr_id",)),
    )
