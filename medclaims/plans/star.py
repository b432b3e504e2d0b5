"""The stored layers: raw tables, star schema and marts, each built once."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medclaims.operators import dims, fact, marts
from medclaims.operators.keys import identity_of
from medclaims.sources import tpch_claims
from medclaims.sources.shared_dir import shared_dir
from medclaims.sources.tables import TableStore

BENEFICIARY_SUMMARY = "BENEFICIARY_SUMMARY"
INPATIENT_CLAIMS = "INPATIENT_CLAIMS"
OUTPATIENT_CLAIMS = "OUTPATIENT_CLAIMS"
DIM_DATE = "DIM_DATE"
DIM_PATIENTS = "DIM_PATIENTS"
DIM_PROVIDERS = "DIM_PROVIDERS"
DIM_DIAGNOSES = "DIM_DIAGNOSES"
FACT_CLAIMS = "FACT_CLAIMS"
MART_MONTHLY = "MART_MONTHLY_CLAIMS_SUMMARY"
MART_DIAGNOSIS = "MART_DIAGNOSIS_SUMMARY"
MART_PROVIDER = "MART_PROVIDER_PERFORMANCE"

RAW_TABLES = [BENEFICIARY_SUMMARY, INPATIENT_CLAIMS, OUTPATIENT_CLAIMS]
STAR_TABLES = [DIM_DATE, DIM_PATIENTS, DIM_PROVIDERS, DIM_DIAGNOSES, FACT_CLAIMS]
MART_TABLES = [MART_MONTHLY, MART_DIAGNOSIS, MART_PROVIDER]

# dimension -> its surrogate key; the keys given so far are kept beside it over reloads
KEY_OF = {DIM_PATIENTS: "patient_key", DIM_PROVIDERS: "provider_key", DIM_DIAGNOSES: "diagnosis_key"}
# the fact is stored by claim type, the one literal filter of the marts
PARTITIONED_BY = {FACT_CLAIMS: ["claim_type"]}


class Layers:
    """Builds tables of a store on first use, from raw tables to marts.

    Every table is written before the next layer reads it: joins are planned
    from real sizes, skewed joins can be split (no operator depends on their
    partitioning), nothing is computed twice and lost executors cost one table
    at most.
    """

    def __init__(self, store: TableStore, dedup: str = "literal"):
        self.store = store
        self.dedup = dedup
        self.spark = store.spark
        self._built: dict[str, DataFrame] = {}
        self._known: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The stored table; built now if it does not exist yet."""
        if name not in self._built and not self.store.exists(name):
            self.build(name)
        df = self._built[name] if name in self._built else self.store.read(name)
        return df.select(*fact.FACT_COLUMNS) if name == FACT_CLAIMS else df

    def build(self, name: str) -> None:
        """(Re)write one table from the layer below; a dimension together with its keys."""
        with self.store.scope(), self.store.transaction():
            df = self.builders()[name]()
            stored = self.store.replace(name, df, PARTITIONED_BY.get(name, ()))
            known = self._known.pop(name, None)
            if known is not None:
                given = known.unionByName(self._keys_of(name, stored)).distinct()
                self.store.replace(f"{name}_KEYS", given)
        self._built[name] = stored

    def _keys_of(self, name: str, table: DataFrame) -> DataFrame:
        """(identity, key) of a dimension's rows; the least key where rows of another variant share an identity."""
        key = KEY_OF[name]
        identity = identity_of(dims.identity_columns(key, table.columns, self.dedup))
        return table.groupBy(identity.alias("identity")).agg(F.min(key).alias(key))

    def known_keys(self, name: str) -> DataFrame | None:
        """All keys a dimension has given to its rows so far; None before its first build.

        A first build writes no list of keys: the table is the list until it is reloaded.
        """
        keys = f"{name}_KEYS"
        if self.store.exists(keys):
            self._known[name] = self.store.read(keys)
        elif self.store.exists(name):
            self._known[name] = self._keys_of(name, self.store.read(name))
        return self._known.get(name)

    def builders(self) -> dict[str, Callable[[], DataFrame]]:
        table = self.table
        return {
            DIM_DATE: lambda: dims.dim_date(self.spark).coalesce(1),
            DIM_PATIENTS: lambda: dims.dim_patients(
                table(BENEFICIARY_SUMMARY), self.store, self.dedup, self.known_keys(DIM_PATIENTS)
            ),
            DIM_PROVIDERS: lambda: dims.dim_providers(
                table(INPATIENT_CLAIMS), table(OUTPATIENT_CLAIMS), self.store, self.known_keys(DIM_PROVIDERS)
            ),
            DIM_DIAGNOSES: lambda: dims.dim_diagnoses(
                table(INPATIENT_CLAIMS), table(OUTPATIENT_CLAIMS), self.store, self.known_keys(DIM_DIAGNOSES)
            ),
            FACT_CLAIMS: lambda: fact.fact_claims(
                table(INPATIENT_CLAIMS), table(OUTPATIENT_CLAIMS), self.dimensions(), self.store
            ),
            MART_MONTHLY: lambda: marts.mart_monthly(
                table(FACT_CLAIMS), table(DIM_DATE), table(DIM_DIAGNOSES)
            ),
            MART_DIAGNOSIS: lambda: marts.mart_diagnosis(
                table(FACT_CLAIMS), table(DIM_DIAGNOSES), self.store
            ),
            MART_PROVIDER: lambda: marts.mart_provider(
                table(FACT_CLAIMS), table(DIM_PROVIDERS), self.store
            ),
        }

    def dimensions(self) -> fact.Dimensions:
        return fact.Dimensions(
            self.table(DIM_PATIENTS), self.table(DIM_PROVIDERS), self.table(DIM_DIAGNOSES)
        )


class DerivedLayers(Layers):
    """Layers whose raw tables are derived from customer, orders and lineitem."""

    def __init__(self, store: TableStore, sf_dir: str):
        super().__init__(store)
        self.sf_dir = sf_dir

    def builders(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            BENEFICIARY_SUMMARY: lambda: tpch_claims.beneficiary(self.spark, self.sf_dir),
            INPATIENT_CLAIMS: lambda: tpch_claims.inpatient(self.spark, self.sf_dir),
            OUTPATIENT_CLAIMS: lambda: tpch_claims.outpatient(self.spark, self.sf_dir),
            **super().builders(),
        }


class LatestLayers(Layers):
    """Layers with one row per beneficiary, hence one per claim; what does not
    depend on patients is read from ``base``."""

    def __init__(self, base: Layers):
        super().__init__(TableStore(base.spark, base.store.path("latest")), dedup="latest")
        self.base = base

    def table(self, name: str) -> DataFrame:
        own = name in (DIM_PATIENTS, FACT_CLAIMS, *MART_TABLES)
        return super().table(name) if own else self.base.table(name)


def _input_version(store: TableStore, sf_dir: str) -> str:
    """Changes when an input table is rewritten: sizes and times from the file system."""
    parts = [sf_dir]
    for name in ("customer", "orders", "lineitem"):
        size, time = store.version_of(f"{sf_dir}/{name}.parquet")
        parts.append(f"{size}:{time}")
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


def derived_layers(spark: SparkSession, sf_dir: str) -> DerivedLayers:
    """Layers over one data folder, kept in the shared folder for this application."""
    root = TableStore(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    return DerivedLayers(TableStore(spark, root.path(_input_version(root, sf_dir))), sf_dir)


def remove_layers(spark: SparkSession) -> None:
    """Delete what this application's queries stored, once their results are read."""
    TableStore(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}").remove()
