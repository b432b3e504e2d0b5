"""Time each build step against the same step written the plain way, in alternating pairs.

The plain way is the statement as one would type it: DISTINCT, a full outer join, eight unions,
look-ups before the grouping, ROW_NUMBER windows, one statement a check; identity columns
are row numbers without an order. Both sides read stored tables and write Parquet. Prints one
JSON line: step -> [plain seconds, our seconds] medians, and whether both gave as many rows.

``python probes.py [pairs]``, with ``BENCH_SF_DIR`` and ``BENCH_CPUS`` as for ``bench.py``;
``PROBE_BROADCAST=off`` plans all joins as shuffled ones.
"""

import json
import os
import statistics
import sys
import time
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.functions import labels
from medclaims.operators import dims, fact, marts
from medclaims.plans import star
from medclaims.session import local_session


def with_identity(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.monotonically_increasing_id() + 1)


def plain_patients(t) -> DataFrame:
    people = t(star.BENEFICIARY_SUMMARY)
    return with_identity(people.select(*dims.patient_attributes(people)).distinct(), "patient_key")


def plain_providers(t) -> DataFrame:
    def side(name: str, prefix: str) -> DataFrame:
        return t(name).where("PRVDR_NUM IS NOT NULL").groupBy(F.col("PRVDR_NUM").alias(f"{prefix}_id")).agg(
            F.count("*").alias(f"{prefix}_n"), F.sum("CLM_PMT_AMT").alias(f"{prefix}_paid"))

    both = side(star.INPATIENT_CLAIMS, "ip").join(side(star.OUTPATIENT_CLAIMS, "op"), F.col("ip_id") == F.col("op_id"), "full_outer")
    claims = F.coalesce("ip_n", F.lit(0)) + F.coalesce("op_n", F.lit(0))
    paid = F.coalesce("ip_paid", F.lit(0)) + F.coalesce("op_paid", F.lit(0))
    return with_identity(both.select(F.coalesce("ip_id", "op_id").alias("provider_id"), claims.alias("claims"), paid.alias("paid"), (paid / claims).alias("mean")), "provider_key")


def plain_diagnoses(t) -> DataFrame:
    codes = None
    for name, columns in ((star.INPATIENT_CLAIMS, V.INPATIENT_CODE_COLUMNS), (star.OUTPATIENT_CLAIMS, V.OUTPATIENT_CODE_COLUMNS)):
        for column in columns:
            some = t(name).select(F.col(column).alias("icd9_code")).where("icd9_code IS NOT NULL").distinct()
            codes = some if codes is None else codes.union(some).distinct()
    return with_identity(codes.select("icd9_code", labels.diagnosis_text("icd9_code"), labels.diagnosis_category("icd9_code")), "diagnosis_key")


def plain_fact(t) -> DataFrame:
    keys = fact.Dimensions(t(star.DIM_PATIENTS), t(star.DIM_PROVIDERS), t(star.DIM_DIAGNOSES))

    def side(name: str, kind: str, measures: dict[str, str]) -> DataFrame:
        rows = t(name)
        for column, found in zip(fact.ID_COLUMNS, (keys.patients, keys.providers, keys.diagnoses)):
            rows = rows.join(found, column, "left")
        rows = rows.groupBy("CLM_ID", *fact.KEY_COLUMNS).agg(
            *[F.max(raw).alias(name) for name, raw in measures.items()], F.countDistinct("SEGMENT").alias("segment_count"))
        values = {c: F.col(c) for c in rows.columns} | {"claim_id": F.col("CLM_ID"), "claim_type": F.lit(kind)}
        return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fact.FACT_SCHEMA.fields])

    both = side(star.INPATIENT_CLAIMS, V.INPATIENT, fact.INPATIENT_MEASURES).union(side(star.OUTPATIENT_CLAIMS, V.OUTPATIENT, fact.OUTPATIENT_MEASURES))
    return with_identity(both, "claim_key")


def our_fact_rows(t) -> DataFrame:
    keys = fact.Dimensions(t(star.DIM_PATIENTS), t(star.DIM_PROVIDERS), t(star.DIM_DIAGNOSES))
    both = fact.fact_inpatient(t(star.INPATIENT_CLAIMS), keys).union(fact.fact_outpatient(t(star.OUTPATIENT_CLAIMS), keys))
    return with_identity(both, "claim_key")


def _ranked(mart: DataFrame, ranks: dict[str, str], tie: str, *groups: str) -> DataFrame:
    for name, measure in ranks.items():
        window = Window.partitionBy(*groups).orderBy(F.col(measure).desc_nulls_first(), F.col(tie))
        mart = mart.withColumn(name, F.row_number().over(window))
    return mart


def plain_mart_diagnosis(t) -> DataFrame:
    mart = marts.mart_diagnosis_etl(t(star.FACT_CLAIMS), t(star.DIM_DIAGNOSES))
    return _ranked(mart, {"rank_by_cost": "total_paid", "rank_by_volume": "claim_count"}, "icd9_code", "claim_type")


def plain_mart_provider(t) -> DataFrame:
    mart = marts.mart_provider_etl(t(star.FACT_CLAIMS), t(star.DIM_PROVIDERS))
    return _ranked(mart, {"revenue_rank": "total_revenue", "volume_rank": "total_claims"}, "provider_id")


def main() -> None:
    pairs = int(sys.argv[1]) if len(sys.argv) > 1 else 3
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "probes")
    layers = star.derived_layers(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    t, store = layers.table, layers.store
    for name in [*star.RAW_TABLES, *star.STAR_TABLES]:
        t(name)
    if os.environ.get("PROBE_BROADCAST") == "off":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ip, op = t(star.INPATIENT_CLAIMS), t(star.OUTPATIENT_CLAIMS)
    steps = {
        "dim_patients": (plain_patients, lambda t: dims.dim_patients(t(star.BENEFICIARY_SUMMARY), store)),
        "dim_providers": (plain_providers, lambda t: dims.dim_providers(ip, op, store)),
        "dim_diagnoses": (plain_diagnoses, lambda t: dims.dim_diagnoses(ip, op, store)),
        "fact_rows": (plain_fact, our_fact_rows),
        "fact_claims": (plain_fact, lambda t: fact.fact_claims(ip, op, layers.dimensions(), store)),
        "mart_diagnosis": (plain_mart_diagnosis, lambda t: marts.mart_diagnosis(t(star.FACT_CLAIMS), t(star.DIM_DIAGNOSES), store)),
        "mart_provider": (plain_mart_provider, lambda t: marts.mart_provider(t(star.FACT_CLAIMS), t(star.DIM_PROVIDERS), store)),
    }

    def timed(build) -> tuple[float, int]:
        path, start = f"{store.root}/probe-{uuid.uuid4().hex}", time.perf_counter()
        with store.scope():
            build(t).write.parquet(path)
        seconds = time.perf_counter() - start
        rows = spark.read.parquet(path).count()
        store.remove_path(path)
        return seconds, rows

    found = {}
    for name, sides in steps.items():
        timed(sides[0]), timed(sides[1])  # compiled once
        runs = [[timed(side) for side in sides] for _ in range(pairs)]
        same = len({rows for pair in runs for _, rows in pair}) == 1
        found[name] = [round(statistics.median(pair[i][0] for pair in runs), 2) for i in (0, 1)] + [same]
    star.remove_layers(spark)
    print(json.dumps(found))


if __name__ == "__main__":
    main()
