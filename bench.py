"""Time the headline jobs once each and print one JSON line.

Every step writes its table, as a refresh would; later steps read what earlier
ones wrote. The raw claims tables are derived from the given tables first
(steps ``load_*``).
"""

import json
import os
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from medclaims.operators import dims, feeds, quality  # noqa: E402
from medclaims.plans import star  # noqa: E402
from medclaims.session import local_session  # noqa: E402
from medclaims.sources.shared_dir import shared_dir  # noqa: E402
from medclaims.sources.tables import TableStore  # noqa: E402

STEPS = {
    "load_beneficiary": star.BENEFICIARY_SUMMARY,
    "load_inpatient": star.INPATIENT_CLAIMS,
    "load_outpatient": star.OUTPATIENT_CLAIMS,
    "dim_date": star.DIM_DATE,
    "dim_patients": star.DIM_PATIENTS,
    "dim_providers": star.DIM_PROVIDERS,
    "dim_diagnoses": star.DIM_DIAGNOSES,
    "fact_claims": star.FACT_CLAIMS,
    "mart_monthly": star.MART_MONTHLY,
    "mart_diagnosis": star.MART_DIAGNOSIS,
    "mart_provider": star.MART_PROVIDER,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    store = TableStore(spark, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}")
    layers = star.DerivedLayers(store, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("session_warm_up", lambda: spark.range(1000).count())
    del seconds["session_warm_up"]
    for step, table in STEPS.items():
        timed(step, lambda table=table: layers.build(table))

    fact, patients = layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PATIENTS)
    timed("dq_all", lambda: quality.quality_checks(fact, patients).collect())
    timed("dq_orphan_patients", lambda: quality.quality_checks(fact, patients, [quality.ORPHANS]).collect())
    monthly, dates = layers.table(star.MART_MONTHLY), layers.table(star.DIM_DATE)
    timed("kpi_cards", lambda: feeds.kpi_cards(monthly, fact, dates).collect())
    timed("monthly_trend_inpatient", lambda: feeds.monthly_trend(monthly, fact, dates).collect())
    timed("top_diagnoses_cost", lambda: feeds.top_diagnoses(layers.table(star.MART_DIAGNOSIS)).collect())
    timed("dim_patients_latest", lambda: store.replace(
        "LATEST_PATIENTS", dims.dim_patients(layers.table(star.BENEFICIARY_SUMMARY), store, dedup="latest")))

    print(json.dumps({
        "metric": "build star schema, marts and quality checks",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
