"""Headed CSV copies of the raw tables, some rows made unfit, to load again.

Beneficiaries go to a folder for each year. The files are compressed, for as text
the rows take many times the room they take in their table.

Fixed faults: every 50th beneficiary has an over-long county, every 97th
inpatient claim a payment that is no number, every 89th outpatient claim an
over-long provider.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims import schemas
from medclaims.sources.tables import TableStore

FAULTS = {
    "BENEFICIARY_SUMMARY": ("BENE_COUNTY_CD", "cast(substr(DESYNPUF_ID, 2) as bigint) % 50 = 1", "1000"),
    "INPATIENT_CLAIMS": ("CLM_PMT_AMT", "CLM_ID % 97 = 0", "n/a"),
    "OUTPATIENT_CLAIMS": ("PRVDR_NUM", "CLM_ID % 89 = 0", "0000000"),
}


# the folder Spark gives to rows without a value
_NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


def _write(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).option("compression", "snappy").csv(path)


def csv_copy(store: TableStore, name: str, table: DataFrame) -> str:
    """The folder of a table's CSV copy; written on first use."""
    folder = f"csv/{name}"
    if not store.exists(folder):
        column, faulty, text = FAULTS[name]
        texts = {c: F.col(c).cast("string") for c in schemas.RAW[name].names}
        texts[column] = F.when(F.expr(faulty), F.lit(text)).otherwise(texts[column])
        rows = table.select(*[value.alias(c) for c, value in texts.items()], *[c for c in ["src_year"] if c in table.columns])

        def write(path: str) -> None:
            if "src_year" not in rows.columns:
                _write(rows, path)
                return
            # year by year, since one write into several folders sorts each task's rows by their folder
            years = [row["src_year"] for row in table.select("src_year").distinct().collect()]
            for year in years:
                of_year = rows.where(F.col("src_year").eqNullSafe(F.lit(year))).drop("src_year")
                _write(of_year, f"{path}/year={_NO_YEAR if year is None else year}")
            if not years:
                _write(rows.drop("src_year"), path)

        store.put(folder, write)
    return store.folder(folder)
