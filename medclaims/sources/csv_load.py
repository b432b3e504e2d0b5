"""Raw CSV files (S1-S4): fixed schemas, bad rows set aside, never dropped."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medclaims import schemas

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
SOURCE_YEAR = "src_year"
REASON = "reject_reason"
WRONG_FIELDS = "wrong number of fields"
# in generated part names, where any four digits may stand
_UUID = "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
_YEAR = r"(?<![0-9A-Fa-f])((?:19|20)\d{2})(?![0-9A-Fa-f])"
# one list of files, or the files of each year
Paths = Sequence[str] | Mapping[int, Sequence[str]]
_BAD = "_bad"


def _rows(spark: SparkSession, paths: Sequence[str], texts: T.StructType, year: Column) -> DataFrame:
    files = (
        spark.read.schema(texts)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(list(paths))
    )
    return files.select(*texts.names, F.col("_metadata.file_name").alias(SOURCE_FILE), year.cast("int").alias(SOURCE_YEAR))


def _year_of_path() -> Column:
    """The year nearest the end of the path that no digit or hex letter touches."""
    path = F.regexp_replace("_metadata.file_path", _UUID, "")
    return F.try_element_at(F.regexp_extract_all(path, F.lit(_YEAR), F.lit(1)), F.lit(-1))


def load_csv(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    on_error: str = "continue",
    observed: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` rows of headed CSV files.

    A row is rejected when a value does not fit its type, a text is longer than
    declared or the number of fields is wrong. NULL alone is no sign of a bad
    row, since every raw column may be NULL. ``good`` is typed; ``rejected``
    keeps the texts as they came, and its ``reject_reason`` names the first faulty
    column. ``on_error="abort"`` makes the first bad row
    fail the job that reads ``good``. ``observed`` learns the number of
    ``rejected`` rows from the first job that reads ``good``.

    The file is read as text and cast here, because the reader checks the types
    of the selected columns only: a row would be good or bad depending on the
    query. The test below reads every column, so each row is judged as a whole.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError(f"on_error is 'continue' or 'abort', not {on_error!r}")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, CORRUPT]])
    given = paths.items() if isinstance(paths, Mapping) else [(None, paths)]
    rows = reduce(
        DataFrame.unionByName,
        [_rows(spark, some, texts, _year_of_path() if year is None else F.lit(year)) for year, some in given],
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    faults = [F.when(F.col(CORRUPT).isNotNull(), WRONG_FIELDS)]
    for field in schema.fields:
        text = F.col(field.name)
        if "max_length" in field.metadata:
            unfit = F.length(text) > field.metadata["max_length"]
        else:
            unfit = text.isNotNull() & typed[field.name].isNull()
        faults.append(F.when(unfit, field.name))
    reason = F.coalesce(*faults)
    bad = reason.isNotNull()
    if on_error == "abort":
        bad = F.when(bad, F.raise_error(F.concat(F.lit("bad row in "), SOURCE_FILE)).cast("boolean")).otherwise(False)
    judged = rows.withColumn(_BAD, bad)
    counted = judged if observed is None else judged.observe(observed, F.count_if(_BAD).alias("rejected"))
    good = counted.where(~F.col(_BAD)).select(*[column.alias(name) for name, column in typed.items()], SOURCE_FILE, SOURCE_YEAR)
    return good, judged.where(_BAD).drop(_BAD).withColumn(REASON, reason)


def load_result(name: str, good: DataFrame, rejected: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """For each file, or year, of a load: rows read, loaded and rejected, and the reason
    that most rejected rows give first (ties: the least)."""
    loaded = good.select(by, F.lit(None).cast("string").alias(REASON)).unionByName(rejected.select(by, REASON))
    by_reason = loaded.groupBy(by, REASON).agg(F.count("*").alias("rows"))
    is_bad = F.col(REASON).isNotNull()
    # the largest count first, then the least reason
    order = F.min(F.when(is_bad, F.struct((-F.col("rows")).alias("rows"), REASON)))
    return by_reason.groupBy(by).agg(
        F.sum("rows").alias("rows_read"),
        F.coalesce(F.sum(F.when(~is_bad, F.col("rows"))), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum(F.when(is_bad, F.col("rows"))), F.lit(0)).alias("rows_rejected"),
        order[REASON].alias("main_reason"),
    ).select(F.lit(name).alias("table_name"), by, "rows_read", "rows_loaded", "rows_rejected", "main_reason")


def read_beneficiary(
    spark: SparkSession,
    paths: Paths,
    on_error: str = "continue",
    observed: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The yearly beneficiary files as one table.

    ``src_year`` is the given year of the files (``{year: paths}``), or else the
    last year (19xx/20xx) in the path that no digit or hex letter touches, so
    that year folders work and generated part names give none; for the
    one-row-per-beneficiary variant of the patient dimension.
    """
    good, rejected = load_csv(spark, paths, schemas.BENEFICIARY, on_error, observed)
    return good.drop(SOURCE_FILE), rejected


def read_inpatient(
    spark: SparkSession,
    paths: Sequence[str],
    on_error: str = "continue",
    observed: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Inpatient claim segments."""
    good, rejected = load_csv(spark, paths, schemas.INPATIENT, on_error, observed)
    return good.drop(SOURCE_FILE, SOURCE_YEAR), rejected


def read_outpatient(
    spark: SparkSession,
    paths: Sequence[str],
    on_error: str = "continue",
    observed: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """S3: outpatient claim segments."""
    good, rejected = load_csv(spark, paths, schemas.OUTPATIENT, on_error, observed)
    return good.drop(SOURCE_FILE, SOURCE_YEAR), rejected
