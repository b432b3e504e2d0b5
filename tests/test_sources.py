import os
import subprocess
import sys
from datetime import timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from medclaims import schemas
from medclaims.sources import csv_load, tpch_claims
from medclaims.sources.csv_copies import csv_copy
from medclaims.sources.shared_dir import CHECKPOINT_SETTING, shared_dir
from medclaims.sources.tables import TableStore


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


def _session(master, **conf):
    return SimpleNamespace(conf=_Conf(conf), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{id(conf)}"))


def test_the_named_folder_is_used_anywhere():
    for master in ("yarn", "local[4]"):
        assert shared_dir(_session(master, **{CHECKPOINT_SETTING: "hdfs:///tmp/shared/"})) == "hdfs:///tmp/shared"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_named_folder_is_refused(master):
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        shared_dir(_session(master))


def test_a_local_session_gets_one_folder_and_keeps_it():
    session = _session("local[2]")
    assert shared_dir(session) == shared_dir(session) != ""


def test_a_query_runs_in_a_session_without_any_settings(tmp_path):
    """Spark refuses to change ``spark.checkpoint.dir`` at run time, so nothing may try."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from medclaims.plans import star\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "layers = star.derived_layers(spark, '/root/testdata/sf0.001')\n"
        "print('days', layers.table(star.DIM_DATE).count())\n"
        "star.remove_layers(spark)\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "days 1096" in done.stdout, done.stderr[-2000:]


def test_append_creates_then_adds(spark, store):
    assert not store.exists("LOG")
    store.append("LOG", spark.range(2))
    store.append("LOG", spark.range(3))
    assert store.exists("LOG") and store.read("LOG").count() == 5


def test_partitioned_table_keeps_its_types(spark, store):
    df = spark.range(4).selectExpr("id", "if(id % 2 = 0, '01', '02') as kind")
    stored = store.replace("T", df, ["kind"])
    assert sorted((r.id, r.kind) for r in stored.collect()) == [(0, "01"), (1, "02"), (2, "01"), (3, "02")]
    assert sorted((r.id, r.kind) for r in store.replace("T", df.limit(0), ["kind"]).collect()) == []


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_a_reader_keeps_the_version_it_began_with(spark, store):
    store.replace("T", spark.range(3))
    before = store.read("T")
    store.replace("T", spark.range(10, 12))
    assert _ids(before) == [0, 1, 2] and _ids(store.read("T")) == [10, 11]


def test_a_failed_write_changes_nothing(spark, store):
    store.replace("T", spark.range(3))
    broken = spark.range(5).select(F.raise_error(F.lit("bad row")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="bad row"):
        store.replace("T", broken)
    assert _ids(store.read("T")) == [0, 1, 2]
    assert store.remove_old_versions(older_than=timedelta(0)) == 0  # nor does it leave files


def test_writers_that_meet_both_commit(spark, store, monkeypatch):
    """Another writer takes the next manifest number between our look and our commit."""
    other = TableStore(spark, store.root)
    taken = []
    look = store._manifest_numbers

    def look_then_lose():
        numbers = look()
        if not taken:
            taken.append(1)
            other.replace("B", spark.range(2))
        return numbers

    monkeypatch.setattr(store, "_manifest_numbers", look_then_lose)
    store.replace("A", spark.range(1))
    assert _ids(other.read("A")) == [0] and _ids(other.read("B")) == [0, 1]
    assert look() == [1, 2]


def test_two_writers_of_one_table_nest_nothing(spark, store):
    other = TableStore(spark, store.root)
    for writer, n in ((store, 2), (other, 3), (store, 4)):
        writer.replace("T", spark.range(n))
        assert store.read("T").count() == other.read("T").count() == n


def test_a_transaction_shows_its_tables_together(spark, store):
    reader = TableStore(spark, store.root)
    store.replace("PATIENTS", spark.range(1))
    store.replace("FACT", spark.range(1))
    with store.transaction():
        store.replace("PATIENTS", spark.range(2))
        assert store.read("PATIENTS").count() == 2  # the writer sees its own
        assert reader.read("PATIENTS").count() == reader.read("FACT").count() == 1
        store.replace("FACT", spark.range(2))
    assert reader.read("PATIENTS").count() == reader.read("FACT").count() == 2


def test_a_transaction_that_stops_between_two_tables_changes_none(spark, store):
    store.replace("PATIENTS", spark.range(1))
    store.replace("FACT", spark.range(1))
    with pytest.raises(RuntimeError), store.transaction():
        store.replace("PATIENTS", spark.range(2))
        raise RuntimeError("stopped")
    assert store.read("PATIENTS").count() == store.read("FACT").count() == 1
    assert store.remove_old_versions(older_than=timedelta(0)) == 0


def test_a_part_of_a_transaction_can_fail_alone(spark, store):
    with store.transaction():
        store.replace("A", spark.range(1))
        with pytest.raises(RuntimeError), store.transaction():
            store.replace("A", spark.range(2))
            store.replace("B", spark.range(2))
            raise RuntimeError("part")
        assert store.read("A").count() == 1 and not store.exists("B")
        with store.transaction():
            store.replace("C", spark.range(3))
    assert store.read("A").count() == 1 and not store.exists("B") and store.read("C").count() == 3


def test_old_versions_go_when_no_recent_manifest_names_them(spark, store):
    for n in range(1, 5):
        store.replace("T", spark.range(n))
    store.replace("U", spark.range(1))
    assert store.remove_old_versions() == 0  # all are too young
    assert store.remove_old_versions(keep=2, older_than=timedelta(0)) == 3
    assert store.read("T").count() == 4 and store.read("U").count() == 1
    store.replace("T", spark.range(7))
    assert store.read("T").count() == 7


def test_a_version_replaced_just_now_stays_however_old_it_is(spark, store):
    for n in (1, 2, 3, 4):
        folder = store.put("T", lambda path, n=n: spark.range(n).write.parquet(path))
        os.utime(folder, (1, 1))
    old = store.read("T")
    store.replace("T", spark.range(9))
    assert store.remove_old_versions(keep=1) == 0 and old.count() == 4
    assert store.remove_old_versions(keep=1, older_than=timedelta(0)) == 4 and store.read("T").count() == 9


def test_a_batch_is_appended_once(spark, store):
    assert store.append("LOG", spark.range(2), "run-1") and not store.append("LOG", spark.range(2), "run-1")
    assert store.append("LOG", spark.range(5, 6), "run-2") and store.append("LOG", spark.range(6, 7))
    assert _ids(store.read("LOG")) == _ids(store.read("LOG", spark.range(1).schema)) == [0, 1, 5, 6]
    assert store.read("LOG").columns == ["id"]


def test_a_failed_append_can_be_tried_again(spark, store):
    broken = spark.range(5).select(F.raise_error(F.lit("bad row")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="bad row"):
        store.append("LOG", broken, "run-1")
    assert not store.exists("LOG") or store.read("LOG", spark.range(1).schema).count() == 0
    store.append("LOG", spark.range(1), "run-1")
    assert _ids(store.read("LOG")) == [0]


def test_a_missing_table_is_named(store):
    with pytest.raises(FileNotFoundError, match="NONE"):
        store.read("NONE")


def test_customers_are_dealt_out_before_their_rows_grow_wide(spark, tmp_path):
    customers = spark.range(2 * tpch_claims.CUSTOMERS_PER_TASK + 1).selectExpr(
        "id as c_custkey", "cast(id % 25 as int) as c_nationkey", "cast(id as double) as c_acctbal"
    )
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = tpch_claims.beneficiary(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 3
    assert rows.count() == rows.distinct().count() == 3 * customers.count()


def test_no_customers(spark, store, tmp_path):
    spark.createDataFrame([], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    rows = tpch_claims.beneficiary(spark, str(tmp_path))
    folder = csv_copy(store, "BENEFICIARY_SUMMARY", rows)
    assert csv_load.read_beneficiary(spark, [folder])[0].count() == 0


def test_csv_copies_are_compressed_and_in_folders_of_years(spark, raw, store):
    rows = raw.beneficiary(
        [{"DESYNPUF_ID": f"B{i:015}", "src_year": year} for i in (2, 3) for year in (2008, 2010, None)], year_column=True
    )
    folder = Path(csv_copy(store, "BENEFICIARY_SUMMARY", rows))
    assert sorted(p.name for p in folder.iterdir() if p.is_dir()) == ["year=2008", "year=2010", "year=__HIVE_DEFAULT_PARTITION__"]
    assert list(folder.rglob("*.csv.snappy")) and not list(folder.rglob("*.csv"))
    good, rejected = csv_load.read_beneficiary(spark, [str(folder)])
    assert sorted(map(str, good.select(*schemas.BENEFICIARY.names, "src_year").collect())) == sorted(map(str, rows.collect()))
    assert rejected.count() == 0


def test_tables_and_scratch_are_written_compressed(spark, store):
    store.replace("t", spark.range(3))
    scratch = store.scratch("s", spark.range(3))
    for folder in (store.folder("t"), Path(scratch.inputFiles()[0].removeprefix("file:")).parent):
        files = list(Path(folder).glob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)
