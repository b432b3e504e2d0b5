import pytest

from medclaims import schemas
from medclaims.sources import csv_load

WIDTH = len(schemas.OUTPATIENT.names)
AMOUNT = schemas.OUTPATIENT.names.index("CLM_PMT_AMT")
PROVIDER = schemas.OUTPATIENT.names.index("PRVDR_NUM")


def _row(**by_position):
    fields = [""] * WIDTH
    fields[:5] = ["00013D2EFD8E45D1", "542192281063886", "1", "20080904", "20080904"]
    fields[AMOUNT], fields[PROVIDER] = "50.00", "001234"
    for position, value in by_position.items():
        fields[int(position[1:])] = value
    return ",".join(fields)


def _write(folder, name, lines, names=schemas.OUTPATIENT.names):
    path = folder / name
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    return str(path)


def test_good_rows_keep_zeros_and_blanks(spark, tmp_path):
    good, rejected = csv_load.read_outpatient(spark, [_write(tmp_path, "o.csv", [_row()])])
    [row] = good.collect()
    assert row.PRVDR_NUM == "001234" and row.DESYNPUF_ID == "00013D2EFD8E45D1"
    assert str(row.CLM_PMT_AMT) == "50.00" and row.ICD9_DGNS_CD_1 is None and row.NCH_BENE_PTB_DDCTBL_AMT is None
    assert good.columns == schemas.OUTPATIENT.names and rejected.count() == 0


def test_header_only(spark, tmp_path):
    good, rejected = csv_load.read_outpatient(spark, [_write(tmp_path, "o.csv", [])])
    assert good.count() == 0 and rejected.count() == 0


def test_bad_rows_are_set_aside_whatever_is_selected(spark, tmp_path):
    lines = [
        _row(),
        _row(**{f"_{AMOUNT}": "fifty"}),
        ",".join(_row().split(",")[:-2]),
        _row() + ",extra",
        _row(**{f"_{PROVIDER}": "1234567"}),
        _row(),
    ]
    good, rejected = csv_load.read_outpatient(spark, [_write(tmp_path, "o.csv", lines)])
    assert good.count() == 2 and len(good.collect()) == 2
    assert good.select("CLM_ID").count() == 2 and good.select("CLM_ID").collect()[0].CLM_ID == 542192281063886
    assert len(good.select("PRVDR_NUM").collect()) == 2
    assert len(rejected.collect()) == 4 and rejected.count() == 4
    assert rejected.select(csv_load.SOURCE_FILE).distinct().collect()[0][0] == "o.csv"


def test_bad_rows_can_stop_the_load(spark, tmp_path):
    path = _write(tmp_path, "o.csv", [_row(**{f"_{AMOUNT}": "fifty"})])
    good, _ = csv_load.read_outpatient(spark, [path], on_error="abort")
    with pytest.raises(Exception):
        good.collect()
    with pytest.raises(ValueError):
        csv_load.read_outpatient(spark, [path], on_error="other")


def test_yearly_beneficiary_files_become_one_table(spark, tmp_path):
    paths = []
    for year in (2008, 2009, 2010):
        fields = ["0001", "19400101", "", "1", "5", "0", "05", "007"] + ["12"] * 3 + ["2"] * 11 + ["1.50"] * 9
        paths.append(_write(tmp_path, f"Beneficiary_{year}_Sample_1.csv", [",".join(fields)], schemas.BENEFICIARY.names))
    good, rejected = csv_load.read_beneficiary(spark, paths)
    assert sorted(r.src_year for r in good.collect()) == [2008, 2009, 2010]
    assert good.columns == [*schemas.BENEFICIARY.names, "src_year"] and rejected.count() == 0
    assert {r.DESYNPUF_ID for r in good.collect()} == {"0001"}


def test_year_is_not_taken_from_a_generated_part_name(spark, tmp_path):
    fields = ["0001", "19400101", "", "1", "5", "0", "05", "007"] + ["12"] * 3 + ["2"] * 11 + ["1.50"] * 9
    path = _write(tmp_path, "part-00000-12019a8b-c000.csv", [",".join(fields)], schemas.BENEFICIARY.names)
    assert [r.src_year for r in csv_load.read_beneficiary(spark, [path])[0].collect()] == [None]


def test_year_of_a_folder_and_given_years(spark, tmp_path):
    fields = ["0001", "19400101", "", "1", "5", "0", "05", "007"] + ["12"] * 3 + ["2"] * 11 + ["1.50"] * 9
    paths = []
    for year in (2008, 2010):
        folder = tmp_path / f"year={year}"
        folder.mkdir()
        name = "part-00000-1a2b3c4d-2009-4e5f-8a9b-0c1d2e3f4a5b-c000.csv"
        paths.append(_write(folder, name, [",".join(fields)], schemas.BENEFICIARY.names))
    assert sorted(r.src_year for r in csv_load.read_beneficiary(spark, paths)[0].collect()) == [2008, 2010]
    given = {2009: paths[:1], 2010: paths[1:]}
    good, rejected = csv_load.read_beneficiary(spark, given)
    assert sorted(r.src_year for r in good.collect()) == [2009, 2010] and rejected.count() == 0


def test_file_without_a_year(spark, tmp_path):
    fields = ["0001"] + [""] * (len(schemas.BENEFICIARY.names) - 1)
    path = _write(tmp_path, "people.csv", [",".join(fields)], schemas.BENEFICIARY.names)
    assert csv_load.read_beneficiary(spark, [path])[0].first().src_year is None


def test_inpatient_reads_its_own_columns(spark, tmp_path):
    names = schemas.INPATIENT.names
    fields = [""] * len(names)
    fields[names.index("CLM_UTLZTN_DAY_CNT")], fields[names.index("CLM_DRG_CD")] = "5", "099"
    path = _write(tmp_path, "i.csv", [",".join(fields)], names)
    row = csv_load.read_inpatient(spark, [path])[0].first()
    assert (row.CLM_UTLZTN_DAY_CNT, row.CLM_DRG_CD, row.CLM_ID) == (5, "099", None)


def test_declared_widths():
    assert [len(s.names) for s in (schemas.BENEFICIARY, schemas.INPATIENT, schemas.OUTPATIENT)] == [31, 33, 29]


def test_reasons_and_counts_by_file(spark, tmp_path):
    first = [_row(), _row(**{f"_{AMOUNT}": "fifty"}), _row(**{f"_{PROVIDER}": "1234567"}), _row(**{f"_{AMOUNT}": "x", f"_{PROVIDER}": "1234567"}),
             _row() + ",extra"]
    paths = [_write(tmp_path, "a.csv", first), _write(tmp_path, "b.csv", [_row()] * 3), _write(tmp_path, "c.csv", [",".join(["1"] * 40)])]
    good, rejected = csv_load.load_csv(spark, paths, schemas.OUTPATIENT)
    reasons = sorted((r.source_file, r.reject_reason) for r in rejected.collect())
    # the first faulty column in order of the schema
    first_of_both = min("CLM_PMT_AMT", "PRVDR_NUM", key=schemas.OUTPATIENT.names.index)
    assert reasons == sorted([("a.csv", "CLM_PMT_AMT"), ("a.csv", "PRVDR_NUM"), ("a.csv", first_of_both), ("a.csv", csv_load.WRONG_FIELDS),
                              ("c.csv", csv_load.WRONG_FIELDS)])
    result = [tuple(r) for r in csv_load.load_result("T", good, rejected).orderBy("source_file").collect()]
    assert result == [("T", "a.csv", 5, 1, 4, first_of_both), ("T", "b.csv", 3, 3, 0, None), ("T", "c.csv", 1, 0, 1, csv_load.WRONG_FIELDS)]
