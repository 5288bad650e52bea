import os
import tempfile
from datetime import date

import pytest
from conftest import rows, settings

from wardline import SiteConfig, run_report
from wardline.operators import cohort
from wardline.operators.tables import TABLES
from wardline.storage import fits_broadcast
from wardline.sources import maps, readers


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


CONFIG = (
    "siteid,include_race,race_in_fact_table,hispanic_in_fact_table,death_data_accurate,"
    "code_prefix_icd9cm,code_prefix_icd10cm,code_prefix_icd9proc,code_prefix_icd10pcs,"
    "obfuscation_blur,obfuscation_small_count_mask,obfuscation_small_count_delete,"
    "obfuscation_demographics,output_as_columns,output_as_csv\n"
)


def test_config_from_a_one_row_table(spark, folder):
    row = "SITE1,1,0,0,1,ICD9:,ICD10:,ICD9PROC:,ICD10PROC:,0,0,0,0,0,1\n"
    cfg = readers.read_config(spark, write(folder, "c.csv", CONFIG + row), date(2020, 6, 1), lab_min_day=-60)
    assert (cfg.siteid, cfg.race_in_fact_table, cfg.hispanic_in_fact_table) == ("SITE1", False, False)
    assert (cfg.code_prefix_icd10pcs, cfg.obfuscation_small_count_mask) == ("ICD10PROC:", 0)
    assert cfg.output_as_csv is True and cfg.output_as_columns is False
    assert (cfg.as_of, cfg.lab_min_day) == (date(2020, 6, 1), -60)
    with pytest.raises(ValueError):
        readers.read_config(spark, write(folder, "d.csv", CONFIG + row + row), date(2020, 6, 1))


def test_defaults_and_bad_settings():
    cfg = SiteConfig(as_of=date(2020, 1, 1))
    assert (cfg.obfuscation_small_count_mask, cfg.obfuscation_blur) == (10, 0)
    assert cfg.blur_salt != SiteConfig(as_of=date(2020, 1, 1)).blur_salt
    assert cfg.blur_salt not in repr(cfg)
    for bad in ({"siteid": "1abc"}, {"siteid": "x" * 21}, {"age_source": "guess"}, {"obfuscation_blur": -1}):
        with pytest.raises(ValueError):
            settings(**bad)


def test_default_maps(spark):
    found = maps.default_maps(spark, rxnorm=False)
    classes = {r.med_class: r.n for r in found.med_map.groupBy("med_class").count().toDF("med_class", "n").collect()}
    assert classes == {
        "ACEI": 14, "ARB": 7, "COAGA": 11, "COAGB": 24, "COVIDVIRAL": 3, "DIURETIC": 7, "HCQ": 2,
        "ILI": 4, "INTERFERON": 2, "SIANES": 7, "SICARDIAC": 10, "REMDESIVIR": 3,
    }
    assert found.lab_map.count() == 20 and found.lab_map.filter("local_lab_code = 'LOINC:6690-2'").count() == 1
    assert found.code_map.filter("code = 'covidpos'").count() == 1
    assert all(fits_broadcast(m) for m in (found.code_map, found.lab_map, found.med_map))


def test_a_site_says_whether_it_has_rxnorm_codes(spark):
    for left_open in (True, None):
        with pytest.raises(ValueError, match="rxnorm"):
            maps.default_maps(spark, left_open)
    with pytest.raises(TypeError):
        maps.default_maps(spark)


def test_rxnorm_rows_come_from_a_file(spark, folder):
    path = write(folder, "rx.csv", "med_class,code\nACEI,36908\nACEI,36908\nHCQ,5521\n")
    found = maps.default_med_map(spark, rxnorm=maps.read_rxnorm_classes(spark, path))
    added = rows(found.filter("local_med_code in ('RxNorm:36908', 'RxNorm:5521')"))
    assert added == [("ACEI", "RxNorm", "RxNorm:36908"), ("HCQ", "RxNorm", "RxNorm:5521")]
    assert found.count() == 94 + 2


def site(spark, folder):
    """A small site as CSV extracts, with positives found by result text."""
    write(
        folder,
        "observation_fact.csv",
        "patient_num,concept_cd,start_date,nval_num,tval_char\n"
        "1,LAB:TEST,2020-03-10 09:00:00,,Positive\n"
        "2,LAB:TEST,2020-03-10 09:00:00,,negative\n"
        "1,LAB:WBC,2020-03-11 09:00:00,4.5,\n"
        "1,LAB:WBC,2020-02-20 09:00:00,9.5,\n"
        "1,LAB:GAS,2020-03-12 09:00:00,40,\n"
        "1,ICD10:I10.9,2020-01-01 09:00:00,,\n"
        "1,MED:1,2020-03-12 09:00:00,,\n",
    )
    write(
        folder,
        "visit_dimension.csv",
        "patient_num,start_date,end_date,inout_cd\n"
        "1,2020-03-10 08:00:00,2020-03-12 10:00:00,Inpatient\n"
        "2,2020-03-10 08:00:00,,Inpatient\n",
    )
    write(
        folder,
        "patient_dimension.csv",
        "patient_num,sex_cd,age_in_years_num,birth_date,race_cd,death_date,vital_status_cd\n"
        "1,F,,1950-05-05,White,,N\n",
    )
    write(folder, "concept_dimension.csv", "concept_path,concept_cd\n")
    found = maps.read_maps(
        spark,
        write(folder, "code.csv", "code,local_code\ninpatient,Inpatient\nfemale,F\nwhite,White\n"),
        write(
            folder,
            "lab.csv",
            "loinc,local_lab_code,scale_factor,lab_units,lab_name\n"
            "6690-2,LAB:WBC,1000,u,\n2019-8,LAB:GAS,,,\n",
        ),
        write(folder, "med.csv", "med_class,code_type,local_med_code\nACEI,Custom,MED:1\n"),
    )
    return readers.read_csv(spark, folder), found


def test_whole_run_from_extracts(spark, folder):
    tables, found = site(spark, folder)
    row = "SITE1,1,0,0,1,ICD9:,ICD10:,ICD9PROC:,ICD10PROC:,0,0,0,0,1,1\n"
    cfg = readers.read_config(
        spark, write(folder, "c.csv", CONFIG + row), date(2020, 3, 13), age_source="birth_date",
        lab_min_day=-60,
    )
    positives = cohort.index_events_by_result(tables.facts, ["LAB:TEST"])
    report = run_report(tables, found, cfg, positives)
    results = report.results()
    assert set(results) == {s.name for s in TABLES} | {s.name + "CSV" for s in TABLES}
    lines = {name[:-3]: [r.s for r in df.collect()] for name, df in results.items() if name.endswith("CSV")}
    assert lines["DailyCounts"][1:] == [
        "SITE1,2020-03-10,1,0,0,1,0", "SITE1,2020-03-11,1,0,0,1,0",
        "SITE1,2020-03-12,1,1,0,1,1", "SITE1,2020-03-13,1,1,0,0,0", "",
    ]
    assert lines["ClinicalCourse"][1:-1] == ["SITE1,0,1,1", "SITE1,1,1,1", "SITE1,2,1,1"]
    assert "SITE1,female,50to69,white,1,1" in lines["Demographics"] and len(lines["Demographics"]) == 10
    assert [line.split(",")[1:8] for line in lines["Labs"][1:-1]] == [
        ["6690-2", "-19", "u", "1", "9500.000000", "0.000000", "9.159100"],
        ["6690-2", "1", "u", "1", "4500.000000", "0.000000", "8.411944"],
    ]
    assert lines["Diagnoses"][1:-1] == ["SITE1,I10,10,1,0,1,0"]
    assert lines["Medications"][1:-1] == ["SITE1,ACEI,0,1,0,1"]
    assert rows(report.violations()) == []
    written = report.write(os.path.join(folder, "out"))
    assert sorted(os.path.basename(p) for p in written) == sorted(f"{s.name}-SITE1.csv" for s in TABLES)
    with open(written[0]) as f:
        assert f.read().split("\n")[:-1] == lines["DailyCounts"]
    with pytest.raises(FileExistsError):
        report.write(os.path.join(folder, "out"))


def test_command_line(spark, folder):
    """The same site from parquet tables and the default maps, grown along its concept tree."""
    from wardline.__main__ import main

    tables, _ = site(spark, folder)
    concepts = spark.createDataFrame(
        [("\\T\\POS\\", "LAB:TEST"), ("\\L\\", "LOINC:6690-2"), ("\\L\\W\\", "LAB:WBC"),
         ("\\M\\A\\", "ATC:C09AA01"), ("\\M\\A\\B\\", "MED:1"), ("\\M\\A\\C\\", "MED:2")],
        "concept_path string, concept_cd string",
    )
    visits = tables.visits.replace("Inpatient", "IN", "inout_cd")
    names = ("observation_fact", "visit_dimension", "patient_dimension", "concept_dimension")
    for name, df in zip(names, (tables.facts, visits, tables.patients, concepts)):
        df.write.parquet(f"{folder}/{name}")
    row = "SITE1,1,0,0,1,ICD9:,ICD10:,ICD9PROC:,ICD10PROC:,0,0,0,0,0,1\n"
    written = main(
        ["--tables", folder, "--config", write(folder, "c.csv", CONFIG + row), "--as-of", "2020-03-13",
         "--out", f"{folder}/out", "--positive-path", "\\T\\", "--expand-labs", "--medication-root", "\\M\\", "--no-rxnorm"]
    )
    found = {}
    for path in written:
        with open(path) as f:
            found[os.path.basename(path)] = f.read().split("\n")[1:-2]
    # Both patients have a test; without result text both count as positive.
    assert found["DailyCounts-SITE1.csv"][0] == "SITE1,2020-03-10,2,0,0,2,0"
    assert [line[:17] for line in found["Labs-SITE1.csv"]] == ["SITE1,6690-2,1,10"]
    assert found["Medications-SITE1.csv"] == ["SITE1,ACEI,0,1,0,0"]
    assert found["Diagnoses-SITE1.csv"] == ["SITE1,I10,10,1,0,0,0"]


def test_parquet_and_catalog_tables(spark, folder):
    tables, _ = site(spark, folder)
    names = ("observation_fact", "visit_dimension", "patient_dimension", "concept_dimension")
    for name, df in zip(names, (tables.facts, tables.visits, tables.patients, tables.concepts)):
        df.write.parquet(f"{folder}/{name}")
        df.createOrReplaceTempView(name)
    for again in (readers.read_parquet(spark, folder), readers.read_tables(spark)):
        assert rows(again.facts) == rows(tables.facts)
        assert again.patients.columns == tables.patients.columns


def test_an_empty_prefix_switches_a_version_off(spark, folder):
    for k, empty in enumerate(("", '""')):
        row = f"SITE1,1,0,0,1,{empty},ICD10:,ICD9PROC:,ICD10PROC:,0,0,0,0,0,1\n"
        cfg = readers.read_config(spark, write(folder, f"e{k}.csv", CONFIG + row), date(2020, 6, 1))
        assert (cfg.code_prefix_icd9cm, cfg.code_prefix_icd10cm) == ("", "ICD10:")
    kept = SiteConfig.from_table(spark.createDataFrame([("S1",)], "siteid string"), date(2020, 6, 1))
    assert kept.code_prefix_icd9cm == "DIAG|ICD9:"


FACTS_HEADER = "patient_num,concept_cd,start_date,nval_num,tval_char\n"


@pytest.mark.parametrize(
    "line",
    ["P1,C,2020-03-10 08:00:00,1,x", "1,C,03/01/2020,1,x", "1,C,2020-03-10 08:00:00,<5,x"],
    ids=["id", "date", "value"],
)
def test_bad_values_fail(spark, folder, line):
    site(spark, folder)
    write(folder, "observation_fact.csv", FACTS_HEADER + line + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        readers.read_csv(spark, folder).facts.collect()


def test_swapped_columns_and_bad_scale_fail(spark, folder):
    site(spark, folder)
    write(folder, "visit_dimension.csv", "start_date,patient_num,end_date,inout_cd\n2020-03-10 08:00:00,1,,I\n")
    with pytest.raises(Exception, match="header|schema"):
        readers.read_csv(spark, folder).visits.collect()
    write(folder, "lab.csv", "loinc,local_lab_code,scale_factor,lab_units,lab_name\na,b,\"1,5\",u,n\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        maps.read_maps(spark, f"{folder}/code.csv", f"{folder}/lab.csv", f"{folder}/med.csv").lab_map.collect()


def test_text_ids_through_all_tables(spark, folder):
    tables, found = site(spark, folder)
    with run_report(tables, found, settings(siteid="S1"), cohort.index_events_by_result(tables.facts, ["LAB:TEST"])) as report:
        want = {name: rows(df) for name, df in report.tables().items()}
    for name in ("observation_fact", "visit_dimension", "patient_dimension"):
        with open(f"{folder}/{name}.csv") as f:
            header, *lines = f.read().splitlines()
        write(folder, f"{name}.csv", "\n".join([header, *("P" + line for line in lines)]) + "\n")
    named = readers.read_csv(spark, folder, text_ids=True)
    with run_report(named, found, settings(siteid="S1"), cohort.index_events_by_result(named.facts, ["LAB:TEST"])) as report:
        assert {name: rows(df) for name, df in report.tables().items()} == want


def test_nothing_written_is_left_after_close(spark, folder):
    import glob

    from wardline.storage import scratch_folder

    where = scratch_folder(spark).removeprefix("file:") + "/*"
    before = set(glob.glob(where))
    tables, found = site(spark, folder)
    report = run_report(tables, found, settings(siteid="S1"), cohort.index_events_by_result(tables.facts, ["LAB:TEST"]))
    with report:
        report.tables()
        assert set(glob.glob(where)) > before
    assert set(glob.glob(where)) == before


def test_a_long_table_is_printed_whole(spark, capsys):
    from wardline.__main__ import print_table

    print_table("T", spark.range(50).selectExpr("id", "IF(id = 3, NULL, 'x') AS c"))
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 52 and out[5] == "3\t"


def test_output_flags_and_time_zone_of_the_command_line(spark, folder, capsys):
    from wardline.__main__ import main

    tables, _ = site(spark, folder)
    row = "SITE1,1,0,0,1,ICD9:,ICD10:,ICD9PROC:,ICD10PROC:,0,0,0,0,1,0\n"
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        written = main(
            ["--tables", folder, "--format", "csv", "--config", write(folder, "c.csv", CONFIG + row), "--as-of", "2020-03-13",
             "--out", f"{folder}/out", "--time-zone", "Asia/Tokyo", "--positive-codes", "LAB:TEST", "--no-rxnorm"]
        )
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert written == [] and not os.path.exists(f"{folder}/out")
    out = capsys.readouterr().out
    assert all(f"# {s.name}" in out for s in TABLES)
