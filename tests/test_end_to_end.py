import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import extracts as x
from tidemark.care_records import CARE_RECORDS
from tidemark.operators.analytics import (
    across_practices,
    code_counts_by_practice,
    describe_codes,
    for_each_practice,
    practice_counts,
    text_date,
    total_code_counts,
)
from tidemark.operators.constraints import CONTROL_RULES, check_constraints
from tidemark.operators.versioned import as_of, current, extract_diff
from tidemark.plans.install import (
    ExtractError,
    clean_staging,
    configure_practice,
    install_all,
    install_counts,
    install_extract,
    install_times,
    save_states,
    stage_extract,
    staged_tables,
)
from tidemark.plans.validate import ValidationError, compare_runs, validate_practices
from tidemark.sources import history as store


@pytest.fixture(scope="module")
def installed(spark, tmp_path_factory):
    """Three extracts installed and validated after each."""
    base = tmp_path_factory.mktemp("three")
    root, folder = str(base / "store"), str(base / "in")
    x.write_extract(f"{folder}/e1", "1-100", "20170101020000", x.bulk())
    x.write_extract(f"{folder}/e2", "101-150", "20170108020000", x.delta(), line_end="\n")
    x.write_extract(
        f"{folder}/e3", "1-40", "20170115020000", x.delta_with_new_practice(), guid=x.GUID.lower()
    )
    done = install_all(spark, root, folder)
    return root, done


@pytest.fixture(scope="module")
def validated(spark, installed):
    root, _ = installed
    when = datetime(2017, 2, 1, 12, 30)
    return [
        validate_practices(spark, root, extract=2, now=when),
        validate_practices(spark, root, now=when),
    ]


def table(spark, root, name):
    registry = store.read_layout(spark, root, CARE_RECORDS)
    return registry.table(name), store.read_history(spark, root, registry.table(name))


def test_log_and_practices(spark, installed, rows):
    root, done = installed
    assert [d.extract for d in done] == [1, 2, 3]
    log = store.read_control(spark, root, "InstalledExtracts")
    assert rows(log, "ExtractId", "ProcessingIdStart", "ProcessingIdEnd") == [
        (1, 1, 100), (2, 101, 150), (3, 1, 40),
    ]
    practices = store.read_snapshot(spark, root, "ConfiguredPractices")
    assert rows(practices, "CDB", "StartExtractId", "NewlyConfigured", "ConfiguredAfter") == [
        (101, 1, False, None), (102, 1, False, None), (103, 3, False, None),
    ]
    assert store.read_control(spark, root, "StagedExtract").isEmpty()


def test_rows_reach_their_practice(spark, installed, rows):
    root, done = installed
    _, users = table(spark, root, "Appointment_SessionUser")
    assert rows(users, "practice", "SessionGuid", "UserInRoleGuid", "ExtractId") == [
        ("Practice101", "S1", "U1", 1), ("Practice101", "S1", "U2", 1),
        ("Practice102", "S2", "U1", 1), ("Practice103", "S3", "U1", 3),
        ("Practice103", "S3", "U1", 3),
    ]
    assert done[0].discarded == {}
    assert done[1].discarded == {"Appointment_SessionUser": 1}
    moved = {(r.TableName, r.practice): r.Rows for r in done[0].counts.collect()}
    assert moved[("CareRecord_Observation", "Practice101")] == 8
    assert moved[("CareRecord_Observation", "Practice102")] == 2


def test_every_row_is_kept_or_reported(spark, installed):
    root, done = installed
    for extract, written in zip(done, (x.bulk(), x.delta(), x.delta_with_new_practice())):
        expected = sum(
            len(written.get(t.name, [])) for t in CARE_RECORDS.tables if t.kind == "P"
        )
        moved = extract.counts.agg(F.sum("Rows")).first()[0]
        doubled = 1 if extract.extract == 3 else 0
        assert moved + sum(extract.discarded.values()) == expected + doubled


def test_counts_and_times_are_kept(spark, installed, rows):
    root, done = installed
    kept = install_counts(spark, root)
    for extract in done:
        told = {(r.TableName, r.practice): r.Rows for r in extract.counts.collect()}
        told |= {(t, None): n for t, n in extract.discarded.items()}
        found = kept.where(F.col("ExtractId") == extract.extract).collect()
        assert {(r.TableName, r.practice): r.Rows for r in found} == told
    times = install_times(spark, root)
    assert times.count() == 3 * len(CARE_RECORDS.tables)
    assert times.where("Seconds <= 0").isEmpty()
    by_extract = times.where("TableName = 'CareRecord_Observation' and Rows > 0")
    _, history = table(spark, root, "CareRecord_Observation")
    assert rows(by_extract, "ExtractId", "Rows") == rows(
        history.groupBy("ExtractId").agg(F.count("*").alias("n")), "ExtractId", "n"
    )


def test_text_survives_reading(spark, installed):
    root, _ = installed
    _, history = table(spark, root, "CareRecord_Observation")
    row = history.where("ObservationGuid = 'O9'").first()
    assert row.AssociatedText == 'said ""no""\r\nthen left'
    assert history.columns[-2:] == ["practice", "ExtractId"]


def test_as_of_each_extract(spark, installed, rows):
    root, _ = installed
    about, history = table(spark, root, "Admin_Patient")

    def surnames(n):
        return rows(as_of(history, about, n), "PatientGuid", "Surname")

    assert ("P2", "Name2") in surnames(1)
    assert [p for p, _ in surnames(2)] == ["P1", "P1", "P3", "P4", "P5", "P6"]
    assert {s for p, s in surnames(2) if p == "P1"} == {"Once", "Twice"}
    assert [p for p, _ in surnames(None)] == ["P1", "P1", "P3", "P4", "P5", "P6", "P7", "P8"]
    changed = extract_diff(
        history, about.scoped_keys(history.columns), 1, 2, deleted="Deleted"
    )
    assert rows(changed, "PatientGuid", "status") == [("P1", "changed"), ("P2", "removed")]


def test_counts(spark, installed, rows):
    root, _ = installed
    practices = store.read_snapshot(spark, root, "ConfiguredPractices")
    about, history = table(spark, root, "Admin_Patient")
    assert [tuple(r) for r in practice_counts(practices, history, about).collect()] == [
        ("Practice No 1", "Practice101", 4),
        ("Practice No 2", "Practice102", 3),
        ("Practice No 3", "Practice103", 1),
    ]
    about, history = table(spark, root, "CareRecord_Observation")
    counts = total_code_counts(
        code_counts_by_practice(current(history, about), date=text_date("EffectiveDate"))
    )
    codes_about, codes = table(spark, root, "Coding_ClinicalCode")
    described = describe_codes(counts, codes, codes_about)
    assert rows(
        described.withColumn("d", F.date_format("MostRecentDate", "yyyy-MM-dd")),
        "CodeId", "Term", "CodeCount", "d",
    ) == [("1", "Cough", 8, "2017-01-11"), ("2", "Fever, mild", 3, "2017-01-08")]


def test_query_over_practices(spark, installed, rows):
    root, _ = installed
    _, patients = table(spark, root, "Admin_Patient")
    once = across_practices(
        spark, "select practice, count(*) as n from {patients} group by practice", patients=patients
    )
    each = for_each_practice(
        spark,
        "select count(*) as n from {patients}",
        ["Practice101", "Practice102", "Practice103"],
        {"patients": patients},
    )
    assert rows(once) == rows(each)


def test_foreign_key_runs(spark, installed, validated, rows):
    root, _ = installed
    first, second = validated
    assert (first.group, second.group) == (1, 2)
    assert rows(first.runs, "RunId", "PracticeDBName") == [(1, "Practice101"), (2, "Practice102")]
    assert rows(first.skipped) == [("Practice103", "starts with extract 3")]
    assert rows(second.runs, "RunId") == [(3,), (4,), (5,)]
    errors = {
        (r.RunId, r.ForeignKeyId): (r.Count, r.DistinctCount)
        for r in store.read_control(spark, root, "ForeignKeyErrors").collect()
    }
    # The patient came one extract after the observation that names it: still an orphan.
    assert errors[(2, 43)] == (1, 1)
    assert errors[(4, 43)] == (1, 1)
    # A patient of another practice does not count.
    assert errors[(5, 17)] == (1, 1)
    assert (3, 17) not in errors and (3, 43) not in errors
    # Blank and empty codes are no errors; every code known.
    assert not any(fk == 38 for _, fk in errors)


def test_report(spark, installed, validated):
    root, _ = installed
    lines = store.read_control(spark, root, "RunText")
    text = [r.Line for r in lines.where("RunId = 5").orderBy("LineId").collect()]
    assert text[:6] == [
        "Data Integrity Report", "Practice: A00003/ Practice No 3", "Extract Id: 3",
        "Extract date: 2017-01-15 02:00:00", "Validation date: 2017-02-01 12:30:00", "",
    ]
    start = text.index(">>Table Appointment_Slot")
    assert text[start - 1:] == [
        "-" * 52, ">>Table Appointment_Slot", "-" * 52, "",
        "  >Column PatientGuid", "",
        "     [ERROR]  1 (1 distinct) PatientGuid value(s) not present in Admin_Patient "
        "(column PatientGuid)", "",
        "     Distinct value(s) are:", "         P1", "",
    ]


def test_comparison(spark, installed, validated, rows):
    root, _ = installed
    report = compare_runs(spark, root, group=2, comparison_group=1)
    assert report.columns[5:] == ["CDB101-Ext3", "CDB102-Ext3", "CDB103-Ext3"]
    found = {(r.FromTable, r.FromColumn): tuple(r)[5:] for r in report.collect()}
    assert found[("CareRecord_Observation", "PatientGuid")] == ("0", "1", "0")
    assert found[("Appointment_Slot", "PatientGuid")] == ("0", "0", "1")


def test_single_practice_run(spark, installed, validated, rows):
    root, _ = installed
    run = validate_practices(spark, root, practice="Practice102")
    assert run.group is None
    assert 43 in [r.ForeignKeyId for r in run.errors.collect()]
    # As of the last extract the patient is there.
    later = validate_practices(spark, root, practice="Practice102", mode="as_of")
    assert 43 not in [r.ForeignKeyId for r in later.errors.collect()]
    with pytest.raises(ValidationError, match="starts with extract 3"):
        validate_practices(spark, root, practice="Practice103", extract=1)
    with pytest.raises(ValidationError, match="not configured"):
        validate_practices(spark, root, practice="Nowhere")
    with pytest.raises(ValidationError, match="not installed"):
        validate_practices(spark, root, extract=9)


def test_control_rules_hold(spark, installed, validated):
    root, _ = installed
    tables = {
        name: store.read_control(spark, root, name) for name in CONTROL_RULES
        if name != "ConfiguredPractices"
    }
    tables["ConfiguredPractices"] = store.read_snapshot(spark, root, "ConfiguredPractices")
    assert check_constraints(tables, CONTROL_RULES).where("Violations > 0").isEmpty()


def refused(spark, root, folder, ids, stamp, tables, match, **options):
    directory, marker = x.write_extract(folder, ids, stamp, tables, **options)
    stage_extract(spark, root, directory, marker, x.FEW)
    with pytest.raises(ExtractError, match=match):
        install_extract(spark, root, x.FEW)
    clean_staging(spark, root)


def test_refusals_leave_the_store_alone(spark, tmp_path):
    root = str(tmp_path / "store")

    def bad(name, match, tables=None, ids="1-9", stamp="20170201000000", **options):
        refused(spark, root, str(tmp_path / name), ids, stamp, tables or x.bulk(), match, **options)

    bad("start", "must be a bulk extract", ids="2-9")
    damaged = x.bulk()
    damaged["Admin_Organisation"][0]["ProcessingId"] = 'the "end"'
    damaged["Admin_Location"][0]["LocationGuid"] = "x" * 51
    sharing = x.text(x.LAYOUT["Agreements_SharingOrganisation"], x.sharing(1, 2))
    problems = (
        "Admin_Location: 1 row.s. with a value longer than declared; "
        "Admin_Organisation: more than one row contains a trailing quote; "
        "Agreements_SharingOrganisation: a header appears among the rows"
    )
    bad("damaged", problems, damaged, replace={"Agreements_SharingOrganisation": sharing * 2})
    cut = x.text(x.LAYOUT["Admin_Patient"], x.bulk()["Admin_Patient"])[:-5]
    bad("cut", "Admin_Patient: no row contains a trailing quote", replace={"Admin_Patient": cut})
    assert store.last_installed(spark, root) is None
    assert store.read_snapshot(spark, root, "ConfiguredPractices").isEmpty()

    directory, marker = x.write_extract(str(tmp_path / "good"), "1-9", "20170201000000", x.bulk())
    stage_extract(spark, root, directory, marker, x.FEW)
    staged = staged_tables(spark, root, x.FEW)
    assert staged["Admin_Patient"].columns == x.LAYOUT["Admin_Patient"]
    assert staged["Admin_Patient"].count() == 6
    with pytest.raises(ExtractError, match="already staged"):
        stage_extract(spark, root, directory, marker, x.FEW)
    assert install_extract(spark, root, x.FEW).extract == 1
    bad("late", "not later than the last installed", stamp="20170131000000")
    bad("same", "installed already", stamp="20170201000000")
    twice = {
        "Agreements_SharingOrganisation": x.sharing(1, 2)
        + [{"OrganisationGuid": "{" + x.ORG[1].lower() + "}", "IsActivated": "true"}],
        "Admin_Patient": [x.patient(5, 2), x.patient(1, 1)],
    }
    bad("twice", "described or shared more than once", twice, stamp="20170202000000")
    unknown = {
        "Agreements_SharingOrganisation": x.sharing(1, 2, 4),
        "Admin_Patient": [x.patient(9, 4), x.patient(1, 1)],
    }
    bad("unknown", r"1 row\(s\) in Admin_Patient", unknown, stamp="20170202000000")
    unshared = {
        "Agreements_SharingOrganisation": x.sharing(1),
        "Admin_Patient": [x.patient(5, 2), x.patient(1, 1)],
    }
    bad("unshared", r"1 row\(s\) in Admin_Patient", unshared, stamp="20170203000000")
    registry = store.read_layout(spark, root, x.FEW)
    history = store.read_history(spark, root, registry.table("Admin_Patient"))
    assert history.count() == 6

    # What the refused installs wrote is replaced, not added to.
    good = {"Agreements_SharingOrganisation": x.sharing(1), "Admin_Patient": [x.patient(1, 1)]}
    directory, marker = x.write_extract(str(tmp_path / "next"), "10-11", "20170204000000", good)
    stage_extract(spark, root, directory, marker, x.FEW)
    assert install_extract(spark, root, x.FEW).extract == 2
    history = store.read_history(spark, root, registry.table("Admin_Patient"))
    assert history.where("ExtractId = 2").count() == 1


def test_staging_refusals(spark, tmp_path):
    root = str(tmp_path / "store")
    directory, marker = x.write_extract(
        str(tmp_path / "e"), "1-9", "20170201000000", x.bulk(), skip=["Admin_Patient"]
    )
    with pytest.raises(ExtractError, match="no file for table.s. Admin_Patient"):
        stage_extract(spark, root, directory, marker, x.FEW)
    with pytest.raises(ExtractError, match="not the Admin_Location file"):
        stage_extract(spark, root, directory, marker.replace("Location", "Patient"), x.FEW)
    with pytest.raises(ExtractError, match="five parts"):
        stage_extract(spark, root, directory, "1-9_Admin_20170201000000.csv")
    with pytest.raises(ExtractError, match="no extract is staged"):
        install_extract(spark, root, x.FEW)


def test_configure_by_hand(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    configure_practice(spark, root, 101, "By hand", "A00001", x.ORG[1])
    with pytest.raises(ExtractError, match="already configured"):
        configure_practice(spark, root, 101, "Again", "A00009", x.ORG[4])
    with pytest.raises(ExtractError, match="already configured"):
        configure_practice(spark, root, 109, "Again", "A00009", x.ORG[1].lower())
    directory, marker = x.write_extract(
        os.path.join(tmp_path, "e"), "1-9", "20170201000000", x.bulk()
    )
    stage_extract(spark, root, directory, marker, x.FEW)
    install_extract(spark, root, x.FEW)
    practices = store.read_snapshot(spark, root, "ConfiguredPractices")
    assert rows(practices, "PracticeName", "StartExtractId") == [
        ("By hand", 1), ("Practice No 2", 1),
    ]


def test_a_bulk_load_goes_on(spark, tmp_path):
    """A rerun with a new folder, a stop after the log line, a refusal: nothing stays staged."""
    root, folder = str(tmp_path / "store"), str(tmp_path / "in {1} [a]*")
    x.write_extract(f"{folder}/e1", "1-9", "20170201000000", x.bulk(), guid="{" + x.GUID + "}")
    assert [d.extract for d in install_all(spark, root, folder, x.FEW)] == [1]
    staged = store.read_control(spark, root, "InstalledExtracts").drop("ExtractId", "InstalledDated")
    again = spark.createDataFrame(staged.collect(), store.CONTROL["StagedExtract"])
    store.replace_control(again, root, "StagedExtract")
    next_day = {"Agreements_SharingOrganisation": x.sharing(1), "Admin_Patient": [x.patient(1, 1)]}
    x.write_extract(f"{folder}/e2", "10-11", "20170202000000", next_day)
    assert [d.extract for d in install_all(spark, root, folder, x.FEW)] == [2]
    stranger = {"Agreements_SharingOrganisation": x.sharing(1), "Admin_Patient": [x.patient(1, 4)]}
    x.write_extract(f"{folder}/e3", "12-13", "20170203000000", stranger)
    with pytest.raises(ExtractError, match="no configured, sharing practice"):
        install_all(spark, root, folder, x.FEW)
    assert store.read_control(spark, root, "StagedExtract").isEmpty()
    assert store.last_installed(spark, root) == 2


def test_numbers_are_taken_once(spark, tmp_path):
    root = str(tmp_path / "store")
    assert store.claim(spark, root, "Extract", 1, "a") == "a"
    assert store.claim(spark, root, "Extract", 1, "b") == "a"
    assert store.claim(spark, root, "Extract", 2, "b") == "b"
    first = [store.claim_numbers(spark, root, "Run", 1, 3) for _ in range(3)]
    assert first == [1, 4, 7] and store.claim_numbers(spark, root, "Run", 5, 1) in (5, 10)


def test_two_validations_from_one_state(spark, installed, monkeypatch):
    """Both see the same last run; both survive, under numbers of their own."""
    root, _ = installed
    read = store.read_control
    before = read(spark, root, "Run").count()
    past = read(spark, root, "Run").collect()
    monkeypatch.setattr(
        store, "read_control",
        lambda s, r, name: s.createDataFrame(past, store.CONTROL["Run"]) if name == "Run" else read(s, r, name),
    )
    one = validate_practices(spark, root, practice="Practice102")
    two = validate_practices(spark, root, practice="Practice102")
    monkeypatch.undo()
    runs = read(spark, root, "Run")
    ids = {one.runs.first().RunId, two.runs.first().RunId}
    assert len(ids) == 2 and runs.count() == before + 2
    assert {r.RunId for r in read(spark, root, "RunText").collect()} >= ids


def test_many_runs_are_written_by_many_tasks(spark, small_skew, tmp_path):
    root = str(tmp_path / "store")
    lines = spark.range(400_000).selectExpr(
        "int(id / 200) as RunId", "int(id % 200) as LineId", "sha2(string(id), 256) as Line"
    )
    store.write_batch(lines, root, "RunText", 1)
    files = [f for f in os.listdir(f"{store.control_path(root, 'RunText')}/Batch=1") if f.startswith("part-")]
    assert len(files) > 1
    assert store.read_batch(spark, root, "RunText", 1).count() == 400_000


def test_states_stand_in_for_earlier_extracts(spark, tmp_path):
    """The same state from a saved one and later partitions; nothing deleted comes back."""
    root, folder = str(tmp_path / "store"), str(tmp_path / "in")
    x.write_extract(f"{folder}/e1", "1-9", "20170201000000", x.bulk())
    changes = {
        "Agreements_SharingOrganisation": x.sharing(1, 2),
        "Admin_Patient": [
            x.patient(1, 1, Deleted="true"), x.patient(2, 1, Surname="New"), x.patient(3, 1),
        ],
    }
    x.write_extract(f"{folder}/e2", "10-11", "20170202000000", changes)
    last = {
        "Agreements_SharingOrganisation": x.sharing(1, 2),
        "Admin_Patient": [x.patient(3, 1, Deleted="true"), x.patient(9, 2)],
    }
    x.write_extract(f"{folder}/e3", "12-13", "20170203000000", last)
    install_all(spark, root, folder, x.FEW)
    about = store.read_layout(spark, root, x.FEW).table("Admin_Patient")

    def states():
        out = []
        for n in (1, 2, 3, None):
            found = as_of(store.recent_history(spark, root, about, n), about, n)
            out.append(sorted(map(tuple, found.collect())))
        return out

    whole = states()
    for extract in (2, 3):
        assert "Admin_Patient" in save_states(spark, root, x.FEW, extract)
        assert states() == whole
    assert [r[0] for r in whole[3]] == sorted(r[0] for r in whole[3]) and len(whole[3]) == 5
    recent = store.recent_history(spark, root, about)
    files = [f for f in recent.inputFiles() if "/history/" in f]
    assert not files, "all extracts are covered"
    assert all("ExtractId=3" in f for f in store.recent_history(spark, root, about, 2).inputFiles() if "/history/" in f)
    with pytest.raises(ValueError, match="not installed"):
        store.save_state(spark, root, about, 4)
