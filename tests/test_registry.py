from collections import Counter

import pytest

from tests.extracts import FEW, LAYOUT
from tidemark.care_records import CARE_RECORDS
from tidemark.registry import COMMON, PRACTICE, ForeignKey, Registry, Table


def test_care_records():
    kinds = Counter(t.kind for t in CARE_RECORDS.tables)
    assert kinds == {COMMON: 7, PRACTICE: 13}
    ends = Counter(
        (CARE_RECORDS.table(k.from_table).kind, CARE_RECORDS.table(k.to_table).kind)
        for k in CARE_RECORDS.foreign_keys
    )
    assert ends == {("C", "C"): 9, ("P", "C"): 40, ("P", "P"): 23}
    assert len({(k.to_table, k.to_column) for k in CARE_RECORDS.foreign_keys}) == 12
    assert [t.name for t in CARE_RECORDS.tables if not t.keys] == [
        "Audit_PatientAudit", "Audit_RegistrationAudit",
    ]
    assert sum(t.deleted is not None for t in CARE_RECORDS.tables) == 13


def test_selection():
    assert len(CARE_RECORDS.select()) == 20
    assert len(CARE_RECORDS.select(practice=False)) == 7
    assert len(CARE_RECORDS.select(common=False)) == 13


def test_layout_widths_and_schema():
    registry = CARE_RECORDS.with_layout(LAYOUT)
    patient = registry.table("Admin_Patient")
    assert patient.last_column == "ProcessingId"
    assert patient.history_schema.names[-2:] == ["practice", "ExtractId"]
    assert registry.table("Admin_Location").history_schema.names[-1] == "ExtractId"
    observation = registry.table("CareRecord_Observation")
    assert observation.schema["AssociatedText"].metadata == {"width": 1000}
    assert observation.width("CodeId") == 50
    assert registry.table("Coding_ClinicalCode").width("SomeCodeCategoryDescription") == 500
    assert patient.scoped_keys(["practice", "PatientGuid"]) == ["practice", "PatientGuid"]
    with pytest.raises(ValueError, match="not known"):
        CARE_RECORDS.table("Admin_Patient").schema


def test_bad_registries():
    table = Table("a", COMMON, ("k",), tenant=None)
    with pytest.raises(ValueError, match="declared twice"):
        Registry((table, table))
    with pytest.raises(ValueError, match="unknown table"):
        Registry((table,), (ForeignKey(1, "a", "x", "b", "k"),))
    with pytest.raises(ValueError, match="declared twice"):
        Registry((table,), (ForeignKey(1, "a", "x", "a", "k"), ForeignKey(2, "a", "x", "a", "k")))
    with pytest.raises(ValueError, match="common table cannot refer"):
        Registry((table, Table("p", PRACTICE, ("k",))), (ForeignKey(1, "a", "x", "p", "k"),))
    with pytest.raises(ValueError, match="lacks column"):
        Registry((table,)).with_layout({"a": ["other"]})


def test_frames(spark, rows):
    assert FEW.table_frame(spark).count() == 4
    assert FEW.foreign_key_frame(spark).where("TableType = 'P' and ToTableType = 'C'").count() == 1
    assert rows(FEW.key_frame(spark), "TableName", "Position", "ColumnName")[0] == (
        "Admin_Location", 1, "LocationGuid",
    )
    wide = Registry((Table("a", COMMON, ("k", "l", "m"), tenant=None),))
    assert rows(wide.key_frame(spark), "Position", "ColumnName") == [(1, "k"), (2, "l"), (3, "m")]
    assert FEW.kind_frame(spark).count() == 2
