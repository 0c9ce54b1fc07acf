"""Writes small extracts in the quoted grammar. All values are invented."""

from __future__ import annotations

import os

from tidemark.care_records import CARE_RECORDS
from tidemark.registry import Registry

GUID = "0F8FAD5B-D9CB-469F-A165-70867728950E"
ORG = {n: f"0000000{n}-AAAA-4BBB-8CCC-00000000000{n}" for n in range(1, 6)}

# The tables most tests of a single rule need.
FEW = Registry(
    tuple(
        CARE_RECORDS.table(name)
        for name in (
            "Admin_Location", "Admin_Organisation", "Agreements_SharingOrganisation", "Admin_Patient",
        )
    ),
    tuple(fk for fk in CARE_RECORDS.foreign_keys if fk.id in (1, 2, 3, 4, 8, 11)),
)

# Columns the tables need for their keys, flags and foreign keys, and a few more.
EXTRA = {
    "Admin_Organisation": ["CDB", "OrganisationName", "ODSCode"],
    "Admin_Patient": ["Surname"],
    "CareRecord_Observation": ["EffectiveDate", "AssociatedText"],
    "Coding_ClinicalCode": ["Term", "ReadTermId", "SnomedCTConceptId", "SnomedCTDescriptionId"],
    "Agreements_SharingOrganisation": ["IsActivated"],
}


def layout() -> dict[str, list[str]]:
    result = {}
    for table in CARE_RECORDS.tables:
        wanted = list(table.keys)
        if table.tenant:
            wanted.append(table.tenant)
        if table.via:
            wanted.append(table.via.column)
        for fk in CARE_RECORDS.foreign_keys:
            if fk.from_table == table.name:
                wanted.append(fk.from_column)
            if fk.to_table == table.name:
                wanted.append(fk.to_column)
        wanted += EXTRA.get(table.name, [])
        if table.deleted:
            wanted.append(table.deleted)
        result[table.name] = list(dict.fromkeys(wanted)) + ["ProcessingId"]
    return result


LAYOUT = layout()


def text(columns, records, line_end="\r\n") -> str:
    lines = [columns] + [[r.get(c, "") or "" for c in columns] for r in records]
    return "".join(
        '"' + '","'.join(v.replace('"', '""') for v in line) + '"' + line_end for line in lines
    )


def write_extract(
    folder, ids, stamp, tables, *, line_end="\r\n", guid=GUID, skip=(), replace=None
) -> tuple[str, str]:
    """Write all 20 files; returns the folder and the name of the marker file."""
    os.makedirs(folder, exist_ok=True)
    for table, columns in LAYOUT.items():
        if table in skip:
            continue
        records = tables.get(table, [])
        for r in records:
            unknown = set(r) - set(columns)
            assert not unknown, f"{table}: {unknown}"
            if "Deleted" in columns:
                r.setdefault("Deleted", "false")
            r.setdefault("ProcessingId", "1")
        body = (replace or {}).get(table) or text(columns, records, line_end)
        with open(os.path.join(folder, f"{ids}_{table}_{stamp}_{guid}.csv"), "w", newline="") as f:
            f.write(body)
    return str(folder), f"{ids}_Admin_Location_{stamp}_{guid}.csv"


def organisation(n, **more):
    return {
        "OrganisationGuid": ORG[n], "CDB": str(100 + n), "OrganisationName": f"Practice No {n}",
        "ODSCode": f"A0000{n}", **more,
    }


def sharing(*orgs):
    return [{"OrganisationGuid": ORG[n], "IsActivated": "true"} for n in orgs]


def patient(p, org, **more):
    return {"PatientGuid": f"P{p}", "OrganisationGuid": ORG[org], "Surname": f"Name{p}", **more}


def observation(o, p, org, **more):
    return {
        "ObservationGuid": f"O{o}", "PatientGuid": f"P{p}", "OrganisationGuid": ORG[org],
        "CodeId": "1", "EffectiveDate": f"2017-01-{o:02d}", **more,
    }


def bulk():
    """Two practices, three locations, six patients, ten observations, two sessions."""
    return {
        "Admin_Location": [{"LocationGuid": f"L{n}"} for n in (1, 2, 3)],
        "Admin_Organisation": [organisation(1), organisation(2)],
        "Agreements_SharingOrganisation": sharing(1, 2),
        "Coding_ClinicalCode": [
            {"CodeId": "1", "Term": "Cough"}, {"CodeId": "2", "Term": "Fever, mild"},
        ],
        "Admin_Patient": [patient(n, 1) for n in (1, 2, 3, 4)] + [patient(n, 2) for n in (5, 6)],
        "CareRecord_Observation": [
            observation(n, 1 + n % 4, 1, CodeId="1" if n < 6 else "2") for n in range(1, 9)
        ] + [
            observation(9, 5, 2, AssociatedText='said "no"\r\nthen left'),
            observation(10, 6, 2),
        ],
        "Appointment_Session": [
            {"AppointmentSessionGuid": "S1", "LocationGuid": "L1", "OrganisationGuid": ORG[1]},
            {"AppointmentSessionGuid": "S2", "LocationGuid": "L2", "OrganisationGuid": ORG[2]},
        ],
        "Appointment_SessionUser": [
            {"SessionGuid": "S1", "UserInRoleGuid": "U1"},
            {"SessionGuid": "S1", "UserInRoleGuid": "U2"},
            {"SessionGuid": "S2", "UserInRoleGuid": "U1"},
        ],
        "Admin_UserInRole": [
            {"UserInRoleGuid": "U1", "OrganisationGuid": ORG[1]},
            {"UserInRoleGuid": "U2", "OrganisationGuid": ORG[1]},
        ],
    }


def delta():
    """A tie, a deletion, an orphan, blank and null keys, a session user without a session."""
    return {
        "Agreements_SharingOrganisation": sharing(1, 2),
        "Admin_Patient": [
            patient(1, 1, Surname="Once"), patient(1, 1, Surname="Twice"),
            patient(2, 1, Deleted="true"),
        ],
        "CareRecord_Observation": [
            observation(11, 7, 2),
            observation(12, 5, 2, CodeId="   "),
            observation(13, 5, 2, CodeId=""),
        ],
        "Appointment_SessionUser": [{"SessionGuid": "S1", "UserInRoleGuid": "U9"}],
    }


def delta_with_new_practice():
    """A third practice; the missing patient arrives; a slot names another practice's patient."""
    return {
        "Admin_Organisation": [organisation(3)],
        "Agreements_SharingOrganisation": sharing(1, 2, 3),
        "Admin_Patient": [patient(7, 2), patient(8, 3)],
        # A session sent twice doubles its users, the last row of their file included.
        "Appointment_Session": [
            {"AppointmentSessionGuid": "S3", "LocationGuid": "L3", "OrganisationGuid": ORG[3]},
            {"AppointmentSessionGuid": "S3", "LocationGuid": "L3", "OrganisationGuid": ORG[3]},
        ],
        "Appointment_SessionUser": [{"SessionGuid": "S3", "UserInRoleGuid": "U1"}],
        "Appointment_Slot": [
            {"SlotGuid": "T1", "PatientGuid": "P1", "OrganisationGuid": ORG[3]},
            {"SlotGuid": "T2", "PatientGuid": "P8", "OrganisationGuid": ORG[3]},
        ],
    }
