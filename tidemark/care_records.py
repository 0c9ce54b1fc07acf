"""The registry of the care-record extracts.

Column order is not declared here: it is read from the header record of the first extract installed
(or passed in as a layout) and from then on is part of the contract. Widths not listed are 50.
"""

from tidemark.registry import COMMON, PRACTICE, ForeignKey, Registry, Table, Via

# Table, kind, key, delete flag, tenant path and the widths other than 50.
TABLES = (
    Table(
        "Admin_Location", COMMON, ("LocationGuid",),
        deleted="Deleted",
        tenant=None,
        widths={"LocationName": 500, "HouseNameFlatNumber": 100},
    ),
    Table(
        "Admin_Organisation", COMMON, ("OrganisationGuid",),
        tenant=None,
        widths={"OrganisationName": 500},
    ),
    Table(
        "Admin_OrganisationLocation", COMMON, ("OrganisationGuid", "LocationGuid"),
        deleted="Deleted",
        tenant=None,
    ),
    Table("Admin_Patient", PRACTICE, ("PatientGuid",), deleted="Deleted"),
    Table(
        "Admin_UserInRole", COMMON, ("UserInRoleGuid",),
        tenant=None,
        widths={"GivenName": 100, "Surname": 100},
    ),
    Table(
        "Agreements_SharingOrganisation", COMMON, ("OrganisationGuid",),
        deleted="Deleted",
        tenant=None,
    ),
    Table(
        "Appointment_Session", PRACTICE, ("AppointmentSessionGuid",),
        deleted="Deleted",
        widths={"Description": 200},
    ),
    Table(
        "Appointment_SessionUser", PRACTICE, ("SessionGuid", "UserInRoleGuid"),
        deleted="Deleted",
        tenant=None,
        via=Via("SessionGuid", "Appointment_Session", "AppointmentSessionGuid"),
    ),
    Table("Appointment_Slot", PRACTICE, ("SlotGuid",), deleted="Deleted"),
    Table("Audit_PatientAudit", PRACTICE),
    Table("Audit_RegistrationAudit", PRACTICE),
    Table(
        "CareRecord_Consultation", PRACTICE, ("PatientGuid", "ConsultationGuid"),
        deleted="Deleted",
        widths={"ConsultationSourceTerm": 500},
    ),
    Table(
        "CareRecord_Diary", PRACTICE, ("PatientGuid", "DiaryGuid"),
        deleted="Deleted",
        widths={"OriginalTerm": 500, "LocationTypeDescription": 500},
    ),
    Table(
        "CareRecord_Observation", PRACTICE, ("PatientGuid", "ObservationGuid"),
        deleted="Deleted",
        widths={"AssociatedText": 1000, "NumericUnit": 500},
    ),
    Table("CareRecord_ObservationReferral", PRACTICE, ("PatientGuid", "ObservationGuid")),
    Table(
        "CareRecord_Problem", PRACTICE, ("PatientGuid", "ObservationGuid"),
        deleted="Deleted",
        widths={"Comment": 500},
    ),
    Table(
        "Coding_ClinicalCode", COMMON, ("CodeId",),
        tenant=None,
        widths={
            "Term": 500,
            "NationalCodeCategory": 500,
            "NationalDescription": 500,
            "*CodeCategoryDescription": 500,
        },
    ),
    Table("Coding_DrugCode", COMMON, ("CodeId",), tenant=None, widths={"Term": 500}),
    Table(
        "Prescribing_DrugRecord", PRACTICE, ("PatientGuid", "DrugRecordGuid"),
        deleted="Deleted",
        widths={"Dosage": 500, "QuantityUnit": 500},
    ),
    Table(
        "Prescribing_IssueRecord", PRACTICE, ("PatientGuid", "IssueRecordGuid"),
        deleted="Deleted",
        widths={"Dosage": 500, "QuantityUnit": 500},
    ),
)

# The declared foreign keys.
FOREIGN_KEYS = (
    ForeignKey(1, "Admin_Location", "ParentLocationGuid", "Admin_Location", "LocationGuid"),
    ForeignKey(2, "Admin_Organisation", "CCGOrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(3, "Admin_Organisation", "MainLocationGuid", "Admin_Location", "LocationGuid"),
    ForeignKey(4, "Admin_Organisation", "ParentOrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(5, "Admin_OrganisationLocation", "LocationGuid", "Admin_Location", "LocationGuid"),
    ForeignKey(6, "Admin_OrganisationLocation", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(7, "Admin_Patient", "ExternalUsualGPOrganisation", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(8, "Admin_Patient", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(9, "Admin_Patient", "UsualGpUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(10, "Admin_UserInRole", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(11, "Agreements_SharingOrganisation", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(12, "Appointment_Session", "LocationGuid", "Admin_Location", "LocationGuid"),
    ForeignKey(13, "Appointment_Session", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(14, "Appointment_SessionUser", "SessionGuid", "Appointment_Session", "AppointmentSessionGuid"),
    ForeignKey(15, "Appointment_SessionUser", "UserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(16, "Appointment_Slot", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(17, "Appointment_Slot", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(18, "Appointment_Slot", "SessionGuid", "Appointment_Session", "AppointmentSessionGuid"),
    ForeignKey(19, "Audit_PatientAudit", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(20, "Audit_PatientAudit", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(21, "Audit_PatientAudit", "UserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(22, "Audit_RegistrationAudit", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(23, "Audit_RegistrationAudit", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(24, "Audit_RegistrationAudit", "UserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(25, "CareRecord_Consultation", "AppointmentSlotGuid", "Appointment_Slot", "SlotGuid"),
    ForeignKey(26, "CareRecord_Consultation", "ClinicianUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(27, "CareRecord_Consultation", "ConsultationSourceCodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(28, "CareRecord_Consultation", "EnteredByUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(29, "CareRecord_Consultation", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(30, "CareRecord_Consultation", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(31, "CareRecord_Diary", "ClinicianUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(32, "CareRecord_Diary", "CodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(33, "CareRecord_Diary", "ConsultationGuid", "CareRecord_Consultation", "ConsultationGuid"),
    ForeignKey(34, "CareRecord_Diary", "EnteredByUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(35, "CareRecord_Diary", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(36, "CareRecord_Diary", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(37, "CareRecord_Observation", "ClinicianUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(38, "CareRecord_Observation", "CodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(39, "CareRecord_Observation", "ConsultationGuid", "CareRecord_Consultation", "ConsultationGuid"),
    ForeignKey(40, "CareRecord_Observation", "EnteredByUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(41, "CareRecord_Observation", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(42, "CareRecord_Observation", "ParentObservationGuid", "CareRecord_Observation", "ObservationGuid"),
    ForeignKey(43, "CareRecord_Observation", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(44, "CareRecord_Observation", "ProblemGuid", "CareRecord_Problem", "ObservationGuid"),
    ForeignKey(45, "CareRecord_ObservationReferral", "ObservationGuid", "CareRecord_Observation", "ObservationGuid"),
    ForeignKey(46, "CareRecord_ObservationReferral", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(47, "CareRecord_ObservationReferral", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(48, "CareRecord_ObservationReferral", "ReferralClosureReasonCodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(49, "CareRecord_ObservationReferral", "ReferralReasonCodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(50, "CareRecord_ObservationReferral", "ReferralSourceOrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(51, "CareRecord_ObservationReferral", "ReferralTargetOrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(52, "CareRecord_ObservationReferral", "ReferringCareProfessionalStaffGroupCodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(53, "CareRecord_Problem", "LastReviewUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(54, "CareRecord_Problem", "ObservationGuid", "CareRecord_Observation", "ObservationGuid"),
    ForeignKey(55, "CareRecord_Problem", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(56, "CareRecord_Problem", "ParentProblemObservationGuid", "CareRecord_Problem", "ObservationGuid"),
    ForeignKey(57, "CareRecord_Problem", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(58, "Prescribing_DrugRecord", "ClinicianUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(59, "Prescribing_DrugRecord", "CodeId", "Coding_DrugCode", "CodeId"),
    ForeignKey(60, "Prescribing_DrugRecord", "EnteredByUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(61, "Prescribing_DrugRecord", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(62, "Prescribing_DrugRecord", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(63, "Prescribing_DrugRecord", "ProblemObservationGuid", "CareRecord_Problem", "ObservationGuid"),
    ForeignKey(64, "Prescribing_IssueRecord", "ClinicianUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(65, "Prescribing_IssueRecord", "CodeId", "Coding_DrugCode", "CodeId"),
    ForeignKey(66, "Prescribing_IssueRecord", "DrugRecordGuid", "Prescribing_DrugRecord", "DrugRecordGuid"),
    ForeignKey(67, "Prescribing_IssueRecord", "EnteredByUserInRoleGuid", "Admin_UserInRole", "UserInRoleGuid"),
    ForeignKey(68, "Prescribing_IssueRecord", "OrganisationGuid", "Admin_Organisation", "OrganisationGuid"),
    ForeignKey(69, "Prescribing_IssueRecord", "PatientGuid", "Admin_Patient", "PatientGuid"),
    ForeignKey(70, "Prescribing_IssueRecord", "ProblemObservationGuid", "CareRecord_Problem", "ObservationGuid"),
    ForeignKey(71, "Coding_ClinicalCode", "ParentCodeId", "Coding_ClinicalCode", "CodeId"),
    ForeignKey(72, "Admin_Patient", "ExternalUsualGPGuid", "Admin_UserInRole", "UserInRoleGuid"),
)

# The table whose file name identifies an extract, the one naming the organisations
# that share data, the one describing them, and the patient and code tables the counts use.
MARKER_SCHEMA, MARKER_TABLE = "Admin", "Location"
SHARING = "Agreements_SharingOrganisation"
ORGANISATION = "Admin_Organisation"
PATIENT = "Admin_Patient"
OBSERVATION = "CareRecord_Observation"
CLINICAL_CODE = "Coding_ClinicalCode"

CARE_RECORDS = Registry(TABLES, FOREIGN_KEYS)
