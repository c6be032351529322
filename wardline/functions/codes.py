"""Concept codes, code families and lookup keys.

Everything in this module is a fixed value of the record system.
"""

from __future__ import annotations

# Concepts: the question an observation answers.
APPOINTMENT_DATE = 5096
OPERATION = 1651
NOTES = 162169
DIAGNOSIS = 6042
VISIT_TYPE = 164181
GROUP_EXCLUDED = 159394
OPERATION_DATE = 159619
HOSPITAL_NUMBER = 5325
PREOPERATIVE_DX = 163034
POSTOPERATIVE_DX = 163035
SURGEON = 1473
FINDINGS = 160029
OPERATIVE_DETAILS = 160632
WEIGHT = 5089
BLOOD_LOSS = 161928
URINE_OUTPUT = 161929

# Answers to the visit-type question.
VISIT_TYPE_LABELS = {164180: "Initial", 160530: "Followup"}
VISIT_TYPE_DEFAULT = "None"

# Encounter types by id, where a report names the id.
DISCHARGE_TYPE = 9
BOOKING_TYPE = 14
SURGERY_TYPE = 16

# Encounter types and forms by external key, where a report looks the id up.
ADMISSION_TYPE_UUID = "d02513f0-8b7a-4040-9dbf-7a1eb62cc271"
NEURO_TYPE_UUID = "4d0b20e6-9bb1-4504-bb76-24486387ca7f"
SURGERY_TYPE_UUID = "f4be29e3-9713-4e3c-ad97-7136ce8768b6"
ADMISSION_FORM_UUID = "fc803dd8-aa3c-4de9-bd87-64ea7c947ae4"
BOOKING_FORM_UUID = "2f59d215-eed5-42e0-ba95-9797125b1d29"

HOSPITAL_NUMBER_TYPE = 4

# Payment modes: column name of the pivot -> mode id.
PAYMENT_MODES = {
    "NHIF": 1,
    "Individual": 2,
    "Government Sponsored": 3,
    "NGO Sponsored": 4,
    "Insurance": 5,
    "Needy Fund": 6,
}

# Code families.
HYDROCEPHALUS_DX = (
    115140, 117470, 117471, 118437, 122148, 122149, 122782, 129291, 132515, 136237,
    138371, 143924, 144543, 145477, 148470, 150017, 153812, 158433, 163858,
)
SPINA_BIFIDA_DX = (
    112213, 112417, 112418, 112833, 115831, 116204, 116205, 119941, 119943, 120774,
    120775, 122136, 124838, 126203, 126204, 126205, 126206, 126207, 126208, 134353,
    134356, 136236, 138367, 138368, 138382, 143237, 143722, 143723, 144092, 152477,
    157506, 158090, 163820,
)
SHUNT_TOTAL = (
    164261, 164262, 164263, 164264, 164265, 164267, 164268, 164270, 164272, 164273,
    164274, 164277, 164278, 164280, 164281, 164282, 164283, 164284, 164285, 164286,
    164287, 164288, 164289, 164291, 164292, 164293, 164294, 164295, 164296, 164297,
    164299, 164303, 164305, 164306, 164308, 164309, 164310, 164311, 164312, 164313,
    164314, 164316, 164317, 164318,
)
SHUNT_REVISIONS = (
    164262, 164267, 164270, 164277, 164280, 164285, 164294, 164295, 164296, 164297,
    164305, 164310, 164311, 164314, 164318,
)
ETV = (164049,)
HYDROCEPHALUS_OPERATIONS = ETV + SHUNT_TOTAL + (164320,)
MMC_CLOSURES = (164271, 164275, 164300, 164301, 164302, 164319)

# Labels the diagnosis families are reported under.
HYDROCEPHALUS = "Hydrocephalus"
SPINA_BIFIDA = "SB"
DX_FAMILIES = {HYDROCEPHALUS: HYDROCEPHALUS_DX, SPINA_BIFIDA: SPINA_BIFIDA_DX}
