"""Rows of the two lookup tables, as VALUES lists.

Fixed values: the ids and external keys that encounter types and forms have in
the record system, with their labels as given. The label of type 11 goes without the name in
brackets after it.
"""

ENCOUNTER_TYPE_ROWS = """
    (1, 'Check In', 'ca3aed11-1aa4-42a1-b85c-8332fc8001fc'),
    (2, 'Vitals', '67a71486-1a54-468f-ac3e-7091a9a79584'),
    (3, 'Discharge', '181820aa-88c9-479b-9077-af92f5364329'),
    (4, 'Admission', 'e22e39fd-7db2-45e7-80f1-60fa0d5a4378'),
    (5, 'Visit Note', 'd7151f82-c1f3-4152-a605-2f9ea7414a79'),
    (6, 'Check Out', '25a042b2-60bc-4940-a909-debd098b7d82'),
    (7, 'Transfer', '7b68d557-85ef-4fc8-b767-4fa4f5eb5c23'),
    (8, 'Procedures', '39d1cf6d-be3d-45d9-b224-e6f708fbdef0'),
    (9, 'Discharge', '3d2ca25a-a008-405d-a874-485d0d84c2cf'),
    (10, 'Social Form', '3faf7df1-f57d-4661-b29e-58e2969d715f'),
    (11, 'NeuroVisit', '4d0b20e6-9bb1-4504-bb76-24486387ca7f'),
    (12, 'Pediatric Visits', '93c4e5dc-42ff-4512-8046-4489c9866d74'),
    (13, 'Investigations', 'b7d7740b-5767-45b6-8ae3-332476e75abf'),
    (14, 'Bookings Form', 'b9490361-6c6a-446a-a6c7-ebcd766c075a'),
    (15, 'Hospitalization', 'd02513f0-8b7a-4040-9dbf-7a1eb62cc271'),
    (16, 'Surgical Procedures', 'f4be29e3-9713-4e3c-ad97-7136ce8768b6')
"""

FORM_ROWS = """
    (1, 'Vitals', 'a000cb34-9ec1-4344-a1c8-f692232f6edd', 2),
    (2, 'Visit Note', 'c75f120a-04ec-11e3-8780-2b40bef9a44b', 5),
    (3, 'Admission (Simple)', 'd2c7532c-fb01-11e2-8ff2-fd54ab5fdb2a', 4),
    (4, 'Discharge (Simple)', 'b5f8ffd8-fbde-11e2-8ff2-fd54ab5fdb2a', 3),
    (5, 'Transfer Within Hospital (Simple)', 'a007bbfe-fbe5-11e2-8ff2-fd54ab5fdb2a', 7),
    (6, 'Hospitalization', 'fc803dd8-aa3c-4de9-bd87-64ea7c947ae4', 15),
    (7, 'Booking Form', '2f59d215-eed5-42e0-ba95-9797125b1d29', 14),
    (8, 'Surgical Procedures', 'd579417c-bdb4-4b2e-bf75-3620c7a2b27e', 16),
    (9, 'Social Form', '7d2a679c-bb5e-425d-b645-50ce46e29fbb', 10),
    (10, 'Neuro Visit', '179ea08c-f66f-4b77-80a9-a5269a75ef49', 11),
    (11, 'PedsSurg Visit', '082b1c09-1237-4851-8862-4e8d0c2ecce0', 12),
    (12, 'Bladder Investigation', '72b1fc63-9ffc-41d3-81ba-f805a192bf54', 13),
    (13, 'Creatinine Investigations', '324f37a9-1b39-4a85-a8a3-26a09ef83f13', 13),
    (14, 'CSF Investigations', '868b87cc-3eca-4aa5-ab5a-509bc17a86ae', 13),
    (15, 'Kidney Investigation', '2e160114-6c24-4933-bbf8-a8553e824cb9', 13),
    (16, 'Other Investigation', '7f4f7ccb-8992-476e-a229-0c6d63e1eda5', 13),
    (17, 'US Head Investigation', 'acb2d701-3deb-4c74-adc1-78b7dc2fce79', 13)
"""

MODE_ROWS = """
    (1, 'NHIF'),
    (2, 'Individual'),
    (3, 'Government Sponsored'),
    (4, 'NGO Sponsored'),
    (5, 'Insurance'),
    (6, 'Needy Fund')
"""
