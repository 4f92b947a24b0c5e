"""Code tables of the claim model: which codes each value set and drug list holds.

Codes are numbered per claim column (``H0`` … ``H96`` and so on); a value set holds
a run of numbers given as (first, count). Both the Spark views and the DuckDB views
are built from these rows.
"""

from __future__ import annotations

# Size of the code space and prefix by claim column.
HCPCS, REV, BILL, POS, DIAG, PROC = (97, "H"), (31, "R"), (11, "B"), (13, "P"), (89, "D"), (53, "Q")

SPACES = {
    "CPT": HCPCS,
    "HCPCS": HCPCS,
    "CPT-CAT-II": HCPCS,
    "UBREV": REV,
    "UBTOB": BILL,
    "POS": POS,
    "ICD10CM": DIAG,
    "ICD9CM": DIAG,
    "ICD10PCS": PROC,
    "ICD9PCS": PROC,
}

VALUE_SETS = {
    "Outpatient": {"CPT": (0, 30), "HCPCS": (30, 5), "UBREV": (0, 6)},
    "Observation": {"CPT": (35, 6), "UBREV": (6, 2)},
    "ED": {"CPT": (40, 10), "UBREV": (8, 3)},
    "Nonacute Inpatient": {"CPT": (50, 6), "UBREV": (11, 3)},
    "Acute Inpatient": {"CPT": (56, 10), "UBREV": (14, 5)},
    "Inpatient Stay": {"UBREV": (12, 10)},
    "Nonacute Inpatient Stay": {"UBREV": (20, 4), "UBTOB": (3, 1)},
    "Lab Panel": {"CPT": (60, 12), "HCPCS": (72, 2)},
    "Serum Potassium": {"CPT": (66, 14)},
    "Serum Creatinine": {"CPT": (74, 16)},
    "AMI": {"ICD10CM": (0, 8), "ICD9CM": (8, 4)},
    "MI": {"ICD10CM": (3, 2)},
    "CABG": {"CPT": (90, 1), "ICD10PCS": (0, 1)},
    "PCI": {"HCPCS": (91, 1), "ICD10PCS": (1, 1)},
    "Other Revascularization": {"CPT": (92, 1)},
    "IVD": {"ICD10CM": (84, 3)},
    "Diabetes": {"ICD10CM": (10, 4), "ICD9CM": (14, 4)},
    "Diabetes Mellitus Without Complications": {"ICD10CM": (10, 12)},
    "Pregnancy": {"ICD10CM": (20, 1)},
    "IVF": {"HCPCS": (93, 1)},
    "Cirrhosis": {"ICD10CM": (21, 1)},
    "Muscular Pain and Disease": {"ICD10CM": (22, 1)},
    "ESRD": {
        "CPT": (94, 1),
        "UBREV": (30, 1),
        "UBTOB": (9, 2),
        "POS": (12, 1),
        "ICD10CM": (23, 1),
        "ICD10PCS": (2, 1),
    },
    "HbA1c Tests": {"CPT": (10, 12), "CPT-CAT-II": (22, 3)},
    "Urine Protein Tests": {"CPT": (24, 3), "CPT-CAT-II": (27, 1)},
    "Nephropathy Treatment": {"CPT": (28, 1), "ICD10CM": (24, 1)},
    "CKD Stage 4": {"ICD10CM": (25, 1)},
    "Kidney Transplant": {"CPT": (95, 1), "UBREV": (29, 1), "ICD10CM": (26, 1), "ICD10PCS": (3, 2)},
    "Diabetic Retinal Screening": {"CPT": (30, 40)},
    "Diabetic Retinal Screening With Eye Care Professional": {"CPT-CAT-II": (70, 3)},
    "Diabetic Retinal Screening Negative": {"CPT-CAT-II": (73, 2)},
    "Unilateral Eye Enucleation": {"CPT": (0, 50)},
    "Unilateral Eye Enucleation Left": {"ICD10PCS": (5, 4)},
    "Unilateral Eye Enucleation Right": {"ICD10PCS": (9, 4)},
    "Perinatal Conditions": {"ICD10CM": (27, 1)},
    "Chemotherapy": {"CPT": (96, 1), "UBREV": (28, 1), "ICD10CM": (28, 2)},
    "Rehabilitation": {"UBREV": (27, 1), "ICD10CM": (29, 1)},
    "Bone Marrow Transplant": {"CPT": (88, 1), "ICD10PCS": (13, 2)},
    "Organ Transplant Other Than Kidney": {"CPT": (89, 1), "ICD10CM": (86, 2), "ICD9PCS": (15, 2)},
    "Potentially Planned Procedures": {"ICD10PCS": (17, 12), "ICD9PCS": (29, 4)},
    "Acute Condition": {"ICD10CM": (30, 20)},
    "Acute Bronchitis": {"ICD10CM": (40, 10)},
    "HIV": {"ICD10CM": (50, 1)},
    "HIV Type 2": {"ICD10CM": (51, 1)},
    "Malignant Neoplasms": {"ICD10CM": (52, 1), "ICD9CM": (53, 1)},
    "Emphysema": {"ICD10CM": (54, 1)},
    "COPD": {"ICD10CM": (55, 1)},
    "Cystic Fibrosis": {"ICD10CM": (56, 1)},
    "Comorbid Conditions": {"ICD10CM": (57, 1)},
    "Disorders of the Immune System": {"ICD9CM": (58, 1)},
    "Pharyngitis": {"ICD10CM": (59, 3)},
    "Competing Diagnosis": {"ICD10CM": (62, 3)},
    "Asthma": {"ICD10CM": (64, 10), "ICD9CM": (74, 4)},
    "Well-Care": {"CPT": (30, 3), "ICD10CM": (76, 2), "ICD9CM": (78, 2)},
    "DTaP Vaccine Administered": {"CPT": (0, 60)},
    "Inactivated Polio Vaccine (IPV) Administered": {"CPT": (10, 50)},
    "Haemophilus Influenzae Type B (HiB) Vaccine Administered": {"CPT": (20, 50)},
    "Pneumococcal Conjugate Vaccine Administered": {"CPT": (30, 55)},
    "Influenza Vaccine Administered": {"CPT": (40, 30)},
    "Hepatitis B Vaccine Administered": {"CPT": (50, 25)},
    "Newborn Hepatitis B Vaccine Administered": {"ICD10PCS": (20, 20)},
    "Hepatitis A Vaccine Administered": {"CPT": (60, 6)},
    "Varicella Zoster (VZV) Vaccine Administered": {"CPT": (66, 6)},
    "Rotavirus Vaccine (2 Dose Schedule) Administered": {"CPT": (70, 15)},
    "Rotavirus Vaccine (3 Dose Schedule) Administered": {"CPT": (80, 25)},
    "Measles, Mumps and Rubella (MMR) Vaccine Administered": {"CPT": (5, 4)},
    "Measles/Rubella Vaccine Administered": {"CPT": (9, 12)},
    "Mumps Vaccine Administered": {"CPT": (21, 12)},
    "Measles Vaccine Administered": {"CPT": (33, 12)},
    "Rubella Vaccine Administered": {"CPT": (45, 12)},
    "Hepatitis A": {"ICD10CM": (1, 2)},
    "Hepatitis B": {"ICD10CM": (3, 1)},
    "Varicella Zoster": {"ICD10CM": (5, 1)},
    "Measles": {"ICD10CM": (7, 3)},
    "Mumps": {"ICD10CM": (11, 3)},
    "Rubella": {"ICD10CM": (15, 3)},
}

ANTIBIOTICS = [
    "Aminoglycosides", "Aminopenicillins", "Beta-lactamase inhibitors",
    "First generation cephalosporins", "Fourth generation cephalosporins", "Ketolides",
    "Lincomycin derivatives", "Macrolides", "Miscellaneous antibiotics", "Natural penicillins",
    "Penicillinase-resistant penicillins", "Quinolones", "Rifamycin derivatives",
    "Second generation cephalosporins", "Sulfonamides", "Tetracyclines",
    "Third generation cephalosporins", "Urinary anti-infectives",
]
ASTHMA_DRUGS = [
    ("Antiasthmatic combinations", "oral"),
    ("Antibody inhibitor", "subcutaneous"),
    ("Inhaled steroid combinations", "inhalation"),
    ("Inhaled corticosteroids", "inhalation"),
    ("Leukotriene modifiers", "oral"),
    ("Mast cell stabilizers", "inhalation"),
    ("Methylxanthines", "oral"),
    ("Short-acting inhaled beta-2 agonists", "inhalation"),
]
DRUG_CODES = 60
# Drug list: (first drug code, count).
DRUG_LISTS = {
    "Diuretic Medications": (0, 25),
    "Beta-Blocker Medications": (8, 40),
    "Diabetes Medications": (20, 8),
    "Estrogen Agonists Medications": (59, 1),
    "High and Moderate-Intensity Statin Medications": (0, 36),
    "Low-Intensity Statin Medications": (36, 10),
    "ACE Inhibitor/ARB Medications": (46, 6),
}


def reference_rows() -> list[tuple[str, str, str]]:
    """(value_set_name, code, code_system)."""
    rows = []
    for name, systems in VALUE_SETS.items():
        for system, (first, count) in systems.items():
            size, prefix = SPACES[system]
            dot = "." if system.startswith("ICD") else ""
            rows += [
                (name, f"{prefix}{dot}{(first + i) % size}", system) for i in range(count)
            ]
    # A type-of-bill code that looks like a revenue code.
    rows.append(("ESRD", "R26", "UBTOB"))
    return rows


def ndc_rows() -> list[tuple[str, str, str, str, str]]:
    """(medication_list, ndc_code, route, description, drug_id)."""
    rows = [
        (name, f"N{(first + i) % DRUG_CODES}", "oral", name, f"d{(first + i) % 6}")
        for name, (first, count) in DRUG_LISTS.items()
        for i in range(count)
    ]
    rows += [
        ("AAB Antibiotic Medications", f"N{30 + i}", "oral", name, f"d{i % 6}")
        for i, name in enumerate(ANTIBIOTICS)
    ]
    for i in range(32):
        name, route = ASTHMA_DRUGS[i % len(ASTHMA_DRUGS)]
        rows.append(("Asthma Medications", f"N{i + 20}", route, name, f"a{i % 5}"))
    # The same drug by another route: fills of N20, N28 and N45 are oral and inhaled or injected.
    rows += [
        ("Asthma Medications", "N20", "inhalation", "Inhaled corticosteroids", "a0"),
        ("Asthma Medications", "N28", "subcutaneous", "Antibody inhibitor", "a3"),
        ("Asthma Medications", "N45", "oral", "Methylxanthines", "a0"),
    ]
    return rows
