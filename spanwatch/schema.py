"""Column vocabulary and fixed values shared by all modules."""

from __future__ import annotations

SITE_KEYS = ["site", "period"]
SENSOR_KEYS = ["site", "period", "sensor_id"]
CHUNK_KEYS = ["site", "period", "chunk"]

READING_COLUMNS = ["site", "period", "family", "sensor_order", "sensor_id", "ts", "value"]

# Fixed values. These must be exactly these for results to be right.

# Families in join order, with the name of the parameter that holds their folder.
FAMILIES = ["rot", "dsp", "str", "tmp"]
FAMILY_FOLDERS = {
    "incl_path": "rot",
    "spost_path": "dsp",
    "str_path": "str",
    "tmp_path": "tmp",
}
BUCKETED_FAMILY = "rot"
BUCKET = "15 minutes"

WARNING_Z = 3.0
ALARM_LEVEL = 3.0
RESET_ABOVE = 3.0
DECAY_RATE = 0.05
GAP_FACTOR = 1.1

UNIT_LABELS = {
    "t": "Temperatura [°C]",
    "e": "Estensione [mm]",
    "s": "Spostamento [mm]",
    "x": "Rotazione longitudinale [mrad]",
    "y": "Rotazione trasversale [mrad]",
}

MONTH_NAMES = [
    "GENNAIO",
    "FEBBRAIO",
    "MARZO",
    "APRILE",
    "MAGGIO",
    "GIUGNO",
    "LUGLIO",
    "AGOSTO",
    "SETTEMBRE",
    "OTTOBRE",
    "NOVEMBRE",
    "DICEMBRE",
]

# site code, site key, label, municipality
SITES = [
    ("P001", "P001_Sommacampagna", "P001 - SOMMACAMPAGNA", "SOMMACAMPAGNA (VR)"),
    ("P002", "P002_Giuliari_Milani", "P002 - GIULIARI MILANI", "VERONA (VR)"),
    ("P003", "P003_Gua", "P003 - GUA", "GUA (VR)"),
    ("P004", "P004_Adige_Est", "P004 - ADIGE EST", "VERONA (VR)"),
    ("P005", "P005_Adige_Ovest", "P005 - ADIGE OVEST", "VERONA (VR)"),
]

CLIENT = "A4"

CATEGORIES = ["Inclinometri", "Potenziometri", "Estensimetri"]
SCORE_CATEGORY_BY_LAST_CHAR = {
    "x": "Inclinometri",
    "y": "Inclinometri",
    "s": "Potenziometri",
    "e": "Estensimetri",
}
RAW_CATEGORY_BY_LABEL_PREFIX = {
    "ICD": "Inclinometri",
    "POT": "Potenziometri",
    "EST": "Estensimetri",
}

# Not reported as artefacts: names holding this word.
EXCLUDED_ARTEFACT = "torte"
ARTEFACT_EXTENSIONS = [".png", ".jpg", ".jpeg"]

KPI_MISSING = "N/A"
