"""Rule tables.

FIXED VALUES — these strings and codes must equal the reference's for equal results. They are
listed plainly, in the reference's order; the operators turn them into Column expressions.
"""

# --- FIXED VALUES: disease registry, module variant -------------------------------------------
# Each entry: flag column -> list of (column, terms); a term is a tuple of substrings that must all
# occur (literal, case-sensitive). The flag is the number of (column, term) hits; E78.01 is 0/1
# (any of its spellings).
DISEASES_MODULE = {
    "is_E75_22": {"any": False, "terms": [("TEXT", ("E75.22",)), ("ICD10", ("E75.22",)),
                                          ("TEXT", ("Gaucher",)), ("TEXT", ("gaucher",))]},
    "is_E78_01": {"any": True, "terms": [("TEXT", ("amiliäre Hyperchol",)), ("TEXT", ("amiliäre hyperchol",)),
                                         ("TEXT", ("amiliären Hyperchol",)), ("TEXT", ("amiliären hyperchol",))]},
    "is_E78_3": {"any": False, "terms": [("TEXT", ("E78.3",)), ("ICD10", ("E78.3",)),
                                         ("TEXT", ("hylomikronämie",))]},
    "is_E71_3": {"any": False, "terms": [("TEXT", ("E71.3",)), ("ICD10", ("E71.3",)),
                                         ("TEXT", ("Betaoxidationsdefekt",))]},
}

# --- FIXED VALUES: disease registry, notebook variant -----------------------------------------
DISEASES_NOTEBOOK = {
    "is_E75_22": DISEASES_MODULE["is_E75_22"],
    "is_E78_0": {"any": False, "terms": [("TEXT", ("E78.0",)), ("ICD10", ("E78.0",)),
                                         ("TEXT", ("Hypercholesterinämie",)), ("TEXT", ("hypercholesterinämie",))]},
    "is_E78_3": {"any": False, "terms": [("TEXT", ("E78.3",)), ("ICD10", ("E78.3",)),
                                         ("TEXT", ("Chylomikronämie",)), ("TEXT", ("chylomikronämie",))]},
    "is_E71_3": {"any": False, "terms": [("TEXT", ("E71.3",)), ("ICD10", ("E71.3",)),
                                         ("TEXT", ("beta", "xidationsdefekt")), ("TEXT", ("β", "xidationsdefekt"))]},
}

# Flag column -> ICD code it stands for (module variant), in the order the code repair checks them.
FLAG_CODES = [("is_E75_22", "E75.22"), ("is_E78_01", "E78.01"), ("is_E78_3", "E78.3"), ("is_E71_3", "E71.3")]

# --- FIXED VALUES: sites ------------------------------------------------------------------------
SITES = ["BER01", "FRA01", "HAM08", "STR01"]

# --- FIXED VALUES: diagnosis label codes, in the reference's loop order -------------------------
LABEL_CODES = ["E78.01", "E78.3", "E75.22", "E71.3"]

# --- FIXED VALUES: certainty repair fragments ---------------------------------------------------
CERTAINTY_TEXT_RULES = [("usschlu", "A"), ("V.a.", "V"), ("Z.a.", "Z")]
CERTAINTY_SUFFIXES = ["G", "A", "V", "Z"]

# --- FIXED VALUES: co-morbidity code imputation, in order (all fragments must occur) ------------
COMORBIDITY_RULES = [
    (("Hyperton", "art"), "I10.90"),
    (("Hepatitis C",), "B18.2"),
    (("Hypothyreose nach medizinischen Maßnahmen",), "E89.0"),
    (("Sterilität beim Mann",), "N46"),
    (("3-Gefäß-KHK",), "I25.13"),
    (("Vit", "D", "Mangel"), "E55.9"),
    (("Anämie",), "D64.9"),
    (("fatigue", "yndrom"), "G93.3"),
    (("Obstruktive Bronchitis",), "J44.89"),
]

# --- FIXED VALUES: co-morbidity feature codes -----------------------------------------------------
COMORBIDITY_CODES = ["E55.9", "I10.90", "D69.61", "G93.3", "R16.1"]

# --- FIXED VALUES: symptom synonym groups; the feature is named after the first term -------------
SYMPTOM_GROUPS = [
    ["Fatigue", "müde", "Fatique", "Erschöpfung", "fatigue"],
    ["Knochenschmerzen", "Knochenstoffwechselstörung"],
    ["Splenomegalie", "Milzläsionen", "splenomegalie", "Splenektomie", "Hepatosplenomegalie"],
    ["Thrombopenie", "Thrombozytopenie"],
    ["Chololithiasis"],
    ["Chitotriosidase"],
    ["Anämie"],
    ["Leukopenie"],
    ["Panzytopenie"],
    ["Niereninsuffizienz"],
    ["Nephrolithiasis"],
]

# --- FIXED VALUES: symptom score terms (notebook list, 21 terms) ----------------------------------
SYMPTOM_TERMS = [
    "müde", "Fatique", "Erschöpfung", "fatigue", "Fatigue",
    "Knochenschmerzen", "Knochenstoffwechselstörung",
    "Milzläsionen", "Splenomegalie", "splenomegalie", "Splenektomie", "Hepatosplenomegalie",
    "Thrombopenie", "Thrombozytopenie", "Chololithiasis", "Chitotriosidase",
    "Anämie", "Leukopenie", "Panzytopenie", "Niereninsuffizienz", "Nephrolithiasis",
]

# --- FIXED VALUES: E75.22 feature tests ------------------------------------------------------------
E75_TESTS = ["ERY", "HB", "HKT", "MCH", "THRO", "AP", "GGT", "FERR", "NEUT", "FKAP", "FKALAQ", "CRP",
             "INSU", "OSTE", "VD25", "TFS", "ALBUMA", "A1GLOA", "A2GLOA", "DPD"]

# Majority categories in argmax priority order, then the value for "no result".
MAJORITY_CATEGORIES = ["Low", "High", "Very low", "Very high", "Normal"]
NO_TEST = "no_test"
# Discriminative search: 7-way majority order, and the four counted outcomes in argmax order.
MAJORITY7_CATEGORIES = ["Low", "High", "Very low", "Very high", "Normal", "Positive", "Negative"]
DOMINANT_CATEGORIES = ["High", "Low", "Positive", "Negative"]

# --- FIXED VALUES: E78 summed lab tests --------------------------------------------------------------
E78_TESTS = ["CHOL", "CRP", "ERY", "FT4", "GGT", "GLU", "GPT", "HB", "HDL", "HKT", "HS", "LDL", "MCH",
             "MCHC", "MCV", "TRI", "TRIG", "TSH", "TPO", "VITD25"]

# --- FIXED VALUES: familial hypercholesterolaemia spellings and search phrase ----------------------
E78_SPELLINGS = ["amiliäre Hyperchol", "amiliäre hyperchol", "amiliären Hyperchol", "amiliären hyperchol"]
E78_PHRASE = "Familiäre Hypercholesterinämie"

# --- FIXED VALUES: lab result inference, in rule order --------------------------------------------
# (substring, label, case_blind)
INFERENCE_RULES = [("--", "Very low", False), ("-", "Low", False), ("++", "Very high", False),
                   ("+", "High", False), ("negativ", "Negative", True), ("positiv", "Positive", True)]
INFERENCE_DEFAULT = "Normal"
# Ordinal code of an inference (Positive has none).
INFERENCE_ORDINAL = {"Low": 1, "High": 1, "Very high": 2, "Very low": 2, "Negative": 2, "Normal": 0}

# --- FIXED VALUES: reimbursement markers ------------------------------------------------------------
REIMBURSEMENT_MARKERS = ["AL:", "|END"]

# --- FIXED VALUES: German stop words (the public Snowball list, as Spark ML ships it) ---------------
GERMAN_STOP_WORDS = """
aber alle allem allen aller alles als also am an ander andere anderem anderen anderer anderes anderm
andern anderr anders auch auf aus bei bin bis bist da damit dann der den des dem die das daß
derselbe derselben denselben desselben demselben dieselbe dieselben dasselbe dazu dein deine deinem
deinen deiner deines denn derer dessen dich dir du dies diese diesem diesen dieser dieses doch dort
durch ein eine einem einen einer eines einig einige einigem einigen einiger einiges einmal er ihn
ihm es etwas euer eure eurem euren eurer eures für gegen gewesen hab habe haben hat hatte hatten
hier hin hinter ich mich mir ihr ihre ihrem ihren ihrer ihres euch im in indem ins ist jede jedem
jeden jeder jedes jene jenem jenen jener jenes jetzt kann kein keine keinem keinen keiner keines
können könnte machen man manche manchem manchen mancher manches mein meine meinem meinen meiner
meines mit muss musste nach nicht nichts noch nun nur ob oder ohne sehr sein seine seinem seinen
seiner seines selbst sich sie ihnen sind so solche solchem solchen solcher solches soll sollte
sondern sonst über um und uns unse unsem unsen unser unses unter viel vom von vor während war waren
warst was weg weil weiter welche welchem welchen welcher welches wenn werde werden wie wieder will
wir wird wirst wo wollen wollte würde würden zu zum zur zwar zwischen
""".split()

# --- FIXED VALUES: text cleaning --------------------------------------------------------------------
EXTRA_STOP_WORDS = ["hypercholesterinaemi", "hypercholesterinami", "hypercholesterinamie"]
RE_TAGS = r"<[^>]+>"
SINGLE_LETTER = "[A-Za-zÀ-ž]"
RE_SINGLE_LETTER_EMBEDDING = r"\b[A-Za-zÀ-ž,.!?]\b"
MIN_TOKEN_LENGTH = 9  # tokens longer than 8

# --- FIXED VALUES: NA tokens read as null (pandas read_csv defaults) -------------------------------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null"]
