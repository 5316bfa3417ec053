"""Rule tables used by the text operators.

Everything here is data. Each operator takes its table as a parameter and only
defaults to the one below, so another domain needs another table, not other code.
"""

# English stopwords, equal to Spark's StopWordsRemover list.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

# Disease categories.
CATEGORIES = ["ALS", "OCD", "Parkinson", "Dementia", "Scoliosis"]

# Section flags, searched in the lower-cased text.
SECTION_RULES = {
    "inclusion_criteria": r"inclusion criteria|eligibility criteria",
    "exclusion_criteria": r"exclusion criteria",
    "study_design": r"study design|trial design",
    "background": r"background|introduction",
    "methodology": r"methodology|methods|procedure",
    "outcome_measures": r"outcome measures|endpoints",
    "statistical_analysis": r"statistical analysis|statistics",
}

# Clinical content flags, searched in the lower-cased text.
CONTENT_RULES = {
    "has_dosage": r"\d+\s*mg|\d+\s*kg",
    "has_duration": r"\d+\s*(weeks?|months?|years?)",
    "has_medical_tests": r"mri|ct scan|blood test|biopsy",
    "has_procedures": r"surgery|procedure|treatment|therapy",
    "has_demographics": r"age|gender|ethnicity|population",
}

# Structure flags, searched in the raw text.
STRUCTURE_RULES = {
    "has_lists": r"\n[-*•]|\d+\.",
    "has_numbers": r"\d+",
    "has_measurements": r"\d+\s*(mg|kg|ml|cm|weeks|months)",
}

# Named patterns counted over the corpus.
COUNTED_PATTERNS = {
    "percentage": r"\d+%",
    "decimal_numbers": r"\d+\.\d+",
    "parentheses": r"\([^)]*\)",
    "brackets": r"\[[^\]]*\]",
    "fractions": r"\d+/\d+",
    "plus_minus": r"\d+±\d+",
    "milligrams": r"\d+\s*mg",
    "kilograms": r"\d+\s*kg",
    "milliliters": r"\d+\s*ml",
    "ranges": r"\d+\s*-\s*\d+",
}

# Abbreviations whose case is unified.
CASE_ABBREVIATIONS = {
    "ALS": "amyotrophic lateral sclerosis",
    "OCD": "obsessive compulsive disorder",
    "PD": "parkinson's disease",
    "AD": "alzheimer's disease",
    "CBT": "cognitive behavioral therapy",
}

# Terms that are lower-cased and reported.
PRESERVED_TERMS = [
    "lateral sclerosis", "amyotrophic", "respiratory", "muscle strength",
    "compulsive", "obsessive", "anxiety", "behavioral therapy",
    "motor", "levodopa", "dopaminergic", "movement disorders",
    "cognitive", "alzheimer", "caregivers", "memory",
    "spine", "curve", "surgical", "idiopathic",
]

# Units whose measurements are written compactly.
COMPACT_UNITS = ["mg", "kg", "ml", "cm", "mm", "units"]

# Characters with a context rule.
CONTEXT_CHARS = ["(", ")", ".", ",", "-", "/", "%", "±"]

# Characters set apart by blanks outside protected spans.
SPACED_CHARS = [";", ":", "|", "\\", "[", "]", "{", "}", "_", "=", "+", "*"]

# Spans left untouched by the special-character cleaner.
PROTECTED_SPANS = {
    "measurements": [
        r"\d+(?:\.\d+)?\s*(?:mg|kg|ml|cm|mm)",
        r"\d+(?:\.\d+)?\s*%",
        r"\d+(?:\.\d+)?\s*±\s*\d+(?:\.\d+)?",
    ],
    "ranges": [r"\d+\s*-\s*\d+", r"\d+\s*/\s*\d+"],
    "compound_terms": [r"\w+(?:-\w+)+", r"\w+(?:/\w+)+"],
    "statistical_values": [r"p\s*[<>]\s*0\.\d+", r"[\+-]\s*\d+(?:\.\d+)?"],
}

# Spans left untouched by the tokenizer, any case.
TOKEN_SPANS = {
    "measurements": r"\d+\s*(?:mg|kg|ml|cm|mm)",
    "scores": r"\d+\s*(?:points?|score)",
    "percentages": r"\d+\s*%",
    "ranges": r"\d+\s*-\s*\d+",
}

# Clinical scores per category, any case.
SCORE_RULES = {
    "ALS": {
        "FVC": r"\d+\s*%?\s*FVC",
        "ALSFRS": r"ALSFRS-?R?\s*(?:score)?\s*:?\s*\d+",
    },
    "OCD": {
        "YBOCS": r"Y-?BOCS\s*(?:score)?\s*:?\s*\d+",
        "Severity": r"severity\s*(?:score)?\s*:?\s*\d+",
    },
    "Parkinson": {
        "UPDRS": r"UPDRS\s*(?:score)?\s*:?\s*\d+",
        "Hoehn": r"Hoehn\s*(?:and)?\s*Yahr\s*(?:stage)?\s*:?\s*\d+",
    },
    "Dementia": {
        "MMSE": r"MMSE\s*(?:score)?\s*:?\s*\d+",
        "CDR": r"CDR\s*(?:score)?\s*:?\s*[\d\.]+",
    },
    "Scoliosis": {
        "Cobb": r"Cobb\s*(?:angle)?\s*:?\s*\d+\s*°?",
        "Degree": r"\d+\s*(?:degree[s]?)?\s*(?:curve|angle)",
    },
}

# Abbreviations written out at their first occurrence.
ABBREVIATIONS = {
    "ALS": "amyotrophic lateral sclerosis",
    "OCD": "obsessive compulsive disorder",
    "PD": "parkinson's disease",
    "AD": "alzheimer's disease",
    "ALSFRS-R": "ALS Functional Rating Scale Revised",
    "FVC": "Forced Vital Capacity",
    "YBOCS": "Yale-Brown Obsessive Compulsive Scale",
    "UPDRS": "Unified Parkinson Disease Rating Scale",
    "MMSE": "Mini-Mental State Examination",
    "CDR": "Clinical Dementia Rating",
    "MRI": "Magnetic Resonance Imaging",
    "CT": "Computed Tomography",
    "EEG": "Electroencephalogram",
    "EMG": "Electromyography",
    "tx": "treatment",
    "dx": "diagnosis",
    "hx": "history",
    "pts": "patients",
    "sig": "significant",
}

# Measurement units and their names.
UNIT_NAMES = {
    "mg": "milligrams",
    "kg": "kilograms",
    "ml": "milliliters",
    "mm": "millimeters",
    "cm": "centimeters",
}

# Synonyms per category.
CATEGORY_SYNONYMS = {
    "ALS": {
        "motor neuron disease": "amyotrophic lateral sclerosis",
        "muscle weakness": "muscular weakness",
        "breathing difficulty": "respiratory difficulty",
        "bulbar symptoms": "bulbar dysfunction",
        "als disease": "ALS",
        "motor function loss": "motor deficit",
    },
    "OCD": {
        "obsessive thoughts": "obsessions",
        "compulsive behaviors": "compulsions",
        "intrusive thoughts": "obsessive thoughts",
        "ritualistic behavior": "compulsive behavior",
        "anxiety symptoms": "anxiety manifestations",
        "ocd symptoms": "OCD manifestations",
    },
    "Parkinson": {
        "tremors": "tremor",
        "shaking": "tremor",
        "movement problems": "motor symptoms",
        "balance problems": "postural instability",
        "stiffness": "rigidity",
        "slow movement": "bradykinesia",
    },
    "Dementia": {
        "memory loss": "cognitive decline",
        "confusion": "cognitive impairment",
        "behavioral changes": "behavioral symptoms",
        "memory problems": "memory impairment",
        "thinking problems": "cognitive dysfunction",
        "mental decline": "cognitive deterioration",
    },
    "Scoliosis": {
        "spine curvature": "spinal curvature",
        "curved spine": "spinal curvature",
        "back deformity": "spinal deformity",
        "spine deviation": "spinal deviation",
        "backbone curve": "spinal curve",
        "spinal bend": "spinal curvature",
    },
}

# Synonyms common to all categories.
COMMON_SYNONYMS = {
    "symptom": "manifestation",
    "side effect": "adverse effect",
    "adverse reaction": "adverse effect",
    "negative effect": "adverse effect",
    "medicine": "medication",
    "drug": "medication",
    "therapy": "treatment",
    "therapeutic": "treatment",
    "test": "assessment",
    "examination": "assessment",
    "evaluation": "assessment",
    "checkup": "examination",
    "condition": "status",
    "state": "status",
    "progression": "disease progression",
    "improvement": "clinical improvement",
    "deterioration": "clinical deterioration",
}

# Frequency and unit synonyms.
FREQUENCY_SYNONYMS = {
    "monthly": "per month",
    "weekly": "per week",
    "daily": "per day",
    "yearly": "per year",
    "twice daily": "BID",
    "three times daily": "TID",
    "four times daily": "QID",
    "once daily": "QD",
    "milliliters": "ml",
    "milligrams": "mg",
    "kilograms": "kg",
    "centimeters": "cm",
}

# Per category, terms to lower-case and measurements to list, any case.
CATEGORY_RULES = {
    "ALS": {
        "terms": ["amyotrophic lateral sclerosis", "motor function", "respiratory"],
        "measurements": [r"\d+\s*fvc", r"\d+\s*alsfrs"],
    },
    "OCD": {
        "terms": ["obsessive compulsive", "anxiety", "behavioral therapy"],
        "measurements": [r"\d+\s*ybocs", r"\d+\s*severity"],
    },
    "Parkinson": {
        "terms": ["motor symptoms", "levodopa", "dopaminergic"],
        "measurements": [r"\d+\s*updrs", r"\d+\s*hoehn"],
    },
    "Dementia": {
        "terms": ["cognitive function", "memory", "alzheimer"],
        "measurements": [r"\d+\s*mmse", r"\d+\s*cdr"],
    },
    "Scoliosis": {
        "terms": ["spinal curve", "surgical correction", "idiopathic"],
        "measurements": [r"\d+\s*degree", r"\d+\s*cobb"],
    },
}

# Words the stopword step always keeps.
KEPT_WORDS = [
    "disease", "disorder", "syndrome", "condition", "symptoms",
    "treatment", "therapy", "drug", "dose", "trial",
    "high", "low", "increase", "decrease", "level",
    "daily", "weekly", "monthly", "duration",
    "positive", "negative", "normal", "abnormal",
]

# Domain stopwords.
DOMAIN_STOPWORDS = [
    "study", "research", "clinical", "medical", "patient",
    "subject", "participant", "investigator", "physician",
    "protocol", "procedure", "visit", "center", "facility",
    "including", "included", "excluded", "following",
    "based", "related", "associated", "regarding",
]

# Per category, words the stopword step keeps.
CATEGORY_KEPT_WORDS = {
    "ALS": ["respiratory", "bulbar", "motor", "muscle", "weakness",
            "progression", "function", "strength", "vital", "capacity"],
    "OCD": ["compulsive", "obsessive", "anxiety", "behavior",
            "ritual", "intrusive", "thoughts", "severity"],
    "Parkinson": ["motor", "tremor", "rigidity", "movement", "balance",
                  "gait", "dopamine", "dyskinesia"],
    "Dementia": ["cognitive", "memory", "mental", "behavioral",
                 "function", "decline", "caregiver", "activities"],
    "Scoliosis": ["curve", "spine", "degree", "correction", "fusion",
                  "thoracic", "lumbar", "surgical"],
}

# General medical terms with a raised weight.
GENERAL_TERMS = [
    "disease", "syndrome", "disorder", "condition", "symptoms",
    "treatment", "therapy", "medication", "diagnosis", "prognosis",
    "clinical", "medical", "therapeutic", "assessment", "evaluation",
]

# Per category, terms with the highest weight.
CATEGORY_TERMS = {
    "ALS": ["amyotrophic", "lateral", "sclerosis", "bulbar", "respiratory",
            "muscle", "weakness", "motor", "function", "strength",
            "vital", "capacity", "decline", "progression", "fvc"],
    "OCD": ["obsessive", "compulsive", "anxiety", "ritual", "behavior",
            "intrusive", "thoughts", "repetitive", "severity", "ybocs",
            "cognitive", "behavioral", "therapy", "exposure", "response"],
    "Parkinson": ["motor", "tremor", "rigidity", "bradykinesia", "balance",
                  "gait", "movement", "dopamine", "levodopa", "dyskinesia",
                  "updrs", "hoehn", "yahr", "stage", "progression"],
    "Dementia": ["cognitive", "memory", "alzheimer", "decline", "mental",
                 "behavioral", "function", "caregivers", "activities", "mmse",
                 "cdr", "impairment", "deterioration", "confusion", "awareness"],
    "Scoliosis": ["spine", "curve", "spinal", "surgical", "correction",
                  "thoracic", "lumbar", "idiopathic", "cobb", "angle",
                  "fusion", "deformity", "degree", "brace", "curvature"],
}

# Term weights by kind; a measurement-like term contains a digit.
TERM_WEIGHTS = {"category": 2.0, "general": 1.2, "measurement": 1.5, "other": 1.0}

# Measurement counts of the statistics features, any case.
MEASUREMENT_RULES = {
    "scores": r"\d+(?:\s*(?:points?|score))",
    "percentages": r"\d+(?:\.\d+)?\s*%",
    "ranges": r"\d+\s*(?:-|to)\s*\d+",
    "units": r"\d+(?:\.\d+)?\s*(?:mg|kg|ml|cm|mm)",
    "plus_minus": r"\d+\s*±\s*\d+",
}

# Category counts of the statistics features, any case.
CATEGORY_COUNT_RULES = {
    "ALS": {
        "scores": r"(?:ALSFRS-R|FVC)",
        "measurements": r"\d+\s*(?:fvc|alsfrs)",
        "time_patterns": r"(?:months?|years?)\s*(?:decline|progression)",
    },
    "OCD": {
        "scores": r"(?:Y-BOCS|severity)",
        "measurements": r"\d+\s*(?:ybocs|severity)",
        "time_patterns": r"(?:frequency|duration)\s*of\s*(?:symptoms|behaviors)",
    },
    "Parkinson": {
        "scores": r"(?:UPDRS|Hoehn)",
        "measurements": r"\d+\s*(?:updrs|stage)",
        "time_patterns": r"(?:onset|progression|duration)",
    },
    "Dementia": {
        "scores": r"(?:MMSE|CDR)",
        "measurements": r"\d+\s*(?:mmse|cdr)",
        "time_patterns": r"(?:months?|years?)\s*(?:decline|progression)",
    },
    "Scoliosis": {
        "scores": r"(?:Cobb|curve)",
        "measurements": r"\d+\s*(?:degree|angle)",
        "time_patterns": r"(?:growth|progression|correction)",
    },
}

# Entity keywords per entity type.
ENTITY_TERMS = {
    "DISEASE": ["disease", "syndrome", "disorder", "condition"],
    "SYMPTOM": ["symptom", "manifestation", "sign", "indication"],
    "ANATOMY": ["muscle", "nerve", "brain", "spine", "respiratory"],
    "MEDICATION": ["drug", "medication", "treatment", "therapy"],
    "MEASUREMENT": ["score", "scale", "rating", "assessment"],
}

# Entity keywords per category and entity type.
CATEGORY_ENTITY_TERMS = {
    "ALS": {
        "symptoms": ["respiratory decline", "muscle weakness", "bulbar dysfunction"],
        "measurements": ["FVC", "ALSFRS-R"],
        "anatomy": ["motor neurons", "respiratory muscles"],
    },
    "OCD": {
        "symptoms": ["intrusive thoughts", "compulsions", "anxiety"],
        "measurements": ["Y-BOCS", "severity scale"],
        "behaviors": ["ritual", "repetitive behavior"],
    },
    "Parkinson": {
        "symptoms": ["tremor", "rigidity", "bradykinesia"],
        "measurements": ["UPDRS", "Hoehn and Yahr"],
        "anatomy": ["substantia nigra", "basal ganglia"],
    },
    "Dementia": {
        "symptoms": ["memory loss", "cognitive decline", "confusion"],
        "measurements": ["MMSE", "CDR"],
        "domains": ["memory", "executive function", "behavior"],
    },
    "Scoliosis": {
        "anatomy": ["spine", "vertebrae", "thoracic", "lumbar"],
        "measurements": ["Cobb angle", "curve degree"],
        "procedures": ["fusion", "correction", "brace"],
    },
}
