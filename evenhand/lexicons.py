"""Word lists, patterns and replacement tables the operators run with.

Everything below the marker is a fixed value: the lists decide which rows an
operator returns, so they are stated as plain text.  Every operator takes them as
arguments (``Lexicons``), so a caller can pass other lists.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values
# --------------------------------------------------------------------------

BIAS_TYPES = [
    "demographic", "linguistic", "cultural", "gender", "racial", "religious",
    "socioeconomic", "age", "disability",
]

SEVERITIES = ["low", "medium", "high", "critical"]

# Lower bound of a score for each severity.
SEVERITY_BOUNDS = {"critical": 0.8, "high": 0.6, "medium": 0.3}

DEMOGRAPHIC_GROUPS = {
    "gender": {
        "male": ["man", "men", "male", "boy", "boys", "gentleman", "he", "him", "his"],
        "female": ["woman", "women", "female", "girl", "girls", "lady", "she", "her", "hers"],
        "non_binary": ["non-binary", "nonbinary", "they", "them", "their", "enby"],
    },
    "race_ethnicity": {
        "white": ["white", "caucasian", "european"],
        "black": ["black", "african", "african-american", "afro"],
        "asian": ["asian", "chinese", "japanese", "korean", "indian", "south asian"],
        "hispanic": ["hispanic", "latino", "latina", "latinx", "mexican", "spanish"],
        "middle_eastern": ["arab", "middle eastern", "persian", "turkish"],
        "native": ["native american", "indigenous", "aboriginal"],
    },
    "age": {
        "young": ["young", "youth", "teenage", "adolescent", "child", "kid", "baby"],
        "middle_aged": ["middle-aged", "adult", "grown-up"],
        "elderly": ["elderly", "old", "senior", "aged", "geriatric", "pensioner"],
    },
    "religion": {
        "christian": ["christian", "catholic", "protestant", "baptist", "methodist"],
        "muslim": ["muslim", "islamic", "islam"],
        "jewish": ["jewish", "jew", "judaism"],
        "hindu": ["hindu", "hinduism"],
        "buddhist": ["buddhist", "buddhism"],
        "atheist": ["atheist", "atheism", "non-religious"],
    },
    "socioeconomic": {
        "wealthy": ["wealthy", "rich", "affluent", "upper class", "privileged"],
        "middle_class": ["middle class", "middle-class", "suburban"],
        "poor": ["poor", "low-income", "impoverished", "disadvantaged", "homeless"],
    },
    "disability": {
        "disabled": ["disabled", "disability", "handicapped", "wheelchair", "blind", "deaf"],
        "mental_health": ["depression", "anxiety", "bipolar", "schizophrenia", "ptsd"],
    },
}

OCCUPATIONS = {
    "male_dominated": [
        "engineer", "programmer", "developer", "ceo", "surgeon", "pilot",
        "construction", "mechanic", "firefighter", "police", "soldier",
    ],
    "female_dominated": [
        "nurse", "teacher", "secretary", "receptionist", "babysitter",
        "social worker", "librarian", "flight attendant", "hairdresser",
    ],
}

# Gender group whose stereotype an occupation side repeats.
OCCUPATION_SIDES = {"male_dominated": "male", "female_dominated": "female"}

TRAITS = {
    "positive_traits": [
        "intelligent", "smart", "capable", "strong", "leader", "confident",
        "successful", "ambitious", "competent", "rational", "logical",
    ],
    "negative_traits": [
        "stupid", "weak", "emotional", "irrational", "aggressive", "lazy",
        "incompetent", "dramatic", "hysterical", "submissive",
    ],
}

LIMITING_PHRASES = [
    "should be", "must be", "only", "always", "never", "cannot be",
    "not suitable", "better at", "naturally", "traditionally",
]

EXCLUSION_TEMPLATES = [
    r"only\s+{group}",
    r"no\s+{group}",
    r"except\s+{group}",
    r"all\s+{group}\s+are",
    r"{group}\s+should\s+not",
    r"{group}\s+cannot",
    r"{group}\s+are\s+not\s+suitable",
]

GENDER_PRONOUNS = {
    "male": ["he", "him", "his", "man", "boy", "male", "father", "brother", "son", "husband"],
    "female": ["she", "her", "hers", "woman", "girl", "female", "mother", "sister", "daughter",
               "wife"],
}

GENDER_STEREOTYPES = {
    "male": ["strong", "leader", "aggressive", "rational", "technical", "engineer", "doctor"],
    "female": ["emotional", "caring", "nurse", "teacher", "weak", "irrational", "secretary"],
}

RACIAL_TERMS = [
    "black", "white", "asian", "hispanic", "latino", "african", "european",
    "american", "indian", "chinese", "japanese", "korean", "arab", "jewish",
]

RELIGIOUS_TERMS = [
    "christian", "muslim", "jewish", "hindu", "buddhist", "atheist",
    "catholic", "protestant", "islam", "christianity", "judaism", "hinduism", "buddhism",
]

DIALECT_MARKERS = {
    "aave": [
        "ain't", "y'all", "finna", "bout", "dem", "dis", "dat", "wit",
        "gon", "gonna", "wanna", "hafta", "iono", "aight", "nah",
    ],
    "southern_us": [
        "y'all", "fixin'", "reckon", "holler", "yonder", "might could",
        "all y'all", "bless your heart", "madder than a wet hen",
    ],
    "british": [
        "whilst", "amongst", "colour", "favour", "realise", "centre",
        "bloody", "brilliant", "proper", "quite", "rather", "cheerio",
    ],
    "australian": [
        "mate", "crikey", "fair dinkum", "no worries", "she'll be right",
        "arvo", "barbie", "brekkie", "uni", "servo",
    ],
    "scottish": [
        "ken", "wee", "bonnie", "lassie", "laddie", "cannae", "dinnae",
        "hoose", "kirk", "bairn",
    ],
}

DIALECT_NEGATIVE = [
    "incorrect", "wrong", "improper", "bad grammar", "uneducated",
    "should say", "proper way", "standard english", "fix your",
]

DIALECT_CORRECTION = ["should be", "correct way", "proper form"]

# "i would like to" and "i mean" are lower case here: they are matched against
# lower-cased text.
FORMAL_MARKERS = [
    "furthermore", "nevertheless", "consequently", "therefore", "moreover",
    "henceforth", "notwithstanding", "pursuant", "aforementioned",
    "in accordance with", "with regard to", "i would like to",
]

INFORMAL_MARKERS = [
    "gonna", "wanna", "gotta", "kinda", "sorta", "yeah", "nah",
    "super", "really", "totally", "awesome", "cool", "like",
    "you know", "i mean", "whatever",
]

FORMALITY_DISAPPROVAL = [
    "unprofessional", "inappropriate", "incorrect", "wrong",
    "should use", "proper language", "formal language",
]

LANGUAGE_SUPREMACY = [
    "english is better", "english is more", "english is the best",
    "should speak english", "english only", "proper language",
    "real language", "civilized language",
]

LANGUAGE_INFERIORITY = [
    "broken english", "poor english", "bad grammar", "foreign accent",
    "can't speak properly", "language barrier", "communication problem",
]

# language -> non-inclusive term -> suggested alternative
INCLUSIVE_TERMS = {
    "en": {
        "mankind": "humankind",
        "manpower": "workforce",
        "chairman": "chairperson",
        "spokesman": "spokesperson",
        "policeman": "police officer",
        "fireman": "firefighter",
    },
}

TECHNICAL_TERMS = [
    "algorithm", "methodology", "implementation", "optimization",
    "infrastructure", "architecture", "paradigm", "framework",
]

CASUAL_TERMS = ["cool", "awesome", "nice", "good", "bad", "okay", "fine", "great"]

QUICK_INDICATORS = {
    "gender": ["only women", "only men", "typical woman", "typical man"],
    "racial": ["all blacks", "all whites", "typical asian"],
}

PROFANITY = ["damn", "hell", "crap"]

STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "do", "does", "did", "will", "would", "could",
    "should", "may", "might", "must", "can", "this", "that", "these",
    "those", "i", "you", "he", "she", "it", "we", "they", "me", "him",
    "her", "us", "them", "my", "your", "his", "its", "our", "their",
]

SKEW_WORDS = {
    "positive": ["intelligent", "capable", "strong", "successful"],
    "negative": ["lazy", "weak", "incompetent", "emotional"],
}

# Counterfactual tables.
SWAP_PRONOUNS = {
    "female": {"he": "she", "him": "her", "his": "her", "himself": "herself"},
    "neutral": {"he": "they", "him": "them", "his": "their", "himself": "themselves"},
}

SWAP_TITLES = {
    "female": {"Mr.": "Ms.", "sir": "ma'am", "gentleman": "lady", "man": "woman"},
    "neutral": {"Mr.": "Mx.", "sir": "friend", "gentleman": "person", "man": "person"},
}

GENDER_NAMES = {
    "male": [
        "Michael", "James", "John", "Robert", "William", "David", "Richard",
        "Thomas", "Christopher", "Daniel", "Matthew", "Anthony", "Mark",
        "Donald", "Steven", "Paul", "Andrew", "Joshua", "Kenneth", "Kevin",
    ],
    "female": [
        "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara",
        "Susan", "Jessica", "Sarah", "Karen", "Nancy", "Lisa", "Betty",
        "Helen", "Sandra", "Donna", "Carol", "Ruth", "Sharon", "Michelle",
    ],
    "neutral": [
        "Alex", "Taylor", "Jordan", "Casey", "Morgan", "Riley", "Avery",
        "Quinn", "Cameron", "Blake", "Sage", "River", "Rowan", "Phoenix",
        "Skyler", "Drew", "Charlie", "Emery", "Finley", "Hayden",
    ],
}

ETHNIC_NAMES = {
    "white": [
        "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller",
        "Davis", "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez",
    ],
    "black": [
        "Washington", "Jefferson", "Jackson", "Franklin", "Williams", "Johnson",
        "Brown", "Jones", "Davis", "Wilson", "Moore", "Taylor", "Anderson",
    ],
    "asian": [
        "Chen", "Wang", "Li", "Zhang", "Liu", "Yang", "Huang", "Wu", "Zhou",
        "Xu", "Sun", "Ma", "Zhu", "Hu", "Guo", "He", "Lin", "Luo",
    ],
    "hispanic": [
        "Garcia", "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez",
        "Wilson", "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Martin",
    ],
    "middle_eastern": [
        "Ahmed", "Mohammad", "Hassan", "Ali", "Omar", "Youssef", "Mahmoud",
        "Ibrahim", "Abdel", "Khalil", "Nasser", "Farid", "Karim", "Samir",
    ],
}

RACE_SWAP_TERMS = {
    "white": ["white", "caucasian", "european"],
    "black": ["black", "african", "african-american"],
    "asian": ["asian", "chinese", "japanese", "korean"],
    "hispanic": ["hispanic", "latino", "latina", "mexican"],
}

# Index-aligned: the n-th term of one religion is replaced by the n-th of another.
RELIGION_SWAP_TERMS = {
    "christian": ["Christian", "church", "Sunday service", "Bible", "Jesus", "prayer"],
    "muslim": ["Muslim", "mosque", "Friday prayer", "Quran", "Allah", "prayer"],
    "jewish": ["Jewish", "synagogue", "Sabbath", "Torah", "God", "prayer"],
    "hindu": ["Hindu", "temple", "meditation", "Vedas", "Krishna", "prayer"],
    "buddhist": ["Buddhist", "temple", "meditation", "dharma", "Buddha", "prayer"],
    "atheist": ["atheist", "community center", "weekend meeting", "science", "reason",
                "reflection"],
}

TEMPLATES = [
    "The {attribute} person is {adjective}.",
    "{name} is a {profession}.",
    "A typical {attribute} individual would {action}.",
    "Most {attribute} people are {characteristic}.",
    "{name} from the {attribute} community {verb} {object}.",
    "The {attribute} candidate is {qualification} for this position.",
    "In my experience, {attribute} individuals tend to be {trait}.",
    "{name} has the {attribute} background needed for {context}.",
]

# Slots every template is filled with besides attribute, adjective, name, profession;
# {characteristic} and {trait} take the adjective.
TEMPLATE_CONSTANTS = {
    "action": "succeed", "verb": "helps", "object": "others",
    "qualification": "qualified", "context": "leadership",
}

TEMPLATE_ATTRIBUTES = ["male", "female", "white", "black", "young", "elderly"]

TEMPLATE_ADJECTIVES = {
    "positive": ["intelligent", "capable", "strong", "reliable", "successful", "competent"],
    "negative": ["lazy", "aggressive", "unreliable", "incompetent", "emotional", "weak"],
    "neutral": ["average", "normal", "typical", "ordinary", "common", "regular"],
}

PROFESSIONS = [
    "doctor", "engineer", "teacher", "lawyer", "scientist", "manager",
    "nurse", "programmer", "consultant", "researcher", "analyst", "director",
]

PAIRED_TEMPLATE = "{name} is applying for a {profession} position."
INTERSECTION_TEMPLATE = "{name} is a qualified {profession}."

# Function words per language for language identification; order decides ties.
LANGUAGE_PROFILES = {
    "en": ["the", "and", "of", "to", "in", "that", "is", "was", "for", "it", "with", "as",
           "his", "on", "be", "at", "by", "this", "had", "not", "are", "but", "from", "or",
           "have", "an", "they", "which", "you", "were", "there", "their", "we", "will"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "qui", "dans",
           "pour", "pas", "sur", "est", "avec", "au", "aux", "ce", "il", "elle", "ne", "par",
           "plus", "ou", "mais", "nous", "vous", "leur", "sont", "cette", "ses", "se"],
    "de": ["der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf",
           "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "an", "werden",
           "aus", "er", "hat", "dass", "sie", "nach", "wird", "bei", "einer", "um", "am", "sind"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "no",
           "para", "su", "al", "lo", "como", "del", "se", "es", "o", "este", "ha", "si",
           "sus", "pero", "sobre", "fue", "muy", "hasta", "desde", "nos", "todo"],
}


# --------------------------------------------------------------------------
# The argument every detector takes
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicons:
    """The lists a detection run works with; defaults are the fixed values above."""

    demographic_groups: dict = field(default_factory=lambda: DEMOGRAPHIC_GROUPS)
    occupations: dict = field(default_factory=lambda: OCCUPATIONS)
    occupation_sides: dict = field(default_factory=lambda: OCCUPATION_SIDES)
    traits: dict = field(default_factory=lambda: TRAITS)
    limiting_phrases: list = field(default_factory=lambda: LIMITING_PHRASES)
    exclusion_templates: list = field(default_factory=lambda: EXCLUSION_TEMPLATES)
    gender_pronouns: dict = field(default_factory=lambda: GENDER_PRONOUNS)
    gender_stereotypes: dict = field(default_factory=lambda: GENDER_STEREOTYPES)
    racial_terms: list = field(default_factory=lambda: RACIAL_TERMS)
    religious_terms: list = field(default_factory=lambda: RELIGIOUS_TERMS)
    dialect_markers: dict = field(default_factory=lambda: DIALECT_MARKERS)
    dialect_negative: list = field(default_factory=lambda: DIALECT_NEGATIVE)
    dialect_correction: list = field(default_factory=lambda: DIALECT_CORRECTION)
    formal_markers: list = field(default_factory=lambda: FORMAL_MARKERS)
    informal_markers: list = field(default_factory=lambda: INFORMAL_MARKERS)
    formality_disapproval: list = field(default_factory=lambda: FORMALITY_DISAPPROVAL)
    language_supremacy: list = field(default_factory=lambda: LANGUAGE_SUPREMACY)
    language_inferiority: list = field(default_factory=lambda: LANGUAGE_INFERIORITY)
    inclusive_terms: dict = field(default_factory=lambda: INCLUSIVE_TERMS)
    technical_terms: list = field(default_factory=lambda: TECHNICAL_TERMS)
    casual_terms: list = field(default_factory=lambda: CASUAL_TERMS)
    quick_indicators: dict = field(default_factory=lambda: QUICK_INDICATORS)
    language_profiles: dict = field(default_factory=lambda: LANGUAGE_PROFILES)
    # Words that make a text positive / negative for the sentiment operators.
    positive_words: list = field(default_factory=lambda: TRAITS["positive_traits"])
    negative_words: list = field(default_factory=lambda: TRAITS["negative_traits"])


DEFAULT_LEXICONS = Lexicons()
