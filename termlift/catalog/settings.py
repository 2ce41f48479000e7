"""Parameters that the queries and their SQL share."""

# Frequent function words of the four languages in the test documents.
STOP_WORDS = (
    "the", "of", "and", "by", "for", "in", "is", "it", "on", "that", "to", "was", "with",
    "de", "des", "du", "et", "la", "le", "les", "que", "un", "une",
    "das", "den", "der", "die", "ein", "nicht", "und", "zu",
    "con", "del", "el", "en", "las", "los", "por", "una",
)

TOP_TERMS = 75
VOCABULARY_SIZE = 2000
MIN_DOCUMENTS = 2
SELECTED_FEATURES = 500

# A validation grid small enough to train on every check.
GRID_FEATURES = (50, 500)
GRID_STD = (True, False)
GRID_REG = (0.01, 0.1, 1.0)
GRID_ITER = (5, 10)
