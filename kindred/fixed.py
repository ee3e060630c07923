"""These must stay as they are for results to be right."""

# Label codes and their names.
LABEL_NAMES = {
    "W": "White",
    "U": "Blue",
    "B": "Black",
    "R": "Red",
    "G": "Green",
}

# Sizes of an item set.
SET_SIZE = 63            # members, anchor included
FIRST_SCORER_PICKS = 49  # picks scored by the anchor; the rest by the first pick
CANDIDATE_LIMIT = 62     # rows kept by the candidate generator
CANDIDATE_OVERLAP = 2    # candidates share more phrases than this
RANK_CLUSTERS = 6        # clusters of the related-items job
UPCOMING_LIMIT = 10      # rows of the upcoming report
SEARCH_LIMIT = 10        # names returned by a search
NEAREST_LIMIT = 10       # nearest items shown

# Feature clustering.
FEATURE_CLUSTERS = 3
KMEANS_STARTS = 10
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5

# Text clean-up.
LINE_MARK = "\\n"        # the two characters, backslash and n
DROPPED_CHARS = ",.:"
SHOWN_LINE_MARK = "- "
MISSING_COST = "manaCost not found"
FLAG_SUPERTYPE = "Legendary"
ANCHOR_TYPE = "Creature"

# Defaults of the typed fill.
FILL_NUMBER = -1.0
FILL_TEXT_NUMBER = "-1"

# Catalog cleaning.
AVAILABILITY = "paper"
DROPPED_TYPE = "Land"
UPCOMING_COHORT = "DSK"
