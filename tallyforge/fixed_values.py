"""Texts, lists and lookups whose exact content decides the results."""

# First word after "(" in a user agent -> device name.
USER_DEVICES = {
    "Windows": "Windows",
    "iPad": "iPad",
    "iPhone": "iPhone",
    "Macintosh": "Machintosh",
    "compatible": "Windows",
    "X11": "Linux",
}
USER_AGENT_WORD = r"\((\w*)"

# Pages of the click log.
CHURN_PAGE = "Cancellation Confirmation"
CANCEL_PAGES = ["Cancel", "Cancellation Confirmation"]
SONG_PAGE = "NextSong"
FEATURE_PAGES = [
    "About", "Add Friend", "Add to Playlist", "Downgrade", "Error", "Help", "Home", "Logout",
    "NextSong", "Roll Advert", "Save Settings", "Settings", "Submit Downgrade", "Submit Upgrade",
    "Thumbs Down", "Thumbs Up", "Upgrade",
]
CLICK_FILL = {"artist": "unknown", "length": 0, "song": "unknown"}
DUMMY_VALUES = {
    "gender": ["F", "M"],
    "level": ["free", "paid"],
    "userDevice": ["Linux", "Machintosh", "Windows", "iPad", "iPhone"],
}

# Survey texts.
HIGHER_ED_WORDS = ["Master’s", "Doctoral", "Professional"]
SATISFIED_WORD = "satisfied"
YEARS_WORDS = {"Less than 1 year": 0.5, "More than 50 years": 51.0}
FIRST_CODE_WORDS = {"Younger than 5 years": 4.0, "Older than 85": 86.0}
MISSING_CHOICE = "nan"
CHOICE_SEPARATOR = ";"

# Tokens that mean "missing" in a text file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Census classes and numeric features.
INCOME_HIGH = ">50K"
INCOME_LOW = "<=50K"
CENSUS_NUMERIC = ["age", "education-num", "capital-gain", "capital-loss", "hours-per-week"]
CENSUS_SKEWED = ["capital-gain", "capital-loss"]

# Words the Treebank rules split in two (first part, second part).
SPLIT_WORDS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")]

# The usual English stop-word list.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should",
    "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven",
    "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't",
    "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
]

# Advice link for each message label.
EMERGENCY_LINK = "https://www.muenchen.de/int/en/tourism/important-information/emergency-help/most-important-emergency-numbers.html"
FIRE_LINK = "https://www.notruf112.bayern.de/notruf112/"
RESCUE_LINK = "https://www.seenotretter.de/en/who-we-are/"
MILITARY_LINK = "https://www.bundeswehr.de/de/aktuelles/schwerpunkte/search-and-rescue-sar-fliegende-lebensretter-rettungsdienst"
FOOD_LINK = "https://www.bundesregierung.de/breg-en/news/germany-is-second-largest-donor-1547358"
MONEY_LINK = "https://www.arbeitsagentur.de/en/financial-support"
REFUGEE_LINK = "https://www.drk.de/en/aid-worldwide/what-we-do/refugee-relief/services-provided-for-refugees-by-the-grc/"
DISASTER_LINK = "https://www.auswaertiges-amt.de/en/aussenpolitik/themen/humanitaerehilfe/cyclone-idai/2201498"
ADVICE_LINKS = {
    "request": EMERGENCY_LINK,
    "offer": EMERGENCY_LINK,
    "aid_related": EMERGENCY_LINK,
    "medical_help": FIRE_LINK,
    "medical_products": FIRE_LINK,
    "search_and_rescue": RESCUE_LINK,
    "security": EMERGENCY_LINK,
    "military": MILITARY_LINK,
    "water": DISASTER_LINK,
    "food": FOOD_LINK,
    "shelter": RESCUE_LINK,
    "clothing": RESCUE_LINK,
    "money": MONEY_LINK,
    "missing_people": RESCUE_LINK,
    "refugees": REFUGEE_LINK,
    "death": EMERGENCY_LINK,
    "other_aid": EMERGENCY_LINK,
    "infrastructure_related": EMERGENCY_LINK,
    "transport": FIRE_LINK,
    "buildings": FIRE_LINK,
    "electricity": FIRE_LINK,
    "tools": FIRE_LINK,
    "hospitals": EMERGENCY_LINK,
    "shops": FOOD_LINK,
    "aid_centers": EMERGENCY_LINK,
    "other_infrastructure": DISASTER_LINK,
    "weather_related": DISASTER_LINK,
    "floods": DISASTER_LINK,
    "storm": DISASTER_LINK,
    "fire": FIRE_LINK,
    "earthquake": FIRE_LINK,
    "cold": DISASTER_LINK,
    "other_weather": DISASTER_LINK,
}
