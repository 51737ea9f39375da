"""Fixed values that results depend on: word list, patterns, formats, constants."""

# The English stop words dropped from keywords.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now",
)

# Record framing of the crawl files.
RECORD_SEPARATOR = "WARC/1.0"
LINE_BREAK = "\r\n"
BLANK_LINE = "\r\n\r\n"
FIELD_SEPARATOR = ": "

# URL patterns.
HTTP_URL = r"^https?://"
DOMAIN_PATTERN = r"[^((https?):\/\/)]((www|www1)\.)?([\w-\.]+)"

# Rank and result constants.
RESET_PROBABILITY = 0.15
RANK_TOLERANCE = 0.0001
RESULTS_PER_PAGE = 20
SCORE_FORMAT = "%2.4f"
