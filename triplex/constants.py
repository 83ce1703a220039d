"""Fixed values that must equal the behaviour we reproduce.

Everything in this module is data, not logic.  The values are stated
plainly and in their natural order so that they can be reviewed at a
glance; operators import them from here.
"""

from __future__ import annotations

# --- FIXED VALUES: triple cleaning -----------------------------------------

# Namespace prefix stripped from subjects (the opening "<" included).
SUBJECT_PREFIX = "<http://rdf.freebase.com/ns/"

# Namespace of the dump, used by the table adapter to build URIs.
NAMESPACE = "http://rdf.freebase.com/ns/"

# Predicate vocabulary mapping applied after the URI tail is isolated.
PREDICATE_MAPPING = (
    ("rdf-schema#label", "type.object.name"),
    ("rdf-syntax-ns#type", "type.object.type"),
)

# Predicate tail: keep the text after the last "/" of a "<...>" value.
# (?d) restricts "." and "$" to "\n" as line terminator, as in Python.
PREDICATE_TAIL_REGEX = r"(?d)^<.*/(.*?)>$"

# Object unquoting: literal backslash-quote at both ends.
OBJECT_UNQUOTE_REGEX = r'^\\"(.*)\\"$'

# Object text: everything before the first "@" on the first line.
OBJECT_TEXT_REGEX = r"^(.*?)@"

# Length (in characters) from which stop words are removed in the
# "long_only" token mode.
MIN_LEN_STOP_WORDS = 50

# Delimiter of every export.
EXPORT_DELIMITER = "|"

# --- FIXED VALUES: tokenizer ------------------------------------------------

# Token separator: runs of anything that is not a Unicode letter.
TOKEN_SPLIT_REGEX = r"[^\p{L}]+"

# Spark's default English stop words (StopWordsRemover, "english"),
# 181 words in the order of the published list.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "her", "hers", "herself", "it", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing",
    "a", "an", "the", "and", "but", "if", "or", "because", "as", "until",
    "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)

# --- FIXED VALUES: defaults of a batch run ----------------------------------

DEFAULT_DOMAIN = "common"
DEFAULT_SAMPLE_FRACTION = 0.5
