"""Fixed values that must stay equal to the original jobs' settings.

FIXED VALUES -- do not edit:

* TOKEN_PATTERN: the word pattern of the review tokenizer (match mode).
  A word run may not start right after an apostrophe; only that one
  character is skipped, so "they're" gives "they", "e".
* STOP_WORDS_ENGLISH: Spark ML's default English stop-word list
  (``StopWordsRemover.loadDefaultStopWords("english")``), 181 words, in
  Spark's order. Kept as text so SQL oracles can use the same list.
* Defaults of the jobs: ALS seed 42, key n-gram size 2, 50 extremes per
  side, split seed 42, SVM regParam grid.
"""

TOKEN_PATTERN = r"(?!(?<='))\w+"

STOP_WORDS_ENGLISH = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll",
    "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd",
    "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've",
    "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's",
    "there's", "what's", "when's", "where's", "who's", "why's", "would",
)

ALS_SEED = 42
SPLIT_SEED = 42
KEY_NGRAM_N = 2
KEY_EXTREMES_PER_SIDE = 50
SVM_REG_GRID = (0.01, 0.1, 1.0)
PERSONA_RATING = 5.0
POSITIVE_MIN_STARS = 4
