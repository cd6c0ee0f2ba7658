"""Fixed values of the data contract: patterns, word lists and limits.

They decide the results, so they are stated once, as plain text, and every
operator takes them as arguments with these defaults.
"""

# --- patterns (Java regular expressions) -------------------------------------
SIGNATURE = r"\s*Reuter\s*\x03?\s*$"
TICKER_TAG = r"\s*<[A-Z0-9.\-]{1,10}>"
ANGLE_WRAP = r"<([^<>]+)>"
SENTENCE_BREAK = r"(?<=[a-z0-9\"\)][.!?])\s+(?=[A-Z\"\(])"
NON_LETTERS = r"[^a-zA-Z]+"
WORD_RUN = r"[\p{L}\p{N}_]{2,}"
CONTROL_CHARS = r"[\x00-\x08\x0b-\x1f]"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+"
# digits and white space of any script
PHONE = r"(?<!\p{Nd})(?:\+?\p{Nd}[\p{Nd}\s\x1c-\x1f\x85\p{Z}\-()]{8,}\p{Nd})(?!\p{Nd})"
# white space as str.split() sees it, wider than Java's \s
UNICODE_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
# character references as the HTML standard scans them
CHAR_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# --- limits ------------------------------------------------------------------
MIN_SENTENCES = 5
MIN_WORDS = 80
MIN_SENTENCE_WORDS = 4
SUMMARY_SENTENCES = 3
KEYWORDS_PER_DOC = 10
LABELLED_SENTENCES = 2
PROMPT_DOCUMENT_CHARS = 12_000
PROMPT_QUESTION_CHARS = 500
PROMPT_PREVIEW_CHARS = 900
ABSTRACTIVE_INPUT_CHARS = 3_000

# --- names that commands and result tables use --------------------------------
SUMMARY_STYLES = ("paragraph", "bullets", "tldr", "eli5", "executive")
SUMMARY_LENGTHS = ("short", "medium", "long")
MODEL_COLUMNS = {
    "Lead-3": "lead3",
    "Spark TF-IDF": "tfidf_summary",
    "Spark ML GBT": "gbt_summary",
    "TextRank": "textrank_summary",
}
LEARNED_MODEL = "Spark ML GBT"

# --- graph ranking and classifier -------------------------------------------
DAMPING = 0.85
RANK_ROUNDS = 50
GBT_PARAMS = {"maxIter": 40, "maxDepth": 4, "seed": 42}
FEATURES = [
    "sent_idx", "rel_pos", "n_sentences", "s_words",
    "tfidf_norm", "tfidf_pct", "n_digits", "cap_ratio",
]

# --- Spark's default English stop words, in Spark's order ---------------------
# (a test compares them with StopWordsRemover.loadDefaultStopWords)
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()
