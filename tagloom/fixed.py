"""Texts, word lists, formats and limits that decide results.

Everything in this module is a plain constant that has to keep its exact value
for outputs to be comparable between runs and engines.
"""

# Parameters (defaults of the four stages).
MAX_POOR_MATCH_RUN = 10
MAX_TOKENS_PER_OBJECTIVE = 5000
HIGH_CUTOFF = 70
MEDIUM_CUTOFF = 40
MINIMAL_CUTOFF = 10
CHAT_MAX_TOKENS = 32000
CHAT_TOKEN_BUFFER = 1000
EMBED_MAX_TOKENS_REMOTE = 8000
EMBED_MAX_TOKENS_LOCAL = 768
EMBED_FLOOR_TOKENS = 512
CHARS_PER_TOKEN = 6
KEEP_FRACTION = 0.8
GOOD_SCORE = 50
MISMATCH_FRACTION = 0.1
TEMPERATURES = (0.0, 0.25, 0.5, 0.75, 1.0)
GENERATE_WAIT_SECONDS = 10.0
RATE_WAIT_SECONDS = 5.0

# Tag suffixes.
HIGH_SUFFIX = "::1_highly_relevant"
MEDIUM_SUFFIX = "::2_somewhat_relevant"
MINIMAL_SUFFIX = "::3_minimally_relevant"

# Words that mark a line as a heading, and how many make it one.
HEADING_WORDS = ["Summary", "Learning", "Objective", "Guiding", "Additional", "Question"]
HEADING_WORD_LIMIT = 2

# Prompt texts. {kind} is the noun for a note, {objective} and
# {card} are the two texts, {text} is a whole document.
RATE_SYSTEM = "You are an assistant that precisely follows instructions."
RATE_USER = (
    "Rate how relevant the {kind} is to the learning question on a scale from 0 to 100 "
    "and return the score.\n    Learning question: {objective}\n    {Kind}: {card}"
)
GENERATE_SYSTEM = (
    "You are a socratic medical school tutor that provides comprehensive learning questions."
)
GENERATE_USER = (
    "Generate a list of learning questions that comprehensively covers the most important "
    "information presented in the text below to understand the topics presented.\n\n{text}"
)

# Patterns, written in the subset Java, RE2 and Python share.
SCORE_PATTERN = r"Score: (\d{1,3})"
NUMBER_PATTERN = r"\b([0-9][0-9]?|100)\b"
LIST_NUMBER_PATTERN = r"^\d+\."
STEM_PATTERN = r"([^/]+?)(\.[^./]+)?/*$"

# Error texts that mean a text was longer than the model accepts.
OVERFLOW_MARKS = ("context length", "exceeds")

# Code points that count as white space when stripping a text.
WHITE_SPACE = "".join(
    map(
        chr,
        [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680]
        + list(range(0x2000, 0x200B))
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
