"""Defaults, lists and patterns that decide results."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

# Suffixes ingested by default; "" stands for files without a suffix.
DEFAULT_EXTENSIONS = [".py", ".md", ""]

# Suffixes a caller may ask for.
ALLOWED_EXTENSIONS = [
    ".cmake", ".cpp", ".cpu", ".css", ".cu", ".cuh", ".h", ".hpp", ".html",
    ".ico", ".in", ".inl", ".jinja", ".jpg", ".js", ".json", ".jsonl", ".md",
    ".neuron", ".nightly_torch", ".patch", ".png", ".ppc64le", ".py", ".rocm",
    ".rocm_base", ".s390x", ".sh", ".toml", ".tpl", ".tpu", ".txt", ".typed",
    ".xpu", ".yaml", "",
]

# Names under which "files without a suffix" may be asked for.
NO_EXTENSION_NAMES = ["no_ext", "no-ext", "noext"]
NO_EXTENSION = "no_ext"

MIN_CHUNK_SIZE = 150
MAX_CHUNK_SIZE = 2000
DEFAULT_CHUNK_SIZE = 2000
DEFAULT_K = 10

# Separators per suffix: (strong ones, weak ones), each tried in list order.
SEPARATORS = {
    ".py": (["\ndef ", "\nclass "], ["\n\n", "\n"]),
    ".md": (["\n#"], ["\n\n", "\n"]),
    "": (["\n\n"], ["\n", "; ", ". "]),
}
# A cut counts only beyond this share of the chunk size.
STRONG_CUT_SHARE = 0.8
WEAK_CUT_SHARE = 0.9

# Word characters: letters, digits and underscore of any script.
WORD_CHARS = r"\p{L}\p{N}_"
MIN_TOKEN_LENGTH = 2

# The 33 English stop words of the Lucene list.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

BM25_K1 = 1.5
BM25_B = 0.75

# Constant score of a vector hit in the hybrid ranking.
VECTOR_SCORE = 0.5

# Evaluation: context budget in characters, overlap share of a hit, depths.
CONTEXT_BUDGET = 3000
HIT_SHARE = 0.05
RECALL_DEPTHS = [1, 3, 5, 10]

# Two newest-mtime values closer than this are the same state.
MTIME_TOLERANCE = 0.001

# Embedding batch handed to a caller-supplied model.
EMBED_BATCH = 100
HASH_DIMENSIONS = 64

# Options handed to a caller-supplied text generator.
GENERATION_OPTIONS = {
    "max_new_tokens": 50,
    "do_sample": False,
    "repetition_penalty": 1.1,
    "return_full_text": False,
}

ANSWER_MARK = "Answer:"
NO_ANSWER = "I don't know"
MIN_ANSWER_LENGTH = 3

PROMPT_HEAD = (
    "Context information is below.\n"
    "---------------------\n"
)
PROMPT_MIDDLE = (
    "\n---------------------\n"
    "Given the context information and not prior knowledge, "
    "answer the query concisely in 1 or 2 sentences max.\n"
    "If the answer is not in the context,"
    " strictly respond with 'I don't know'.\n"
    "Query: "
)
PROMPT_TAIL = "\nAnswer: "

# --- end of fixed values ----------------------------------------------------
