"""Shared constants."""

# These must be exactly as written for results to agree.
SKU_PATTERN = r"^OLD-([A-Z]{3})-(\d{4})$"
SKU_ERROR = "Error: Invalid SKU format"
NOTES_PREFIX = "The answer should mention the following facts either explicitly or implicitly"
NOTES_HEADER = (
    "The answer should mention the following facts either explicitly or implicitly "
    "(NOTE: It is sufficient for the answer to mention these facts **implicitly** "
    "because explicit agreement is not required!):"
)
PROMPT = """Given the following context
  {context}
  ###############
  Answer the following query to the best of your knowledge:
  {user_query}
"""
HUMAN_SOURCE = "HUMAN_SOURCE"
SYNTHETIC_SOURCE = "SYNTHETIC_FROM_DOC"
TO_PROCESS = "to_process"
SKIPPED = "skipped"
PRECISION_COLUMN = "retrieval/llm_judged/chunk_relevance/precision"
JUDGES = (
    "chunk_relevance",
    "context_sufficiency",
    "correctness",
    "groundedness",
    "relevance_to_query",
    "safety",
)
MAX_CONTEXT_CHARS = 4096 * 4
MAX_TOOL_ITERATIONS = 10
LOOKBACK_DAYS = 30
SAMPLE_RATE = 0.3
HOURLY_CAP = 2000
NUM_RESULTS = 5
QUESTIONS_PER_DOC = 3
RETRY_ATTEMPTS = 6
RETRY_MIN_SECONDS = 1
RETRY_MAX_SECONDS = 60

# Reciprocal rank fusion constant of Cormack, Clarke and Buettcher (SIGIR 2009).
RRF_K = 60

# What Python's str.strip() removes: as a regex class that Java and RE2 both accept, and as characters.
PY_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
PY_SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
