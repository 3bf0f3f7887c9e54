"""Fixed values shared by every operator.

Values in the FIXED VALUES block must stay equal to the corpus
pipeline this engine reproduces, otherwise ids, filters and splits
change.  Everything else is a tunable default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reproduced pipeline's defaults)
# ---------------------------------------------------------------------------

# File extensions kept by discovery, in configuration order.
CODE_EXTENSIONS = (
    ".py", ".js", ".ts", ".jsx", ".tsx", ".cpp", ".c", ".h", ".hpp", ".java",
    ".go", ".rs", ".rb", ".cs", ".php", ".swift", ".kt", ".sh", ".md", ".txt",
)

# Path-part exclusion patterns (matched as lower-case substrings of every
# path part in "substring" mode, as per-part globs in "glob" mode).
EXCLUDE_PATTERNS = (
    "node_modules", ".git", "__pycache__", "dist", "build", "vendor",
    "*.min.js", "*.lock",
)

MIN_FILE_BYTES = 64
MAX_FILE_BYTES = 1048576

# Special tokens: four core tokens then the extra ones, ids 0..14.
CORE_SPECIALS = ("<unk>", "<pad>", "<bos>", "<eos>")
EXTRA_SPECIALS = (
    "<fim_prefix>", "<fim_suffix>", "<fim_middle>", "<|endoftext|>",
    "<|python|>", "<|javascript|>", "<|typescript|>", "<|cpp|>", "<|java|>",
    "<|go|>", "<|rust|>",
)
SPECIALS = CORE_SPECIALS + EXTRA_SPECIALS

# Extension -> language tag token (None = no tag).
EXT_TO_TAG = {
    ".py": "<|python|>", ".js": "<|javascript|>", ".jsx": "<|javascript|>",
    ".ts": "<|typescript|>", ".tsx": "<|typescript|>", ".cpp": "<|cpp|>",
    ".cc": "<|cpp|>", ".cxx": "<|cpp|>", ".c": "<|cpp|>", ".h": "<|cpp|>",
    ".hpp": "<|cpp|>", ".java": "<|java|>", ".go": "<|go|>", ".rs": "<|rust|>",
    ".rb": "<|rust|>", ".cs": "<|cpp|>", ".php": "<|javascript|>",
    ".swift": "<|cpp|>", ".kt": "<|java|>", ".sh": "<|python|>",
    ".md": None, ".txt": None,
}

# Byte-level pre-tokenizer pattern (no prefix space); white space is Unicode
# white space, which Java's \s means only under (?U).
PRETOKENIZE_RE = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

VOCAB_SIZE = 32000
MIN_FREQ = 2
VAL_RATIO = 0.005
FIM_RATE = 0.5
SPM_RATE = 0.5
TRAIN_SHUFFLE_SEED = 1337
LABEL_PAD = -100
PERPLEXITY_OVERFLOW_LOSS = 300.0
TEMPERATURE_FLOOR = 1e-8
PASS_AT_K = (1, 5, 10)
N_SAMPLES = 20
STORAGE_WIDTH_LIMIT = 65535
FIM_TEXT_MARKERS = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")

# Characters Python's str.strip() removes (str.isspace), as a regex class
# that Java and RE2 read the same way.
PY_SPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Unicode white space (the property), as a class body that RE2 reads.
WHITE_SPACE = (
    r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# ---------------------------------------------------------------------------
# Mapping of the driver's tables onto corpus concepts (our own choice).
# ---------------------------------------------------------------------------

# documents.lang -> file extension of the "code file" a document stands for.
LANG_TO_EXT = {"en": ".py", "de": ".js", "fr": ".md", "es": ".go"}

# First folder of a document's path in the discovery queries, by id: some
# match an exclusion pattern whole, some only hold one, some neither.
TREE_DIRS = ("src", "lib", "build", "rebuilt", "node_modules", "dist", "distance", "vendor",
             "docs", ".github", "app.git", "tests")

# Word-hash tokenizer used by oracle-checkable stream queries: every run of
# non-blank ASCII-delimited characters is one token with id
# HASH_ID_BASE + h(word) mod HASH_ID_SPAN; documents end with EOT_ID.
HASH_WORD_RE = r"[^ \t\n\r\f]+"
HASH_ID_BASE = 100
HASH_ID_SPAN = 30000
EOT_ID = 7


def special_id(token: str) -> int:
    return SPECIALS.index(token)


@dataclass(frozen=True)
class CorpusConfig:
    """Driver-side configuration; never a DataFrame."""

    extensions: tuple = CODE_EXTENSIONS
    exclude_patterns: tuple = EXCLUDE_PATTERNS
    min_bytes: int = MIN_FILE_BYTES
    max_bytes: int = MAX_FILE_BYTES
    exclude_mode: str = "substring"
    ext_to_tag: dict = field(default_factory=lambda: dict(EXT_TO_TAG))
