"""Column-expression helpers (all built-in Spark functions, no Python UDFs)."""

from tabula.functions.hashing import hash_fraction, hashed_key60, row_digest60, seeded_md5
from tabula.functions.numeric import MISSING_TOKENS, is_missing, nan_to_null, null_tokens, to_number
from tabula.functions.temporal import cyclic, epoch_millis, years_since

__all__ = [
    "MISSING_TOKENS",
    "cyclic",
    "epoch_millis",
    "hash_fraction",
    "hashed_key60",
    "is_missing",
    "nan_to_null",
    "null_tokens",
    "row_digest60",
    "seeded_md5",
    "to_number",
    "years_since",
]
