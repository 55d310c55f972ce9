from tidemark.functions.hashing import row_digest, row_hash
from tidemark.functions.numeric import (as_money, mean_exact, nan_to_null, pct, pct_or_zero,
                                        round2, round_ratio)
from tidemark.functions.text import normalise, snake_case_name, strip_ws, title_case

__all__ = ["row_digest", "row_hash", "as_money", "mean_exact", "nan_to_null", "pct", "pct_or_zero",
           "round2", "round_ratio", "normalise", "snake_case_name", "strip_ws", "title_case"]
