"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from bowline.functions.text import tokens, TOKEN_SPLIT
from bowline.functions.numeric import (
    plogp, argmax_1based, entropy_of, gini_of, safe_div, NEG_INF,
)

__all__ = ["tokens", "TOKEN_SPLIT", "plogp",
           "argmax_1based", "entropy_of", "gini_of", "safe_div", "NEG_INF"]
