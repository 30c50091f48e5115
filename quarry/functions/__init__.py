from quarry.functions.text import (TOKEN_PATTERN, clean_text, first_line, lexical_text,
                                   relevance_text, snippet, tokens)
from quarry.functions.vectors import (dot, hash_bucket, hash_sign, l2_norm, l2_normalize,
                                      to_double_array)

__all__ = [
    "TOKEN_PATTERN", "clean_text", "first_line", "lexical_text", "relevance_text", "snippet",
    "tokens", "dot", "hash_bucket", "hash_sign", "l2_norm", "l2_normalize", "to_double_array",
]
