"""Where the public vocabulary files lie on the driver (their content is broadcast), and their pattern."""

import public_tokenizers

TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
