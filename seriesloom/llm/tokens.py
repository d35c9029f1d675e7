"""Encoding whole texts with the public byte-level vocabulary.

The merges of the vocabulary's rank file are applied by tiktoken, which returns the ids of
``byte_bpe_50k.json`` about three times as fast; a test holds the two against each other.
Each task opens the vocabulary file itself; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools

import tiktoken

VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 1


@functools.lru_cache(maxsize=2)
def encoding(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
