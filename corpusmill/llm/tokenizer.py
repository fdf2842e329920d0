"""Public tokenizers by name; each Python worker loads a vocabulary once."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

DEFAULT_DIR = os.environ.get("CORPUSMILL_TOKENIZERS", "/opt/tokenizers")

#: Fixed value: the split pattern of the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=8)
def ranks(name: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> dict[bytes, int]:
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=8)
def byte_bpe(name: str = "byte_bpe_50k", folder: str = DEFAULT_DIR):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=SPLIT, mergeable_ranks=ranks(name, folder), special_tokens={})


@lru_cache(maxsize=4)
def pieces(name: str = "piece_bpe_32k", folder: str = DEFAULT_DIR) -> tuple[list[str], list[float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{name}.model")
    return [p.id_to_piece(i) for i in range(len(p))], [p.get_score(i) for i in range(len(p))]
