"""Token ids of a public byte-level vocabulary.

The ids are those of the tokenizers library. The tiktoken library reads the same vocabulary and is several
times faster; tests compare the two. A text that its pattern engine gives up on goes to tokenizers.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np

#: A name among the public vocabulary files; the tiktoken form has the same stem.
VOCABULARY = "byte_bpe_50k.json"


@cache
def _encoders(vocabulary: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    exact.no_truncation()
    exact.no_padding()
    ranks = {}
    with open(public_tokenizers.path(vocabulary.removesuffix(".json") + ".tiktoken"), "rb") as lines:
        for token, rank in map(bytes.split, lines):
            ranks[base64.b64decode(token)] = int(rank)
    special = {t.content: k for k, t in exact.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding(
        vocabulary,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=special,
    )
    return exact, fast


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a text as unsigned 32-bit integers; a null text has none."""
    exact, fast = _encoders(vocabulary)
    try:
        return fast.encode_to_numpy(text or "", allowed_special="all").astype("<u4", copy=False)
    except Exception:  # the pattern engine's own limits on a text; tokenizers has none
        return np.array(exact.encode(text or "", add_special_tokens=False).ids, "<u4")


def vocabulary_size(vocabulary: str = VOCABULARY) -> int:
    return _encoders(vocabulary)[0].get_vocab_size(with_added_tokens=True)
