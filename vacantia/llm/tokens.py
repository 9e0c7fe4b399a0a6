"""Token ids of a byte-level BPE file of ``tokenizers``.

The file's vocabulary is loaded with ``tokenizers`` and run by tiktoken's merger, which gives the same ids (tests hold
them against each other) in a sixth of the time; a text that holds a special token's string goes through ``tokenizers``
itself. The file's path is a parameter.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the split of byte-level BPE before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable letter: its own where it has one, else the next free one from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        byte_of = {c: b for b, c in _byte_letters().items()}
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in self.whole.get_vocab(with_added_tokens=False).items() if piece not in self.special}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids of the whole text."""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.bpe.encode_to_numpy(text, disallowed_special=()), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
