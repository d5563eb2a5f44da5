"""Token ids of a public byte-level BPE vocabulary, with a cache of whole words.

The vocabulary file is a parameter (by default the one of the installed ``public_tokenizers``
package). A text is cut at single spaces; since the vocabulary's split pattern attaches one
space to the word after it, each piece is encoded on its own and remembered. Pieces next to
other white space (doubled spaces, a space beside a line break, a space at the end) fall back to
encoding the text whole, so ids always equal those of the whole text. The vocabulary's added tokens are found in
texts first, as the published tokenizer does by default: what lies between them is encoded on its own.
"""

from __future__ import annotations

import base64
import sys
from array import array
from functools import lru_cache

VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 2
# The added tokens of the published vocabulary.
ADDED = {"<|endoftext|>": 50256}
# Words remembered per Python worker: about 100 MB. The cache is emptied when full.
CACHE_WORDS = 400_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; one per Python worker and vocabulary."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._plain = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self._words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = array("I", self._plain(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        for token, number in ADDED.items():
            if token in text:
                return number.to_bytes(4, "little").join(map(self._between, text.split(token)))
        return self._between(text)

    def _between(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        words = self._words
        if len(words) + len(rest) > CACHE_WORDS:
            words.clear()
        found = list(map(words.get, rest))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    w = rest[i]
                    if not w or w[0].isspace() or w[-1].isspace():
                        return self._whole(text)
                    found[i] = words.get(w) or words.setdefault(w, self._whole(" " + w))
        if first and (first[-1].isspace() and rest):
            return self._whole(text)
        return (self._whole(first) if first else b"") + b"".join(found)
