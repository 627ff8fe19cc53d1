"""Ids of a byte-level BPE tokenizer file, for batches of texts.

The file is one of the tokenizers library.  Where its merges are ranked as its ids are, tiktoken's
merger gives the same ids several times faster; it is used for texts of characters below U+0250, whose
classes are the same in both libraries' regular expressions, without the strings of added tokens (as
<|endoftext|>), which the tokenizers library finds first.  That library encodes all others, as it is by default:
the string of an added token in a text is that token.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# Fixed value: the split pattern of byte-level BPE as the tokenizers library applies it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_OTHER = re.compile("[^\x00-ɏ]")
_LONG_SPACE = re.compile(r"\s{1000}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class ByteBPE:
    def __init__(self, path: str):
        self.path, self.fast, self.whole, self.added = path, None, None, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], _byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ranked = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        own = {t["content"] for t in spec.get("added_tokens", ())}
        if own:
            self.added = re.compile("|".join(map(re.escape, sorted(own))))
        if ranked and spec.get("normalizer") is None and model.get("dropout") is None:
            import tiktoken

            ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in own}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def library(self):
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self.whole

    def encode(self, text: str) -> np.ndarray:
        """The text's ids, without special tokens."""
        if self.fast is not None and not (self.added and self.added.search(text)) and not _OTHER.search(text) and not (len(text) >= 1000 and _LONG_SPACE.search(text)):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.library().encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """One encoder for each worker process and file."""
    return ByteBPE(path)
