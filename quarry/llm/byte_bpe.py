"""Byte-level BPE ids of whole texts, fast.

The vocabulary file is that of the ``tokenizers`` library.  Its ids double as
merge ranks, so the same vocabulary also runs in ``tiktoken`` at several times
the speed with equal ids; texts where the two could differ (special tokens
spelled out, characters on which their Unicode tables might disagree) go
through ``tokenizers`` itself."""

from __future__ import annotations

import json

import numpy as np

#: The pre-tokenizer pattern of byte-level BPE.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNCOMMON = r"[^\x00-\x84\x86-ɏ‐-‧‰-⁞€]"


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes for themselves, the others in turn from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.size = self.slow.get_vocab_size()
        self.begins = np.zeros(self.size, bool)  # ids that start with a blank
        self.begins[[i for b, i in ranks.items() if b.startswith(b" ")]] = True
        self.uncommon = regex.compile(UNCOMMON).search

    def __call__(self, text: str) -> np.ndarray:
        """Ids (uint32) as ``tokenizers`` gives them without special tokens
        added."""
        if self.uncommon(text) or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The vocabulary at ``path``, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
