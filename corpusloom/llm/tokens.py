"""Token ids of a byte-level BPE file of the tokenizers library, by a faster engine for the same merges."""

from __future__ import annotations

import json
import re
import sys
import types

from .base import by_value

by_value(__name__)

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cached(key: object, make):
    """Made once per worker process: the module lives in sys.modules, unlike functions that come with a task."""
    held = sys.modules.setdefault("_corpusloom_cache", types.ModuleType("_corpusloom_cache")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


#: Runs of white space (as the pattern has it) that its regex engine may give up on.
LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")


def unbroken(encoding):
    """A text's ids by PATTERN and tiktoken's encoding, also where the regex engine gives up on a very long run of white space, with a panic.

    Such a run is one match of the pattern, but for its last one, which may begin the next token; so texts are cut there.
    """

    def ids(text: str) -> list[int]:
        try:
            return encoding.encode_ordinary(text)
        except BaseException as e:
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        out, at = [], 0
        for m in LONG_SPACE.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += encoding.encode_ordinary(text[at : m.start()]) + encoding._encode_single_piece(text[m.start() : end])
            at = end
        return out + encoding.encode_ordinary(text[at:])

    return ids


class Encoder:
    """ids(text) as tokenizers' encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str):
        import tiktoken

        self.path, self._slow = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def slow(self):
        """The library's own, for the few texts that need it: loaded with the first of them."""
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    def ids(self, text: str) -> list[int]:
        if any(x in text for x in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # its regex engine gives up on some very long runs, with a panic
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.slow.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    return cached(("byte_bpe", path), lambda: Encoder(path))
