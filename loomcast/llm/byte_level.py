"""Ids of byte-level BPE tokenizers, as the ``tokenizers`` library gives them for a file.

Where the file is the plain kind (ids in the order of the merges, no normaliser,
the usual split into pre-tokens), the faster ``tiktoken`` makes the same ids from
the file's own vocabulary; every other file, and texts whose runs of white space
are too long for its pattern, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: Fixed value: the pattern that byte-level tokenizers split text by before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: bytes without a visible sign follow from 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encoder of a ``tokenizers`` file; with ``plain`` the strings of special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        special = {t["content"]: t["id"] for t in made["added_tokens"] if t["special"]}
        sign = byte_of_sign()
        #: bytes of each entry but the special ones
        self.bytes_of = {i: bytes(sign[c] for c in t) for t, i in made["model"]["vocab"].items() if t not in special and sign.keys() >= set(t)}
        self.size = self.tokenizer.get_vocab_size()
        #: the smallest kind of number that holds every id
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._allowed = set() if plain else "all"
        self._fast = self._tiktoken(special) if self._is_plain_bpe(made, special) else None

    def _is_plain_bpe(self, made: dict, special: dict) -> bool:
        model, split = made["model"], made["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        joined = [model["vocab"].get("".join(m)) for m in merges]
        return (
            model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and made["normalizer"] is None
            and made["truncation"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and len(special) == len(made["added_tokens"])
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"])
            and sorted(b for b in self.bytes_of.values() if len(b) == 1) == [bytes([b]) for b in range(256)]
            and None not in joined
            and joined == sorted(set(joined))
            and set(joined) == {i for i, b in self.bytes_of.items() if len(b) > 1}
        )

    def _tiktoken(self, special: dict):
        import tiktoken

        ranks = {b: i for i, b in self.bytes_of.items()}
        return tiktoken.Encoding("of_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text, without added special tokens."""
        if self._fast:
            try:
                return self._fast.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=()).astype(self.kind)
            except ValueError:  # the pattern gives up on very long runs of white space
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)


_LOADED: dict[tuple[str, bool], ByteLevel] = {}


def byte_level(path: str, plain: bool = False) -> ByteLevel:
    """The encoder of this worker, loaded once; it keeps no texts."""
    if (path, plain) not in _LOADED:
        _LOADED[path, plain] = ByteLevel(path, plain)
    return _LOADED[path, plain]
