"""Ids of a public tokenizer of words, as the ``tokenizers`` library gives them.

The file lower-cases, drops white space, splits text into words, single digits
and signs, and merges the bytes of each, the last one with a word's end. Here
many texts are split at once by classes of their characters, each part is closed
by a mark, and ``tiktoken`` merges bytes and mark by the file's own table. Texts
with characters that the two libraries might class unlike, with control
characters or special tokens go to ``tokenizers`` itself, and so does every text
of a file of another kind.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from loomcast.llm.byte_level import byte_of_sign

END_ID = 1
_MARK = "\x01"
_WORD_END = "</w>"
_SPECIAL = "<|"
#: The file's normaliser and split, for which the classes below stand.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANK, _LETTER, _NUMBER, _SIGN, _UNSURE = range(5)


def _classes() -> np.ndarray:
    """Class of each code of the first plane; unsure are control characters and what Unicode 3.2 did not have."""
    out = np.full(1 << 16, _UNSURE, np.uint8)
    for code in range(1 << 16):
        kind, old = unicodedata.category(chr(code)), unicodedata.ucd_3_2_0.category(chr(code))
        if kind == old and kind[0] not in "CZ":
            out[code] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _SIGN)
    out[[9, 10, 11, 12, 13, 32, 0xA0, 0x3000]] = _BLANK
    return out


class WordIds:
    """Ids of texts by a ``tokenizers`` file whose ids fit 16 bits."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self._fast = self._merger(made) if self._is_of_words(made) else None
        self._class_of = _classes()

    @staticmethod
    def _is_of_words(made: dict) -> bool:
        model, steps = made["model"], (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        joined = [model["vocab"].get("".join(m)) for m in merges]
        single = {s + end for s in byte_of_sign() for end in ("", _WORD_END)}
        return (
            (made["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and made["truncation"] is None
            and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": _SPLIT}
            and (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True)
            and steps[1] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
            and model["type"] == "BPE"
            and model.get("end_of_word_suffix") == _WORD_END
            and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback"))
            and all(t["special"] and t["content"].startswith(_SPECIAL) for t in made["added_tokens"])
            and None not in joined
            and joined == sorted(set(joined))
            and single <= set(model["vocab"])
            and max(model["vocab"][s] for s in single) < joined[0]
            and len(single) + len(joined) == len({*model["vocab"]} - {t["content"] for t in made["added_tokens"]})
        )

    @staticmethod
    def _merger(made: dict):
        """The file's merges over bytes; a last byte and the mark merge before all else, as their ids come first."""
        import tiktoken

        sign, ranks = byte_of_sign(), {}
        special = {t["content"] for t in made["added_tokens"]}
        for token, i in made["model"]["vocab"].items():
            if token not in special:
                word_ends = token.endswith(_WORD_END)
                data = bytes(sign[c] for c in (token[: -len(_WORD_END)] if word_ends else token))
                if _MARK.encode() not in data:
                    ranks[data + _MARK.encode() * word_ends] = i
        ranks[_MARK.encode()] = 1 << 20  # never left alone
        return tiktoken.Encoding("of_file", pat_str=f"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks, special_tokens={})

    def _slowly(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, without added special tokens."""
        known = [t.decode("utf-8", "replace") for t in texts]
        if not self._fast:
            return [self._slowly(t) for t in known]
        # a capital sigma has one small form here, wherever it stands
        plain = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in known]
        sure = [_SPECIAL not in t and self._sure(t) for t in known]
        marked, ends = self._marked([t if s else "" for t, s in zip(plain, sure, strict=True)])
        out, at = [], 0
        for text, s, end in zip(known, sure, ends, strict=True):
            out.append(self._fast.encode_to_numpy(marked[at:end], disallowed_special=()).astype(np.uint16) if s else self._slowly(text))
            at = end
        return out

    def _codes(self, text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def _sure(self, text: str) -> bool:
        if text.isascii():
            c = self._class_of[np.frombuffer(text.encode(), np.uint8)]
        else:
            both = self._codes(text + unicodedata.normalize("NFC", text).lower())
            c = self._class_of[np.minimum(both, (1 << 16) - 1)]  # the last code is unsure
        return not (c == _UNSURE).any()

    def _marked(self, texts: list[str]) -> tuple[str, list[int]]:
        """All parts of all texts, each with a mark after it; and where each text ends in that."""
        codes = self._codes("\n".join([*texts, ""]))
        c = self._class_of[codes]
        following = np.append(c[1:], np.uint8(_BLANK))
        last = (c != _BLANK) & ((c != following) | (c == _NUMBER))
        # 's, 't, 'm, 'd, 're, 've and 'll are parts of their own where a run of signs would begin
        quote = np.flatnonzero(codes == ord("'"))
        quote = quote[(quote == 0) | (c[quote - 1] != _SIGN)]
        if len(quote):
            one, two = (codes[np.minimum(quote + k, len(codes) - 1)] for k in (1, 2))
            short = np.isin(one, list(map(ord, "stmd")))
            long = np.isin(one, list(map(ord, "rv"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            last[quote[short | long]] = False
            last[quote[short] + 1] = True
            last[quote[long] + 2] = True
        keep = c != _BLANK
        place = np.cumsum(keep.astype(np.int64) + last)
        out = np.full(int(place[-1]), ord(_MARK), np.uint32)
        out[(place - last - 1)[keep]] = codes[keep]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        return out.tobytes().decode("utf-32-le"), place[ends].tolist() if len(texts) else []


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The encoder of this worker, loaded once; it keeps no texts."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def with_end(ids: np.ndarray) -> np.ndarray:
    return np.append(ids, np.uint16(END_ID))
