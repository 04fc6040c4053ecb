"""Whole-text byte-level BPE encoding.

The vocabulary is that of a ``tokenizers`` JSON file; texts are encoded by ``tiktoken``
with the ranks read from that file, which gives the same ids several times faster.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Fixed value: how byte-level BPE of this kind cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Such files write bytes as characters: printable ones of Latin-1 as themselves, the
#: others, in order, as those from U+0100.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
CHAR_BYTES = {chr(b): b for b in _PLAIN} | {
    chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}

#: tiktoken's matcher nests on runs of white space and fails beyond some hundred thousand;
#: texts with a run this long are encoded by ``tokenizers`` itself, which gives the same ids.
LONG_RUN = re.compile(r"\s{50000}")

_known: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None) -> "Encoder":
    """The encoder of this process for a tokenizer file."""
    path = path or default_path()
    if path not in _known:
        _known[path] = Encoder(path)
    return _known[path]


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        special = {x["content"]: x["id"] for x in file.get("added_tokens", ())}
        ranks = {bytes(CHAR_BYTES[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merged = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        if any(model["vocab"]["".join(m)] != 256 + i for i, m in enumerate(merged)):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self._bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.table = [b""] * (max([*ranks.values(), *special.values()]) + 1)  # the bytes of every id
        for token, i in ranks.items():
            self.table[i] = token
        for token, i in special.items():
            self.table[i] = token.encode()
        self.size = np.array([len(t) for t in self.table], np.int64)
        self._path, self._slow, self._special = path, None, special
        longest_first = sorted(special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def _ordinary(self, text: str) -> list[int]:
        if len(text) < 50_000 or not LONG_RUN.search(text):
            return self._bpe.encode_ordinary(text)
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str, literal: bool = False) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit numbers. Strings of special tokens in the
        text are those tokens, as the tokenizer reads them, or ordinary text if ``literal``."""
        if literal or not any(s in text for s in self._special):
            return np.array(self._ordinary(text), "<u4")
        ids: list[int] = []
        for part in self._cut.split(text):
            ids += [self._special[part]] if part in self._special else self._ordinary(part)
        return np.array(ids, "<u4")

    def decode(self, ids) -> str:
        return b"".join([self.table[i] for i in ids]).decode("utf-8")

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Character offsets (starts, ends) of the tokens of a text, side by side without
        gaps. A token of part of a character has the span of that character."""
        size = self.size[self.encode(text)]
        ends = np.cumsum(size)
        starts = ends - size
        if text.isascii():
            return starts, ends
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character of every byte
        return char[starts], char[ends - 1] + 1
