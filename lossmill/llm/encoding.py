"""Token ids of whole texts, as little-endian unsigned 32-bit numbers.

Any tokenizer of the tokenizers library can be asked for the ids of a text. For one kind there is a
faster way with the same result: tokenizers that drop white space and part words by a known pattern
encode a text word by word, and words come again.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Chunks of a generation; two generations are kept, some 200 bytes a chunk.
_CACHED_CHUNKS = 500_000
_CACHED_CHARS = 64
_ID = "<u4"

# The normalizer and pre-tokenizer that ``WordEncoder`` follows.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {
                "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            },
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next
    one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of a text, encoded whole."""

    def __init__(self, tokenizer):
        self._tokenizer = tokenizer

    def encode(self, text: str) -> bytes:
        found = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, _ID).tobytes()

    def forget(self) -> None:
        """Nothing is kept from text to text."""


class WordEncoder(dict):
    """The same for tokenizers with the normalizer and pre-tokenizer above.

    A text is cut at spaces and line ends, and the ids of the chunks are kept. When they are too
    many, the dictionary begins anew and chunks that come again are taken from the one before.
    Letters at the beginning of a chunk are one word for the model if they are of Latin-1, whose
    composed form they are already; whatever else there is goes to the tokenizer.
    """

    _head = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\x00-\x7f])").match

    def __init__(self, tokenizer):
        super().__init__({"": b""})
        self._before: dict[str, bytes] = {}
        self._tokenizer = tokenizer
        self._tokenize = tokenizer.model.tokenize
        self._of_id = [np.array([k], _ID).tobytes() for k in range(tokenizer.get_vocab_size())]
        self._letters = byte_letters()

    def encode(self, text: str) -> bytes:
        if len(self) > _CACHED_CHUNKS:
            self._before = dict(self)
            self.clear()
            self[""] = b""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def __missing__(self, chunk: str) -> bytes:
        ids = self._before.get(chunk)
        if ids is None:
            ids = self._encoded(chunk)
        if len(chunk) <= _CACHED_CHARS:
            self[chunk] = ids
        return ids

    def forget(self) -> None:
        """Let go of all chunks. The worker that ran a task lives on and shares its executor's
        memory with others; without this its next task finds the chunks again."""
        self.clear()
        self._before = {}
        self[""] = b""

    def _encoded(self, chunk: str) -> bytes:
        head = self._head(chunk)
        word = head[0] if head else ""
        if word and len(word) < len(chunk):
            ids = self[word] + self[chunk[len(word) :]]
        elif word and (lower := word.lower()) != word:
            ids = self[lower]
        else:
            if word:
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self._letters)
                found = [t.id for t in self._tokenize(word)]
            else:
                found = self._tokenizer.encode(chunk, add_special_tokens=False).ids
            ids = b"".join([self._of_id[k] for k in found])
        return ids


_encoders: dict[str, Encoder | WordEncoder] = {}


def encoder(path: str) -> Encoder | WordEncoder:
    """One per Python worker, so that the vocabulary is read once."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        said = json.loads(tokenizer.to_str())
        by_word = (
            said["normalizer"] == _NORMALIZER
            and said["pre_tokenizer"] == _PRE_TOKENIZER
            and said["model"]["type"] == "BPE"
            and not said["model"].get("dropout")
        )
        _encoders[path] = (WordEncoder if by_word else Encoder)(tokenizer)
    return _encoders[path]
