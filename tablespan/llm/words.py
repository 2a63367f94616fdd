"""Token ids of texts by a public word-based vocabulary, word by word.

The vocabulary's tokenizer lower-cases, drops white space and merges inside words only, so a text's ids are its words'
ids one after another. Each task keeps the ids of words it has met. Texts with characters beyond plain Latin letters,
or with the vocabulary's special strings, go through the tokenizer as they are.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Fixed values of the vocabulary's definition: characters whose handling is the same in every regular-expression engine,
# and how it splits lower-cased text. The letters are Latin-1 and Latin Extended-A.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-įĲ-ňŊ-ž]*")
_LETTER = "a-zªµºß-öø-ž"
_NUMBER = "0-9²³¹¼-¾"
# What stands alone between white space and runs of letters.
_APART = f"[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\r{_LETTER}{_NUMBER}]+"
_SPECIAL = "<|"
# The vocabulary writes a byte beyond ASCII as the character of that number, but for these, which would not be seen.
_SYMBOLS = {byte: 162 + byte for byte in range(127, 161)} | {173: 323}

#: Words remembered by one worker process, in each of two generations.
KEPT_WORDS = 200_000


@cache
def word_tokenizer(file: str) -> WordTokenizer:
    """One per worker process, which serves many tasks."""
    return WordTokenizer(file)


class WordTokenizer:
    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned little-endian 32-bit numbers, without special tokens."""
        plain = [_PLAIN.fullmatch(t) is not None and _SPECIAL not in t for t in texts]
        split = _split([t if p else "" for t, p in zip(texts, plain)])
        found = split.flatten().dictionary_encode()
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {"": b""}, self.known
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, words))
        new = [k for k, i in enumerate(ids) if i is None]
        self._learn({words[k] for k in new})
        for k in new:
            ids[k] = self.known[words[k]]
        # the ids of all words in order, from those of the distinct ones
        size, index = np.array(list(map(len, ids)), np.int64) // 4, found.indices.to_numpy()
        begin, n = (np.cumsum(size) - size)[index], size[index]
        upto = np.concatenate([[0], np.cumsum(n)])
        raw = np.frombuffer(b"".join(ids), "<u4")[np.repeat(begin - upto[:-1], n) + np.arange(upto[-1])].tobytes()
        at = (4 * upto[split.offsets.to_numpy()]).tolist()
        return [raw[a:b] if p else _bytes(self.tokenizer.encode(t, add_special_tokens=False).ids)
                for t, p, a, b in zip(texts, plain, at, at[1:])]

    def _learn(self, words: set[str]) -> None:
        """Makes `words`, which are not, known. Words not seen for a while are forgotten. The vocabulary's model merges a
        word alone: it is lower-cased and split off already."""
        for word in words:
            ids = self.older.get(word)
            if ids is None:
                symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_SYMBOLS)
                ids = _bytes([token.id for token in self.model.tokenize(symbols)])
            self.known[word] = ids


def _split(texts: list[str]) -> pa.ListArray:
    """The lower-cased words of each text, with empty ones where white space is at an end."""
    apart = pc.replace_substring_regex(pc.utf8_lower(pa.array(texts, pa.string())), _APART, r" \0 ")
    return pc.ascii_split_whitespace(apart)


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else b"".join(i.to_bytes(4, "little") for i in ids)
