"""Token ids of whole texts as bytes, with a bounded table of words already encoded.

The word tokenizer drops white space before it splits, so no token reaches
across ASCII white space: a text's ids are its words' ids, joined. It lowers
letters, and splits letters from the signs after them, so a word is looked up
in lower case and a sign after letters on its own. Each distinct word is
encoded by the library once for each table; a Python worker keeps one table
in two generations, of which the older goes when the younger is full.

A word of Latin letters in lower case is one piece to the tokenizer's splitter
and unchanged by its normalizer, so it is handed to the library's BPE model
alone (a quarter of the time of a whole call); every other word takes the
whole way. Whether a tokenizer file allows that is read from the file.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

MAX_WORDS = 1_000_000
END_ID = 2
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    """Place of a public tokenizer file (``$TOKENIZERS_DIR`` or the installed package)."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class Generations(dict):
    """A bounded table: what was not asked for in a whole generation is forgotten."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most // 2, {}

    def compute(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


# letters up to U+024F: composed already, and letters in every version of Unicode
LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")


def byte_characters() -> dict[int, str]:
    """Byte -> the character that byte-level tokenizers write for it: itself if it is visible, else from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def takes_letters_whole(spec: dict) -> bool:
    """Whether a tokenizer file lowers and composes letters, keeps runs of them together, and then works on bytes."""
    normal = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if sorted(normal) != ["Lowercase", "NFC", "Replace"] or [x["type"] for x in split] != ["Split", "ByteLevel"]:
        return False
    pattern = split[0].get("pattern", {}).get("Regex", "")
    return (spec["model"]["type"] == "BPE" and "|[\\p{L}]+|" in pattern and pattern.startswith("'")
            and not split[1].get("add_prefix_space") and not spec.get("post_processor"))


class WordTable(Generations):
    """word bytes -> its ids as little-endian uint32 bytes."""

    SIGNS = """!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""

    def __init__(self, path: str):
        super().__init__(MAX_WORDS)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.letters_whole = takes_letters_whole(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.encode, self.split = self.tokenizer.encode, self.tokenizer.model.tokenize
        self.characters = byte_characters()

    def compute(self, word: bytes) -> bytes:
        if word.isalpha() and self.letters_whole:       # ASCII letters alone; a text with "<|" comes as it is
            return array("I", [t.id for t in self.split(word.lower().decode())]).tobytes()
        text = word.decode("utf-8", "surrogatepass")
        letters = text.rstrip(self.SIGNS)
        if letters != text and letters.lower().isalpha():
            return self[letters.encode()] + self[text[len(letters):].encode()]
        if self.letters_whole and LATIN.fullmatch(text) and text.lower() == text:
            seen = word.decode("latin-1").translate(self.characters)
            return array("I", [t.id for t in self.split(seen)]).tobytes()
        return np.array(self.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_TABLES: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    """This process's table for a tokenizer file."""
    if path not in _TABLES:
        _TABLES[path] = WordTable(path)
    return _TABLES[path]


def id_bytes(text: str | None, words: WordTable, end_id: int = END_ID) -> bytes:
    """Ids of the whole text, then ``end_id``, as little-endian uint32 bytes (null: empty text)."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    # special tokens are looked for before letters are lowered
    found = (raw if b"<|" in raw else raw.lower()).split()
    return b"".join(map(words.__getitem__, found)) + np.array([end_id], "<u4").tobytes()
