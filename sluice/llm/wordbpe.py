"""Token ids of a ``tokenizers`` BPE file, a whole column of texts at a time.

The library's full pipeline costs over a microsecond a character.  Texts that hold only ASCII
and the Latin-1 letters (normal form and lower case are plain there) are cut
into words by the pre-tokenizer's own pattern with Arrow's string functions, and each distinct
word goes to the library's BPE model once while a worker keeps it; any other text goes through
the library's whole pipeline.  So does every text if the file's pipeline is not of the known
kind.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluice.llm.textcols import CodedWords, WordTable, texts_of

# The pre-tokenizer pattern and normalizers for which the shortcut is exact.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

_LETTERS = "a-zß-öø-ÿ"
# texts, before lower-casing, that hold only these: their normal form and lower case are plain and \\s is
# \\t\\n\\r and blank (Arrow lowers U+0130 to a plain i, the library to two characters)
_SAFE = rf"^[ -~\t\n\rÀ-ÖØ-Þ{_LETTERS}]*$"
_PLAIN = rf"^[{_LETTERS}., \t\n\r]*$"  # words, stops, commas ...
_DOUBLE = r"[.,][.,]"  # ... none adjacent: then each stands for itself
_BETWEEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t\n\r0-9{_LETTERS}]+"  # all but letter runs
_WORDS = 75_000  # words kept per generation and worker process: some 30 MB in all


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the others for the
    characters from U+0100 on, in byte order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordBpe:
    """Encoder of one tokenizer file; ``encode(text)`` gives a uint32 array."""

    _loaded: dict[tuple[str, int], "WordBpe"] = {}

    @classmethod
    def load(cls, path: str, words: int = _WORDS) -> "WordBpe":
        """One encoder per worker process, file and number of words kept."""
        if (path, words) not in cls._loaded:
            cls._loaded[path, words] = cls(path, words)
        return cls._loaded[path, words]

    def __init__(self, path: str, words: int = _WORDS) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.known = (kinds == _NORMALIZERS and len(pre) == 2
                      and pre[0].get("pattern") == {"Regex": _PATTERN} and pre[0].get("invert")
                      and pre[1].get("type") == "ByteLevel" and not pre[1]["add_prefix_space"]
                      and not pre[1]["use_regex"] and not spec["model"].get("dropout"))
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.known = self.known and not any(re.search(r"\s", t) for t in self.special)
        self.alphabet = _byte_alphabet()
        self.vocab_size = max(self.library.get_vocab().values()) + 1
        self.words = WordTable(self._encode_each, words, many=True)

    def _encode_each(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian bytes."""
        tokenize, letter = self.model.tokenize, self.alphabet.__getitem__
        return [array("I", [t.id for t in tokenize(w if w.isascii() else "".join(map(letter, w.encode())))]).tobytes()
                for w in words]

    def encode(self, text: str | None) -> list[int]:
        """One text by the library's whole pipeline; null: none."""
        return self.library.encode(text, add_special_tokens=False).ids if text else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other (uint32) and their offsets by text."""
        texts = texts_of(texts)
        low = pc.utf8_lower(texts)
        easy = pc.match_substring_regex(texts, _SAFE)
        for special in self.special:
            easy = pc.and_not(easy, pc.match_substring(texts, special))
        if not self.known:
            easy = pc.and_(easy, False)
        plain = pc.and_not(pc.and_(easy, pc.match_substring_regex(low, _PLAIN)),
                           pc.match_substring_regex(low, _DOUBLE))
        counts = np.zeros(len(texts), dtype=np.int64)
        parts = []  # (rows, ids, offsets)
        spaced = low.filter(plain)
        for mark in ".,":
            spaced = pc.replace_substring(spaced, mark, f" {mark} ")
        parts.append((_where(plain), *self._encode_words(spaced)))
        others = pc.and_not(easy, plain)
        spaced = pc.replace_substring_regex(low.filter(others), _BETWEEN, r" \0 ")
        parts.append((_where(others), *self._encode_words(spaced)))
        hard = pc.invert(easy)
        ids = [self.encode(t) for t in texts.filter(hard).to_pylist()]
        parts.append((_where(hard), np.array([x for d in ids for x in d], dtype="<u4"),
                      np.cumsum([0, *map(len, ids)])))
        for rows, _, offsets in parts:
            counts[rows] = np.diff(offsets)
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(ends[-1], dtype="<u4")
        for rows, flat, offsets in parts:
            if len(flat):  # where each id of the part belongs
                if len(rows) == len(texts):
                    return flat, ends
                shift = np.repeat(ends[rows] - offsets[:-1], np.diff(offsets))
                shift += np.arange(len(flat))
                out[shift] = flat
        return out, ends

    def _encode_words(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = CodedWords(pc.ascii_split_whitespace(spaced))
        uniq = words.strings()
        empty = uniq.index("") if "" in uniq else None  # at the ends of a text
        values = self.words([w for w in uniq if w])
        if empty is not None:
            values.insert(empty, b"")
        return words.gather(values)


def _where(mask: pa.Array) -> np.ndarray:
    return np.flatnonzero(mask.to_numpy(zero_copy_only=False))
