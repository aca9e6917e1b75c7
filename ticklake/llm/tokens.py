"""Token ids of whole texts by the ``tokenizers`` library, with a cache of words.

A vocabulary whose file says "normalise NFC, fold white space, lower-case, split by the word pattern"
never lets a token cross white space, so a text's ids are those of its white-space-separated words one
after the other.  Most words repeat, so a task keeps a bounded cache from word to id bytes.  A word of
Latin letters and trailing punctuation is given straight to the library's model; any other word goes
through the library's whole encoder.  Texts of Latin-1 letters are lower-cased first, as the library does, so that
a word is kept once.  Vocabularies with other rules are encoded text by text.

Half of the distinct words of a corpus occur once.  So the caches have two generations: when the young one is full
it becomes the old one, and words that are met again come back from there; what is not met again goes.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

# The settings of a vocabulary file under which words are independent.
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{|}~]*)")
#: Punctuation between a letter or digit and white space: a piece of its own under ``WORD_PATTERN``.
TRAILING_MARKS = re.compile(r"[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{|}~](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ].)[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{|}~]*(?![^ \n\t])")
BEYOND_LATIN = re.compile("[^\x00-\xff]")
#: Words of one generation.
CACHED_WORDS = 400_000


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


_shared: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of this Python worker, kept from task to task with its caches (a worker runs one task at a time)."""
    if path not in _shared:
        _shared.clear()  # one vocabulary's caches at a time
        _shared[path] = Encoder(path)
    return _shared[path]


class Encoder:
    """Whole texts to little-endian unsigned 32-bit ids.

    Null and empty texts have no ids.  The caches hold two generations of ``CACHED_WORDS`` words and of parts, so
    memory stays bounded; they never change a result.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}]
        self.by_word = (
            [n.get("type") for n in norm.get("normalizers", [])] == WORD_NORMALIZERS
            and (steps[0].get("pattern") or {}).get("Regex") == WORD_PATTERN
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])))
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.added = sorted({t["content"].lower() for t in spec.get("added_tokens", [])})
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        """Ids of one lower-case run of letters or punctuation."""
        spelled = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(self.words) >= CACHED_WORDS:
            self.words, self.old_words = {}, self.words
        self.words[word] = ids
        return ids

    def _run(self, text: str) -> bytes:
        """Ids of one lower-case run that stands beside another one, which is a word too."""
        found = self.words.get(text)
        if found is None:
            found = self.old_words.get(text)
            found = self._keep(text, self._ids(text) if found is None else found)
        return found

    def _fill(self, words: list[str], ids: list[bytes | None]) -> None:
        """Put the ids of the words that the young generation does not hold."""
        hard: dict[str, list[int]] = {}
        for i in [i for i, found in enumerate(ids) if found is None]:
            word = words[i]
            found = self.words.get(word)
            if found is None:
                found = self.old_words.get(word)
                if found is None:
                    plain = PLAIN_WORD.fullmatch(word)
                    if plain is None:
                        hard.setdefault(word, []).append(i)
                        continue
                    letters, marks = plain.groups()
                    if not marks:
                        found = self._ids(letters.lower()) if letters else b""
                    else:
                        found = self._run(letters.lower()) + self._run(marks) if letters else self._ids(marks)
                self._keep(word, found)
            ids[i] = found
        if hard:
            for (word, places), whole in zip(hard.items(), self.tokenizer.encode_batch(list(hard), add_special_tokens=False)):
                found = self._keep(word, array("I", whole.ids).tobytes())
                for i in places:
                    ids[i] = found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The id bytes of each text."""
        if not self.by_word:
            found = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            return [np.array(x.ids, dtype="<u4").tobytes() for x in found]
        out = []
        for text in texts:
            text = text or ""
            lowered = text.lower()
            if not any(token in lowered for token in self.added):
                text = TRAILING_MARKS.sub(r" \g<0>", lowered if text.isascii() or not BEYOND_LATIN.search(text) else text)
            words = text.replace("\n", " ").replace("\t", " ").split(" ")
            ids = list(map(self.words.get, words))
            if None in ids:
                self._fill(words, ids)
            out.append(b"".join(ids))
        return out
