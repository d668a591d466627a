"""Batch encoder for the lower-casing word BPE (NFC, white space dropped, word ends).

The library's own ``encode`` spends most of its time on normalisation and on
words it has seen. Texts are normalised whole, split at white space, and each
distinct word goes through the library's merges once while it stays in a cache
of bounded size; the ids are the library's, with its defaults: added tokens are
found in the text as it stands, and what is between them is encoded apart.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import regex

#: Characters that str.split() takes for white space and the tokenizer doesn't.
SEPARATORS = regex.compile("[\x1c-\x1f]")
#: Marks that often end a word.
MARKS = frozenset(".,;:!?")
#: The normaliser sees these as white space (Unicode White_Space).
SPACE = regex.compile(r"\s+")


def assigned_later() -> str:
    """A pattern of the characters that ``regex`` knows and ``unicodedata`` doesn't yet. The library's parts are
    of several Unicode versions, so texts that hold such characters are left to it."""
    known = regex.findall(r"\P{Cn}", "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)])))
    later = [ord(c) for c in known if unicodedata.category(c) == "Cn"]
    ranges: list[list[int]] = []
    for c in later:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]" if ranges else "(?!)"


def latin(text: str) -> bool:
    """Whether all characters are below U+0100, none of which is new."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class WordBpe:
    def __init__(self, source: bytes, cache_words: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(source)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.cut = regex.compile(split["pattern"]["Regex"]).findall
        self.later = re.compile(assigned_later())
        self.library = Tokenizer.from_str(json.dumps(spec))
        self.added = {t["content"]: t["id"].to_bytes(4, "little") for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take part in normalisation or strip what is beside them")
        # The longest of those that begin at a place is found.
        self.parting = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        #: Ids that end a piece: each piece has one, its last.
        self.ending = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
        self.ending[[i for t, i in spec["model"]["vocab"].items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.letters = dict(enumerate(byte_letters()))
        # The same merges behind a plain split at spaces: pieces come cut and normalised.
        self.merges = Tokenizer.from_str(json.dumps(
            spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
        #: Ids of words; an added token stands here behind a space, which no word holds.
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.most = cache_words

    @staticmethod
    def normal(text: str) -> list[str]:
        """The words of a text as the normaliser leaves them."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # Each character alone is lower-cased; Python would end words in another sigma.
            text = text.replace("Σ", "σ")
        low = text.lower()
        return SPACE.split(low) if SEPARATORS.search(low) else low.split()

    def parted(self, text: str) -> list[str]:
        """The words of a text, and its added tokens behind a space."""
        out: list[str] = []
        at = 0
        for m in self.parting.finditer(text):
            out += [*self.normal(text[at:m.start()]), f" {m[0]}"]
            at = m.end()
        return out + self.normal(text[at:]) if out else self.normal(text)

    def pieces(self, word: str) -> list[str]:
        """The parts of a word that are merged apart; letters with one mark behind need no pattern."""
        if word[-1:] in MARKS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.cut(word)

    def _merge(self, parts: list[str]) -> None:
        """Put the ids of distinct pieces, none of them known, into the cache."""
        # An ASCII piece holds no space or control sign that a letter would stand for.
        spelt = [p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.letters) for p in parts]
        joined = [" ".join(spelt[at:at + 2000]) for at in range(0, len(parts), 2000)]
        for at, done in zip(range(0, len(parts), 2000), self.merges.encode_batch_fast(joined, add_special_tokens=False)):
            own = np.array(done.ids, "<u4")
            ids, ends = own.tobytes(), (4 * np.flatnonzero(self.ending[own]) + 4).tolist()
            for p, start, end in zip(parts[at:at + 2000], [0, *ends], ends):
                self.parts[p] = ids[start:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        late = {i for i, t in enumerate(texts) if not latin(t) and self.later.search(t)}
        lists = [[] if i in late else self.parted(t) for i, t in enumerate(texts)]
        words, parts = self.words, self.parts
        new = set().union(*lists).difference(words)
        words.update({w: self.added[w[1:]] for w in new if w[:1] == " "})
        whole = {w for w in new if w.isalpha()}  # of letters alone: one piece
        cut = [(w, self.pieces(w)) for w in new - whole if w[:1] != " "]
        new_parts = {p for _, own in cut for p in own}.union(whole).difference(parts)
        self._merge(list(new_parts))
        for w in whole:
            words[w] = parts[w]
        for w, own in cut:
            words[w] = parts[own[0]] if len(own) == 1 else b"".join([parts[p] for p in own])
        out = [b"".join([words[w] for w in ws]) for ws in lists]
        for i in late:
            out[i] = b"".join([n.to_bytes(4, "little") for n in self.library.encode(texts[i], add_special_tokens=False).ids])
        if len(words) > self.most:  # the words met first, the frequent ones, stay
            for w in new:
                del words[w]
        if len(parts) > self.most:
            for p in new_parts:
                del parts[p]
        return out
