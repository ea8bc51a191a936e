"""Word-level encoding with a vocabulary of the ``tokenizers`` library.

The library's pipeline for these vocabularies splits a text into words before it
merges anything, so the ids of a text are the ids of its words in a row. The encoder
here splits texts, remembers the ids of words it has met, and gives the rest to the
library many at a time. What it returns equals ``Tokenizer.encode`` on the whole text.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

# Letters and digits of Latin-1 after lower-casing; for such texts the library's
# normalisation is lower-casing alone.
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")
# A word of a plain text: the library gives it exactly one word end.
_PLAIN_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}A-ZÀ-ÖØ-Þ\u0100-\U0010ffff]+"
)
_PIECE_OF_TEXT = re.compile(r"[^\t-\r ]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_WORD_END = "</w>"

ID_TYPE = np.dtype("<u4")


def is_plain(text: str) -> bool:
    """Whether the words of ``text`` can be told apart without the library."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return "<|" not in text and not _SEPARATORS.search(text)


def split_words(text: str) -> list[str]:
    """The words of a text in order; each is encoded on its own.

    A plain text gives the vocabulary's own words. Any other text is cut at ASCII
    white space only, and each stretch is left to the library as a whole.
    """
    if is_plain(text):
        return _WORD.findall(text.lower())
    return _PIECE_OF_TEXT.findall(text)


def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordTable:
    """Ids of distinct words, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, number in vocabulary.items():
            self._ends[number] = piece.endswith(_WORD_END)

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word. One call of the library encodes all plain words.

        Any other stretch of text may have no word end or several and is encoded alone.
        """
        plain = [word for word in words if _PLAIN_WORD.fullmatch(word)]
        if len(plain) == len(words):
            return self.encode_plain(words)
        others = [word for word in words if not _PLAIN_WORD.fullmatch(word)]
        ids_of = dict(zip(others, self.encode_alone(others), strict=True))
        ids_of.update(zip(plain, self.encode_plain(plain), strict=True))
        return [ids_of[word] for word in words]

    def encode_alone(self, words: list[str]) -> list[bytes]:
        """The ids of any stretches of text, each encoded on its own."""
        if not words:
            return []
        return [
            np.array(encoded.ids, dtype=ID_TYPE).tobytes()
            for encoded in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ]

    def encode_plain(self, words: list[str]) -> list[bytes]:
        """The ids of words of plain texts, which have one word end each."""
        if not words:
            return []
        # Without offsets, which nothing here needs.
        [encoded] = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype=ID_TYPE)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self.encode_alone(words)
        raw, bounds = ids.tobytes(), (ends * ID_TYPE.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]


#: Entries of a text encoder; a million take some 200 MB.
MAX_KNOWN = 1_600_000


class TextEncoder:
    """Encodes texts one after another, with a memory of at most ``max_known`` entries.

    What stands between white space repeats often enough that most of a text is looked
    up without being split into words. The memory has two generations: what is met goes to
    the younger one, and when that holds half of the entries it takes the place of the
    older. So frequent stretches stay, however many rare ones there are.
    """

    def __init__(self, path: str, max_known: int = MAX_KNOWN) -> None:
        self._table = WordTable(path)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._max_young = max(1, max_known // 2)

    def encode(self, text: str) -> bytes:
        plain = is_plain(text)
        chunks = text.lower().split() if plain else _PIECE_OF_TEXT.findall(text)
        found = list(map(self._known.get, chunks))
        if None in found:
            places = [k for k, ids in enumerate(found) if ids is None]
            new = self._recall({chunks[k] for k in places}, plain)
            for k in places:
                found[k] = new[chunks[k]]
        return b"".join(found)

    def _recall(self, chunks: set[str], plain: bool) -> dict[str, bytes]:
        """The ids of chunks that the younger generation lacks; it holds them from now on."""
        older = self._older
        found = {chunk: older[chunk] for chunk in chunks if chunk in older} if older else {}
        if len(found) < len(chunks):
            self._encode_new(chunks - found.keys() if found else chunks, plain, found)
        if len(self._known) + len(found) > self._max_young:
            self._older, self._known = self._known, {}
        if len(found) <= self._max_young:
            self._known.update(found)
        return found

    def _encode_new(self, chunks: set[str], plain: bool, found: dict[str, bytes]) -> None:
        """Add the ids of chunks that are not known, and of the words in them."""
        known, older = self._known, self._older
        parts, words, others = [], set(), []
        for chunk in chunks:
            if chunk.isalpha() and chunk.isascii() and (plain or chunk.islower()):
                words.add(chunk)
            elif plain or is_plain(chunk):
                pieces = _WORD.findall(chunk if plain else chunk.lower())
                if pieces == [chunk]:
                    words.add(chunk)
                else:
                    parts.append((chunk, pieces))
                    words.update(p for p in pieces if p not in known)
            else:
                others.append(chunk)
        if older:
            found.update((word, older[word]) for word in words if word in older)
        new = [word for word in words if word not in found]
        found.update(zip(new, self._table.encode_plain(new), strict=True))
        found.update(zip(others, self._table.encode_alone(others), strict=True))
        for chunk, pieces in parts:
            found[chunk] = b"".join([found[p] if p in found else known[p] for p in pieces])


_encoders: dict[tuple[str, int], TextEncoder] = {}


def shared_encoder(path: str, max_known: int = MAX_KNOWN) -> TextEncoder:
    """One encoder for each Python worker, so that its memory serves many tasks."""
    key = (path, max_known)
    if key not in _encoders:
        _encoders[key] = TextEncoder(path, max_known)
    return _encoders[key]
