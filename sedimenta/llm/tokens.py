"""Ids of texts as the `tokenizers` library gives them.

Texts in Latin letters, which are nearly all, are cut into pieces here and go through the faster BPE of `tiktoken`
over the vocabulary of the same file; every other text goes to the library itself, and so does a text that holds the
string of an added token. Both give the same ids, which the tests hold against each other.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import tiktoken


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: visible Latin-1 characters
    stand for themselves, all others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TextTokenizer:
    """ids(texts): per text its ids as little-endian unsigned 32-bit integers; null counts as empty.

    The string of a special token in a text has that token's id, as in the library; no special tokens are added.
    """

    # Letters, digits and marks whose class and case all Unicode versions agree on.
    LATIN = re.compile("[\t\n\x0b\x0c\r -~\xa0-įı-ɏ]*")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.vocabulary = {t: i for t, i in self.library.get_vocab().items() if t not in self.added}

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for text in texts:
            text = text or ""
            plain = self.LATIN.fullmatch(text) and not any(t in text for t in self.added)
            yield self._latin(text) if plain else self.whole(text)

    def whole(self, text: str) -> bytes:
        """The ids of the library itself."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _latin(self, text: str) -> bytes:
        raise NotImplementedError


def encode_all(bpe: tiktoken.Encoding, text: str) -> bytes:
    return bpe.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


class ByteLevelTokenizer(TextTokenizer):
    """For byte-level vocabularies without word ends."""

    # Fixed value: how byte-level vocabularies cut texts.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        super().__init__(path)
        byte = byte_characters()
        ranks = {bytes(byte[c] for c in token): i for token, i in self.vocabulary.items()}
        del self.vocabulary
        self.bpe = tiktoken.Encoding("byte-level", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _latin(self, text: str) -> bytes:
        return encode_all(self.bpe, text)


class PieceIds(dict):
    """The ids of pieces, each found once while it is remembered: the pieces of late, and those used again of the time before."""

    MOST = 250_000  # pieces of either kind, some 50 MB

    def __init__(self, encode: Callable[[str], list[int]], end: str):
        super().__init__()
        self.encode, self.end, self.before = encode, end, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = array("I", self.encode(piece + self.end)).tobytes()  # quicker than NumPy for a few ids
        if len(self) >= self.MOST:
            self.before = dict(self)
            self.clear()
        self[piece] = found
        return found


class WordEndTokenizer(TextTokenizer):
    """For lower-case vocabularies in which the last symbol of a piece carries a word end.

    The word end is written as one more byte behind each piece, NUL, which is cut off from texts otherwise. It merges with the last
    byte before anything else, as the symbols with a word end have the lowest ids above the bytes.
    """

    END, SUFFIX = "\0", "</w>"
    # Fixed value: what such vocabularies take for a piece, besides runs of letters: 's|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+
    # Written for lower-case `LATIN` texts, and so that one class finds where a piece starts.
    DIGIT, LETTER = "0-9²³¹¼-¾", "a-zªµºß-öø-\U0010ffff"
    PIECES = re.compile(rf"[^\s{LETTER}](?:(?<=[{DIGIT}])|(?<=')(?:s|t|re|ve|m|ll|d)|[^\s{LETTER}{DIGIT}]*)")

    def __init__(self, path: str):
        super().__init__(path)
        byte = byte_characters()
        end = self.END.encode()
        ranks = {}
        for token, i in self.vocabulary.items():
            body = token.removesuffix(self.SUFFIX)
            data = bytes(byte[c] for c in body)
            if data != end:  # the NUL byte itself does not occur in Latin texts
                ranks[data + end if body != token else data] = i
        ranks[end] = max(self.vocabulary.values()) + 3  # never left over
        del self.vocabulary
        self.bpe = tiktoken.Encoding("word-end", pat_str=r"[^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.known = PieceIds(self.bpe.encode_ordinary, self.END)

    def _latin(self, text: str) -> bytes:
        pieces = self.PIECES.sub(r" \g<0> ", text.lower()).split()
        return b"".join(map(self.known.__getitem__, pieces))


_tokenizers: dict[tuple[str, bool], TextTokenizer] = {}


def tokenizer(path: str, byte_level: bool) -> TextTokenizer:
    """The worker's own tokenizer for a vocabulary file."""
    if (path, byte_level) not in _tokenizers:
        _tokenizers[path, byte_level] = (ByteLevelTokenizer if byte_level else WordEndTokenizer)(path)
    return _tokenizers[path, byte_level]
