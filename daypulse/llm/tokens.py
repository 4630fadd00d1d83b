"""Token ids of texts, with a tokenizer file of the `tokenizers` library."""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

DEFAULT_FILE = "word_bpe_49k.json"
#: Pieces kept in memory per worker; beyond, the table starts anew.
CACHE_PIECES = 1_000_000

# Texts of these characters only are unchanged by NFC, and lower-casing maps
# each letter to one letter, so pieces can be encoded apart.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*").fullmatch
#: The tokenizer's own split, stated for lower-case text of those characters.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters, digits and white space up to here are the same in every version of Unicode.
_LATIN = re.compile("[\x00-\u024f]*").fullmatch


def byte_level() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte. Printable bytes stand for
    themselves, the others follow from 256 on in their order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteEncoder:
    """``encode`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``
    of a byte-level tokenizer whose special tokens are plain text; ``decode``
    gives the text back.

    The vocabulary taken as ranks encodes four times as fast. Ranks join any two
    parts whose bytes are a token, the tokenizer only the two of its merge. Where
    every token is made from its own bytes by the merges, no other two parts can
    be left to meet, so both give the same ids; that is asked of every token."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are text
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        of = byte_level()
        plain = {t: i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if not set(t) - of.keys()}
        self.fast = None
        if all(len(self.tokenizer.model.tokenize(token)) == 1 for token in plain):
            import public_tokenizers
            import tiktoken

            ranks = {bytes(of[c] for c in token): i for token, i in plain.items()}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast and _LATIN(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.fast.decode(ids) if self.fast else self.tokenizer.decode(ids, skip_special_tokens=False)


class _Known(dict):
    """Piece -> its ids as bytes; a missing piece is encoded and kept."""

    def __init__(self, tokenizer: Tokenizer, dtype):
        super().__init__()
        self.tokenizer, self.dtype = tokenizer, dtype

    def __missing__(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        found = self[piece] = np.array(ids, self.dtype).tobytes()
        return found


class WordEncoder:
    """``encode(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    The tokenizer of DEFAULT_FILE drops white space and never merges across
    its split pieces, so ids of pieces are encoded once and kept. Texts with
    other characters, or with the start of a special token's name, go to the
    tokenizer whole."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if self.vocab_size <= 1 << 16 else np.uint32
        self.known = _Known(self.tokenizer, self.dtype)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if not _PLAIN(text) or "<|" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        joined = b"".join(map(self.known.__getitem__, _PIECES(text.lower())))
        return np.frombuffer(joined, self.dtype).astype(np.uint32)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
