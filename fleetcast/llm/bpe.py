"""Byte-level BPE on pre-tokens with the public vocabulary files (whole words cached per worker)."""

from __future__ import annotations

import base64

import regex
import tiktoken


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class PieceCoder:
    """Ids of texts by the ranks of one vocabulary file.

    A pre-token boundary always lies where a non-space character meets a
    space, so a text falls into units (a space and what follows it up to the
    next space) that can be coded one by one; the ids of a unit are cached.
    Units that touch other white space at an end are joined with their
    neighbours first.  The cache is emptied when full.
    """

    LIMIT = 100_000

    def __init__(self, rank_file: str | None = None):
        path = rank_file or default_path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("units", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
        self.regex = regex.compile(pattern())
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.names = [str(i) for i in range(1 + max(ranks.values()))]
        self.cache: dict[str, list[int]] = {}

    def units(self, text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0]] if parts[0] else []
        glue = bool(parts[0]) and parts[0][-1].isspace()
        for p in parts[1:]:
            if glue or not p or p[0].isspace():  # a run of white space: code it together with its neighbours
                if out:
                    out[-1] += " " + p
                else:
                    out.append(" " + p)
            else:
                out.append(" " + p)
            glue = out[-1][-1].isspace()
        return out

    def encode(self, text: str) -> list[int]:
        cache, ids = self.cache, []
        for u in self.units(text):
            got = cache.get(u)
            if got is None:
                got = self.encoding.encode_ordinary(u)
                if len(u) <= 32:
                    if len(cache) >= self.LIMIT:
                        cache.clear()
                    cache[u] = got
            ids += got
        return ids

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        got = self.cache.get(piece)  # a match by itself is a unit as well
        if got is None:
            got = self.encoding.encode_ordinary(piece)
            if len(piece) <= 32:
                if len(self.cache) >= self.LIMIT:
                    self.cache.clear()
                self.cache[piece] = got
        return got

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODERS: dict[str | None, PieceCoder] = {}


def coder(rank_file: str | None = None) -> PieceCoder:
    """One coder per worker and file."""
    if rank_file not in _CODERS:
        _CODERS[rank_file] = PieceCoder(rank_file)
    return _CODERS[rank_file]
