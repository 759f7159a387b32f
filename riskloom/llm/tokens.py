"""Token ids of texts by the public 50k byte-level BPE, fast enough for a whole corpus.

The vocabulary's pre-tokeniser never joins a non-space character and a space
that follows it, so a text may be cut before each such space and the parts
encoded alone.  Parts repeat, so each task keeps the ids of those it has met;
new parts of a batch are encoded in one call.  Texts in which white space
stands before a space are encoded whole.  The tests hold the ids equal to
those of the ``tokenizers`` library on the vocabulary's JSON file.  That file
has one added token, ``ADDED``: with ``added`` the text is cut at each one, as
the library does by default, else it is text like any other (the library with
``encode_special_tokens``).
"""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import tiktoken

END = 0                     # id that closes a document
ADDED, ADDED_ID = "<|endoftext|>", 50256
CACHE = 400_000             # parts kept by one task; emptied when full
SPACE_BEFORE_SPACE = re.compile(r"\s ")


def load(path: str | None = None) -> tiktoken.Encoding:
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Ids:
    """Maps texts to their ids, two bytes each (the vocabulary has fewer than 2^16 entries)."""

    def __init__(self, path: str | None = None, added: bool = False):
        self.encoding, self.added = load(path), added
        self.known: dict[str, bytes] = {}
        self.opens = np.array([self.encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(self.encoding.n_vocab)])
        self.end = np.array([END], "<u2").tobytes()

    def _whole(self, text: str) -> bytes:
        if self.added and ADDED in text:
            return np.array([ADDED_ID], "<u2").tobytes().join(map(self._whole, text.split(ADDED)))
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def _learn(self, parts: set[str]) -> None:
        """Encodes `` part`` for each new part: each part's ids start with the one id that opens with a space."""
        if len(self.known) + len(parts) > CACHE:
            self.known.clear()
        parts = list(parts - self.known.keys())
        if not parts:
            return
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(parts)), "<u2")
        at = np.append(np.flatnonzero(self.opens[ids]), len(ids)) * 2
        data = ids.tobytes()
        self.known.update(zip(parts, [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], strict=True))

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: empty) with the closing id."""
        split = []
        for t in texts:
            t = t or ""
            whole = self.added and ADDED in t
            split.append(t if whole or SPACE_BEFORE_SPACE.search(t) or t[:1] == " " or t[-1:].isspace() else t.split(" "))
        self._learn(set().union(*(p[1:] for p in split if isinstance(p, list))))
        get = self.known.__getitem__
        return [(self._whole(p) if isinstance(p, str) else self._whole(p[0]) + b"".join(map(get, p[1:]))) + self.end for p in split]
