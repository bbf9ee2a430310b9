"""Token ids of texts, remembered word by word.

A byte-level tokenizer never joins text across a single space or line feed between two
visible characters, so a text can be cut there. Most of the parts repeat, and each is
sent to the tokenizers library once.
"""

from __future__ import annotations

import os
import re
import string
from functools import lru_cache
from itertools import chain

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
MEMO_PARTS = 750_000  # parts of each of two generations a worker remembers; bounds its memory, changes no result
# White space other than single spaces and line feeds, or what may be part of it.
UNUSUAL = (b"  ", b"\n\n", b" \n", b"\n ", b"\0", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
CONTROLS = bytes([9, 11, 12, 13, 28, 29, 30, 31])
CUT = re.compile(r"(?<=\S) (?=\S)")
HEAD = "\0"  # marks the first part of a text, which has no space before it


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def parts(raw: bytes) -> list[str]:
    """The text cut before single spaces and line feeds between visible characters.

    A part stands for itself with a space before it, unless it starts with a line
    feed or with HEAD.
    """
    text = raw.decode("utf-8", "replace")
    if any(x in raw for x in UNUSUAL) or raw[0] in b" \n" or raw[-1] in b" \n" or len(raw.translate(None, CONTROLS)) < len(raw):
        cut = CUT.split(text)
        return [HEAD + cut[0], *(x if x[0] != HEAD else HEAD + " " + x for x in cut[1:])]
    cut = text.replace("\n", " \n").split(" ")
    cut[0] = HEAD + cut[0]
    return cut


def plain(part: str) -> str:
    return part[1:] if part[0] == HEAD else part if part[0] == "\n" else " " + part


class Encoder:
    """Little-endian 32-bit ids of texts, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, new: set[str]) -> None:
        """Add the ids of parts to the young generation."""
        known, whole, split = {}, [], {}

        def remembered(p: str) -> bytes | None:
            ids = known.get(p)
            if ids is None:
                ids = self.young.get(p)
                if ids is None:
                    ids = self.old.get(p)
            return ids

        for p in new:
            ids = self.old.get(p)
            if ids is not None:
                known[p] = ids
                continue
            # A letter and punctuation behind it are never joined.
            bare = p.rstrip(string.punctuation)
            if len(bare) < len(p) and bare[-1:].isalpha():
                split[p] = bare, HEAD + p[len(bare):]
            else:
                whole.append(p)
        whole += {x for pair in split.values() for x in pair if remembered(x) is None}.difference(whole)
        for i in range(0, len(whole), 50_000):
            some = whole[i:i + 50_000]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([plain(x) for x in some], add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
            at = 0
            for p, ids in zip(some, found):
                known[p] = flat[at:at + 4 * len(ids)]
                at += 4 * len(ids)
        for p, (bare, tail) in split.items():
            known[p] = remembered(bare) + remembered(tail)
        if len(self.young) + len(known) > MEMO_PARTS:
            self.old, self.young = self.young, {}
        self.young.update(known)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for raw in texts:
            cut = parts(raw) if raw else []
            ids = list(map(self.young.get, cut))
            if None in ids:
                self.learn({p for p, x in zip(cut, ids) if x is None})
                ids = [self.young[p] if x is None else x for p, x in zip(cut, ids)]
            out.append(b"".join(ids))
        return out

    def documents(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of whole documents with the end id; null is an empty text."""
        return [ids + END_ID.to_bytes(4, "little") for ids in self.encode([t or b"" for t in texts])]


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    return Encoder(path or vocabulary_path())
