"""Token ids of the public word-end BPE, with a bounded cache of words in each Python worker."""

from __future__ import annotations

import os
import struct
from functools import lru_cache

#: Bytes that may follow a word without joining its last letter or digit in one pre-token.
_TAIL = b".,;:!?%*$&#|"
#: Entries of each cache; a full cache is emptied, which costs time and changes no result.
CACHE_ENTRIES = 1_200_000


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit bytes.

    The vocabulary's pre-tokenizer never joins characters across white space, so the ids of a text are those of its
    parts between ASCII white space in order; each distinct part is encoded once while the cache holds it. A-Z are
    put in lower case first (the vocabulary does so itself) unless the text has combining marks, with which an upper-case
    letter may compose differently, or ``<|``: special tokens are matched in the text's own case.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.entries = entries
        self.parts: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    def _learn(self, missing: set[bytes]) -> None:
        if len(self.cores) > self.entries:
            self.cores = {}
        whole, split = [], []
        for part in missing:
            core = part.rstrip(_TAIL)
            if len(core) == len(part) or not (core and core.decode().lower()[-1].isalnum()):
                whole.append(part)
            else:
                split.append((part, core, part[len(core) :]))
        cores = self.cores
        new = [x for x in {*whole, *(s[1] for s in split), *(s[2] for s in split)} if x not in cores]
        for core, enc in zip(new, self.model.encode_batch_fast([x.decode() for x in new], add_special_tokens=False), strict=True):
            ids = enc.ids
            cores[core] = struct.pack(f"<{len(ids)}I", *ids)
        self.parts.update(zip(whole, map(cores.__getitem__, whole), strict=True))
        self.parts.update((part, cores[core] + cores[tail]) for part, core, tail in split)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [(t if b"\xcc" in t or b"\xcd" in t or b"<|" in t else t.lower()).split() for t in texts]
        out = []
        for lo in range(0, len(split), 64):
            some = split[lo : lo + 64]
            before = self.parts
            missing = set().union(*some).difference(before)
            if len(before) + len(missing) > self.entries:
                self.parts = {}
            self._learn(missing)
            get = self.parts.get
            for words in some:
                found = list(map(get, words))
                if self.parts is not before:  # what a full cache held is looked up there
                    found = [before[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
                out.append(b"".join(found))
        return out


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    """One for each path and Python worker."""
    return WordTokenizer(path)
