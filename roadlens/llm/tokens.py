"""Token ids of whole texts, as the ``tokenizers`` library gives them, fast enough for a corpus."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np

#: Chunks whose ids a worker remembers at most, half of them since it last forgot; and the longest worth remembering.
REMEMBERED = 1_000_000
LONGEST = 64
#: Words that the library gets as one text.
TOGETHER = 256
STOPS = ".,;:!?"
DIGITS = "0123456789"
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# White space beside space, tab and line ends; blocks of marks that combine with letters.
RARE_SPACE = (0x0B, 0x0C, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
MARKS = (
    (0x0300, 0x036F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0x3099, 0x309A), (0xFE20, 0xFE2F),
)


def _any_of(codes: Iterable[int]) -> str:
    return "[" + "".join(re.escape(chr(c)) for c in codes) + "]"


class Encoder:
    """Encodes texts with a tokenizer file; each white-space-delimited chunk goes to the library once per worker.

    Both kinds of tokenizer split a text at white space before any merge, so a
    text's ids are those of its chunks, one after the other: a chunk is a run
    without white space, with ``leading_space`` the one space before it too, or
    white space. Letters and digits are split from stops by any of them, so the
    ids of "word" and "," make those of "word,". Where a text holds control or rare white-space characters, on
    which patterns may differ, or the string of an added token, which the library
    takes for that token, it gets the whole text.
    """

    def __init__(self, path: str, leading_space: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        rare = [*range(0x1C, 0x20), *(RARE_SPACE if leading_space else ())]
        marks = [c for first, last in MARKS for c in range(first, last + 1)]
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # what only the library should see, in whole texts: white space that is split at here or there, marks that
        # combine with letters, strings of added tokens
        self.odd = re.compile("|".join([_any_of([*rare, *(() if leading_space else marks)]), *added])).search
        # splitting at white space takes these away
        self.split_at = [] if leading_space else [chr(c) for c in rare]
        self.split = re.compile(r" ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+").findall if leading_space else str.split
        # a tokenizer that lowers case gives A-Z the ids of a-z, unless marks could combine with them
        self.lowers = not leading_space and self._ids(["A Z"]) == self._ids(["a z"])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # which tokens begin a word after a space, or end one
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token.startswith("\u0120") if leading_space else token.endswith("</w>")
        self.leading_space = leading_space

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", e.ids).tobytes() for e in found]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """The same for words of letters alone, many at a time: tokens tell where a word begins or ends."""
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        gap = "" if self.leading_space else " "
        found = self.tokenizer.encode_batch_fast([gap.join(g) for g in groups], add_special_tokens=False)
        out: list[bytes] = []
        for group, e in zip(groups, found, strict=True):
            ids = np.array(e.ids, np.uint16)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(group):  # some letter that the library parts words at
                out += self._ids(group)
                continue
            if self.leading_space:
                starts, ends = edges, np.append(edges[1:], len(ids))
            else:
                starts, ends = np.append(0, edges[:-1] + 1), edges + 1
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip((2 * starts).tolist(), (2 * ends).tolist(), strict=True)]
        return out

    def _learn(self, new: set[str]) -> None:
        """Finds the ids of new chunks; a chunk that ends in a letter or digit and stops is cut before the stops."""
        known, cut, plain = self.known, [], set()
        for c in new:
            if c[-1] in STOPS and (core := c.rstrip(STOPS)) and (core[-1].isalpha() or core[-1] in DIGITS):
                stops = c[len(core) :]
                cut.append((c, core, stops))
                plain.add(core)
                plain.add(stops)
            else:
                plain.add(c)
        older = self.older
        known.update([(p, older[p]) for p in plain if p in older])
        words, others = [], []
        first = 1 if self.leading_space else 0
        for p in plain:
            if p not in known:
                (words if p[:first] in ("", " ") and p[first:].isalpha() else others).append(p)
        known.update(zip(words, self._ids_of_words(words), strict=True))
        known.update(zip(others, self._ids(others), strict=True))
        known.update([(c, known[core] + known[stops]) for c, core, stops in cut])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 16-bit integers of this machine, little-endian on all that Spark runs on."""
        given = texts
        if self.lowers:
            texts = [t.lower() if t.isascii() else t.encode("utf-8", "replace").translate(UPPER).decode() for t in texts]
        chunks = [self.split(t) for t in texts]
        known = self.known
        new = set(chain.from_iterable(chunks)).difference(known)
        # chunks that are known are not odd; in lower case too, what is no token as written may not become one
        odd = {c for c in new if not (c.isalnum() and c.isascii()) and self.odd(c)}
        new -= odd
        whole = [
            i for i, (t, cs) in enumerate(zip(given, chunks, strict=True))
            if (odd and not odd.isdisjoint(cs)) or any(c in t for c in self.split_at)
        ]
        at_once = self._ids([given[i] for i in whole])
        for i in whole:
            chunks[i] = []
        self._learn(new)
        out = [b"".join(map(known.__getitem__, cs)) for cs in chunks]
        for i, ids in zip(whole, at_once, strict=True):
            out[i] = ids
        for c in new:
            if len(c) > LONGEST:
                known.pop(c, None)
        if len(known) > REMEMBERED // 2:
            self.older, self.known = known, {}
        return out


@lru_cache(maxsize=2)
def encoder(path: str, leading_space: bool) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path, leading_space)
