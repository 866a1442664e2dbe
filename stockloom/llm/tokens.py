"""Whole texts to token ids with the tokenizers library, word by word.

A byte-level BPE vocabulary never merges across the start of a blank-led word, so a text may be cut before every blank
that follows a non-blank character, and the ids of the parts put together are the ids of the text. Each distinct part is
encoded once and kept for the worker's later tasks, in two generations of ``keep`` parts at most; this is the same result as
encoding the text at once, several times faster.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable
from itertools import islice

from tokenizers import Tokenizer

#: The usual byte alphabet of byte-level BPE: printable bytes stand for themselves, the others for characters from 256 on.
#: White space other than blank and line feed; texts that hold any are cut with more care.
_RARE_SPACE = [chr(c) for c in (*range(0x09, 0x0A), *range(0x0B, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = {b: chr(b) for b in _PRINTABLE}
ALPHABET |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_BLANK = ALPHABET[0x20]
#: Letters and a run of marks after them, to the end of a part: two pieces of the pre-tokenizer.
_MARKED = re.compile(r"([^\W\d_]+)([^\w\s]+)").fullmatch


class _Written(dict):
    """What the alphabet writes for a character, by code point."""

    def __missing__(self, code: int) -> str:
        out = self[code] = "".join([ALPHABET[b] for b in chr(code).encode()])
        return out


class _Parts(dict):
    """Ids of parts after a blank; those of a new part are made when they are asked for, and kept."""

    def __init__(self, make: Callable[[str], bytes], known: Iterable[tuple[str, bytes]] = ()):
        super().__init__(known)
        self.make = make

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = self.make(part)
        return ids


_WRITTEN = _Written()
#: Parts looked up before the generations are checked again.
_STRETCH = 1 << 14


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class TextEncoder:
    """Ids of whole texts as little-endian 32-bit bytes. Use :meth:`of` inside tasks: one per worker and vocabulary."""

    _loaded: dict[tuple[str, int], TextEncoder] = {}

    def __init__(self, vocabulary: str, keep: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self._tokenize = self.model.tokenize
        self.keep = keep
        self.parts, self.older = _Parts(self._new), {}

    @classmethod
    def of(cls, vocabulary: str, keep: int = 400_000) -> TextEncoder:
        if (vocabulary, keep) not in cls._loaded:
            cls._loaded[vocabulary, keep] = cls(vocabulary, keep)
        return cls._loaded[vocabulary, keep]

    def piece(self, part: str) -> bytes:
        """Ids of a part that begins with a blank or a line feed after a character other than white space; not kept."""
        if part[0] == " ":
            return self._word(_BLANK, part[1:])
        return self._whole(part) if part[1:2].isspace() else self._mark("\n") + self._word("", part[1:])

    def rest(self, most: int | None = None) -> None:
        """At the end of a task: one generation of parts stays for the worker's next one, the fuller of the two.

        ``most`` keeps its first parts only, where other stages need the worker's memory.
        """
        fuller = max(self.parts, self.older, key=len)
        self.parts, self.older = fuller if most is None else _Parts(self._new, islice(fuller.items(), most)), {}

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, blank: str, word: str) -> bytes:
        """Ids of letters only, after a blank or not: one piece of the pre-tokenizer, so the model alone decides."""
        mapped = blank + (word if word.isascii() else word.translate(_WRITTEN))
        return _bytes([t.id for t in self._tokenize(mapped)])

    def _word(self, blank: str, part: str) -> bytes:
        """Ids of a part without a blank inside; ``blank`` is what the alphabet writes for the one before it, or nothing."""
        if part.isalpha():
            return self._letters(blank, part)
        if (marked := _MARKED(part)) and marked[1].isalpha():
            return self._letters(blank, marked[1]) + self._mark(marked[2])
        if "\n" in part and "" not in (lines := part.split("\n")):
            # a line feed between two other characters is a piece of its own
            first = self._cached(lines[0]) if blank else self._word("", lines[0])
            return first + b"".join([self._mark("\n") + self._word("", line) for line in lines[1:]])
        return self._whole((" " if blank else "") + part)

    def _mark(self, mark: str) -> bytes:
        """Ids of a line feed or a run of marks by itself; no part holds what leads its key."""
        key = "\0" + mark
        ids = self.parts.get(key)
        if ids is None:
            ids = self.parts[key] = _bytes([t.id for t in self.model.tokenize(mark.translate(_WRITTEN))])
        return ids

    def _turn(self) -> None:
        """A full generation becomes the older one."""
        if len(self.parts) >= self.keep:
            self.parts, self.older = _Parts(self._new), self.parts

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head, *rest = text.split(" ")
        if not head or text[-1] in " \n" or "  " in text or "\n " in text or "\0" in text or any([c in text for c in _RARE_SPACE]):
            return self._careful(head, rest)
        out = [self._whole(head)]
        for start in range(0, len(rest), _STRETCH):
            self._turn()
            out += map(self.parts.__getitem__, rest[start : start + _STRETCH])
        return b"".join(out)

    def _new(self, part: str) -> bytes:
        """Ids of a blank and a part that the younger generation lacks.

        A word before a mark has the ids of the word alone, so these are looked up before they are made.
        """
        ids = self.older.get(part) if self.older else None
        if ids is not None:
            return ids
        if part.isalpha():
            return self._letters(_BLANK, part)
        if (marked := _MARKED(part)) and marked[1].isalpha():
            return self.parts[marked[1]] + self._mark(marked[2])
        return self._word(_BLANK, part)

    def _careful(self, head: str, rest: list[str]) -> bytes:
        """Parts that end in white space belong to the next one."""
        out, open_, first = [], head, True
        for part in rest:
            if open_ and not open_[-1].isspace():
                out.append(self._whole(open_) if first else self._cached(open_[1:]))
                open_, first = " " + part, False
            else:
                open_ += " " + part
        out.append(self._whole(open_) if first else self._cached(open_[1:]))
        return b"".join(out)

    def _cached(self, part: str) -> bytes:
        """Ids of a blank and the part."""
        if "\0" in part or not part:
            return self._whole(" " + part)
        self._turn()
        return self.parts[part]
