"""Encoding texts through their distinct pieces.

The tokenizers used here split a text by one pattern before they merge, and
that pattern never joins what lies before a white-space character with what
follows it when a visible character comes next. A text may therefore be cut
there and encoded piece by piece; a corpus repeats its pieces, so each distinct
one is encoded once and remembered. Texts for which the cut is not certain
(two white-space characters in a row, or one at the end) are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from tierloom.llm.common import gather

#: Pieces remembered; later ones are encoded with their batch and forgotten again.
REMEMBERED = 1 << 18
#: Characters that are cut into pieces at a time.
SEGMENT = 1 << 21
#: Mark of pieces at which a text can't be cut.
UNSAFE = -1

#: Ids of each string of a list: all ids one after the other, and their number per string.
EncodeMany = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def segments(text: str) -> Iterator[str]:
    """The text in parts of about SEGMENT characters, cut where it may be cut."""
    begin = 0
    while len(text) - begin > SEGMENT:
        cut = text.find(" ", begin + SEGMENT)
        while 0 <= cut < len(text) - 1 and text[cut + 1].isspace():
            cut = text.find(" ", cut + 1)
        if not 0 <= cut < len(text) - 1:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def portions(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Segments of all texts, about SEGMENT characters together, and the number of the text of each."""
    numbers, together, size = [], [], 0
    for number, text in enumerate(texts):
        for part in segments(text):
            numbers.append(number)
            together.append(part)
            size += len(part)
            if size >= SEGMENT:
                yield numbers, together
                numbers, together, size = [], [], 0
    if together:
        yield numbers, together


class Spans:
    """Ids of numbered strings, which may be added to and cut back."""

    def __init__(self) -> None:
        self.flat, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, ids])
        self.sizes = np.concatenate([self.sizes, sizes])

    def keep(self, count: int) -> None:
        if len(self) > count:
            self.flat = self.flat[: self.starts[count]]
            self.starts, self.sizes = self.starts[:count], self.sizes[:count]

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[numbers], self.sizes[numbers])


class PieceEncoder:
    """Token ids of texts, from those of their distinct pieces."""

    def __init__(self, encode_many: EncodeMany, remembered: int = REMEMBERED) -> None:
        self.encode_many, self.remembered = encode_many, remembered
        self.later: dict[str, int] = {}  # pieces after the first: a space or, if they begin with it, a line feed leads
        self.first: dict[str, int] = {}
        self.known = Spans()

    def _number(self, known: dict[str, int], piece: str, whole: str, pending: list[str]) -> int:
        known[piece] = len(self.known) + len(pending)
        pending.append(whole)
        return known[piece]

    def _later(self, piece: str, pending: list[str]) -> int:
        feed = piece[:1] == "\n"
        body = piece[1:] if feed else piece
        if not body or body[0].isspace():
            self.later[piece] = UNSAFE
            return UNSAFE
        return self._number(self.later, piece, piece if feed else f" {piece}", pending)

    def _pieces(self, text: str, pending: list[str]) -> list[int]:
        first, *rest = text.replace("\n", " \n").split(" ")
        numbers = [self.first.get(first), *map(self.later.get, rest)]
        if None in numbers:
            for at, number in enumerate(numbers):
                if number is None and at:
                    known = self.later.get(rest[at - 1])
                    numbers[at] = self._later(rest[at - 1], pending) if known is None else known
            if numbers[0] is None:
                numbers[0] = self._number(self.first, first, first, pending)
        if UNSAFE in numbers:
            pending.append(text)
            return [len(self.known) + len(pending) - 1]
        return numbers

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and the number of ids of each text."""
        found, total = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        for numbers, together in portions(texts):
            ids, sizes = self._encode(together)
            found.append(ids)
            np.add.at(total, numbers, sizes)
        return np.concatenate(found), total

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pending: list[str] = []
        numbers = [np.array(self._pieces(text, pending), np.int64) for text in texts]
        if pending:
            self.known.add(*self.encode_many(pending))
        used = np.concatenate([np.empty(0, np.int64), *numbers])
        ends = np.concatenate([[0], np.cumsum(self.known.sizes[used])])
        until = ends[np.cumsum([len(x) for x in numbers], dtype=np.int64)]
        ids = self.known.of(used)
        self._forget()
        return ids, np.diff(until, prepend=0)

    def _forget(self) -> None:
        """Keep the first pieces only; dictionaries hold their entries in the order they came."""
        if len(self.known) > self.remembered:
            for known in (self.later, self.first):
                while known and not 0 <= next(reversed(known.values())) < self.remembered:
                    known.popitem()
            self.known.keep(self.remembered)
