"""Byte-pair coding of words, in plain Python for use inside tasks."""

from __future__ import annotations

from heapq import heappop, heappush

#: Words kept in a coder's memory, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 1 << 16, 256


def merged(word: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of the word's pieces.

    Pieces are single bytes at first. Of all neighbours that are a known piece together, those of the lowest
    rank are joined first, the leftmost of several. Joins wait in a heap, so a word of n bytes takes n log n steps.
    """
    size = len(word)
    # A piece is named by the place of its first byte; end[place] is 0 once it is part of another one.
    end = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    waiting: list[tuple[int, int, int, int]] = []

    def offer(left: int, right: int) -> None:
        if left >= 0 and right < size and end[right] - left <= longest:
            rank = ranks.get(word[left : end[right]])
            if rank is not None:
                heappush(waiting, (rank, left, right, end[right]))

    for place in range(size - 1):
        offer(place, place + 1)
    while waiting:
        _, left, right, stop = heappop(waiting)
        # Out of date if one of the two has been joined to something else since.
        if end[left] != right or end[right] != stop:
            continue
        end[left], end[right] = stop, 0
        if stop < size:
            before[stop] = left
        offer(left, stop)
        offer(before[left], left)
    ids, place = [], 0
    while place < size:
        ids.append(ranks[word[place : end[place]]])
        place = end[place]
    return ids


class WordCoder:
    """Ids of words by a table of ranks; remembers words in two generations of bounded size."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def ids(self, word: str) -> list[int]:
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = merged(word.encode("utf-8", "surrogatepass"), self.ranks, self.longest)
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.young) >= REMEMBERED:
                    self.old, self.young = self.young, {}
                self.young[word] = found
        return found


class TextCoder(WordCoder):
    """Ids of whole texts, as a tokenizer that takes a list of texts and returns a list of id lists."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(ranks)
        import regex

        self.words = regex.compile(pattern).findall

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [[piece for word in self.words(text) for piece in self.ids(word)] for text in texts]
