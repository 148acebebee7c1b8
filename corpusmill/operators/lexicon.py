"""Whole-word tokens: the leftmost, longest words of a lexicon in texts, by a trie.

A batch of texts is one array of characters. All its places take a step in the trie together, and only those that
found an edge take the next one, so the work depends on how deep places get, not on how many words there are.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

# More than any code point, so (node, character) is one number; texts are kept apart by a value that no word has.
_CHARACTERS = 1 << 21
_BETWEEN = _CHARACTERS - 1


def code_points(texts: Iterable[str]) -> np.ndarray:
    """The characters of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)


class Lexicon:
    """A trie as sorted edges: (node, character) to node, and the word that ends at a node."""

    def __init__(self, words: list[str]):
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        for number, word in enumerate(words):
            node = 0
            for char in map(ord, word):
                node = edges.setdefault(node * _CHARACTERS + char, len(edges) + 1)
            if word:
                ends.setdefault(node, number)
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.nodes = np.append(np.fromiter(edges.values(), np.int64, len(edges))[order], 0)
        self.word = np.full(len(edges) + 1, -1, np.int64)
        for node, number in ends.items():
            self.word[node] = number

    def longest(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, word) of the longest word at each place that begins one."""
        n = len(chars)
        padded = np.append(chars, _BETWEEN)
        # The root's edges are the first ones; a table over their characters settles most places at once.
        first = self.keys[: np.searchsorted(self.keys, _CHARACTERS)]
        begins = np.zeros(int(max(first.max(initial=0), chars.max(initial=0))) + 1, bool)
        begins[first] = True
        at = np.flatnonzero(begins[chars])
        node = np.zeros(len(at), np.int64)
        length, word = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        depth = 0
        while len(at):
            key = node * _CHARACTERS + padded[np.minimum(at + depth, n)]
            edge = np.searchsorted(self.keys, key)
            found = self.keys[edge] == key
            at, node = at[found], self.nodes[edge[found]]
            depth += 1
            whole = self.word[node] >= 0
            length[at[whole]], word[at[whole]] = depth, self.word[node[whole]]
        start = np.flatnonzero(word >= 0)
        return start, length[start], word[start]

    def matches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, length, word): from left to right, the longest word at the first place that has one."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        chars = np.full(int(sizes.sum()) + len(texts), _BETWEEN, np.int64)
        inside = np.ones(len(chars), bool)
        inside[begin + sizes] = False
        chars[inside] = code_points(texts)
        start, length, word = self.longest(chars)
        taken, free = [], 0
        for k, (a, b) in enumerate(zip(start.tolist(), (start + length).tolist())):
            if a >= free:
                taken.append(k)
                free = b
        start, length, word = start[taken], length[taken], word[taken]
        text = np.searchsorted(begin, start, "right") - 1
        return text, start - begin[text], length, word


def cut_at_words(lexicon: Lexicon, texts: list[str]) -> pa.StructArray:
    """(stretches, words): the texts between the lexicon's words, in order, and the words' numbers. A text with n words has
    n + 1 stretches, empty ones included."""
    text, start, length, word = lexicon.matches(texts)
    counts = np.bincount(text, minlength=len(texts))
    ends = np.cumsum(counts)
    stretches: list[str] = []
    at = 0
    start, stop = start.tolist(), (start + length).tolist()
    for value, end in zip(texts, ends.tolist()):
        free = 0
        for k in range(at, end):
            stretches.append(value[free : start[k]])
            free = stop[k]
        stretches.append(value[free:])
        at = end
    per_text = np.insert(np.cumsum(counts + 1), 0, 0).astype(np.int32)
    per_word = np.insert(ends, 0, 0).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(per_text, pa.array(stretches, pa.string())),
            pa.ListArray.from_arrays(per_word, pa.array(word, pa.int64())),
        ],
        names=["stretches", "words"],
    )
