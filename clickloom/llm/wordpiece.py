"""Token counts of greedy longest-match word pieces, in time linear in the text.

The vocabulary is a trie over bytes.  Its failure link leads from a node to
where matching goes on once the longest pieces of what was read are popped, and
the number of popped tokens is stored beside it.  Every single byte is a piece
too (unknown characters fall back to their bytes), so each node has a successor
for each byte and links and counts fold into one transition table: counting
reads each byte once and builds no piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, texts, with_columns
from .pieces import MARK, MODEL, NORMAL, Model, model_bytes

#: With fewer words left than this, the rest of each is read alone.
FEW = 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Automaton:
    """Greedy word-piece counts over byte strings that begin with ``start``."""

    def __init__(self, pieces: list[bytes], start: bytes = MARK.encode()):
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in [*(bytes([i]) for i in range(256)), *pieces]:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(False)
                node = children[node][byte]
            ends[node] = ends[node] or bool(piece)
        size = len(children)
        self.next = np.zeros((size, 256), np.int32)
        self.popped = np.zeros((size, 256), np.uint16)
        link, pops, self.left = np.zeros(size, np.int32), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.next[0] = [children[0][i] for i in range(256)]
        level = [(0, byte, node) for byte, node in children[0].items()]
        while level:
            parent, byte, node = (np.array(x) for x in zip(*level, strict=True))
            end = np.array(ends)[node]
            # A whole piece is popped as one; else the parent's link reads the byte.
            link[node] = np.where(end, 0, self.next[link[parent], byte])
            pops[node] = np.where(end, 1, pops[parent] + self.popped[link[parent], byte])
            self.left[node] = pops[node] + self.left[link[node]]
            self.next[node] = self.next[link[node]]
            self.popped[node] = self.popped[link[node]] + pops[node][:, None]
            level = [(u, b, v) for u in node.tolist() for b, v in children[u].items()]
            for u, b, v in level:
                self.next[u, b], self.popped[u, b] = v, 0
        state, self.base = 0, 0
        for byte in start:
            self.base += int(self.popped[state, byte])
            state = int(self.next[state, byte])
        self.start = state

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word ``data[start:end]``; all words are read side by side."""
        order = np.argsort(starts - ends, kind="stable")
        at, sizes = starts[order], (ends - starts)[order]
        state, tokens = np.full(len(at), self.start, np.int64), np.full(len(at), self.base, np.int64)
        step, popped, longest = self.next.ravel(), self.popped.ravel(), int(sizes[0]) if len(sizes) else 0
        more = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
        done = 0
        while done < longest and more[done] >= FEW:
            n = more[done]
            key = state[:n] * 256 + data[at[:n] + done]
            tokens[:n] += popped[key]
            state[:n] = step[key]
            done += 1
        if done < longest:
            fast, pop = memoryview(step), memoryview(popped)
            for i in range(more[done]):
                now, total = int(state[i]), 0
                for byte in data[at[i] + done : at[i] + sizes[i]].tobytes():
                    key = now * 256 + byte
                    total += pop[key]
                    now = fast[key]
                state[i], tokens[i] = now, tokens[i] + total
        out = np.empty(len(at), np.int64)
        out[order] = tokens + self.left[state]
        return out


_built: dict[bytes, Automaton] = {}


def automaton_of(content: bytes) -> Automaton:
    """The automaton of a model's pieces, built once a worker."""
    if content not in _built:
        _built.clear()
        _built[content] = Automaton([p.encode() for p, _, kind in Model.parse(content).pieces if kind == NORMAL])
    return _built[content]


def token_counts(docs: DataFrame, path: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_words`` and ``n_tokens`` of the whole text.

    Words are what ASCII white space separates; a word is read with the marker
    of word starts before it, cut greedily into the longest pieces of the
    vocabulary, and bytes that no piece covers are a token each.  A null or
    empty text has none.  Columns of these names are replaced; all others stay.
    """
    content = model_bytes(docs.sparkSession, path)

    def work(column):
        automaton = automaton_of(content)
        data, offsets = texts(column)
        words, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high in blocks(offsets):
            at = offsets[low : high + 1] - offsets[low]
            own = data[offsets[low] : offsets[high]]
            word = ~_BLANK[own]
            cut = np.zeros(len(own) + 1, bool)
            cut[at] = True
            starts = np.flatnonzero(word & (~np.concatenate(([False], word))[:-1] | cut[:-1]))
            ends = np.flatnonzero(word & (~np.concatenate((word, [False]))[1:] | cut[1:])) + 1
            total = np.concatenate(([0], np.cumsum(automaton.count(own, starts, ends))))
            first = np.searchsorted(starts, at)
            words.append(np.diff(first))
            tokens.append(np.diff(total[first]))
        return [pa.array(np.diff(offsets)), pa.array(np.concatenate(words)), pa.array(np.concatenate(tokens))]

    return with_columns(docs, [text_col], work, "n_bytes long, n_words long, n_tokens long")
