"""Longest-match word pieces in time linear in a word, many words at once.

The pieces make two tries, one for pieces that begin a word and one for pieces inside a
word, kept as arrays.  A node that cannot be left by the next character has a failure
link: the pieces that its path is sure to begin with, and the node inside the trie where
the rest of the path stands (Song et al., "Fast WordPiece Tokenization", 2021).  So no
character is read twice, however long the pieces are.  All words of a batch walk together:
a step looks up the next character of every word in one search.
"""

from __future__ import annotations

import numpy as np

# Bits of a code point within the number of an edge.
_CHAR = 21
BEGIN, INSIDE, NONE = 0, 1, -1
MARK = "##"


def points_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after the other, and where each word begins."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points, np.concatenate([[0], np.cumsum(sizes)])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `starts`, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class PieceTrie:
    """Pieces and their ids; immutable, built once for a task."""

    def __init__(self, tokens: list[str], ids: np.ndarray):
        ids = np.asarray(ids, dtype=np.int64)
        inner = np.array([t.startswith(MARK) and len(t) > len(MARK) for t in tokens], dtype=bool)
        # A marked token is also a piece that begins a word, one that begins with the mark.
        texts = [*tokens, *(t[len(MARK) :] for t, is_inner in zip(tokens, inner) if is_inner)]
        value = np.concatenate([ids, ids[inner]])
        at = np.concatenate([np.full(len(tokens), BEGIN), np.full(int(inner.sum()), INSIDE)])
        points, first = points_of(texts)
        size = np.diff(first)
        levels, keys, targets = [], [], []
        nodes = 2
        token_of = {}
        live = np.flatnonzero(size > 0)
        depth = 0
        while len(live):
            edge = (at[live] << _CHAR) | points[first[live] + depth]
            unique, where = np.unique(edge, return_inverse=True)
            at[live] = nodes + where
            levels.append((nodes, unique))
            keys.append(unique)
            targets.append(nodes + np.arange(len(unique)))
            nodes += len(unique)
            depth += 1
            ended = live[size[live] == depth]
            token_of[depth] = (at[ended], value[ended])
            live = live[size[live] > depth]
        order = np.argsort(np.concatenate(keys), kind="stable") if keys else np.zeros(0, np.int64)
        self.keys = np.concatenate(keys)[order] if keys else np.zeros(0, np.int64)
        self.targets = np.concatenate(targets)[order] if keys else np.zeros(0, np.int64)
        self._link(nodes, levels, token_of)

    def _link(self, nodes: int, levels: list, token_of: dict) -> None:
        """Failure links and their pieces, level by level, from shorter paths to longer ones."""
        token = np.full(nodes, NONE, np.int64)
        for at, value in token_of.values():
            token[at] = value
        self.fail = np.full(nodes, NONE, np.int64)
        self.pop_start, self.pop_size = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        pops, total = [np.zeros(0, np.int64)], 0
        flat = pops[0]
        for start, unique in levels:
            node = start + np.arange(len(unique))
            parent, char = unique >> _CHAR, unique & ((1 << _CHAR) - 1)
            is_token = token[node] != NONE
            # A whole piece: itself, and then whatever stands inside a word.
            own = node[is_token]
            self.fail[own] = INSIDE
            # Otherwise what the parent begins with, and the parent's links until one can go on.
            rest = np.flatnonzero(~is_token)
            link = self.fail[parent[rest]]
            sources = [(rest, parent[rest])]
            open_ = np.flatnonzero(link != NONE)
            rest_target = np.full(len(rest), NONE, np.int64)
            while len(open_):
                target = self.go(link[open_], char[rest[open_]])
                rest_target[open_] = target
                stuck = open_[target == NONE]
                sources.append((rest[stuck], link[stuck]))
                link[stuck] = self.fail[link[stuck]]
                open_ = stuck[link[stuck] != NONE]
            self.fail[node[rest]] = rest_target
            whole = np.concatenate([s for s, _ in sources])
            source = np.concatenate([s for _, s in sources])
            reached = self.fail[node[whole]] != NONE
            order = np.argsort(whole[reached], kind="stable")
            whole, source = whole[reached][order], source[reached][order]
            sizes = self.pop_size[source]
            taken = flat[ragged(self.pop_start[source], sizes)]
            count = np.bincount(whole, sizes, len(node)).astype(np.int64)
            count[is_token] = 1
            begin = total + np.cumsum(count) - count
            level = np.empty(int(count.sum()), np.int64)
            level[begin[is_token] - total] = token[own]
            level[ragged(begin[~is_token] - total, count[~is_token])] = taken
            self.pop_start[node], self.pop_size[node] = begin, count
            total += len(level)
            pops.append(level)
            flat = np.concatenate([flat, level])
        self.pops = flat

    def go(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes that characters lead to, `NONE` where there is no edge."""
        if not len(self.keys):
            return np.full(len(node), NONE, np.int64)
        edge = (node << _CHAR) | char
        place = np.minimum(np.searchsorted(self.keys, edge), len(self.keys) - 1)
        return np.where(self.keys[place] == edge, self.targets[place], NONE)

    def split(self, words: list[str], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces word by word, the number of each word's, and which words have a split.

        A word of over `longest` characters has none; an empty word has one without pieces.
        """
        points, first = points_of(words)
        size = np.diff(first)
        node = np.full(len(words), BEGIN, np.int64)
        known = size <= longest
        events: list[tuple[np.ndarray, np.ndarray]] = []

        def fall(at: np.ndarray) -> np.ndarray:
            """Take the failure links of words; those without one drop out."""
            link = self.fail[node[at]]
            known[at[link == NONE]] = False
            at, link = at[link != NONE], link[link != NONE]
            events.append((at, node[at]))
            node[at] = link
            return at

        live, depth = np.flatnonzero(known & (size > 0)), 0
        while len(live):
            waiting = live
            while len(waiting):
                target = self.go(node[waiting], points[first[waiting] + depth])
                moved = target != NONE
                node[waiting[moved]] = target[moved]
                waiting = fall(waiting[~moved])
            depth += 1
            live = live[known[live] & (size[live] > depth)]
        waiting = np.flatnonzero(known & (size > 0))
        while len(waiting):
            waiting = fall(waiting)
            waiting = waiting[node[waiting] != INSIDE]
        if not events:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64), known
        word, source = (np.concatenate(part) for part in zip(*events))
        keep = known[word]
        order = np.argsort(word[keep], kind="stable")
        word, source = word[keep][order], source[keep][order]
        sizes = self.pop_size[source]
        counts = np.bincount(word, sizes, len(words)).astype(np.int64)
        return self.pops[ragged(self.pop_start[source], sizes)], counts, known
