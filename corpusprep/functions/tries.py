"""Words segmented many at a time: matches against a set of strings, pair merges and best paths in numpy.

Every function takes an Arrow array of distinct words and works on the code points of all of them together; no word becomes
a Python object.  ``Segments`` is what they return: pieces of all words one after the other.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from corpusprep.functions.batches import code_points, text_sizes

# Entries of a trie's table of children; a larger trie is looked up in the sorted list of its edges.
TABLE = 1 << 23
CODE_POINTS = 0x110000


class Segments(NamedTuple):
    first: np.ndarray  # of every word its first piece, then their number
    name: np.ndarray  # of every piece its place in ``names``
    begin: np.ndarray  # and its span in the word
    end: np.ndarray
    names: pa.Array


class Trie:
    """Strings by their prefixes.  Node 1 is the root, node 0 is no node."""

    def __init__(self, entries: list[str]):
        edges: dict = {}
        entry = [-1, -1]
        for i, text in enumerate(entries):
            node = 1
            for c in text:
                node = edges.setdefault(node * CODE_POINTS + ord(c), len(entry))
                if node == len(entry):
                    entry.append(-1)
            if node > 1:
                entry[node] = i
        self.entry = np.array(entry, dtype=np.int64)
        keys = np.array(sorted(edges), dtype=np.int64)
        children = np.array([edges[k] for k in keys.tolist()], dtype=np.int64)
        used = np.unique(keys % CODE_POINTS)
        self.kind = np.zeros(CODE_POINTS, dtype=np.int32)
        self.kind[used] = np.arange(1, len(used) + 1)
        self.kinds = len(used) + 1
        places = keys // CODE_POINTS * self.kinds + self.kind[keys % CODE_POINTS]  # in the same order
        self.table = None
        if len(entry) * self.kinds <= TABLE:
            self.table = np.zeros(len(entry) * self.kinds, dtype=np.int32)
            self.table[places] = children
        else:
            self.places, self.children = np.append(places, -1), np.append(children, 0)

    def step(self, nodes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The nodes' children by the characters' kinds, 0 where there is none."""
        at = nodes * np.int64(self.kinds) + kinds
        if self.table is not None:
            return self.table[at]
        found = np.searchsorted(self.places[:-1], at)
        return np.where(self.places[found] == at, self.children[found], 0)

    def longest(self, kinds: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End and number of the longest entry that begins at each start and ends before its stop, -1 where none does."""
        end, found = np.full(len(starts), -1, dtype=np.int64), np.full(len(starts), -1, dtype=np.int64)
        which, at, nodes = np.arange(len(starts)), starts, np.ones(len(starts), dtype=np.int64)
        while len(which):
            going = at < stops[which]
            which, at, nodes = which[going], at[going], nodes[going]
            nodes = self.step(nodes, kinds[at])
            going = nodes > 0
            which, at, nodes = which[going], at[going] + 1, nodes[going]
            entry = self.entry[nodes]
            hit = entry >= 0
            end[which[hit]], found[which[hit]] = at[hit], entry[hit]
        return end, found


class LongestMatch:
    """Greedy longest matches from the left: ``first`` holds what a word may begin with, ``rest`` what may follow; a word
    that cannot be matched whole is ``unknown``."""

    def __init__(self, first: list[str], rest: list[str], names: list[str], unknown: str):
        """``names``: of all of ``first``, then of all of ``rest``."""
        self.first, self.rest, self.offset = Trie(first), Trie(rest), len(first)
        self.names = pa.array([*names, unknown], pa.string())

    def __call__(self, words: pa.Array) -> Segments:
        points, at = code_points(words)
        lengths = np.diff(at)
        stop = np.repeat(at[1:], lengths)
        end, name = self.rest.longest(self.rest.kind[points], np.arange(len(points)), stop)
        name[name >= 0] += self.offset
        full = np.flatnonzero(lengths)
        start = at[full]
        end[start], name[start] = self.first.longest(self.first.kind[points], start, at[full + 1])
        visited, failed = np.zeros(len(points), dtype=bool), np.zeros(len(words), dtype=bool)
        here, word = start, full
        while len(here):
            visited[here] = True
            then = end[here]
            failed[word[then < 0]] = True
            going = (then >= 0) & (then < at[word + 1])
            here, word = then[going], word[going]
        visited &= ~np.repeat(failed, lengths)
        lost = np.flatnonzero(failed)
        visited[at[lost]], end[at[lost]], name[at[lost]] = True, at[lost + 1], len(self.names) - 1
        pieces = np.flatnonzero(visited)
        origin = np.repeat(at[:-1], lengths)[pieces]
        return Segments(np.searchsorted(pieces, at), name[pieces], pieces - origin, end[pieces] - origin, self.names)


class Merges:
    """Pair merges replayed in the order of their ranks, on characters or (``byte_level``) on bytes in hex."""

    def __init__(self, ranks: dict[tuple[str, str], int], byte_level: bool):
        self.byte_level = byte_level
        names = sorted({s for pair in ranks for s in (*pair, "".join(pair))})
        number = {s: i + 1 for i, s in enumerate(names)}  # 0: a symbol of no merge
        self.names, self.n = names, len(names) + 1
        pairs = sorted((number[a] * self.n + number[b], r, number[a + b]) for (a, b), r in ranks.items())
        self.codes, self.rank, self.made = (np.array([p[i] for p in pairs] + [-1], dtype=np.int64) for i in range(3))
        self.base = np.zeros(256 if byte_level else CODE_POINTS, dtype=np.int64)
        for s, i in number.items():
            if len(s) == (2 if byte_level else 1):
                self.base[int(s, 16) if byte_level else ord(s)] = i
        self.table = None
        if self.n * self.n <= TABLE:  # of every pair its place in the lists, the last one for none
            self.table = np.full(self.n * self.n, len(self.codes) - 1, dtype=np.int32)
            self.table[self.codes[:-1]] = np.arange(len(self.codes) - 1)
        self.rank[-1] = np.iinfo(np.int64).max

    def _found(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Place in the lists of the pair that begins at every symbol; none at the last symbol of a word."""
        none = len(self.codes) - 1
        codes = symbols[:-1] * self.n + symbols[1:]
        if self.table is not None:
            out = self.table[codes]
        else:
            out = np.searchsorted(self.codes[:-1], codes)
            out[self.codes[out] != codes] = none
        out = np.append(out, none)
        out[last] = none
        return out

    def __call__(self, words: pa.Array) -> Segments:
        points, at = code_points(words)
        raw, units = points, at
        if self.byte_level:
            raw = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
            units = np.concatenate([[0], np.cumsum(text_sizes(words), dtype=np.int64)])
        symbols = self.base[raw]
        begins = np.arange(len(raw))  # of every symbol, in units
        sizes = np.diff(units)
        done: list = []  # (word, symbol, begin) of words that have no more merges
        which = np.flatnonzero(sizes)
        while len(which):
            n = sizes[which]
            ends = np.cumsum(n)
            found = self._found(symbols, ends - 1)
            rank = self.rank[found]
            least = np.minimum.reduceat(rank, ends - n)
            going = least < self.rank[-1]
            inside = np.repeat(going, n)
            done.append((np.repeat(which[~going], n[~going]), symbols[~inside], begins[~inside]))
            if not going.any():
                break
            hit = np.flatnonzero(inside & (rank == np.repeat(least, n)))
            symbols = symbols.copy()
            # places of a pair of equal symbols may overlap: every second one of a run is taken
            same = np.diff(hit, prepend=-2) == 1
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(hit))))
            hit = hit[run % 2 == 0]
            symbols[hit] = self.made[found[hit]]
            inside[hit + 1] = False
            lost = np.add.reduceat(~inside, ends - n)
            symbols, begins = symbols[inside], begins[inside]
            sizes = sizes.copy()
            sizes[which] = n - lost
            which = which[going]
        word, symbols, begins = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, dtype=np.int64) for i in range(3))
        # symbols of a word lie together and in order; their begins are in the order of the words
        order = np.argsort(begins, kind="stable")
        word, symbols, begins = word[order], symbols[order], begins[order]
        ends = np.append(begins, len(raw))[1:len(begins) + 1]
        names = list(self.names)
        plain = np.flatnonzero(symbols == 0)  # symbols of no merge are one unit long
        kinds, kind = np.unique(raw[begins[plain]], return_inverse=True)
        name = symbols - 1
        name[plain] = len(names) + kind
        names += [f"{k:02X}" if self.byte_level else chr(k) for k in kinds.tolist()]
        if self.byte_level:  # spans of the characters that hold the piece's bytes
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            first, last = char[begins] - at[word], char[ends - 1] + 1 - at[word]
        else:
            first, last = begins - at[word], ends - at[word]
        return Segments(np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))]), name, first, last, pa.array(names, pa.string()))


class BestPaths:
    """Segmentations of words into units with costs (-log of their probabilities), words of one length together: a step for
    every start and length of a piece takes all words at once."""

    #: Words times places of a lattice that is held at a time, and the least probability of a word that is taken in floats.
    HELD, LEAST = 1 << 23, 1e-280

    def __init__(self, model: dict[str, float], unknown: str, one_expected=None):
        """``one_expected``: the expected counts of a single word, for words too unlikely for floats."""
        self.model, self.one_expected = model, one_expected
        self.units = list(model)
        self.trie = Trie(self.units)
        self.entry = (self.trie.entry + 1).astype(np.int32)  # 0: no unit ends here
        self.cost = np.array([np.inf, *model.values()])
        self.length = np.array([0, *map(len, self.units)])
        self.longest = int(self.length.max())
        self.names = pa.array([*self.units, unknown], pa.string())

    def _groups(self, points: np.ndarray, at: np.ndarray):
        """(numbers of some words of one length, their lattice): of every start the units of length 1 and so on, as
        numbers from 1 on, 0 or None for no unit."""
        lengths = np.diff(at)
        order = np.argsort(lengths, kind="stable")
        kinds = self.trie.kind[points]
        n_of, first = np.unique(lengths[order], return_index=True)
        for n, a, b in zip(n_of.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            if not n:
                continue
            step = max(1, self.HELD // (n * min(n, self.longest)))
            for lo in range(a, b, step):
                words = order[lo:min(lo + step, b)]
                own = kinds[at[words] + np.arange(n)[:, None]]
                lattice = []
                for start in range(n):
                    nodes, row = np.ones(len(words), dtype=np.int64), []
                    for k in range(start, n):
                        nodes = self.trie.step(nodes, own[k])
                        if not nodes.any():
                            break
                        unit = self.entry[nodes]
                        row.append(unit if unit.any() else None)
                    lattice.append(row)
                yield words, lattice

    def _best(self, lattice: list, n_words: int, paths: bool = True, rows: np.ndarray | None = None, banned: np.ndarray | None = None):
        """Least costs of the words up to every place; with ``paths`` the start and unit of the last piece before each.
        Of equal costs the earliest start stays.  ``rows`` of the words are taken, without the units ``banned``."""
        n = len(lattice)
        best = np.full((n + 1, n_words), np.inf)
        best[0] = 0.0
        start_of, unit_of = (np.zeros((n + 1, n_words), dtype=np.int32) for _ in range(2)) if paths else (None, None)
        for start, row in enumerate(lattice):
            for k, unit in enumerate(row):
                if unit is None:
                    continue
                end = start + k + 1
                if rows is not None:
                    unit = unit[rows]
                cost = self.cost[unit]
                if banned is not None:
                    cost[unit == banned] = np.inf
                cost += best[start]
                better = cost < best[end]
                np.copyto(best[end], cost, where=better)
                if paths:
                    np.copyto(start_of[end], start, where=better)
                    np.copyto(unit_of[end], unit, where=better)
        return best[n], start_of, unit_of

    @staticmethod
    def _pieces(costs: np.ndarray, start_of: np.ndarray, unit_of: np.ndarray):
        """(word, start, end, unit) of the pieces of the best paths, from the last to the first."""
        word = np.flatnonzero(np.isfinite(costs))
        end = np.full(len(word), len(start_of) - 1)
        while len(word):
            start = start_of[end, word]
            yield word, start, end, unit_of[end, word]
            word, end = word[start > 0], start[start > 0]

    def __call__(self, words: pa.Array) -> Segments:
        """The best segmentation of every word, a word without one is unknown."""
        points, at = code_points(words)
        visited = np.zeros(len(points), dtype=bool)
        name, end_at = np.full(len(points), len(self.units), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
        for which, lattice in self._groups(points, at):
            found = self._best(lattice, len(which))
            for word, start, end, unit in self._pieces(*found):
                place = at[which[word]] + start
                visited[place], name[place], end_at[place] = True, unit - 1, end
            lost = at[which[~np.isfinite(found[0])]]
            visited[lost], end_at[lost] = True, len(lattice)
        pieces = np.flatnonzero(visited)
        return Segments(np.searchsorted(pieces, at), name[pieces], pieces - np.repeat(at[:-1], np.diff(at))[pieces], end_at[pieces], self.names)

    def expected(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        """How often each unit is expected in the words, over all their segmentations (forward-backward), times counts."""
        points, at = code_points(words)
        chance = np.exp(-self.cost)
        total = np.zeros(len(self.cost))
        for which, lattice in self._groups(points, at):
            n, some = len(lattice), len(which)
            ahead, behind = np.zeros((n + 1, some)), np.zeros((n + 1, some))
            ahead[0], behind[n] = 1.0, 1.0
            for start, row in enumerate(lattice):
                for k, unit in enumerate(row):
                    if unit is not None:
                        ahead[start + k + 1] += ahead[start] * chance[unit]
            share = np.where(ahead[n] > self.LEAST, counts[which] / np.maximum(ahead[n], self.LEAST), 0.0)
            for start in range(n - 1, -1, -1):
                units, sums = [], []
                for k, unit in enumerate(lattice[start]):
                    if unit is not None:
                        here = chance[unit] * behind[start + k + 1]
                        behind[start] += here
                        units.append(unit)
                        sums.append(here * (ahead[start] * share))
                if units:
                    total += np.bincount(np.concatenate(units), np.concatenate(sums), len(total))
            if self.one_expected:
                for w in which[ahead[n] <= self.LEAST].tolist():
                    for unit, x in self.one_expected(words[w].as_py(), self.model, self.longest).items():
                        total[self.trie_number(unit)] += counts[w] * x
        return total[1:]

    def trie_number(self, unit: str) -> int:
        node = 1
        for c in unit:
            node = int(self.trie.step(np.array([node]), self.trie.kind[[ord(c)]])[0])
        return int(self.entry[node])

    def removal_losses(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        """How much dearer the best segmentations of the words get without each multi-character unit of them, times
        counts."""
        points, at = code_points(words)
        total = np.zeros(len(self.cost))
        for which, lattice in self._groups(points, at):
            costs, start_of, unit_of = self._best(lattice, len(which))
            codes = [word * len(total) + unit for word, _, _, unit in self._pieces(costs, start_of, unit_of)]
            codes = np.unique(np.concatenate(codes)) if codes else np.zeros(0, dtype=np.int64)
            codes = codes[self.length[codes % len(total)] > 1]
            for lo in range(0, len(codes), len(which)):
                word, unit = codes[lo:lo + len(which)] // len(total), codes[lo:lo + len(which)] % len(total)
                without = self._best(lattice, len(word), False, word, unit)[0]
                total += np.bincount(unit, (without - costs[word]) * counts[which[word]], len(total))
        return total[1:]
