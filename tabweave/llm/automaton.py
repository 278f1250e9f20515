"""Byte-pair merges compiled into a deterministic automaton, and words run through it by its tables.

A state stands for "the last token was t". Merges are built in one after the other: the gadget of merge
k, (a, b) -> c, removes the arc b from state a and adds state c, which is entered from wherever a could
be entered at that time and is left the way b could be left. Written out, the arcs of all states are
quadratic in the vocabulary; so a state keeps the two states it was made from and the time of its
gadget, and an arc is worked out from them when it is first asked for.

A word is read byte by byte and never backwards. A second table says, for what has been read, the tokens it
ends in. Exactly one of them is entered by an arc from the state at its beginning, as every beginning of a word
has one tokenization, and that one is the state behind the byte.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_NEVER = 1 << 60
ARCS = 200_000  # arcs that are kept once worked out; beyond it they are worked out anew
_PLACES = 19  # bits of the number of places that keep arcs of words read together
_TOGETHER = 1 << 13  # words that are read together
_SHORT = 64  # bytes of the longest of them


class MergeAutomaton:
    """Deterministic automaton over tokens, with bytes as the base symbols."""

    def __init__(self, symbols: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]], tokens: dict[bytes, int]):
        """``symbols``: base tokens; ``merges`` in order; ``tokens``: ids of what merges make."""
        self.made: dict[int, tuple[int, int]] = {}
        self.time: dict[int, int] = dict.fromkeys(symbols.values(), 0)
        self.removed: dict[int, int] = {}
        label: dict[int, bytes] = {i: b for b, i in symbols.items()}
        self._arcs: dict[int, bool] = {}
        known = dict(symbols)
        for k, (a, b) in enumerate(merges, start=1):
            # Without the arc there is nothing to merge: an earlier rule always comes between.
            if a in known and b in known and self._arc_at(known[a], known[b], k):
                c = known[a + b] = tokens[a + b]
                self.removed.setdefault(known[a] << 32 | known[b], k)
                if c not in self.time:
                    self.made[c], self.time[c], label[c] = (known[a], known[b]), k, a + b
        self.length = {t: len(text) for t, text in label.items()}
        self._read(label)

    def _read(self, label: dict[int, bytes]) -> None:
        """The table that reads bytes: places in the tree of all tokens, and where to go on when the tree ends."""
        step: dict[int, int] = {}
        token_at: list[int] = [-1]
        parent_edge: list[int] = [0]
        for token, text in label.items():
            node = 0
            for byte in text:
                key = node << 8 | byte
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(token_at)
                    token_at.append(-1)
                    parent_edge.append(key)
            token_at[node] = token
        depth = [0] * len(token_at)
        for node in range(1, len(token_at)):
            depth[node] = depth[parent_edge[node] >> 8] + 1
        # The longest proper ending of a place that is a place as well, shorter places first.
        back = [0] * len(token_at)
        # All tokens that end at a place with their lengths, the longest one first.
        ends: list[tuple[tuple[int, int], ...]] = [()] * len(token_at)
        for node in sorted(range(1, len(token_at)), key=depth.__getitem__):
            above, byte = parent_edge[node] >> 8, parent_edge[node] & 255
            at = back[above] if above else 0
            while above and at and (at << 8 | byte) not in step:
                at = back[at]
            back[node] = step.get(at << 8 | byte, 0) if above else 0
            ends[node] = ends[back[node]]
            if token_at[node] >= 0:
                ends[node] = ((token_at[node], depth[node]), *ends[node])
        self.step, self.back, self.ends = step, back, ends
        self._tabulate(token_at)

    def _tabulate(self, token_at: list[int]) -> None:
        """The same tables as arrays, for many words at a time."""
        size = max(self.length) + 1
        first = [e[0] if e else (-1, 0) for e in self.ends]
        keys = np.fromiter(self.step, dtype=np.int64, count=len(self.step))
        order = np.argsort(keys)
        self._edges = keys[order]
        self._edge_to = np.fromiter(self.step.values(), dtype=np.int64, count=len(self.step))[order]
        self._back = np.array(self.back, dtype=np.int64)
        self._longest = np.array([t for t, _ in first], dtype=np.int64)
        self._size, self._shorter = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self._time, self._left, self._right = (np.zeros(size, dtype=np.int64) for _ in range(3))
        for token, length in self.length.items():
            self._size[token], self._time[token] = length, self.time[token]
        for token, (a, b) in self.made.items():
            self._left[token], self._right[token] = a, b
        for node, token in enumerate(token_at):
            if token >= 0 and len(self.ends[node]) > 1:
                self._shorter[token] = self.ends[node][1][0]
        gone = np.fromiter(self.removed, dtype=np.int64, count=len(self.removed))
        order = np.argsort(gone)
        self._gone = np.append(gone[order], _NEVER)
        self._gone_at = np.append(np.fromiter(self.removed.values(), dtype=np.int64, count=len(gone))[order], _NEVER)
        # Arcs worked out lately, each at the place that its hash says.
        self._kept = np.full(1 << _PLACES, -1, dtype=np.int64)
        self._kept_arc = np.zeros(1 << _PLACES, dtype=bool)

    def _follow(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The places behind one more byte."""
        out = np.zeros(len(node), dtype=np.int64)
        left = np.arange(len(node))
        while len(left):
            key = node[left] << 8 | byte[left]
            at = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            found = self._edges[at] == key
            out[left[found]] = self._edge_to[at[found]]
            left = left[~found & (node[left] > 0)]
            node = node.copy()
            node[left] = self._back[node[left]]
        return out

    def _arcs_of(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may follow in its state."""
        key = state << 32 | token
        place = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PLACES)).astype(np.int64)
        found = self._kept_arc[place]
        new = np.flatnonzero(self._kept[place] != key)
        if len(new):
            asked, one = np.unique(key[new], return_inverse=True)
            answer = self._work_out(asked >> 32, asked & 0xFFFFFFFF)
            found[new] = answer[one]
            self._kept[place[new]] = key[new]
            # Keys that meet at a place leave the last one there, so its answer is taken for the key that is kept.
            self._kept_arc[place[new]] = answer[np.searchsorted(asked, self._kept[place[new]])]
        return found

    def _work_out(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """:meth:`_arc_at` of many pairs, after the last gadget."""
        state, token = state.copy(), token.copy()
        now = np.full(len(state), _NEVER)
        out = np.zeros(len(state), dtype=bool)
        left = np.arange(len(state))
        while len(left):
            s, t = state[left], token[left]
            key = s << 32 | t
            at = np.searchsorted(self._gone, key)
            there = np.where(self._gone[at] == key, self._gone_at[at], _NEVER) >= now[left]
            made, entered = self._time[s], self._time[t]
            plain = there & (made == 0) & (entered == 0)
            out[left[plain]] = True
            run = (made < entered) & (s == self._left[t]) & (s == self._right[t])
            on = there & ~plain & ~run
            left, s, t, made, entered = left[on], s[on], t[on], made[on], entered[on]
            now[left] = np.maximum(made, entered)
            state[left] = np.where(made >= entered, self._right[s], s)
            token[left] = np.where(made <= entered, self._left[t], t)
        return out

    def encode_many(self, words: list[bytes]) -> list[np.ndarray]:
        """:meth:`encode` of many words; short ones are read side by side, a byte of each at a time."""
        out: list[np.ndarray] = [np.zeros(0, dtype="<u4")] * len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for i in np.flatnonzero(lengths > _SHORT).tolist():
            out[i] = np.array(self.encode(words[i]), dtype="<u4")
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] <= _SHORT]
        for at in range(0, len(order), _TOGETHER):
            chosen = order[at : at + _TOGETHER].tolist()
            for i, ids in zip(chosen, self._side_by_side([words[i] for i in chosen]), strict=True):
                out[i] = ids
        return out

    def _side_by_side(self, words: list[bytes]) -> list[np.ndarray]:
        """The tokens of words that come in falling length."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        widest = int(lengths[0])
        data = np.zeros((len(words), widest), dtype=np.int64)
        data[np.arange(widest) < lengths[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
        states = np.full((len(words), widest + 1), -1, dtype=np.int64)
        node = np.zeros(len(words), dtype=np.int64)
        for at in range(1, widest + 1):
            n = int(np.searchsorted(-lengths, -at, side="right"))
            node = self._follow(node[:n], data[:n, at - 1])
            token = self._longest[node]
            left = np.arange(n)
            while len(left):
                if (token[left] < 0).any():
                    raise ValueError("no path spells this word")
                before = at - self._size[token[left]]
                entered = before == 0
                inner = np.flatnonzero(~entered)
                entered[inner] = self._arcs_of(states[left[inner], before[inner]], token[left[inner]])
                left = left[~entered]
                token[left] = self._shorter[token[left]]
            states[:n, at] = token
        # Backwards from the ends, one token of each word at a time.
        at, spelled = lengths.copy(), []
        rows = np.flatnonzero(at)
        while len(rows):
            tokens = states[rows, at[rows]]
            spelled.append((rows, tokens))
            at[rows] -= self._size[tokens]
            rows = rows[at[rows] > 0]
        counts = np.zeros(len(words), dtype=np.int64)
        for rows, _ in spelled:
            counts[rows] += 1
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]), dtype="<u4")
        for i, (rows, tokens) in enumerate(spelled):
            flat[ends[rows] - 1 - i] = tokens
        return np.split(flat, ends[:-1])

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``."""
        key = state << 32 | token
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) >= ARCS:
                self._arcs.clear()
            found = self._arcs[key] = self._arc_at(state, token, _NEVER)
        return found

    def _arc_at(self, state: int, token: int, now: int) -> bool:
        """Whether the arc existed just before gadget ``now``."""
        while True:
            if self.removed.get(state << 32 | token, _NEVER) < now:
                return False
            made, entered = self.time[state], self.time[token]
            if not made and not entered:
                return True
            if made == entered:  # a token behind itself
                # It is entered like its first part and left like its second part.
                now, state, token = made, self.made[state][1], self.made[token][0]
            elif made > entered:
                now, state = made, self.made[state][1]
            else:
                first, second = self.made[token]
                if state == first == second:
                    # In a run of one symbol the left pair merges first, so it never stands alone before the new token.
                    return False
                now, token = entered, first

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: the states of the one path through the automaton that spells it."""
        step, back, ends, arcs = self.step, self.back, self.ends, self._arcs
        states: list[int] = [-1]  # behind each byte, the state that its beginning of the word ends in
        node = 0
        for at, byte in enumerate(word, start=1):
            following = step.get(node << 8 | byte)
            while following is None and node:
                node = back[node]
                following = step.get(node << 8 | byte)
            node = following or 0
            for token, size in ends[node]:
                if at == size:
                    break
                state = states[at - size]
                allowed = arcs.get(state << 32 | token)
                if allowed is None:
                    allowed = self.arc(state, token)
                if allowed:
                    break
            else:
                raise ValueError("no path spells this word")
            states.append(token)
        out: list[int] = []
        at = len(word)
        while at:
            token = states[at]
            out.append(token)
            at -= self.length[token]
        out.reverse()
        return out
