"""Edit strings as linked nodes that share their prefixes, and the repair that compares them."""

from __future__ import annotations

from collections.abc import Iterator

BASE, PRIME = 1_000_003, (1 << 61) - 1

#: What the roles kept so far allow next: nothing kept, after a system turn, after a user's, after an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
WANTED = {NONE: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Where a conversation may end.
FINAL = (NONE, ASSISTANT)
#: Costs of the edits; a truncated row that stays adds one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


class Prefixes:
    """Strings as a tree: a node adds a piece to its parent's string, so versions share prefixes.

    A node knows its ancestors at the distances 1, 2, 4 ... and a rolling hash of its string.
    Two strings are compared by a search for the deepest ancestors of equal hash, which is the
    longest common prefix. Equality of hashes is not trusted: the two paths are walked to where
    they meet, and what was walked once is remembered as equal.

    Pieces are single letters, or letters of one block of rows. Either way, equal strings are cut
    alike, since each piece goes on with a row's edit and insertions follow the row before them.
    """

    def __init__(self, base: int = BASE, prime: int = PRIME) -> None:
        self.base, self.prime = base, prime
        self.piece = [""]
        self.hash = [0]
        self.depth = [0]
        self.up: list[list[int]] = [[]]
        self.first = [0]  # a node of an equal string, or itself

    def add(self, parent: int, piece: str) -> int:
        node = len(self.piece)
        value = self.hash[parent]
        for letter in piece:
            value = (value * self.base + ord(letter)) % self.prime
        ups, k, above = [parent], 0, parent
        while k < len(self.up[above]):
            above = self.up[above][k]
            ups.append(above)
            k += 1
        self.piece.append(piece)
        self.hash.append(value)
        self.depth.append(self.depth[parent] + 1)
        self.up.append(ups)
        self.first.append(node)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The ancestor at this depth, by powers of two."""
        while rest := self.depth[node] - depth:
            node = self.up[node][rest.bit_length() - 1]
        return node

    def _known(self, node: int) -> int:
        while self.first[node] != node:
            self.first[node] = node = self.first[self.first[node]]
        return node

    def _parted(self, x: int, y: int) -> tuple[int, int] | None:
        """The first pair of different pieces on the paths to nodes of one depth; None if none."""
        walked, parted = [], None
        while self._known(x) != self._known(y):
            if self.piece[x] != self.piece[y]:
                parted, walked = (x, y), []
            else:
                walked.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        for a, b in walked:
            self.first[self._known(a)] = self._known(b)
        return parted

    def split(self, x: int, y: int) -> tuple[int, int] | None:
        """Where the strings part: two nodes with different pieces and equal strings before them.
        None if one string goes on from the other."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.hash[a] == self.hash[b]:
            return self._parted(a, b)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        return self._parted(self.up[a][0], self.up[b][0]) or (a, b)

    def less(self, x: int, y: int) -> bool:
        """Whether the string of ``x`` comes before that of ``y``."""
        found = self.split(x, y)
        if found is None:
            return self.depth[x] < self.depth[y]
        a, b = found
        return self._onward(a, x) < self._onward(b, y)

    def _onward(self, node: int, tip: int) -> str:
        """A node's piece and the next one: a piece may go on where the other ends."""
        if self.depth[tip] == self.depth[node]:
            return self.piece[node]
        return self.piece[node] + self.piece[self.ancestor(tip, self.depth[node] + 1)]

    def pieces(self, node: int) -> list[str]:
        out = []
        while node:
            out.append(self.piece[node])
            node = self.up[node][0]
        return out[::-1]


#: For each state the least cost, and the node of the least audit of that cost.
Best = list[tuple[int, int] | None]


def offer(strings: Prefixes, best: Best, state: int, cost: int, parent: int, piece: str) -> None:
    """Take ``parent`` and ``piece`` into a state if they are cheaper there, or as cheap and less."""
    held = best[state]
    if held is not None and held[0] < cost:
        return
    node = strings.add(parent, piece)
    if held is None or cost < held[0] or strings.less(node, held[1]):
        best[state] = (cost, node)


def insert(strings: Prefixes, best: Best) -> None:
    """Turns inserted after what the states hold; no cheapest repair has three in a row."""
    for state in (NONE, SYSTEM, ASSISTANT):
        if best[state] is not None:
            cost, node = best[state]
            offer(strings, best, USER, cost + INSERT, node, "I")
    if best[USER] is not None:
        cost, node = best[USER]
        offer(strings, best, ASSISTANT, cost + INSERT, node, "I")


def after(state: int, initial: str) -> int | None:
    """The state that a turn of this role's initial leads to, if it may follow."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def edit_rows(rows: list[tuple[str, str | None]], start: int, opening: bool, strings: Prefixes) -> Best:
    """The cheapest edits of rows ``(initial, fault)`` from one state to each; ``opening`` allows
    insertions before the first row."""
    best: Best = [None] * 4
    best[start] = (0, 0)
    if opening:
        insert(strings, best)
    for initial, fault in rows:
        now: Best = [None] * 4
        for state, held in enumerate(best):
            if held is None:
                continue
            cost, node = held
            offer(strings, now, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            stays = cost + (TRUNCATED if fault == CUT else 0)
            if (to := after(state, initial)) is not None:
                offer(strings, now, to, stays, node, "K")
            offer(strings, now, after(state, WANTED[state][0]), stays + REROLE, node, "R")
        insert(strings, now)
        best = now
    return best


def cheapest(strings: Prefixes, best: Best) -> tuple[int, int]:
    """Cost and node of the best repair that ends where a conversation may."""
    (cost, node), *others = [best[s] for s in FINAL if best[s] is not None]
    for c, n in others:
        if c < cost or c == cost and strings.less(n, node):
            cost, node = c, n
    return cost, node


def apply_edits(audit: str, rows: list[tuple], state: int) -> tuple[list[tuple], int]:
    """Rows ``(edit, turn, role, text)`` after the edits of ``(turn, role, text)``, and the state then."""
    out = []
    left: Iterator[tuple] = iter(rows)
    for edit in audit:
        turn, role, text = (None, "", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit != "K":
            role = WANTED[state]
        state = after(state, role[:1])
        out.append((edit, turn, role, text))
    return out, state
