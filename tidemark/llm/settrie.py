"""A path-compressed trie over ordered token sets, probed for sets of Jaccard
similarity 0.75 or more."""

from __future__ import annotations

import numpy as np

#: Similarity bound as a fraction; all tests are in whole numbers.
NUMERATOR, DENOMINATOR = 3, 4


class _Node:
    __slots__ = ("label", "children", "members")

    def __init__(self, label: np.ndarray):
        self.label = label  # tokens on the edge into this node
        self.children: dict[int, _Node] = {}  # by the first token of the edge
        self.members: list[int] = []  # sets that end here


def _insert(root: _Node, member: int, tokens: np.ndarray) -> None:
    node, rest = root, tokens
    while len(rest):
        child = node.children.get(int(rest[0]))
        if child is None:
            child = node.children[int(rest[0])] = _Node(rest)
            rest = rest[len(rest) :]
        else:
            n = min(len(child.label), len(rest))
            differ = np.flatnonzero(child.label[:n] != rest[:n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.label):
                upper = _Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[int(child.label[0])] = child
                node.children[int(rest[0])] = child = upper
            rest = rest[same:]
        node = child
    node.members.append(member)


class SetTrie:
    """Sets are ascending arrays of token ranks; ``sizes`` are their full sizes, which count
    tokens left out because no other set has them.

    A probe meets all sets at once. Sets that begin alike share the overlap counted on the
    way to them. A subtree is left as soon as its overlap and what both sides have left
    cannot reach the bound, or when all its members are in the probe's class.
    """

    def __init__(self, members: list[int], sets: list[np.ndarray], sizes: np.ndarray, universe: int):
        root = _Node(np.zeros(0, np.int64))
        for member in members:
            _insert(root, member, sets[member])
        self._flatten(root, sizes)
        self.mask = np.zeros(universe + 1, dtype=np.int64)
        self.universe = universe

    def _flatten(self, root: _Node, sizes: np.ndarray) -> None:
        """Nodes in preorder, so that a subtree is a range of nodes and of members."""
        nodes, parents, ends, first_member, last_member, order = [], [], [], [], [], []
        stack: list[tuple[_Node, int] | int] = [(root, -1)]
        while stack:
            top = stack.pop()
            if isinstance(top, int):  # the subtree of this node is complete
                ends[top], last_member[top] = len(nodes), len(order)
                continue
            node, parent = top
            at = len(nodes)
            nodes.append(node)
            parents.append(parent)
            ends.append(0)
            first_member.append(len(order))
            last_member.append(0)
            order += node.members
            stack.append(at)
            stack += [(child, at) for child in node.children.values()]
        self.parents, self.ends = parents, ends
        self.first_member, self.last_member = np.array(first_member), np.array(last_member)
        self.order = np.array(order, dtype=np.int64)
        self.members = [node.members for node in nodes]
        self.sizes = [int(s) for s in sizes]
        lengths = np.array([len(node.label) for node in nodes])
        self.labels = np.concatenate([node.label for node in nodes])
        # the root's label is empty, all others have a token
        self.starts = np.cumsum(lengths)[:-1] if len(nodes) > 1 else np.zeros(0, np.int64)
        self.last_token = self.labels[np.cumsum(lengths)[1:] - 1]
        below = sizes[self.order] if len(order) else np.zeros(0, np.int64)
        spans = list(zip(first_member, last_member, strict=True))
        self.least = [int(below[a:b].min()) if b > a else 0 for a, b in spans]
        self.most = [int(below[a:b].max()) if b > a else 0 for a, b in spans]
        self.deepest = [0] * len(nodes)  # most tokens a set has below the node
        for at in range(len(nodes) - 1, 0, -1):
            parent = parents[at]
            self.deepest[parent] = max(self.deepest[parent], self.deepest[at] + int(lengths[at]))

    def probe(self, tokens: np.ndarray, size: int, classes: np.ndarray | None = None, own: int = -1):
        """Members whose sets reach the bound. With ``classes`` (a class for each member),
        the class of ``own`` takes in that of each member found, and members already in it
        are left out."""
        self.mask[tokens] = 1
        shared = [0, *np.add.reduceat(self.mask[self.labels], self.starts).tolist()] if len(self.starts) else [0]
        self.mask[tokens] = 0
        left = [len(tokens), *(len(tokens) - np.searchsorted(tokens, self.last_token, side="right")).tolist()]
        alike = self._alike(classes, own)
        found: list[int] = []
        overlaps = [0] * len(self.parents)
        weight, at = NUMERATOR + DENOMINATOR, 0
        while at < len(self.parents):
            overlap = overlaps[at] = shared[at] + (overlaps[self.parents[at]] if at else 0)
            if (
                alike[at]
                or weight * (overlap + min(left[at], self.deepest[at])) < NUMERATOR * (size + self.least[at])
                or DENOMINATOR * self.most[at] < NUMERATOR * size
                or DENOMINATOR * size < NUMERATOR * self.least[at]
            ):
                at = self.ends[at]
                continue
            for member in self.members[at]:
                if weight * overlap >= NUMERATOR * (size + self.sizes[member]):
                    if classes is None:
                        found.append(member)
                    elif classes[member] != classes[own]:
                        found.append(member)
                        classes[classes == classes[member]] = classes[own]
                        alike = self._alike(classes, own)
            at += 1
        return found

    def _alike(self, classes: np.ndarray | None, own: int) -> list[bool]:
        """Of each node, whether all members below are in the class of ``own``."""
        if classes is None:
            return [False] * len(self.parents)
        same = np.concatenate(([0], np.cumsum(classes[self.order] == classes[own])))
        inside = same[self.last_member] - same[self.first_member]
        return (inside == self.last_member - self.first_member).tolist()
