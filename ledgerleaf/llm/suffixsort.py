"""Deep-shallow sorting of byte strings, with the lengths of common prefixes.

Multikey quicksort orders the strings up to a shallow depth, one byte at a time. What is still equal there, strings
with a long common prefix, goes into a blind trie: an inner node holds only the depth at which its strings
part and the bytes there, so an insertion looks at few bytes and compares one string in full.
"""

from __future__ import annotations

SHALLOW = 24


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which ``start`` is known."""
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    return start + len(x) - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


class BlindTrie:
    """Strings by number; -1 stands for the end of a string and sorts before every byte."""

    def __init__(self, strings: list[bytes], depth: int) -> None:
        self.strings, self.depth, self.root = strings, depth, None

    def _byte(self, k: int, depth: int) -> int:
        s = self.strings[k]
        return s[depth] if depth < len(s) else -1

    def add(self, k: int) -> None:
        if self.root is None:
            self.root = [k]  # a leaf: equal strings
            return
        # Blindly down to any leaf, then up to where the string really parts from it.
        node = self.root
        while isinstance(node, tuple):
            children = node[1]
            node = children.get(self._byte(k, node[0])) or next(iter(children.values()))
        s, leaf = self.strings[k], self.strings[node[0]]
        depth = common_prefix(s, leaf, self.depth)
        if depth == len(s) == len(leaf):
            node.append(k)
            return
        parent, edge, node = None, 0, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, edge = node, self._byte(k, node[0])
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._byte(k, depth)] = [k]
            return
        some = node
        while isinstance(some, tuple):
            some = next(iter(some[1].values()))
        new = (depth, {self._byte(some[0], depth): node, self._byte(k, depth): [k]})
        if parent is None:
            self.root = new
        else:
            parent[1][edge] = new

    def ordered(self) -> tuple[list[int], list[int]]:
        """The numbers in order, and for each the common prefix with the one before it (the first: 0)."""
        order: list[int] = []
        shared: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if isinstance(node, tuple):
                edges = sorted(node[1])
                # The first child continues what came before this node; the others part from it here.
                for n in range(len(edges) - 1, -1, -1):
                    stack.append((node[1][edges[n]], before if n == 0 else node[0]))
            else:
                order += node
                shared += [before, *[len(self.strings[node[0]])] * (len(node) - 1)]
        return order, shared


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings, and common prefix of each with the one before it (the first: 0). ``known`` bytes are the
    same in all."""
    order: list[int] = []
    shared: list[int] = []
    # (numbers, depth to which they agree, common prefix with what comes before)
    stack = [(list(range(len(strings))), known, 0)]
    while stack:
        group, depth, before = stack.pop()
        if not group:
            continue
        if len(group) == 1:
            order.append(group[0])
            shared.append(before)
            continue
        if depth >= known + shallow:
            trie = BlindTrie(strings, depth)
            for k in group:
                trie.add(k)
            o, s = trie.ordered()
            order += o
            shared += [before, *s[1:]]
            continue
        keys = [strings[k][depth] if depth < len(strings[k]) else -1 for k in group]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less = [k for k, c in zip(group, keys, strict=True) if c < pivot]
        same = [k for k, c in zip(group, keys, strict=True) if c == pivot]
        more = [k for k, c in zip(group, keys, strict=True) if c > pivot]
        stack.append((more, depth, depth))
        if pivot < 0:
            # All of these end here.
            stack.extend(([k], depth, depth) for k in same[1:])
            stack.append((same[:1], depth, depth if less else before))
        else:
            stack.append((same, depth + 1, depth if less else before))
        stack.append((less, depth, before))
    return order, shared
