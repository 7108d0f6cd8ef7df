"""An adaptive radix tree over byte strings: node layouts that grow with their children, and compressed paths.

A node keeps up to 4 or 16 children as sorted bytes, up to 48 through a
256-byte index, more in a plain array of 256. Bytes that all keys below a node
share are its prefix. A key that ends where others go on is its node's value.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    __slots__ = ("prefix", "layout", "index", "kids", "value")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.layout, self.index, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            return self.kids[at] if at < len(self.index) and self.index[at] == byte else None
        if self.layout == 48:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def add(self, byte: int, kid: Node) -> None:
        """A child under a byte that has none yet."""
        if self.layout < 256 and len(self.kids) == self.layout:
            self._grow()
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            self.index.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == 48:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        pairs = list(self.children())
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            self.layout, self.index, self.kids = 48, bytearray(256), []
            for byte, kid in pairs:
                self.add(byte, kid)
        else:
            self.layout, self.index, self.kids = 256, None, [None] * 256
            for byte, kid in pairs:
                self.kids[byte] = kid

    def children(self) -> Iterator[tuple[int, Node]]:
        """(byte, child) by byte."""
        if self.layout <= 16:
            yield from zip(self.index, self.kids)
        elif self.layout == 48:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)
        else:
            yield from ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)

    def split(self, at: int) -> None:
        """Cut the prefix before its byte ``at``: what was here hangs below as the one child."""
        lower = Node(self.prefix[at + 1:], self.value)
        lower.layout, lower.index, lower.kids = self.layout, self.index, self.kids
        byte, self.prefix, self.value = self.prefix[at], self.prefix[:at], None
        self.layout, self.index, self.kids = 4, bytearray(), []
        self.add(byte, lower)


def insert(root: Node | None, key: bytes, value) -> tuple[Node, Node]:
    """(root, the node where the key ends); the value is set only where the key is new, else left to the caller."""
    if root is None:
        root = Node(key, value)
        return root, root
    node, at = root, 0
    while True:
        if not key.startswith(node.prefix, at):
            node.split(_common(node.prefix, key, at))
        at += len(node.prefix)
        if at == len(key):
            if node.value is None:
                node.value = value
            return root, node
        kid = node.child(key[at])
        if kid is None:
            kid = Node(key[at + 1:], value)
            node.add(key[at], kid)
            return root, kid
        node, at = kid, at + 1


def _common(prefix: bytes, key: bytes, at: int) -> int:
    """How many bytes of the prefix the key has from ``at`` on."""
    low, high = 0, min(len(prefix), len(key) - at)
    while low < high:                       # the longest equal start, by halving
        middle = (low + high + 1) // 2
        if key.startswith(prefix[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low
