"""Adaptive radix tree over byte keys, in memory.

A node has a compressed path (the bytes that all keys below it share), the value of the key that ends
with that path, if there is one, and children by their next byte. The layout that holds the children
grows with their number: sorted bytes for up to 4 and up to 16 of them, a table of 256 places into a
list of up to 48, and a list of 256.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class _Sorted:
    """Children beside their bytes, both in order of the bytes."""

    __slots__ = ("capacity", "bytes", "nodes")

    def __init__(self, capacity: int):
        self.capacity, self.bytes, self.nodes = capacity, bytearray(), []

    def find(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def replace(self, byte: int, node: Node) -> None:
        self.nodes[self.bytes.find(byte)] = node

    def add(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) == self.capacity:
            larger = _Sorted(16) if self.capacity < 16 else _Indexed()
            for old, child in zip(self.bytes, self.nodes):
                larger.add(old, child)
            return larger.add(byte, node)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def ordered(self) -> list[Node]:
        return self.nodes


class _Indexed:
    """Up to 48 children in order of arrival, and their place (from 1 on) by byte."""

    __slots__ = ("places", "nodes")

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def replace(self, byte: int, node: Node) -> None:
        self.nodes[self.places[byte] - 1] = node

    def add(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) == 48:
            larger = _Direct()
            for old, place in enumerate(self.places):
                if place:
                    larger.nodes[old] = self.nodes[place - 1]
            return larger.add(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def ordered(self) -> list[Node]:
        return [self.nodes[place - 1] for place in self.places if place]


class _Direct:
    """A child's place is its byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def replace(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def add(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def ordered(self) -> list[Node]:
        return [node for node in self.nodes if node is not None]


Layout = _Sorted | _Indexed | _Direct


class Node:
    """``path`` follows the byte by which the parent found this node. ``note`` is for the tree's user."""

    __slots__ = ("path", "value", "children", "note")

    def __init__(self, path: bytes, value: Any = None):
        self.path, self.value, self.note = path, value, None
        self.children: Layout | None = None

    def add(self, byte: int, child: Node) -> None:
        self.children = (self.children or _Sorted(4)).add(byte, child)

    def ordered(self) -> list[Node]:
        """Children in order of their bytes."""
        return self.children.ordered() if self.children else []


def _shared(path: bytes, key: bytes, at: int) -> int:
    """Bytes that ``path`` shares with ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(path[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Keys of bytes with a value each. The root's path is empty."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value: Any) -> None:
        """Add a key, or give it another value. Values are not None."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.find(key[at]) if node.children else None
            if child is None:
                node.add(key[at], Node(key[at + 1 :], value))
                return
            n = _shared(child.path, key, at + 1)
            if n < len(child.path):
                upper = Node(child.path[:n])
                upper.add(child.path[n], child)
                child.path = child.path[n + 1 :]
                node.children.replace(key[at], upper)
                child = upper
            node, at = child, at + 1 + n
        node.value = value

    def path_to(self, key: bytes) -> Iterator[Node]:
        """The nodes from the root to a key of the tree."""
        node, at = self.root, 0
        yield node
        while at < len(key):
            node = node.children.find(key[at])
            at += 1 + len(node.path)
            yield node

    def preorder(self) -> Iterator[tuple[Node, int, int]]:
        """(node, bytes of the key at its parent's end, bytes at its own end), parents first; the root's parent ends at -1."""
        todo = [(self.root, -1, 0)]
        while todo:
            node, start, end = todo.pop()
            yield node, start, end
            todo += [(child, end, end + 1 + len(child.path)) for child in reversed(node.ordered())]
