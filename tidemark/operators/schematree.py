"""Edit distance between nested schemas, and the scripts it yields.

A schema is a tree of named, typed fields whose order means nothing. The distance between two trees is the least cost of
deletions, insertions, renames, retypings and moves that turn one into the other. All children of matched nodes are matched with each other by minimum-cost assignment, so
a script is optimal among those that keep parents matched to parents; a deleted subtree that comes back unchanged under another
parent is then a move. Fields of one name may be matched whatever their values, fields of two names only with evidence: a pair of paths whose values are known to be equal. A renaming may retype as well, and costs both.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from difflib import SequenceMatcher

DELETE = INSERT = MOVE = 1.0
RENAME, RETYPE = 0.4, 0.5
NEVER = 1e9


@dataclass(frozen=True)
class Node:
    name: str
    type: str
    children: tuple[Node, ...] = field(default=())

    @property
    def size(self) -> int:
        return 1 + sum(c.size for c in self.children)


@dataclass(frozen=True)
class Edit:
    kind: str
    path: str
    old_path: str | None = None
    old_type: str | None = None
    new_type: str | None = None


def _node(name: str, kind) -> Node:
    if isinstance(kind, dict):
        inner = kind.get("fields") or ([{"name": "element", "type": kind["elementType"]}] if "elementType" in kind else [])
        return Node(name, str(kind.get("type", "struct")), _children(inner))
    return Node(name, str(kind))


def _children(fields: Iterable[dict]) -> tuple[Node, ...]:
    found = {str(f["name"]): _node(str(f["name"]), f.get("type")) for f in fields}
    return tuple(found[n] for n in sorted(found))


def parse(text: str | None) -> Node | None:
    """The root of a schema given as a JSON list of {name, type} or as {"fields": [...]}; None if it can't be read."""
    try:
        raw = json.loads(text) if text is not None else None
        raw = raw.get("fields") if isinstance(raw, dict) else raw
        return None if raw is None else Node("", "struct", _children(raw))
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


def assign(cost: list[list[float]]) -> list[int]:
    """For each row of a square matrix the column of a minimum-cost assignment (shortest augmenting paths with potentials)."""
    n = len(cost)
    row_pot, col_pot = [0.0] * n, [0.0] * n
    owner = [-1] * n
    for start in range(n):
        slack, came, done = [float("inf")] * n, [-1] * n, [False] * n
        row, col = start, -1
        while True:
            for j in range(n):
                if not done[j] and (gap := cost[row][j] - row_pot[row] - col_pot[j]) < slack[j]:
                    slack[j], came[j] = gap, col
            nxt = min((j for j in range(n) if not done[j]), key=slack.__getitem__)
            step = slack[nxt]
            row_pot[start] += step
            for j in range(n):
                if done[j]:
                    row_pot[owner[j]] += step
                    col_pot[j] -= step
                else:
                    slack[j] -= step
            done[nxt], col = True, nxt
            if owner[nxt] < 0:
                break
            row = owner[nxt]
        while col >= 0:
            prev = came[col]
            owner[col] = owner[prev] if prev >= 0 else start
            col = prev
    out = [0] * n
    for j, i in enumerate(owner):
        out[i] = j
    return out


def script(old: Node, new: Node, equal: frozenset[tuple[str, str]] = frozenset()) -> tuple[float, list[Edit]]:
    """Least cost and edits. ``equal``: pairs (old path, new path) whose values are known to be equal."""
    cost, edits = _match(old, new, "", "", equal)
    return _moves(cost, edits, old, new)


def _path(base: str, name: str) -> str:
    return f"{base}.{name}" if base else name


def _cost(a: Node, b: Node, at_old: str, at_new: str, equal: frozenset[tuple[str, str]]) -> float:
    """What matching two fields costs, with all below them; NEVER where they may not be matched."""
    if a.name != b.name and (_path(at_old, a.name), _path(at_new, b.name)) not in equal:
        return NEVER
    below = _match(a, b, _path(at_old, a.name), _path(at_new, b.name), equal)[0] if a.children or b.children else 0.0
    return (a.name != b.name) * RENAME + (a.type != b.type) * RETYPE + below


def _match(old: Node, new: Node, at_old: str, at_new: str, equal: frozenset[tuple[str, str]]) -> tuple[float, list[Edit]]:
    """Least cost and edits of the children of two matched nodes."""
    news = {c.name: c for c in new.children}
    # fields that are alike on both sides, and in no evidence, can only be matched with themselves
    told = {x for pair in equal for x in pair}
    settled = {c.name for c in old.children if news.get(c.name) == c and not {_path(at_old, c.name), _path(at_new, c.name)} & told}
    gone, fresh = [c for c in old.children if c.name not in settled], [c for c in new.children if c.name not in settled]
    n, total, edits = len(gone) + len(fresh), 0.0, []
    pairs = []
    if gone and fresh:
        # a name likeness far under any cost decides between matches of one cost
        near = lambda a, b: (1 - SequenceMatcher(None, a.name, b.name).ratio()) * 1e-6
        matrix = [[0.0] * n for _ in range(n)]
        for i in range(n):
            for j in range(n):
                if i < len(gone) and j < len(fresh):
                    cost = _cost(gone[i], fresh[j], at_old, at_new, equal)
                    matrix[i][j] = cost + near(gone[i], fresh[j]) if cost < NEVER else NEVER
                elif i < len(gone):
                    matrix[i][j] = DELETE * gone[i].size
                elif j < len(fresh):
                    matrix[i][j] = INSERT * fresh[j].size
        chosen = assign(matrix)
        pairs = [(gone[i], fresh[chosen[i]]) for i in range(len(gone)) if chosen[i] < len(fresh) and matrix[i][chosen[i]] < NEVER]
    for a, b in sorted(pairs, key=lambda p: p[0].name):
        before, after = _path(at_old, a.name), _path(at_new, b.name)
        total += (a.name != b.name) * RENAME + (a.type != b.type) * RETYPE
        if a.name != b.name or a.type != b.type:
            edits.append(Edit("renamed" if a.name != b.name else "retyped", after, before, a.type, b.type))
        cost, inner = _match(a, b, before, after, equal)
        total, edits = total + cost, [*edits, *inner]
    for c in gone:
        if all(c is not a for a, _ in pairs):
            total += DELETE * c.size
            edits.append(Edit("removed", _path(at_old, c.name), _path(at_old, c.name), c.type, None))
    for c in fresh:
        if all(c is not b for _, b in pairs):
            total += INSERT * c.size
            edits.append(Edit("added", _path(at_new, c.name), None, None, c.type))
    return total, edits


def leaves(node: Node, at: str = "") -> dict[str, str]:
    """The paths that hold values, with their types: fields without children, and arrays as wholes."""
    out: dict[str, str] = {}
    for c in node.children:
        path = _path(at, c.name)
        out |= leaves(c, path) if c.children and c.type == "struct" else {path: c.type}
    return out


def renamings(old: Node, new: Node) -> tuple[list[str], list[str]]:
    """Paths that are only in the old, and only in the new tree, below parents that both have."""
    a, b = {c.name: c for c in old.children}, {c.name: c for c in new.children}
    gone, fresh = sorted(a.keys() - b.keys()), sorted(b.keys() - a.keys())
    for name in sorted(a.keys() & b.keys()):
        if a[name].type == b[name].type == "struct":
            inner = renamings(a[name], b[name])
            gone, fresh = gone + [_path(name, x) for x in inner[0]], fresh + [_path(name, x) for x in inner[1]]
    return gone, fresh


def _find(root: Node | None, path: str) -> Node | None:
    """The node at a path; None where a name holds a dot and so has no such path."""
    for name in path.split("."):
        root = next((c for c in root.children if c.name == name), None) if root else None
    return root


def _moves(cost: float, edits: list[Edit], old: Node, new: Node) -> tuple[float, list[Edit]]:
    """A removed and an added subtree that are alike but for their place become one move."""
    out, removed = [e for e in edits if e.kind != "removed"], [e for e in edits if e.kind == "removed"]
    for e in removed:
        node = _find(old, e.path)
        twin = next((x for x in out if node and x.kind == "added" and x.path != e.path and _find(new, x.path) == node), None)
        if twin is None:
            out.append(e)
        else:
            out[out.index(twin)] = Edit("moved", twin.path, e.path, node.type, node.type)
            cost += MOVE - (DELETE + INSERT) * node.size
    return cost, out
