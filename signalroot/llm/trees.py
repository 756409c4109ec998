"""Small decision trees in numpy: one CART grower serves boosting and classification."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    value: float
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, least: float = 1.0, ridge: float = 1.0) -> Node:
    """Tree of second-order gain; with grad = -y and hess = 1 it is plain least squares."""
    node = Node(float(-grad.sum() / (hess.sum() + ridge)))
    if depth == 0 or len(x) < 2:
        return node
    whole = grad.sum() ** 2 / (hess.sum() + ridge)
    best, where = 1e-9, None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        g, h = grad[order].cumsum()[:-1], hess[order].cumsum()[:-1]
        rest_g, rest_h = grad.sum() - g, hess.sum() - h
        gain = g**2 / (h + ridge) + rest_g**2 / (rest_h + ridge) - whole
        gain[(v[1:] <= v[:-1]) | (h < least) | (rest_h < least)] = -np.inf
        if len(gain) and gain.max() > best:
            k = int(gain.argmax())
            best, where = float(gain[k]), (f, float((v[k] + v[k + 1]) / 2))
    if where is None:
        return node
    node.feature, node.at = where
    left = x[:, node.feature] <= node.at
    node.low = grow(x[left], grad[left], hess[left], depth - 1, least, ridge)
    node.high = grow(x[~left], grad[~left], hess[~left], depth - 1, least, ridge)
    return node


def score(node: Node, row) -> float:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.at else node.high
    return node.value


def boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float) -> list[Node]:
    """Gradient boosting of the logistic loss; leaves carry the learning rate."""
    margin, out = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x, p - y, np.maximum(p * (1 - p), 1e-6), depth, least=0.2)
        _scale(tree, rate)
        margin += np.array([score(tree, r) for r in x])
        out.append(tree)
    return out


def _scale(node: Node | None, rate: float) -> None:
    if node:
        node.value *= rate
        _scale(node.low, rate)
        _scale(node.high, rate)


def as_sql(node: Node, names: list[str]) -> str:
    if node.feature < 0:
        return f"CAST({node.value!r} AS DOUBLE)"
    return f"CASE WHEN {names[node.feature]} <= {node.at!r} THEN {as_sql(node.low, names)} ELSE {as_sql(node.high, names)} END"
