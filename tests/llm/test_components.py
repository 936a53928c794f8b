"""Connected components against a plain union-find."""

from __future__ import annotations

import numpy as np
import pytest

from starforge.llm.components import components


def _plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def _graph():
    r = np.random.default_rng(8)
    out = [(i, i + 1) for i in range(100, 160)]                                     # a path
    out += [(200 + (i * 37) % 61, 200 + ((i + 1) * 37) % 61) for i in range(60)]    # a path in mixed order
    out += [(300, 300 + i) for i in range(1, 200)]                                  # a star under its smallest
    out += [(900, 900 - i) for i in range(1, 200)]                                  # a star over its largest
    out += [(1000 + i, 1000 + (i + 1) % 30) for i in range(30)]                     # a ring
    out += [(2000 + int(a), 2000 + int(b)) for a, b in r.integers(0, 300, (220, 2)) if a != b]
    out += [(3000 + i, 3000 + i // 2) for i in range(1, 120)]                       # a tree
    out += [(4001, 4000), (4000, 4001), (4001, 4000)]                               # repeated and turned round
    return out


@pytest.mark.parametrize("kind", ["long", "binary"])
def test_components_against_union_find(spark, kind):
    edges = _graph()
    as_kind = (lambda x: x) if kind == "long" else (lambda x: x.to_bytes(16, "big"))
    rows = [(as_kind(a), as_kind(b)) for a, b in edges] + [(as_kind(7), as_kind(7)), (None, as_kind(1)), (as_kind(1), None)]
    df = spark.createDataFrame(rows, f"a {kind}, b {kind}")
    got = [(x.node, x.root) for x in components(df).collect()]
    got = [tuple(map(bytes, x)) for x in got] if kind == "binary" else got
    assert len(got) == len(set(got))
    assert dict(got) == {as_kind(x): as_kind(y) for x, y in _plain(edges).items()} and len(got) == len(dict(got))


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(5, 5), (None, 5)], "a long, b long")).count() == 0
