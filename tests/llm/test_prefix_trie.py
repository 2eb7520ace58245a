"""The trie against a plain one in dictionaries, with long, branching and awkward conversations."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from slotcast.llm import prefix_trie as P
from slotcast.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, p1 string"  # extra columns with clashing names
GRAFT = {"base": "conv - conv % 20", "keep": "crc32(CAST(conv AS STRING)) % 4"}


def plain(rows, graft=True):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    convs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4 if graft else 0
        convs[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = {}
    for node, m in members.items():
        below = [x for x in members if x[:len(node)] == node]
        leaf = [x for x in below if not any(y[:-1] == x for y in members if len(y) == len(x) + 1)]
        saved = sum((len(members[x]) - 1) * len(re.findall("[^\x20\x09-\x0D]+", x[-1][1] if x else "")) for x in below)
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        children = sum(len(x) == len(node) + 1 for x in below)
        out[min(m), len(node)] = (min(members[node[:-1]]) if node else None, len(m), children, len(leaf), saved,
                                  hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[c] for c in (
        "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_awkward_rows(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t} {'same' if c < 45 else c % 3}") for c in range(20, 70) for t in range(c % 5)]
    rows += [(None, 0, "user", "lost"), (100, None, None, None), (100, 0, "", ""), (100, 1, "user", "a  b\tc"), (101, None, "user", "late"),
             (103, 5, "user", "x"), (103, 5, "user", "x"), (103, -2, "b", "y z"), (7, 0, "user", "no base"), (7, 1, "user", "second"),
             (7, 2, "user", "third"), (7, 3, "user", "fourth"), (120, 0, "u", "w " * 2000)]
    rows += [(140 + c, t, "user", str(t)) for c in range(40) for t in range(1)]
    turns = P.number_turns(frame(spark, rows))
    assert found(P.trie(P.regraft(turns, **GRAFT))) == plain(rows)
    assert found(P.trie(P.whole(turns), piece=8)) == plain(rows, graft=False)


def test_empty_table(spark):
    empty = P.trie(P.regraft(P.number_turns(frame(spark, [])), **GRAFT))
    assert empty.count() == 0 and "ends_sha256" in empty.columns


def test_long_and_common_conversations(spark, monkeypatch):
    """One conversation has a third of all rows, one beginning a third of all conversations; many rounds, blocks and partitions."""
    monkeypatch.setattr(P, "BLOCK", 16)
    rows = [(1, t, "user", f"long {t}") for t in range(300)] + [(2, t, "user", f"long {t}") for t in range(200)]
    rows += [(c, t, "user", f"common {t}") for c in range(300, 400) for t in range(3)]
    rows += [(c, t, "user", f"{t} {c % 7 if t else 0}") for c in range(500, 560) for t in range(4)]
    turns = P.number_turns(frame(spark, rows))
    want = plain(rows, graft=False)
    for piece in (4, 64, 1 << 14):
        assert found(P.trie(P.whole(turns), piece=piece)) == want, piece


def test_decomposition_of_random_forests():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30, 400):
        for kind in ("random", "path", "star", "forest"):
            parent = np.array([-1] + [int(rng.integers(0, i)) if kind in ("random", "forest") else i - 1 if kind == "path" else 0 for i in range(1, n)])
            if kind == "forest":
                parent[rng.random(n) < 0.2] = -1
            own, component, depth = rng.integers(1, 5, n), np.zeros(n, int), np.zeros(n, int)
            for i in range(n):
                component[i], depth[i] = (component[parent[i]], depth[parent[i]] + 1) if parent[i] >= 0 else (i, rng.integers(0, 3))
            values = rng.integers(0, 9, (n, 2))
            weight, want = own.copy(), values.copy()
            for i in range(n - 1, 0, -1):
                if parent[i] >= 0:
                    weight[parent[i]] += weight[i]
                    want[parent[i]] += want[i]
            shuffled = rng.permutation(n)
            place = np.argsort(shuffled)
            moved = np.where(parent[shuffled] >= 0, place[parent[shuffled]], -1)
            got = P.decompose(component[shuffled], moved, depth[shuffled], weight[shuffled], values[shuffled])
            assert (got == want[shuffled]).all(), (n, kind)


def test_runs_of_ends_are_joined_in_order(spark):
    rows = [(c, 0, "user", "only") for c in [5, 300, 255, 256, 700, 70_000, -3, -300, 9]]
    turns = P.whole(P.number_turns(frame(spark, rows)))
    assert found(P.trie(turns)) == plain(rows, graft=False)


@pytest.mark.parametrize("d", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, d):
    import compare

    con = compare.connect(f"/root/testdata/{d}")
    got = QUERIES["op13_prefix_trie"](spark, f"/root/testdata/{d}").toPandas()
    assert compare.differences(got, con.execute(ORACLES["op13_prefix_trie"]).df()) is None
