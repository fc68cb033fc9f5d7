import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tillstar.llm import conversation_trie
from tillstar.llm.conversation_trie import contract, ordered_turns, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, size int, n int, digest string"


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """A dictionary of prefixes."""
    own = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            own[c].append((n is not None, n or 0, digest((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        full = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        ends[full].append(c)
        for d in range(len(full) + 1):
            members[full[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    out = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below = [out[c] for c in children[p]]
        out[p] = (members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(below),
                  sum(b[5] for b in below) or 1, saved + sum(b[6] for b in below), hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
    return sorted(out.values(), key=str)


def measured(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, prefix_trie(*rebuilt(ordered_turns(df)), **options).collect()), key=str)


def random_rows(seed, convs, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for t in range(rng.randint(0, 14)):
            rows.append((c, None if rng.random() < 0.1 else rng.randint(0, 9), rng.choice(["user", "assistant", None, ""]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("seed, block_nodes, chunk", [(1, 1, 4096), (2, 7, 3), (3, 200_000, 1)])
def test_equals_dictionary_of_prefixes(spark, monkeypatch, seed, block_nodes, chunk):
    monkeypatch.setattr(conversation_trie, "CHUNK", chunk)
    rows = random_rows(seed, 40, ["", None, "a", "é", "字字"])
    assert measured(spark, rows, block_nodes=block_nodes) == brute(rows)


def test_shapes(spark):
    chain = [(5, i, "user", f"t{i % 3}") for i in range(300)]  # one very long conversation
    copies = [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]
    star = [(c, 0, "user", f"first {c}") for c in range(200, 260)]
    lone = [(None, 1, "user", "no id"), (401, 0, "user", "base is absent"), (7, None, None, None), (7, None, None, None)]
    rows = chain + copies + star + lone
    assert measured(spark, rows, block_nodes=50) == brute(rows)


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(c, 0, r, t) for c, (r, t) in enumerate([("user", "a"), ("use", "ra"), ("", "usera"), (None, "usera"), ("u", ":a"), ("1:", "a")])]
    assert measured(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert measured(spark, []) == []
    assert measured(spark, [(None, 1, "user", "x")]) == []


def test_contract_sums_to_the_end_of_the_stretch():
    # root (0,0) with children (0,1) and (3,1) in one block; (9,1) lies elsewhere.
    sums, conv, step, head = contract(*(np.array(c, np.int64) for c in (
        [0, 0, 3], [0, 1, 1], [-1, 0, 0], [0, -1, -1], [-1, 3, 9], [0, 1, 1], [0, 10, 20])))
    assert sums.tolist() == [[5, 1, 4, 3, 2, 1], [2, 0, 2, 1, 1, 0], [30, 0, 30, 20, 20, 0]]
    assert conv.tolist()[0] == 9 and step.tolist()[0] == 2  # on into the child elsewhere
    assert step.tolist()[1] == -1  # out of the root: the end
    assert head.tolist() == [True, True, False, False, False, False]
