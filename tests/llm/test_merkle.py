import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import merkle
from tidewatch.llm.ranked import ranked

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def above(nodes):
    return [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]


def climb(nodes, at, value):
    """(root, siblings of node ``at``, root with ``value`` in its place), level by level over whole lists."""
    siblings = []
    while len(nodes) > 1:
        first = at - at % 3
        siblings += nodes[first:at] + nodes[at + 1:first + 3]
        value = H(*nodes[first:at], value, *nodes[at + 1:first + 3])
        nodes, at = above(nodes), at // 3
    return nodes[0], siblings, value


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        leaf = H(*map(field, r[:5]))
        changed = leaf
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            changed = H(*map(field, (*r[:4], r[4].replace("\n", ""))))
        groups[r[1]].append((r[0], leaf, changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for s in names}
    subroots = [climb([r[1] for r in trees[s]], 0, "")[0] for s in names]
    out = []
    for place, s in enumerate(names):
        leaves = [r[1] for r in trees[s]]
        for at, (key, leaf, changed) in enumerate(trees[s]):
            subroot, below, value = climb(leaves, at, changed)
            root, top, folded = climb(subroots, place, value)
            out.append((key, leaf, subroot, root, H(*below, *top), folded, folded == root))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def query(spark, frame):
    return merkle.manifest(spark, frame, "source", "doc_id", FIELDS, {"text": F.replace("text", F.lit("\n"), F.lit(""))},
                           F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)


def test_manifest_against_whole_lists(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["hot", "hot", "a", "é", "", None]), rnd.choice(["en", None]), i, f"line\n{i}", "x") for i in range(90)]
    rows += [(None, "hot", None, None, "a\nb", "x"), (None, "hot", None, None, None, "x"), (7, "hot", "en", 7, "", "x"),
             (200, "one", "en", 1, "\n" * 5 + "z" * 100000, "x"), (8, "a", "en", 1, "twice", "x"), (8, "a", "en", 1, "twice", "x")]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, leaf string")
    got = [tuple(r) for r in query(spark, frame.repartition(5)).collect()]
    assert order(got) == order(by_hand(rows))
    assert {r[6] for r in got} == {True, False}


def test_many_bands(spark):
    rows = spark.range(3**8 + 5).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars",
                                            "concat('t\n', id) AS text")
    got = [tuple(r) for r in query(spark, rows).collect()]
    trees = [H(*map(field, (i, "s", "en", i, f"t\n{i}"))) for i in range(3**8 + 5)]
    root, siblings, _ = climb(trees, 3**8 + 1, "")
    found = {r[0]: r for r in got}
    assert len(got) == 3**8 + 5 and found[0][3] == found[0][2] == root
    assert found[3**8 + 1][4] == H(*siblings)
    for key in (1, 2186, 2187, 3**8 + 4):
        changed = H(*map(field, (key, "s", "en", key, f"t{key}"))) if zlib.crc32(str(key).encode()) % 2 == 0 else trees[key]
        assert found[key][5] == climb(trees, key, changed)[2]


def test_empty_and_single(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert query(spark, spark.createDataFrame([], schema)).count() == 0
    one = [(5, None, None, None, None)]
    assert order(query(spark, spark.createDataFrame(one, schema)).collect()) == order(by_hand(one))


def test_resumed_states():
    rnd = random.Random(1)
    for n in (1, 2, 3, 4, 9, 10, 26):
        nodes = [H(str(rnd.random())).encode() for _ in range(n)]
        root, kept = merkle.climb(nodes, merkle.levels(n))
        for at in range(n):
            steps, slot = [], at
            for states, rights, _ in kept:
                steps.append((states[slot], rights[slot]))
                slot //= 3
            assert merkle.resume(nodes[at], steps) == root
            want = climb([x.decode() for x in nodes], at, "0" * 64)[2]
            assert merkle.resume(b"0" * 64, steps).decode() == want
    with pytest.raises(ValueError):
        merkle.climb([b"a", b"b"], 0)


def test_places(spark):
    rows = [("a", i % 7, i) for i in range(100)] + [("b", 1, 0), ("c", None, 1), ("c", None, 1)]
    frame = spark.createDataFrame(rows, "k string, o int, _x int").repartition(6)
    got = ranked(spark, frame, "k", [F.col("o").asc_nulls_first(), "_x"]).collect()
    want = {k: sorted((r[1:] for r in rows if r[0] == k), key=repr) for k in "abc"}
    assert sorted(((r.k, r["_pos"], r.o, r["_x"]) for r in got), key=repr) == sorted(
        ((k, i, *v) for k in want for i, v in enumerate(sorted(want[k], key=lambda v: (v[0] is not None, v[0] or 0, v[1])))), key=repr)
    assert all(r["_n"] == len(want[r.k]) for r in got)
