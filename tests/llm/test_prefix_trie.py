import hashlib
import math
import random
import zlib
from collections import defaultdict

from tidewatch.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string"


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def by_hand(conversations):
    """Every prefix as a whole tuple, subtrees by walking down."""
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children[node]]
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        totals[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return [(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), *totals[n],
             hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()]


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(7)


def test_rebuilt_conversations(spark):
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "é", "", None]))
            for c in range(-12, 60) if c % 7 for t in range(rnd.randint(1, 12))]
    rows += [(None, 0, "user", "lost"), (61, None, "user", "first"), (61, 0, "user", "b"), (61, 0, "user", "b"),
             (61, 0, "system", "a"), (65, 3, "user", "x" * 200000), (2**40, 1, "user", "alone")]
    want = by_hand(rebuilt_by_hand(rows))
    assert order(prefix_trie.rebuilt_trie(spark, frame(spark, rows)).collect()) == order(want)
    # the smallest member and the depth name a node
    assert len({r[:2] for r in want}) == len(want)


def test_deep_and_shared(spark):
    """Bands of bands: long conversations that part late, many equal ones, and running sums over several chunks."""
    long = [("user", f"t{i}") for i in range(1100)]
    conversations = {1: long, 2: long[:1060] + [("user", "other")] * 9, 3: long[:64], 4: long[:65], 5: [], 6: long[:1],
                     **{c: long[:9] for c in range(100, 400)}}
    turns = [(c, d + 1, *t) for c, ts in conversations.items() for d, t in enumerate(ts)]
    rows = spark.createDataFrame(turns, "conv_id long, depth long, role string, text string").selectExpr(
        "conv_id", "depth", "unhex(sha2(concat(role, ':', text), 256)) AS content", "CAST(octet_length(text) AS BIGINT) AS n_bytes")
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    assert order(prefix_trie.trie(spark, rows, ids).collect()) == order(by_hand(conversations))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.rebuilt_trie(spark, empty).count() == 0
    alone = spark.createDataFrame([(None, 1, "user", "x", 1, "x")], SCHEMA)
    assert prefix_trie.rebuilt_trie(spark, alone).count() == 0
