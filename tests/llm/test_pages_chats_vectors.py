import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import chat_format, queries, topk_search, url_filter

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("allow", "", ""), ("block", "a.net", "/e"), ("allow", "a.net", "/e"), ("block", "com", "/x/y"),
]
URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/1?x#y", "http://www.example.com/en/", "http://m.www.example.com/en/a",
    "http://xexample.com/en/", "https://a.net/es/", "https://a.net/e", "https://b.a.net/else", "http://com", "http://com/",
    "http://com/x/yz", "http://com/x/y/z", "ftp://q.org/a?b=://c/d", "http://É.com/en/", "http://a.net/es/\nb", "http://com/", None,
]


def brute(url):
    rest = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for mark in "?#":
            rest = rest.split(mark)[0]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fits = [(len(h) + len(p), len(h), a == "block", h + p, a) for a, h, p in RULES
            if (host == h or host.endswith("." + h) or not h) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


@pytest.mark.parametrize("most", [1000, 2])
def test_url_rules(spark, most):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    got = {r[0]: tuple(r[1:]) for r in url_filter.judge_urls(pages, rules, max_trie_rules=most).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert url_filter.judge_urls(pages.limit(0), rules, max_trie_rules=most).count() == 0


@pytest.mark.parametrize("most", [1000, 2])
def test_url_with_nul_and_rules_with_nulls(spark, most):
    pages = spark.createDataFrame([(1, "http://a\0b.com/x\0y"), (2, "http://q.org/")], "page_id long, url string")
    rules = spark.createDataFrame(
        [("block", "com", "/x\0"), ("block", None, "/"), ("block", "org", None), (None, "org", "/")],
        "action string, host string, path string")
    got = sorted(tuple(r) for r in url_filter.judge_urls(pages, rules, max_trie_rules=most).collect())
    assert got == [(1, "a\0b.com", "/x\0y", "com/x\0", "block"), (2, "q.org", "/", None, "allow")]


def test_url_trie_against_all_rules(spark):
    rnd = random.Random(1)
    host = lambda: ".".join(rnd.choice("abc") for _ in range(rnd.randint(1, 3)))
    path = lambda: "".join(rnd.choice(["/", "p", "q"]) for _ in range(rnd.randint(0, 5)))
    rules = list({(rnd.choice(["allow", "block"]), host(), "/" + path()) for _ in range(60)})
    trie = url_filter.UrlTrie(rules)
    for _ in range(500):
        h, p = host(), "/" + path()
        fits = [(len(a) + len(b), len(a), v == "block", a + b, v) for v, a, b in rules
                if (h == a or h.endswith("." + a)) and p.startswith(b)]
        assert trie.match(h, p) == (max(fits)[3:] if fits else None)


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, prompt string"
    turns = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], schema)
    chosen = turns([(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 1, None, None), (2, 0, "user", "u"),
                    (3, 0, "user", "same"), (None, 0, "user", "lost"), (4, 0, "assistant", ""), (4, 0, "assistant", "")])
    rejected = turns([(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"), (2, 0, "user", "u"),
                      (2, 1, None, None), (3, 0, "user", "same"), (5, 0, "user", "alone"), (4, 0, "assistant", "")])
    got = {r.pair_id: r for r in chat_format.format_preferences(chosen, rejected).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert got[1].n_prompt_turns == 1 and got[1].prompt == "<|im_start|>user\nq<|im_end|>\n"
    assert [(s.text, s.train) for s in got[1].chosen] == [
        ("<|im_start|>assistant\n", False), ("good<|im_end|>", True), ("\n", False)]
    assert "".join(s.text for s in got[1].rejected).endswith("why<|im_end|>\n")
    assert [s.train for s in got[1].rejected] == [False, True, False, False, False, False]
    assert got[2].n_prompt_turns == 2 and not got[2].chosen and not got[2].rejected
    assert got[3].n_prompt_turns == 1
    assert got[4].n_prompt_turns == 1 and len(got[4].chosen) == 3 and not got[4].rejected
    assert got[5].prompt == "" and not got[5].chosen and len(got[5].rejected) == 3
    plan = chat_format.format_preferences(chosen, rejected)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat_format.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


def test_exchanged_answers_that_tie(spark, tmp_path):
    """All answers of the last turn are exchanged, those without a turn are not."""
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"),
            (3, 0, "user", "q"), (3, 1, "assistant", "c"), (3, 1, "assistant", None), (4, None, "assistant", "x"),
            (5, 0, "user", "y")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r.pair_id: r for r in queries.op2_chat_formatting(spark, str(tmp_path)).collect()}
    turn = "<|im_start|>assistant\n{}<|im_end|>\n".format
    assert got[2].chosen == turn("a") + turn("b") + turn("b") and got[2].rejected == turn("") + turn("c")
    assert got[3].chosen == turn("") + turn("c") and got[3].rejected == turn("a") + turn("b") + turn("b")
    assert got[4].rejected == "" and got[5].rejected == ""
    duckdb = pytest.importorskip("duckdb").connect()
    duckdb.execute("SET default_null_order = 'nulls_first'")  # as Spark orders a null among tied turns
    duckdb.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = duckdb.execute(queries.ORACLES["op2_chat_formatting"])
    names = [c[0] for c in want.description]
    assert {r[names.index("pair_id")]: r for r in want.fetchall()} == {
        p: tuple(r[n] for n in names) for p, r in got.items()}


def test_top_k_against_all_pairs(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([0.0, 0.5, -0.25, rnd.random()]) for _ in range(rnd.choice([3, 4]))]) for i in range(300)]
    rows += [(300, None), (301, [math.nan, 1.0]), (302, [None, 1.0]), (303, []), (304, [math.inf]), (None, [1.0]),
             (7, [9.0, 9.0]), (310, [1.0]), (310, [2.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(5)
    got = topk_search.top_k(frame, F.col("vec_id") % 10 == 0, k=5).collect()
    usable = [(i, [math.floor(256 * float(F32(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asking = {}
    for i, v in usable:
        if i % 10 == 0:
            asking[i] = max(asking.get(i, v), v)
    want = []
    for q, v in asking.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk_search.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def F32(x):
    import numpy as np
    return np.float32(x)
