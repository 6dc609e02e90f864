import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, language_id, lattice_lm, ngram_join, toxicity
from tidewatch.llm.common import fold
from tidewatch.llm.piece_codec import PieceModel

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def components_by_hand(rows, width, percent):
    sets, parent = {}, {}
    for doc, text in rows:
        words = text.encode().lower().split() if text else []
        n = min(width, len(words))
        sets[doc] = frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()
        parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for doc in sets:
        for s in sets[doc]:
            lists[s].append(doc)
    for doc, own in sets.items():
        for other, shared in Counter(o for s in own for o in lists[s] if o < doc).items():
            if 100 * shared >= percent * (len(own) + len(sets[other]) - shared):
                a, b = find(doc), find(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_join_against_all_pairs(spark, texts, width, percent):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = list(enumerate(texts[:40]))
    for group in range(12):  # chains of ever more distant copies, and passages that many share
        base = [rnd.choice(words) for _ in range(rnd.choice([5, 30, 200]))]
        for _ in range(12):
            base = [rnd.choice(words) if rnd.random() < 0.01 else w for w in base]
            rows.append((1000 + len(rows), " ".join(base)))
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows += [(3000 + i, " ".join(rnd.choice(words) for _ in range(8)) + " " + passage) for i in range(60)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(spark, frame, width, percent).collect()}
    assert got == components_by_hand(rows, width, percent)


def test_join_by_blocks_of_a_list(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rnd = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(60):  # copies about as far apart as the similarity allows
        words = [rnd.choice(passage[:4]) if rnd.random() < 0.04 else w for w in passage]
        rows.append((i * 7 % 60, " ".join(words)))
    got = ngram_join.link(spark, spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == components_by_hand(rows, 4, 85)


def test_join_writes_no_pairs_that_classes_tell_apart(spark, monkeypatch):
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))  # so much of each text that all meet on its shingles
    rows = [(i, passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(8))) for i in range(150)]
    written, save = [], ngram_join.save

    def counted(spark, frame, label):
        out = save(spark, frame, label)
        if label == "pairs":
            written.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "save", counted)
    got = ngram_join.link(spark, spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == components_by_hand(rows, 4, 85)
    assert written[-1] <= len(rows)


def test_join_edge_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text), (5, text), (None, text), (None, "only a null id here of course"), (9, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(ngram_join.link(spark, frame).collect(), key=str)
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 3, 0), (0, 4, 5), (5, 4, 5), (5, 4, 5), (8, 0, 8), (9, 0, 9)]
    assert ngram_join.link(spark, frame.limit(0)).count() == 0


def test_join_of_unlike_texts_with_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (2, a + " word"), (3, b + " word"), (4, c), (4, ""), (4, ""), (9, c), (None, b), (6, a), (7, "else"), (7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.link(spark, frame, width=4, percent=85).collect()
    assert sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in got)) == sorted([
        (5, 57, 2), (5, 57, 2), (2, 58, 2), (3, 58, 2), (4, 57, 4), (4, 0, 4), (4, 0, 4), (9, 57, 4), (0, 57, 2), (6, 57, 2),
        (7, 1, 7), (7, 0, 7)])


def test_divide_skip_keeps_what_reaches_the_overlap():
    query = np.arange(0, 100, dtype=np.uint64)
    near, far = np.arange(5, 105, dtype=np.uint64), np.arange(50, 150, dtype=np.uint64)
    assert ngram_join.divide_skip(query, {60: [0, 1], 61: [0, 1]}, [near, far], 85) == [0]


def test_contamination(spark):
    items = [(1, "Yesterday Anna bought 12 apples for 3 dollars and gave Bob 12 of the apples. How many apples has she?"),
             (2, "the quick brown fox jumps over the lazy dog while it rains outside today"), (3, "tiny item of five words"),
             (4, None), (5, ""), (2, "the quick brown fox jumps over the lazy dog while it rains outside today"), (None, "x y z a b c d e f g")]
    docs = [(10, "so Yesterday Clara bought 17 apples for 5 euros and gave Dan 17 of the apples. How many apples has she? end"),
            (11, "Yesterday Clara bought 17 apples for 5 euros and gave Dan 18 of the apples. How many apples has she?"),
            (12, "THE QUICK!! brown$$$ fox, jumps over the LAZY dog"), (13, None), (14, ""), (15, "a tiny item of five words"),
            (16, "nothing to see here at all in this clean text"), (12, "THE QUICK!! brown$$$ fox, jumps over the LAZY dog"),
            (None, "tiny item of five words"), (17, "the quick brown fox jumps " * 4000 + "over the lazy dog while it rains")]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, hash int")
    want = {(10, 1, "reparameterised"), (12, 2, "verbatim"), (15, 3, "verbatim"), (17, 2, "verbatim")}
    for most in (1000, 1):
        got = decontaminate.contaminated(d, b, max_sent=most).collect()
        assert {(r.doc_id, r.item_id, r.kind) for r in got} == want and len(got) == len(want)
    assert decontaminate.contaminated(d.limit(0), b).count() == 0
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_contamination_against_a_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")

    def cores(text):
        import re
        found = (re.search(r"\w(?:.*\w)?", w, re.S) for w in (text or "").split())
        return [m[0].lower() for m in found if m]

    windows = {tuple(w[i:i + 8]): None for r in items.collect() for w in [cores(r.text)] for i in range(len(w) - 7)}
    want = {r.doc_id for r in docs.collect() for w in [cores(r.text)] if any(tuple(w[i:i + 8]) in windows for i in range(len(w) - 7))}
    got = {r.doc_id for r in decontaminate.contaminated(docs, items).where("kind = 'verbatim'").collect()}
    assert got == want and want


def test_workers_remember_few_words():
    text = " ".join(f"word{i}" for i in range(60_000))
    shingler, known = ngram_join.Shingler(5), {}
    assert len(shingler(text)) == 59_996 and len(shingler.codes) <= 32_768
    toxicity.cut(text, known)
    assert len(known) <= 16_384


def test_windows_are_made_only_where_the_benchmark_has_the_words():
    rng = random.Random(3)
    some = ["apples", "Then", "gave", "Bob", "Anna", "12", "7", "km", "euros", "of", "the", "to.", "and,", "New", "York"]
    items = [" ".join(rng.choices(some, k=40)) for _ in range(40)]
    texts = ["", *(" ".join(rng.choices(some, k=30)) for _ in range(60)), *(x.replace("gave", "lent") for x in items), "", "no such words " * 20000,
             *(" ".join([*rng.choices(["other", "Mary", "stone"], k=9), items[i][rng.randrange(80):]]) for i in range(40)), *items, " "]
    known = decontaminate.Words()
    made, codes = [], []
    for _, _, words in decontaminate.read(known, items):
        made += [w[3] for w in decontaminate.text_windows(words, None, None)]
        codes.append(words[2])
    sent = decontaminate.sifted(np.unique(np.array(made, dtype=np.int64).view(np.uint64)))
    lengths, all_words, few_words = [4, 8], decontaminate.Words(), decontaminate.Words(np.unique(np.concatenate(codes)))
    want = sorted((i, *w) for i, _, t in decontaminate.read(all_words, texts) for w in decontaminate.text_windows(t, lengths, sent))
    runs = list(decontaminate.read(few_words, texts, 4))
    assert sorted(decontaminate.run_windows(runs, lengths, sent)) == want and want
    assert sum(len(t[0]) for _, _, t in runs) < 10000


def _kinds(spark, item, *texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.contaminated(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    return {r.doc_id: r.kind for r in got}


def test_contamination_verbatim_beside_an_altered_slot(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    words[5] = "12"
    quoted = [*words[:5], "13", *words[6:20]]
    twice = [*words[:30], "12", *words[31:]]
    assert _kinds(spark, " ".join(words), " ".join(quoted)) == {0: "verbatim"}
    assert _kinds(spark, " ".join(twice), " ".join([*twice[:30], "13", *twice[31:]])) == {0: "verbatim"}


def test_contamination_names_at_sentence_starts(spark):
    item = "Tom has 5 apples. Tom buys 3 more apples. How many apples does Tom have now?"
    assert _kinds(
        spark, item, "Anna has 7 apples. Anna buys 4 more apples. How many apples does Anna have now?",
        "Anna has 7 apples. Clara buys 4 more apples. How many apples does Anna have now?") == {0: "reparameterised"}


def test_contamination_of_number_runs(spark):
    assert _kinds(spark, "Compute 12 34 56 78 90", "so: compute 12 34 56 78 90 now", "compute 12 34 56 78 91") == {0: "verbatim"}


def test_contamination_by_values_of_another_length(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    a, b = " ".join(words[:14]), " ".join(words[15:])
    a, b = a.replace("wac", "5"), b.replace("wba", "8")  # every literal window of eight but few holds an altered value
    a, b = a.replace("wai", "6"), b.replace("wbc", "9")

    def text(place, more=0):
        for old in "5689":
            place = place.replace(f" {old} ", f" {int(old) + more} ")
        return place

    item = f"{a} New York {b}"
    assert _kinds(spark, item, text(f"{a} Paris {b}", 10)).get(0)
    short = "they drove from New York to the coast with 3 dogs and then came home by train"
    assert _kinds(spark, short, "they drove from Paris to the coast with 4 dogs and then came home by train") == {0: "reparameterised"}
    short = "they paid 25 for the old boat with 3 sails and then went home by train"
    assert _kinds(spark, short, "they paid twenty six for the old boat with 4 sails and then went home by train") == {0: "reparameterised"}


def test_lattice_against_enumeration():
    pieces = lattice_lm.Pieces.from_model(PieceModel(open(PIECES, "rb").read()))
    lattice, weight = lattice_lm.Lattice(pieces), dict(zip(pieces.texts, pieces.weights))

    def by_hand(word):
        text = "▁" + word
        ways = [1.0] + [0.0] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                part = text[start:end]
                log = weight.get(part)
                if log is None and end == start + 1:
                    log = len(part.encode()) * math.log(lattice_lm.BYTE_MASS / 256)
                ways[end] += ways[start] * math.exp(log) if log is not None else 0.0
        return math.log(ways[-1])

    words = ["the", "thntblere", "é", "😀x", "a", "日本", "x" * 50]
    assert np.allclose(lattice.marginals(words), [by_hand(w) for w in words])
    # expected counts spell every word once
    spelled = sum(n * len(pieces.texts[i]) for i, n in enumerate(lattice.expected(["hello", "the"])))
    assert spelled == pytest.approx(len("▁hello▁the"))
    assert np.exp(pieces.weights).sum() == pytest.approx(1 - lattice_lm.BYTE_MASS)


def test_scores(spark, documents, texts):
    got = {r.doc_id: r for r in lattice_lm.score(spark, documents, PIECES, fold("doc_id", 7) != 2).collect()}
    assert len(got) == len(texts) + 1
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    seen, distinct = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (seen + distinct + 1)) for w in ws)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (
            held[i], len(ws), sum(counts[w] > 0 for w in ws), seen)
        assert row.base_score == pytest.approx(base) and row.score < 0 and math.isfinite(row.score)
    none = lattice_lm.score(spark, documents.limit(0), PIECES, F.lit(True))
    assert none.count() == 0
    assert lattice_lm.score(spark, documents.limit(3), PIECES, F.lit(False)).where("base_score = 0").count() == 3


def test_language(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("score")
    model = language_id.fit(rows, fold("doc_id", 4) != 2)
    judged = language_id.predict(rows, model).where(fold("doc_id", 4) == 2)
    right, accepted, total = judged.agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("accepted").cast("int")), F.count("*")).first()
    assert right >= 0.97 * total and accepted >= 0.97 * total
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "123 !!", 5), (4, "the and of", 5)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values()) and not got[1].accepted
    nothing = language_id.fit(rows.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_toxicity(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    def sentence():
        return " ".join(rnd.choice(words) for _ in range(8))
    rows, labels = [], []
    for i in range(600):
        parts = [sentence() for _ in range(rnd.randint(1, 8))]
        bad = i % 4 == 0
        if bad:
            k = rnd.randrange(len(parts))
            parts[k] = f"w1 Vile{rnd.choice(['', 'ness', 'st'])} w2"
        rows.append((i, ". ".join(parts) + ".", 1))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    tags = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, tags, fold("doc_id", 4) != 2)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i].predicted == bad for i, bad in labels) >= 0.98 * len(labels)
    for i, bad in labels:
        if bad and got[i].predicted:
            spans = [rows[i][1].encode()[o.begin:o.end].decode() for o in got[i].offending]
            assert any("Vile" in s for s in spans)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "VILE! " * 5000), (5, "İ vile")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert scores[1] == scores[2] == scores[3] == 0 and scores[4] > 0.3 and all(0 <= s <= 1 for s in scores.values())
    assert {r.score for r in toxicity.score(odd, toxicity.fit(docs, tags.limit(0), F.lit(True))).collect()} == {0.0}
