"""Benchmark decontamination with template windows.

Words are canonicalised: numbers, names and units become typed placeholders, other words their lower-cased core.
Windows of ``width`` template words of the benchmark are hash-joined with those of all documents, so a question whose
numbers or names were exchanged still meets its original.  The slots of the joined windows are then checked: along one
alignment, equal values of the benchmark must have equal values in the document and different ones different values.

Each text is read in several views.  The literal view has no slots.  The template view has names within a sentence,
numbers and units as slots; once more with names as words, since a name written in another case is still the same; and
once more with capitalised words that start a sentence as names, where the slot check decides.  A value may have another
number of words, so each of these is also read with runs of equal slots as one.  Windows with slots need as many plain
words as slots.

A literal window is a verbatim hit if no slot of its alignment differs, or if it holds a value itself (a number, unit or
name); of windows without a value beside differing slots it takes two, that is one word more than a window, since a
question with other values shares its wording too.  Re-parameterised hits count from half of an item's windows, on an
alignment together with those up to ``SHIFT`` words away, as far as the slots agree.
Items shorter than a window are one window of their own length, with at least ``SHORTEST`` words.

A window that matches has no plain word that the benchmark lacks.  So while the benchmark's words are sent to the workers,
windows are made only within runs of words that occur there or can be slots.

Edge cases: null and empty texts and null ids have no windows; repeated rows add no further pairs; other columns
are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

WIDTH, SHORTEST = 8, 4
#: windows of the benchmark that are sent to the workers to drop what can't match before the join (50 MB); beyond
#: this many the documents' windows all go to the join
MAX_SENT_WINDOWS = 2_000_000
#: remembered words in a worker, some 150 bytes each; the table starts anew when it is full
MEMO = 500_000
#: characters of the texts that are read together, beside those of the last one
READ_TOGETHER = 1 << 21
#: number words and units (fixed values)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half "
    "dozen".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes ounce ounces pound pounds ml "
    "l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars euro euros cent cents percent degree degrees celsius fahrenheit kelvin watt watts "
    "kw volt volts joule joules newton newtons hertz hz kmh mph".split())
NUMBER, UNIT, NAME = "\x01number", "\x01unit", "\x01name"
#: views of a text as bits; VALUED marks literal windows that hold a value
LITERAL, TEMPLATE, STARTS, RUNS, RUN_STARTS, VALUED = 1, 2, 4, 8, 16, 32
#: views whose windows are counted together
READINGS = (TEMPLATE, TEMPLATE | STARTS, RUNS, RUNS | RUN_STARTS)
#: alignments so many words apart can belong to one passage
SHIFT = 16
_CORE = re.compile(r"\w(?:.*\w)?", re.S)
_WINDOW = "length int, pos int, stop int, hash long, types string, slots array<string>, views int"


class Words(dict):
    """Numbers of raw words (what stands between white space), and what is known of each number.

    ``literal``: code of the lower-cased core (0: no word); ``kind``: slot it can be (0 none, 1 number, 2 unit,
    3 name); ``ends``: whether it ends a sentence.  ``vocabulary``: sorted codes of the words that can match, if not all can.
    """

    def __init__(self, vocabulary: np.ndarray | None = None):
        super().__init__()
        self.vocabulary = vocabulary
        self.literal = np.zeros(1024, dtype=np.uint64)
        self.kind, self.ends = np.zeros(1024, dtype=np.int8), np.zeros(1024, dtype=bool)
        self._fresh: list[tuple[int, int, bool]] = []

    def __missing__(self, raw: str) -> int:
        number = self[raw] = len(self)
        self._fresh.append(self._look(raw))
        return number

    def numbers(self, raw: list[str]) -> np.ndarray:
        """Number of each word; the arrays then hold what is known of all of them."""
        out = np.fromiter(map(self.__getitem__, raw), dtype=np.int64, count=len(raw))
        if self._fresh:
            end, columns = len(self), list(zip(*self._fresh))
            for name, column in zip(("literal", "kind", "ends"), columns):
                array = getattr(self, name)
                if end > len(array):
                    array = np.resize(array, 2 * end)
                    setattr(self, name, array)
                array[end - len(column):end] = column
            self._fresh.clear()
        return out

    def runs(self, literal: np.ndarray, kinds: np.ndarray, bounds: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """Text, begin and end of each run of at least ``least`` words that can match."""
        can = kinds > 0
        if len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, literal), len(self.vocabulary) - 1)
            can |= self.vocabulary[at] == literal
        edge = np.zeros(len(can) + 1, dtype=bool)
        edge[bounds] = True
        edge[1:-1] |= can[1:] != can[:-1]
        cuts = np.flatnonzero(edge)
        begins, ends = cuts[:-1], cuts[1:]
        some = can[begins] & (ends - begins >= least)
        begins, ends = begins[some], ends[some]
        return zip(np.searchsorted(bounds, begins, side="right") - 1, begins, ends)

    @staticmethod
    def _look(raw: str) -> tuple[int, int, bool]:
        ends = False
        if raw.isalnum():  # a core as it is; the common case
            word = raw
        else:
            core = _CORE.search(raw)
            ends = raw.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":")
            if core is None:
                return 0, 0, ends
            word = core[0]
        low = word.lower()
        code = xxhash.xxh64_intdigest(low) or 1
        if word[0].isdigit() or low in NUMBER_WORDS:
            return code, 1, ends
        if low in UNITS:
            return code, 2, ends
        return code, 3 if len(word) > 1 and word[0].isupper() and word[1:].islower() else 0, ends


def _code(word: str) -> int:
    """64-bit hash of a word, never 0."""
    return xxhash.xxh64_intdigest(word) or 1


_SLOT_CODES = np.array([0, _code(NUMBER), _code(UNIT), _code(NAME)], dtype=np.uint64)


def read(words: Words, texts: list[str], least: int = 1) -> Iterator[tuple[int, int, tuple]]:
    """Of each text, or of each run of at least ``least`` words in it that can match: its number, the number of its first
    word, and its words as places in a list of raw words, that list, and of each word the literal code, the slot kind and
    whether it starts a sentence.

    The texts are split together, so that a word is looked up once for all of them.
    """
    if len(words) >= MEMO:
        words.clear()
    marked = [t.replace("\n", " .\n ") if "\n" in t else t for t in texts]
    split = pc.utf8_split_whitespace(pa.array(marked, pa.large_string()))
    bounds = split.offsets.to_numpy()
    coded = split.values.dictionary_encode()
    raw, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    numbers = words.numbers(raw)[places]
    literal = words.literal[numbers]
    keep = np.flatnonzero(literal)
    # a word starts a sentence if, since the last word of the text, something ended one
    ended = np.cumsum(words.ends[numbers])[keep] - words.ends[numbers[keep]]
    starts = np.concatenate([[True], ended[1:] > ended[:-1]])[:len(keep)]
    bounds = np.searchsorted(keep, bounds)
    starts[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    places, literal, kinds = places[keep], literal[keep], words.kind[numbers[keep]]
    whole = zip(range(len(texts)), bounds[:-1], bounds[1:])
    for text, begin, end in whole if words.vocabulary is None else words.runs(literal, kinds, bounds, least):
        yield int(text), int(begin - bounds[text]), (
            places[begin:end], raw, literal[begin:end], kinds[begin:end], starts[begin:end])


def window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` codes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        total = (total ^ codes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def sifted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes in order, and which last bits occur in them."""
    sieve = np.zeros(1 << (16 * len(hashes)).bit_length(), dtype=bool)
    sieve[hashes & np.uint64(len(sieve) - 1)] = True
    return np.sort(hashes), sieve


def _views(kinds: np.ndarray, starts: np.ndarray) -> list[list]:
    """(slot kind of each word, first word of each token, views this is): what is alike is listed once."""
    names = kinds == 3
    inside, freed = np.where(names & starts, 0, kinds), np.where(names, 0, kinds)
    every = np.arange(len(kinds))
    out = [[np.zeros_like(kinds), every, LITERAL]]

    def add(slots: np.ndarray, first: np.ndarray, bit: int) -> None:
        for view in out:
            if len(view[1]) == len(first) and np.array_equal(view[0], slots):
                view[2] |= bit
                return
        out.append([slots, first, bit])

    for slots, bit, run_bit in ((inside, TEMPLATE, RUNS), (freed, TEMPLATE, RUNS), (kinds, STARTS, RUN_STARTS)):
        add(slots, every, bit)
        same = (slots[1:] > 0) & (slots[1:] == slots[:-1]) & ~starts[1:]
        add(slots, np.flatnonzero(np.concatenate([[True], ~same])) if same.any() else every, run_bit)
    return out


def text_windows(words: tuple, lengths: list[int] | None, sent: tuple | None, width: int = WIDTH):
    """(length, first and last word, hash, kinds, slot values, views) of the windows of a read text that can match.

    Without ``lengths`` each view has its windows of ``width``, or the one window of a shorter text.
    """
    places, raw, literal, kinds, starts = words
    if not len(places):
        return
    valued = np.concatenate([[0], np.cumsum((kinds > 0) & ~(starts & (kinds == 3)))])
    found: dict[tuple, int] = {}
    for slots, first, bits in _views(kinds, starts):
        after = np.append(first[1:], len(places))
        slots, plain = slots[first], literal[first]
        codes = np.where(slots > 0, _SLOT_CODES[slots], plain) if bits != LITERAL else plain
        filled = np.concatenate([[0], np.cumsum(slots > 0)])
        for length in lengths or [min(width, len(first))]:
            if length < SHORTEST or length > len(first):
                continue
            hashes = window_hashes(codes, length)
            some = np.full(len(hashes), True) if sent is None else sent[1][hashes & np.uint64(len(sent[1]) - 1)]
            if bits != LITERAL:
                some &= 2 * (filled[length:] - filled[:len(hashes)]) <= length
            at = np.flatnonzero(some)
            if sent is not None and len(at):
                values, some = sent[0], hashes[at]
                at = at[values[np.minimum(np.searchsorted(values, some), len(values) - 1)] == some]
            for i in at:
                part = slots[i:i + length]
                begin, end = int(first[i]), int(after[i + length - 1])
                filler = tuple(
                    " ".join(_CORE.search(raw[places[w]])[0].lower() for w in range(first[i + k], after[i + k]))
                    for k in np.flatnonzero(part))
                key = length, begin, end - 1, int(hashes[i].view(np.int64)), "".join(map(str, part)), filler
                more = VALUED if bits & LITERAL and valued[end] > valued[begin] else 0
                found[key] = found.get(key, 0) | bits | more
    for key, bits in found.items():
        yield *key[:5], list(key[5]), bits


def run_windows(runs: list[tuple[int, int, tuple]], lengths: list[int], sent: tuple):
    """Text and windows of runs that were read together, as one text in which a word of no text precedes each run."""
    if not runs:
        return
    texts, starts, parts = zip(*runs)
    gap, sizes = (np.zeros(1, np.int64),) * 5, np.array([len(p[0]) for p in parts])
    begins = np.cumsum(sizes + 1) - sizes
    columns = [np.concatenate([x[i].astype(p[i].dtype) for p in parts for x in (gap, p)]) for i in (0, 2, 3, 4)]
    for length, pos, stop, *more in text_windows((columns[0], parts[0][1], *columns[1:]), lengths, sent):
        run = np.searchsorted(begins, pos, side="right") - 1
        back = starts[run] - int(begins[run])
        yield texts[run], length, pos + back, stop + back, *more


def _vocabulary(benchmark: DataFrame, text: str, most: int) -> np.ndarray | None:
    """Codes of the benchmark's words in order, if these are at most ``most``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            codes = [w[2] for _, _, w in read(words, batch["text"].dropna().tolist())]
            yield pd.DataFrame({"code": np.unique(np.concatenate([np.zeros(0, np.uint64), *codes])).view(np.int64)})

    few = benchmark.select(F.col(text).alias("text")).mapInPandas(run, "code long").distinct().limit(most + 1)
    codes = np.array([r[0] for r in few.collect()], dtype=np.int64).view(np.uint64)
    return np.sort(codes) if len(codes) <= most else None


def _windows(rows: DataFrame, key: str, text: str, lengths: list[int] | None, sent, width: int) -> DataFrame:
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(sent.value[2] if sent else None)
        for batch in batches:
            batch = batch[batch["text"].notna()]
            read_first = batch["text"].str.len().cumsum() // READ_TOGETHER
            for _, part in batch.groupby(read_first):
                keys = part["key"].tolist()
                runs = read(words, part["text"].tolist(), min(lengths or [1]))
                if words.vocabulary is not None:
                    out = [(keys[i], *w) for i, *w in run_windows(list(runs), lengths, sent.value)]
                else:
                    out = [(keys[i], *w) for i, _, t in runs
                           for w in text_windows(t, lengths, sent.value if sent else None, width)]
                yield pd.DataFrame(out, columns=["key", "length", "pos", "stop", "hash", "types", "slots", "views"])

    return rows.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key long, {_WINDOW}")


def _one_to_one(pairs):
    """Whether equal values have equal counterparts and different ones different ones."""
    left, right = (F.array_distinct(F.transform(pairs, lambda p: p[side])) for side in ("b", "d"))
    return (F.size(left) == F.size(pairs)) & (F.size(right) == F.size(pairs))


def _joined(base, others):
    """Item windows of a line and of those others that keep its slots one to one, the fullest first."""
    def extend(so_far, line):
        pairs = F.array_distinct(F.concat(so_far["pairs"], line["pairs"]))
        return F.when(_one_to_one(pairs), F.struct(
            F.array_union(so_far["ats"], line["ats"]).alias("ats"), pairs.alias("pairs"))).otherwise(so_far)

    order = F.sort_array(F.transform(others, lambda o: F.struct(
        (-F.size(o["ats"])).alias("n"), o["ats"].alias("ats"), o["pairs"].alias("pairs"))))
    return F.aggregate(order, base, extend)["ats"]


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", width: int = WIDTH,
                 max_sent: int = MAX_SENT_WINDOWS) -> DataFrame:
    """key, item, n_windows (matched on the best alignment), item_windows, first_word, last_word and kind."""
    known = _windows(benchmark, item, item_text, None, None, width).select(
        F.col("key").alias("_item"), "length", F.col("pos").alias("_at"), "hash", "types",
        F.col("slots").alias("_slots"), F.col("views").alias("_views")).distinct().persist()

    def seen(column: str, bits: int):
        return F.col(column).bitwiseAND(F.lit(bits)) > 0

    totals = known.groupBy("_item").agg(
        F.countDistinct("_at").alias("item_windows"),
        F.size(F.collect_set(F.when(seen("_views", TEMPLATE), F.col("_at")))).alias("_templates"),
        F.size(F.collect_set(F.when(seen("_views", RUNS), F.col("_at")))).alias("_runs"))
    lengths = sorted(r[0] for r in known.select("length").distinct().collect()) or [width]
    few = known.select("hash").distinct().limit(max_sent + 1)
    hashes = np.array([r[0] for r in few.collect()], dtype=np.int64).view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(
        (*sifted(hashes), _vocabulary(benchmark, item_text, max_sent))) if len(hashes) <= max_sent else None
    found = _windows(docs, key, text, lengths, sent, width).withColumnRenamed("key", "_doc")

    hits = found.join(known, ["length", "hash", "types"]).withColumn("_both", F.col("views").bitwiseAND(F.col("_views")))
    hits = hits.select("_doc", "_item", "pos", "stop", "_at", (F.col("pos") - F.col("_at")).alias("_line"), "_views",
                       "_both", F.arrays_zip(F.col("_slots").alias("b"), F.col("slots").alias("d")).alias("_pairs"))

    def read_by(bits: int):
        return F.struct(
            F.collect_set(F.when(seen("_both", bits), F.col("_at"))).alias("ats"),
            F.array_distinct(F.flatten(F.collect_set(F.when(seen("_both", bits), F.col("_pairs"))))).alias("pairs"))

    # one row for each alignment of a document with an item; its windows are bounded by the item's length
    lines = hits.groupBy("_doc", "_item", "_line").agg(
        F.size(F.collect_set("_at")).alias("_own"), F.min("pos").alias("first_word"), F.max("stop").alias("last_word"),
        F.size(F.collect_set(F.when(seen("_both", LITERAL), F.col("_at")))).alias("_literal"),
        F.max(seen("_both", LITERAL) & seen("_views", VALUED)).alias("_valued"),
        *(read_by(bits).alias(f"_read{i}") for i, bits in enumerate(READINGS)))
    unlike = F.exists("_read0.pairs", lambda p: p["b"] != p["d"])
    verbatim = F.col("_valued") | (F.col("_literal") >= 2) | ((F.size("_read0.ats") > 0) & ~unlike)
    near = Window.partitionBy("_doc", "_item").orderBy("_line")
    sides = (near.rangeBetween(-SHIFT, -1), near.rangeBetween(1, SHIFT))
    judged = lines.join(totals, "_item")
    for i, bits in enumerate(READINGS):
        name = f"_read{i}"
        others = F.concat(*(F.collect_list(name).over(side) for side in sides))
        judged = judged.withColumn(f"_near{i}", others)
    counts = []
    for i, bits in enumerate(READINGS):
        ats = F.when(_one_to_one(F.col(f"_read{i}.pairs")), _joined(F.col(f"_read{i}"), F.col(f"_near{i}")))
        total = F.col("_templates" if bits & TEMPLATE else "_runs")
        counts.append(F.when((F.size(ats) > 0) & (2 * F.size(ats) >= total), F.size(ats)))
    judged = judged.withColumn("_joined", F.greatest(*counts)).withColumn(
        "kind", F.when(verbatim, "verbatim").when(F.col("_joined").isNotNull(), "reparameterised"))
    judged = judged.where("kind IS NOT NULL").withColumn(
        "n_windows", F.when(F.col("kind") == "verbatim", F.col("_own")).otherwise(F.greatest("_own", "_joined")))
    best = judged.groupBy("_doc", "_item").agg(F.max_by(
        F.struct("n_windows", "item_windows", "first_word", "last_word", "kind"),
        F.struct(F.col("kind") == "verbatim", "n_windows", -F.col("_line"))).alias("_b"))
    return best.select(F.col("_doc").alias(key), F.col("_item").alias(item), "_b.*")
