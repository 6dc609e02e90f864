"""SentencePiece BPE encoding with byte spans in the original text, and decoding.

Normalisation replaces, at every position, the longest prefix found in the model's compiled character map and
records for each normalised character the bytes it came from.  Merging then works on normalised characters, and every
piece is projected to the original bytes of its characters.

Where the model leaves characters as they are and no piece holds a space mark after another character - proven
from its vocabulary - a text falls into stretches that cannot merge with each other.  The distinct stretches of a batch
of texts are merged together, one pair of each a round, and forgotten with the batch.

Edge cases: null and empty texts have the end id only; characters without a piece become byte pieces; repeated rows
are encoded one by one; other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

MARK = "▁"
#: piece types of the model file (fixed values)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: symbols from which on a heap finds the best pair
FEW = 24
#: symbols of the longest stretch that is merged together with others, places of one in a column with both its ends,
#: and stretches that are merged together
LONGEST, PLACES, TOGETHER = 30, 32, 8192
#: rank of what is no pair
NO_PAIR = np.iinfo(np.int32).max
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_LOADED: dict[str, PieceModel] = {}


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            size = varint()
            value, at = blob[at:at + size], at + size
        else:
            size, form = (4, "<f") if kind == 5 else (8, "<d")
            value, at = struct.unpack_from(form, blob, at)[0], at + size
        yield tag >> 3, value


class CharMap:
    """Compiled character map: a double-array trie over UTF-8 bytes whose leaves point into a pool of strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.pool = blob[4 + size:]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest known prefix of ``data`` from ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.pool[found[1]:self.pool.index(b"\0", found[1])]


#: bytes of a mark beyond the one it stands for
_MARK_EXTRA = len(MARK.encode()) - 1


class Met(dict):
    """Numbers of marked stretches, in the order in which they were met."""

    def __missing__(self, marked: str) -> int:
        self[marked] = number = len(self)
        return number


class Merges:
    """The pairs a vocabulary merges, as arrays; symbols are the known pieces by code + 1, then other single characters.

    ``code`` is that of a symbol, or of its byte piece, and -1 where it takes several or has none.
    """

    def __init__(self, model: PieceModel):
        symbols = {p: i + 1 for p, i in model.known.items()}
        lone = {c for p in symbols for c in p}.union(map(chr, range(128))).difference(symbols)
        symbols.update({c: len(model.pieces) + 1 + i for i, c in enumerate(sorted(lone))})
        self.code = np.full(len(model.pieces) + 1 + len(lone), -1, dtype=np.int64)
        for text, symbol in symbols.items():
            if text not in lone:
                self.code[symbol] = symbol - 1
            elif model.fallback and text.isascii():
                self.code[symbol] = model.bytes[ord(text)]
        singles = [(ord(t), s) for t, s in symbols.items() if len(t) == 1]
        self.char = np.zeros(0x110000, dtype=np.int32)
        self.char[[c for c, _ in singles]] = [s for _, s in singles]
        order = {score: i for i, score in enumerate(sorted(set(model.ranked.values())))}
        pairs = sorted(
            (symbols[a] * len(self.code) + symbols[b], order[model.ranked[p]], symbols[p])
            for p in model.known for k in range(1, len(p)) if (a := p[:k]) in symbols and (b := p[k:]) in symbols)
        columns = list(zip(*pairs)) or [(), (), ()]
        self.key = np.array([*columns[0], np.iinfo(np.int64).max], dtype=np.int64)
        self.rank, self.into = (np.array([*c, 0], dtype=np.int32) for c in columns[1:])
        self.sieve = np.zeros(1 << (16 * len(self.key)).bit_length(), dtype=bool)
        self.sieve[self._place(self.key[:-1])] = True

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 >> 15) & (len(self.sieve) - 1)

    def pairs(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair with the place ``at`` in its last bits, or NO_PAIR, and the symbol it becomes."""
        keys = left.astype(np.int64) * len(self.code) + right
        rank, into = np.full(len(keys), NO_PAIR, dtype=np.int32), np.zeros(len(keys), dtype=np.int32)
        some = np.flatnonzero(self.sieve[self._place(keys)])
        entry = np.searchsorted(self.key, keys[some])
        same = self.key[entry] == keys[some]
        some, entry = some[same], entry[same]
        rank[some], into[some] = self.rank[entry] * PLACES + at[some], self.into[entry]
        return rank, into

    def merge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts one after another, with -1 for symbols without a code, and how many each text has.

        A text is a column; in each round the best pair of every column, leftmost first, becomes one symbol.
        """
        sizes = np.array(list(map(len, texts)))
        n, rows = len(texts), int(sizes.max()) + 2
        chars = self.char[np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)]
        column = np.repeat(np.arange(n), sizes)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        symbol = np.zeros((rows, n), dtype=np.int32)
        symbol[place, column] = chars
        there = np.zeros((rows, n), dtype=bool)
        there[place, column] = True
        after = np.repeat(np.arange(1, rows + 1, dtype=np.int32)[:, None], n, axis=1)
        before = after - 2
        rank, into = np.full((rows, n), NO_PAIR, dtype=np.int32), np.zeros((rows, n), dtype=np.int32)
        for row in range(1, rows - 2):
            rank[row], into[row] = self.pairs(symbol[row], symbol[row + 1], np.full(n, row))
        active = np.arange(n)
        while len(active):
            best = rank.min(axis=0)
            live = best < NO_PAIR
            if not live.all():
                active, rank, best = active[live], rank[:, live], best[live]
            at, here = best & (PLACES - 1), np.arange(len(active))
            gone = after[at, active]
            then, ahead = after[gone, active], before[at, active]
            made = into[at, active]
            symbol[at, active], there[gone, active] = made, False
            after[at, active], before[then, active] = then, at
            rank[gone, here] = NO_PAIR
            rank[ahead, here], into[ahead, active] = self.pairs(symbol[ahead, active], made, ahead)
            rank[at, here], into[at, active] = self.pairs(made, symbol[then, active], at)
        there = there.T
        return self.code[symbol.T[there]], there.sum(axis=1)


class PieceModel:
    """A BPE model with byte fallback, read from the bytes of its file."""

    def __init__(self, blob: bytes):
        self.pieces, self.scores, self.types = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(blob):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(piece.get(2, 0.0))
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or trainer.get(24):
            raise ValueError("only BPE models with leading space marks are supported")
        self.dummy_prefix, self.trim = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        self.map = CharMap(normalizer.get(2, b""))
        self.known = {p: i for i, p in enumerate(self.pieces) if self.types[i] in (NORMAL, USER_DEFINED, UNUSED)}
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.fallback = bool(trainer.get(35, 0))
        self.unknown = next(i for i, t in enumerate(self.types) if t == UNKNOWN)
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        end = trainer.get(47, b"</s>").decode()
        self.end = self.pieces.index(end)
        frozen = sorted((p for p, i in self.known.items() if self.types[i] == USER_DEFINED), key=len, reverse=True)
        self.frozen = re.compile("|".join(map(re.escape, frozen))) if frozen else None
        self.simple = not frozen and UNUSED not in self.types and max(self.scores, default=0.0) <= 0
        self.ranked = {p: -self.scores[i] for p, i in self.known.items()}  # the least is the best
        self.apart = (
            not self.map.units and not frozen and self.dummy_prefix and not self.trim and self.escape
            and self.fallback and MARK in self.known and not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.known)
        )
        self.merges = Merges(self) if self.apart and self.simple else None
        self.numerals = [str(i) for i in range(len(self.pieces))]
        #: text of each piece by itself; bytes beyond ASCII have none, since they are joined into characters
        self.surfaces = [
            None if t == BYTE else self.unknown_text if t == UNKNOWN else "" if t == CONTROL else p.replace(MARK, " ")
            for p, t in zip(self.pieces, self.types)]
        for i, byte in self.byte_of.items():
            self.surfaces[i] = chr(byte) if byte < 128 else None
        #: bytes that a piece stands for
        self.sizes = np.array([
            1 if t == BYTE else len(p.encode()) - _MARK_EXTRA * p.count(MARK) for p, t in zip(self.pieces, self.types)],
            dtype=np.int64)

    # normalisation

    def normalize(self, text: str) -> tuple[list[str], list[tuple[int, int]]]:
        """Normalised characters (or frozen pieces) and the original bytes of each."""
        data, at = text.encode(), 0
        chars: list[str] = []
        spans: list[tuple[int, int]] = []
        while at < len(data):
            size, value = self._next(data, at)
            for char in ([value] if self.frozen and self.frozen.fullmatch(value) else value):
                chars.append(char)
                spans.append((at, at + size))
            at += size
        if self.trim:
            kept = [i for i, c in enumerate(chars) if c != " " or (i and chars[i - 1] != " ")]
            while kept and chars[kept[-1]] == " ":
                kept.pop()
            chars, spans = [chars[i] for i in kept], [spans[i] for i in kept]
        if self.dummy_prefix and chars:
            chars.insert(0, " ")
            spans.insert(0, (spans[0][0], spans[0][0]))
        return [MARK if self.escape and c == " " else c for c in chars], spans

    def _next(self, data: bytes, at: int) -> tuple[int, str]:
        if self.frozen and (hit := self.frozen.match(data[at:at + 256].decode(errors="ignore"))):
            return len(hit[0].encode()), hit[0]
        if found := self.map.longest(data, at):
            return found[0], found[1].decode()
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at:at + size].decode()

    # encoding

    def merge(self, symbols: list[str]) -> list[tuple[str, int, int]]:
        """(piece, first, last + 1 symbol) after merging the best pair, leftmost first, until none is known."""
        n = len(symbols)
        if n < FEW and self.simple:
            out, at = [], 0
            for piece in self._merge_few(list(symbols)):
                out.append((piece, at, at + len(piece)))
                at += len(piece)
            return out
        symbols, ends = list(symbols), list(range(1, n + 1))
        before = list(range(-1, n - 1))
        known, scores, types = self.known, self.scores, self.types
        fixed = [self.frozen is not None and types[known[s]] == USER_DEFINED if s in known else False for s in symbols]
        undone: dict[str, tuple[str, str]] = {}
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i < 0 or j >= n or fixed[i] or fixed[j]:
                return
            both = symbols[i] + symbols[j]
            if (found := known.get(both)) is not None:
                heapq.heappush(heap, (-scores[found], i, j, both))
                if types[found] == UNUSED:
                    undone[both] = symbols[i], symbols[j]

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or ends[i] != j or len(symbols[i]) + len(symbols[j]) != len(both):
                continue
            symbols[i], symbols[j] = both, ""
            ends[i] = ends[j]
            if ends[j] < n:
                before[ends[j]] = i
            offer(before[i], i)
            offer(i, ends[i])
        out: list[tuple[str, int, int]] = []
        for i, piece in enumerate(symbols):
            if piece:
                self._restore(piece, i, ends[i], undone, out)
        return out

    def _merge_few(self, symbols: list[str]) -> list[str]:
        """The pieces of a short stretch, for models without frozen and unused pieces."""
        get, none = self.ranked.get, float("inf")
        found = [get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            at = found.index(best)
            both = symbols[at] + symbols[at + 1]
            symbols[at:at + 2] = [both]
            del found[at]
            if at:
                found[at - 1] = get(symbols[at - 1] + both, none)
            if at < len(found):
                found[at] = get(both + symbols[at + 1], none)
        return symbols

    def _restore(self, piece, first, last, undone, out) -> None:
        """Pieces the model marks as unused are taken apart again."""
        if piece in undone and self.types[self.known[piece]] == UNUSED:
            left, right = undone[piece]
            self._restore(left, first, first + len(left), undone, out)
            self._restore(right, first + len(left), last, undone, out)
        else:
            out.append((piece, first, last))

    def _codes(self, chars: list[str], spans: list[tuple[int, int]]) -> Iterator[tuple[int, tuple[int, int]]]:
        for piece, first, last in self.merge(chars):
            span = spans[first][0], spans[last - 1][1]
            if piece in self.known:
                yield self.known[piece], span
            elif self.fallback:
                raw = piece.encode()
                even = span[1] - span[0] == len(raw)
                for k, byte in enumerate(raw):
                    yield self.bytes[byte], (span[0] + k, span[0] + k + 1) if even else span
            else:
                yield self.unknown, span

    def _stretch(self, marked: str) -> list[int]:
        """Codes of a stretch of marked text."""
        chars = list(marked)
        return [code for code, _ in self._codes(chars, [(i, i + 1) for i in range(len(chars))])]

    def _coded(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the stretches one after another, in any order, and where those of each stretch begin and end.

        Short stretches are merged together; others, and those with characters of several byte pieces, one by one.
        """
        sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        order = np.argsort(sizes, kind="stable")
        short = np.searchsorted(sizes[order], LONGEST, side="right") if self.merges else 0
        begins, ends = np.zeros((2, len(marked)), dtype=np.int64)
        flat, used, alone = [np.zeros(0, dtype=np.int64)], 0, order[short:].tolist()
        for at in range(0, short, TOGETHER):
            part = order[at:min(at + TOGETHER, short)]
            codes, counts = self.merges.merge([marked[i] for i in part.tolist()])
            ends[part] = used + np.cumsum(counts)
            begins[part] = ends[part] - counts
            alone += part[np.unique(np.searchsorted(ends[part], used + np.flatnonzero(codes < 0), side="right"))].tolist()
            flat.append(codes)
            used += len(codes)
        for i in alone:
            codes = self._stretch(marked[i])
            begins[i], ends[i] = used, used + len(codes)
            flat.append(np.array(codes, dtype=np.int64))
            used += len(codes)
        return np.concatenate(flat), begins, ends

    def _apart(self, texts: Iterable[str | None]) -> Iterator[np.ndarray | None]:
        """Codes of each text whose stretches can be coded apart; None for another text."""
        met = Met()
        parts = [
            np.fromiter(map(met.__getitem__, _STRETCH.findall(MARK + text.replace(" ", MARK))), dtype=np.int64)
            if text and self.apart and MARK not in text else None for text in texts]
        codes, begins, ends = self._coded(list(met))
        met.clear()
        for part in parts:
            if part is None:
                yield None
                continue
            first, counts = begins[part], ends[part] - begins[part]
            last = np.cumsum(counts)
            yield codes[np.arange(last[-1]) + np.repeat(first - last + counts, counts)]

    def _bounds(self, codes: np.ndarray) -> np.ndarray:
        """Begin and end of the codes of a text that was coded apart, and of the end id."""
        sizes = self.sizes[codes]
        sizes[0] -= 1  # the first mark stands for no byte
        bounds = np.zeros((len(sizes) + 1, 2), dtype="<i8")
        np.cumsum(sizes, out=bounds[:-1, 1])
        bounds[-1, 1] = bounds[-2, 1]
        bounds[1:, 0] = bounds[:-1, 1]
        return bounds

    def _encoded(self, text: str | None, codes: np.ndarray | None) -> tuple[list[int], np.ndarray]:
        """Ids with the end id, and a row (begin, end) in the bytes of the text for each; that of the end id is empty."""
        if codes is not None:
            ids, bounds = codes.tolist(), self._bounds(codes)
        else:
            ids, spans = [], []
            for code, span in self._codes(*self.normalize(text)) if text else ():
                ids.append(code)
                spans.append(span)
            size = len(text.encode()) if text else 0
            bounds = np.array([*spans, (size, size)], dtype="<i8")
        ids.append(self.end)
        return ids, bounds

    def encode(self, text: str | None) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids with the end id, and each id's (begin, end) in the bytes of the text; the end id has an empty span."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """What ``encode`` gives for each text; the texts are coded together."""
        coded = map(self._encoded, texts, self._apart(texts))
        return [(ids, list(map(tuple, bounds.tolist()))) for ids, bounds in coded]

    def digest(self, text: str | None) -> tuple[int, str, str, str]:
        """(number of ids, hash of their decimal text, of the text they decode to, and of begin and end of each span)."""
        return self.digest_all([text])[0]

    def digest_all(self, texts: list[str | None]) -> list[tuple[int, str, str, str]]:
        """What ``digest`` gives for each text; the texts are coded together."""
        return list(map(self._digest, texts, self._apart(texts)))

    def _digest(self, text: str | None, codes: np.ndarray | None) -> tuple[int, str, str, str]:
        ids, bounds = self._encoded(text, codes)
        decimal, decoded = " ".join(map(self.numerals.__getitem__, ids)), self.decode(ids)
        return (len(bounds), *(hashlib.sha256(x).hexdigest() for x in (decimal.encode(), decoded.encode(), bounds.tobytes())))

    # decoding

    def _surface(self, ids) -> str:
        """Text of the ids, marks as spaces, byte pieces joined into characters."""
        try:
            return "".join(map(self.surfaces.__getitem__, ids))
        except TypeError:
            out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(_characters(raw))
                raw = bytearray()
            out.append(self.surfaces[i])
        if raw:
            out.append(_characters(raw))
        return "".join(out)

    def decode(self, ids) -> str:
        """Text of the ids; control pieces have none, and the added prefix goes."""
        first = next((i for i in ids if self.types[i] != CONTROL), None)
        text = self._surface(ids)
        if (self.dummy_prefix or self.trim) and first is not None and self.pieces[first].startswith(MARK):
            return text[1:]
        return text


def _characters(raw: bytearray) -> str:
    """Valid characters as such, every other byte as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(raw[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def _model(blob: bytes) -> PieceModel:
    """One model for each worker and file."""
    key = hashlib.sha256(blob).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = PieceModel(blob)
    return _LOADED[key]


def _broadcast(rows: DataFrame, model_file: str):
    """The model's bytes (some 0.5 MB), read by the driver."""
    small_batches(rows.sparkSession)
    with open(model_file, "rb") as file:
        return rows.sparkSession.sparkContext.broadcast(file.read())


def encode(rows: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ids, and begin and end of each id in the UTF-8 bytes of the text."""
    blob = _broadcast(rows, model_file)

    @F.pandas_udf("ids array<int>, begins array<int>, ends array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(blob.value)
        for texts in batches:
            codes = model.encode_all(texts)
            yield pd.DataFrame({
                "ids": [c[0] for c in codes],
                "begins": [[s[0] for s in c[1]] for c in codes], "ends": [[s[1] for s in c[1]] for c in codes],
            })

    return rows.select(F.col(key), encoded(F.col(text)).alias("_e")).select(key, "_e.*")


def decode(rows: DataFrame, model_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key and text of id lists; a null list has an empty text."""
    blob = _broadcast(rows, model_file)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(blob.value)
        for lists in batches:
            yield pd.Series([model.decode([int(i) for i in x]) if x is not None else "" for x in lists], dtype=object)

    return rows.select(F.col(key), decoded(F.col(ids)).alias("text"))


def digests(rows: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns to keep, and of the codes n_tokens, ids_sha256, decoded_sha256 (of the text they decode to) and
    spans_sha256 (of begin and end of each code), without storing them."""
    blob = _broadcast(rows, model_file)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(blob.value)
        for texts in batches:
            yield pd.DataFrame(
                model.digest_all(texts),
                columns=["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return rows.select(*keep, digested(F.col(text)).alias("_d")).select(*keep, "_d.*")
