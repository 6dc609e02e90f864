import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import piece_codec, token_count

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(documents, texts):
    tokenizer = Tokenizer.from_file(BPE)
    got = {r.doc_id: r for r in token_count.count_tokens(documents, BPE, limit=100).collect()}
    assert len(got) == documents.count()
    for i, text in enumerate(texts):
        want = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len((text or "").encode()), want > 100), text


def test_proof_of_whole_tokens():
    counter = token_count.TokenCounter(open(BPE, encoding="utf-8").read())
    tokenizer = Tokenizer.from_file(BPE)
    some = [s for s in sorted(counter.whole) if s.isascii() and s.isalpha()][::500]
    assert all(len(tokenizer.encode(s, add_special_tokens=False).ids) == 1 for s in some)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_count.TokenCounter(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_codes_spans_and_decoding(spark, documents, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = piece_codec.encode(documents, PIECES)
    back = {r.doc_id: r.text for r in piece_codec.decode(coded, PIECES).collect()}
    brief = {r.doc_id: r for r in piece_codec.digests(documents, PIECES).collect()}
    for row in coded.where("doc_id IS NOT NULL").collect():
        text = texts[row.doc_id] or ""
        want = library.encode(text, add_eos=True)
        assert row.ids == want, text
        assert back[row.doc_id] == library.decode(want)
        digest = brief[row.doc_id]
        assert digest.n_tokens == len(want)
        assert digest.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digest.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()
        # spans follow each other and cover the text
        assert row.begins[0] == 0 and row.ends[-1] == len(text.encode())
        assert all(a == b for a, b in zip(row.ends, row.begins[1:]))


def test_digests_are_those_of_encoding_and_decoding(spark, documents, texts):
    model = piece_codec.PieceModel(open(PIECES, "rb").read())
    for row in piece_codec.digests(documents, PIECES).where("doc_id IS NOT NULL").collect():
        ids, spans = model.encode(texts[row.doc_id])
        bounds = b"".join(bound.to_bytes(8, "little") for span in spans for bound in span)
        assert row.spans_sha256 == hashlib.sha256(bounds).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_stretches_change_nothing(texts):
    model = piece_codec.PieceModel(open(PIECES, "rb").read())
    assert model.apart
    fast = [model.encode(t) for t in texts]
    model.apart = False
    assert [model.encode(t) for t in texts] == fast


def test_stretches_of_a_batch_are_merged_together(monkeypatch):
    model = piece_codec.PieceModel(open(PIECES, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sizes = (1, 2, piece_codec.LONGEST - 2, piece_codec.LONGEST - 1, piece_codec.LONGEST, 90)
    odd = [f"  {c * n}\n {c}{n}. " for c in ("e", "é", "☃", "\t", "{", "the", "\x00") for n in sizes]
    many = [" ".join(f"w{i}or{i * 7919}d{k}" for i in range(2000)) for k in range(6)]
    texts = [None, "", " ", *odd, *many]
    alone = []
    one = piece_codec.PieceModel._stretch
    monkeypatch.setattr(piece_codec.PieceModel, "_stretch", lambda self, m: alone.append(m) or one(self, m))
    for text, (ids, spans) in zip(texts, model.encode_all(texts)):
        assert ids == library.encode(text or "", add_eos=True), text
        assert spans[-1][1] == len((text or "").encode())
    # only what is long or takes several bytes a character is coded by itself
    assert all(len(m) > piece_codec.LONGEST or not m.replace(piece_codec.MARK, "").isascii() for m in alone)
    assert model.digest_all(texts) == [model.digest(t) for t in texts]


def test_character_map_takes_the_longest_prefix():
    # a double array for the keys "a" -> "x" and "ab" -> "yz", laid out by hand
    def unit(label=0, offset=0, leaf=False):
        return label | leaf << 8 | offset << 10
    units = [0] * 1024
    units[0] = unit(offset=1)
    first = 1 ^ ord("a")
    units[first] = unit(ord("a"), first ^ 256, True)  # the children stand at 256
    units[256] = 1 << 31 | 0
    second = 256 ^ ord("b")
    units[second] = unit(ord("b"), second ^ 512, True)
    units[512] = 1 << 31 | 2
    import struct
    blob = struct.pack("<I1024I", 4096, *units) + b"x\0yz\0"
    chars = piece_codec.CharMap(blob)
    assert chars.longest(b"abc", 0) == (2, b"yz")
    assert chars.longest(b"aac", 0) == (1, b"x")
    assert chars.longest(b"b", 0) is None
    model = piece_codec.PieceModel(open(PIECES, "rb").read())
    model.map, model.apart = chars, False
    assert model.normalize("cab a") == (["▁", "c", "y", "z", "▁", "x"], [(0, 0), (0, 1), (1, 3), (1, 3), (3, 4), (4, 5)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_count.count_tokens(none, BPE).count() == 0
    assert piece_codec.digests(none, PIECES).count() == 0
