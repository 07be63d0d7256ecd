"""SentencePiece, token counts and shard files against the libraries and brute force."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import sentence_piece, token_counts, token_shards
from tagloom.llm.byte_bpe import ByteBpe, Units
from tagloom.llm.elias_fano import EliasFano
from tagloom.session import scratch

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DATA = open(PIECES, "rb").read()
MODEL = sentence_piece.PieceModel(DATA, remembered=50)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
BPE = ByteBpe(BYTES, remembered=50)
TOKENIZER = Tokenizer.from_file(BYTES)
TOKENIZER.encode_special_tokens = True

ALPHABET = st.text(alphabet=st.one_of(st.sampled_from("abcde ETA.,'s\n\t  é北🙂0123<|>"), st.characters(exclude_categories=["Cs"])), max_size=80)


def unigram_data() -> bytes:
    """The same pieces and scores as a unigram model: its kind is one byte of the trainer's settings."""
    at = DATA.rindex(b"\x18\x02 \x80\xfa\x01")
    return DATA[:at] + b"\x18\x01" + DATA[at + 2 :]


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_pieces_equal_the_library(text):
    ids = MODEL.encode(text)
    if "▁" not in text and "\0" not in text:
        assert ids.tolist() == LIBRARY.encode(text)
        assert MODEL.decode(ids) == text
    assert MODEL.decode(ids) == text.replace("▁", " ")


def test_unigram_paths_have_the_best_score(spark, small):
    model = sentence_piece.PieceModel(unigram_data())
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram_data())
    longest = max(map(len, model.ids))
    assert model.kind == sentence_piece.UNIGRAM

    def total(ids):
        return sum(model.scores[i] for i in ids if i not in model.bytes_of)

    def best(line):
        """The best sum over all ways to cut a line into pieces."""
        marked, scores = "▁" + line.replace(" ", "▁"), [0.0]
        for end in range(1, len(marked) + 1):
            ways = [scores[at] + model.scores[model.ids[marked[at:end]]] for at in range(max(0, end - longest), end) if marked[at:end] in model.ids]
            scores.append(max(ways))
        return scores[-1]

    for r in spark.read.parquet(f"{small}/documents.parquet").limit(30).collect():
        for line in filter(None, r.text.split("\n")):
            ids, theirs = model.encode(line).tolist(), library.encode(line)
            assert model.decode(ids) == line and total(ids) >= total(theirs)
            if model.bytes_of.keys().isdisjoint(ids):
                assert total(ids) == best(line)


def test_every_document_round_trips(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in sentence_piece.round_trip(docs, PIECES).collect()}
    for r in docs.collect():
        ids = LIBRARY.encode(r.text)
        assert got[r.doc_id].n_pieces == len(ids) and got[r.doc_id].same
        assert got[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_of_odd_rows(odd, nothing):
    rows = sentence_piece.decode(sentence_piece.encode(odd, PIECES), PIECES).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows) and len(rows) == odd.count()
    assert all(r.piece_ids == [] for r in rows if r.doc_id in (1, 2))
    assert sentence_piece.round_trip(nothing, PIECES).count() == 0
    checked = {r.doc_id: r for r in sentence_piece.encode_checked(odd, PIECES).collect()}
    assert not checked[9].round_trip and all(r.round_trip for d, r in checked.items() if d != 9)
    assert checked[7].piece_ids == LIBRARY.encode("x" * 100_000) and len(checked[8].piece_ids) > 60_000


def test_models_that_change_texts_are_refused():
    at = DATA.rindex(b"\x18\x01 \x002\x00")
    with pytest.raises(ValueError):
        sentence_piece.PieceModel(DATA[:at] + b"\x18\x01 \x012\x00" + DATA[at + 6 :])


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_byte_ids_equal_the_library(text):
    assert np.frombuffer(BPE.encode(text), BPE.dtype).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


LOADED = Tokenizer.from_file(BYTES)
MARK = "<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.just(MARK), st.sampled_from(["<|endoftext", "|>", " ", "\n", "a"]), ALPHABET), max_size=8).map("".join))
def test_byte_ids_of_added_tokens_equal_the_library_as_loaded(text):
    assert np.frombuffer(BPE.encode(text), BPE.dtype).tolist() == LOADED.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_counts_and_shards(spark, make):
    texts = [f"a {MARK} b", f"{MARK}{MARK}", f" {MARK}\n\nword {MARK[:-1]}", "later words"]
    docs, ids = make(list(enumerate(texts))), [LOADED.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in ids[0]
    assert {r.n_tokens: r.docs for r in token_counts.histogram(docs, BYTES).collect()} == {n: sum(len(i) == n for i in ids) for n in map(len, ids)}
    got = token_shards.read_shards(token_shards.write_shards(docs, scratch(spark, "test-shards"), BYTES)).orderBy("doc_id").collect()
    starts = np.cumsum([0] + [len(i) + 1 for i in ids]).tolist()
    assert [tuple(r) for r in got] == [(d, starts[d], len(i) + 1, zlib.crc32(np.array([*i, 0], "<u4").tobytes())) for d, i in enumerate(ids)]


def test_units_forget_and_give_the_same():
    made = []
    units = Units(lambda u: made.append(u) or u.upper(), limit=2)
    assert [units[x] for x in "abcabcddd"] == list("ABCABCDDD") and len(made) < 9


def test_curve_equals_sums_over_documents(spark, make):
    lengths = [0, 0, 3, 5, 5, 5, 1024, 2000, 2048, 5000]
    points = token_counts.curve(spark.createDataFrame([(x,) for x in lengths], "n_tokens long").groupBy("n_tokens").agg(F.count("*").alias("docs")))
    got = {r.n_tokens: r for r in points.collect()}
    for limit in set(lengths):
        r = got[limit]
        assert r.docs == lengths.count(limit)
        assert r.docs_longer == sum(x > limit for x in lengths) and r.docs_within == sum(x <= limit for x in lengths)
        assert r.tokens_within == sum(x for x in lengths if x <= limit)
        assert r.tokens_cut == sum(min(x, limit) for x in lengths) and r.tokens_lost == sum(max(0, x - limit) for x in lengths)
    cut = {r.context: r for r in token_counts.cut_totals(points, [4, 1500, 9999]).collect()}
    assert {k: (r.docs_longer, r.tokens_cut) for k, r in cut.items()} == {k: (sum(x > k for x in lengths), sum(min(x, k) for x in lengths)) for k in (4, 1500, 9999)}
    assert token_counts.length_quantile(points, 0.5) == 5


def test_token_counts_of_documents(spark, small, odd, nothing):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    points = token_counts.curve(token_counts.histogram(docs, BYTES)).collect()
    lengths = [len(TOKENIZER.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()]
    assert sorted((r.n_tokens, r.docs) for r in points) == sorted((x, lengths.count(x)) for x in set(lengths))
    assert {r.n_tokens: r.docs for r in token_counts.histogram(odd, BYTES).collect()}[0] == 2
    assert token_counts.curve(token_counts.histogram(nothing, BYTES)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=900))
def test_elias_fano_gives_all_numbers_back(gaps):
    values = np.cumsum(np.array(gaps, np.uint64)) if gaps else np.zeros(0, np.uint64)
    coded = EliasFano.of(values)
    assert coded.values().tolist() == values.tolist()
    assert [coded[i] for i in range(0, len(values), 7)] == values[::7].tolist()
    with pytest.raises(IndexError):
        coded[len(values)]


def test_elias_fano_is_small():
    coded = EliasFano.of(np.cumsum(np.random.default_rng(1).integers(1, 3000, 10_000)))
    assert (len(coded.low) + len(coded.high) + coded.samples.nbytes) * 8 < 10_000 * 14


def test_shards_give_back_every_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    files = token_shards.write_shards(docs, scratch(spark, "test-shards"), BYTES, shard_ids=20_000)
    assert files.count() > 3
    got = token_shards.read_shards(files).orderBy("doc_id").collect()
    start = 0
    for r, doc in zip(got, docs.orderBy("doc_id").collect()):
        ids = TOKENIZER.encode(doc.text, add_special_tokens=False).ids + [0]
        assert tuple(r) == (doc.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    shard = token_shards.ShardReader(files.orderBy("before").first().path)
    assert shard.document(3).tolist() == TOKENIZER.encode(docs.filter("doc_id = 3").first().text, add_special_tokens=False).ids + [0]


def test_shards_of_odd_rows(spark, odd, nothing):
    files = token_shards.write_shards(odd, scratch(spark, "test-shards"), BYTES)
    got = sorted((tuple(r) for r in token_shards.read_shards(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert {r[0]: r[2] for r in got}[1] == 1 and got[0][2:] == got[1][2:]
    assert token_shards.read_shards(token_shards.write_shards(nothing, scratch(spark, "test-shards"), BYTES)).count() == 0
