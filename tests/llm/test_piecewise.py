import hashlib
import random
import tracemalloc

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, documents, mixed_texts
from tidewatch.llm import piecewise
from tidewatch.llm.batches import cuts, pieces
from tidewatch.llm.piecewise import BLANK, Decoder, Encoder, Words, decode_pieces, encode_pieces, piece_report, read_vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(MODEL)


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return Encoder(vocabulary)


def ids_of(encoder, texts):
    offsets, flat = Words(encoder).encode(texts, 2)
    return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


def check(encoder, library, texts):
    assert ids_of(encoder, texts) == [library.encode(t or "", add_eos=True) for t in texts]


def test_runs_ties_and_rare_characters_equal_the_library(encoder, library):
    blanks = [" " * k for k in range(70)] + ["a" + " " * k + "b" for k in range(70)]
    runs = [c * k for c in "-=/*a\n\t▁0é中" for k in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33, 500)]
    rare = ["\x00", "a\x00b", "😀é́", "<s></s><unk><0x41>", "￿\U0010ffff", "", None, "▁a ▁", " \n "]
    check(encoder, library, blanks + runs + rare)


def test_joined_pieces_equal_the_library(encoder, library):
    rng = random.Random(11)
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    check(encoder, library, ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 10))) for _ in range(1500)])
    check(encoder, library, mixed_texts(["in", "on", "er", " ", "  ", "t", "h", "e", "▁", "é", "😀", "\n", "1"], 800, 30, 12))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(encoder, library, text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    check(encoder, library, [text])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(0, 31999), st.sampled_from([259, 28705])), max_size=12))
def test_any_ids_decode_as_the_library_does(vocabulary, library, ids):
    assert Decoder(vocabulary).decode(ids) == library.decode(ids)


def test_whole_texts_need_no_split_at_blanks(encoder, library, monkeypatch):
    monkeypatch.setattr(encoder, "splits", False)
    check(encoder, library, mixed_texts(["the", " ", "   ", "of", "\n", "é", "😀"], 200, 60, 13))


def test_rare_and_long_words_go_one_by_one(vocabulary, library, monkeypatch):
    monkeypatch.setattr(piecewise, "COLUMNS", 40)
    monkeypatch.setattr(piecewise, "SHORT", 9)
    monkeypatch.setattr(piecewise, "SLOT_BITS", 3)
    encoder = Encoder(vocabulary)
    assert encoder.can_step("▁the") and not encoder.can_step("é")
    pieces = [library.id_to_piece(i) for i in range(259, 32000, 7)]
    rng = random.Random(16)
    check(encoder, library, ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) for _ in range(600)])


def test_small_caches_change_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(piecewise, "CACHE_WORDS", 3)
    monkeypatch.setattr(piecewise, "CACHE_PAIRS", 5)
    words = Words(encoder)
    for text in mixed_texts(["word", " ", "other", " x", "..", "9"], 100, 20, 14):
        offsets, flat = words.encode([text], 2)
        assert flat.tolist() == library.encode(text, add_eos=True)


def test_a_worker_holds_little(encoder, library, monkeypatch):
    # About 130 bytes for a kept answer and 9 for a place; the limits of memory are for two workers of each kind and the JVM.
    fixed = encoder.step.nbytes + encoder.asked.nbytes + encoder.answered.nbytes
    assert fixed + 130 * piecewise.CACHE_PAIRS < 50e6
    monkeypatch.setattr(piecewise, "CACHE_PAIRS", 100)
    check(Encoder(read_vocabulary(MODEL)), library, mixed_texts(["the", "re", "in", "g", " ", "é", "x"], 300, 40, 17))
    texts = [None, "", *(c * 20_000 for c in "abcdefgh" * 50), "x" * 900_000, None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    tracemalloc.start()
    try:
        rows = [(i, len(t or "")) for part in pieces(cuts([batch], "text", 100_000), "text") for i, t in zip(part["doc_id"], part["text"], strict=True)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == [(i, len(t or "")) for i, t in enumerate(texts)] and peak < 2_500_000
    sizes = [sum(len(t or "") for t in part.column("text").to_pylist()) for part in cuts([batch, batch.slice(0, 0)], "text", 100_000)]
    assert max(sizes) == 900_000 and sorted(sizes)[-2] <= 100_000 and len(sizes) < 90


def test_compatible_pairs_are_those_that_stay_apart(encoder, library):
    rng = random.Random(15)
    for _ in range(3000):
        a, b = rng.randrange(259, 32000), rng.randrange(259, 32000)
        if rng.random() < 0.5:
            b = library.piece_to_id(rng.choice("aeinorst▁"))
        text = library.id_to_piece(a) + library.id_to_piece(b)
        if not text.startswith(BLANK) or a not in encoder.merges or b not in encoder.merges:
            continue
        assert encoder.compatible(a, b) == (library.encode(text[1:].replace(BLANK, " ")) == [a, b])


def test_awkward_rows_and_real_texts(spark, sf, library):
    real = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = AWKWARD + [(r["doc_id"], r["text"]) for r in real]
    df = documents(spark, rows)
    ids = encode_pieces(df.repartition(3), MODEL)
    assert ids.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    want = sorted(((i, library.encode(t or "", add_eos=True)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["ids"]) for r in ids.collect()), key=repr) == want
    report = sorted((tuple(r) for r in piece_report(df.repartition(3), MODEL).collect()), key=repr)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert report == sorted(
        ((i, len(e), digest(" ".join(map(str, e))), digest(library.decode(e))) for i, e in want), key=repr
    )
    assert piece_report(df.limit(0), MODEL).count() == 0


def test_decode_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [], "x"), (3, [22557, 1526, 2], "x")], "k int, ids array<int>, decoded string")
    got = decode_pieces(df, MODEL)
    assert got.columns == ["k", "ids", "decoded"]
    assert [r["decoded"] for r in got.orderBy("k").collect()] == [None, "", "Hello world"]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    other = tmp_path / "other.model"
    other.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        read_vocabulary(str(other))
