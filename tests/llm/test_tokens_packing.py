import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, documents, mixed_texts
from tidewatch.llm.packing import Schedule, WordIds, pack, queue_places
from tidewatch.llm.tokens import Counter, count_tokens, frequent_lengths

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TOKENS = [
    "'s", "'t", "'", "'re", "'LL", "'v", "e", "s", "B", " ", "  ", "\n", "\t", "\xa0", "\x85", "1", "²", "9", "!", "-", "é", "É", "\x1c",
    "\x00", "’", "ſ", "Ÿ", "€", "😀", "中", "<|endoftext|>", "İ", " 's", "m", "d", "ª", "µ", "º", "¼", "Σ", "ς", "e\u0301",
]


@pytest.fixture(scope="module")
def texts(spark, sf):
    own = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    edges = [f"a{chr(c)}1 {chr(c)}{chr(c)}b" for c in (*range(0x180), *range(0x2010, 0x2028))]
    return own + mixed_texts(TOKENS, 4000, 14, 2) + edges


def test_counts_equal_the_library(texts):
    library = Tokenizer.from_file(BYTES)
    count = Counter(library, frequent_lengths(library), entries=5000)
    assert count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_word_ids_equal_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    got = WordIds(library, 1, entries=5000)(texts)
    for g, t in zip(got, texts, strict=True):
        assert np.frombuffer(g, "<u2").tolist() == [*library.encode(t, add_special_tokens=False).ids, 1]


def test_counts_of_awkward_rows(spark):
    library = Tokenizer.from_file(BYTES)
    df = documents(spark)
    got = count_tokens(df, BYTES, limit=5).collect()
    for row, (i, t) in zip(got, AWKWARD, strict=True):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (row["doc_id"], row["n_bytes"], row["n_tokens"], row["over_limit"]) == (i, len((t or "").encode()), n, n > 5)
    assert count_tokens(df.limit(0), BYTES).count() == 0


def check_packing(rows, docs, sequence):
    """Every id in one piece, sequences without gaps, all but the last full; tokens of each sequence by source."""
    library = Tokenizer.from_file(WORDS)
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t, _ in docs]
    want = sorted(((d, len(x), zlib.crc32(x.tobytes())) for (d, _, _), x in zip(docs, ids, strict=True)), key=repr)
    pieces = sorted(((r["sequence_id"], r["offset"], r["length"]) for r in rows))
    last = pieces[-1][0]
    at: dict[int, int] = {}
    for s, offset, length in pieces:
        assert offset == at.get(s, 0) and length > 0
        at[s] = offset + length
    assert sorted(at) == list(range(last + 1)) and all(n == sequence for s, n in at.items() if s != last)
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    assert sum(r["length"] for r in rows) == sum(n for _, n, _ in want)
    for (d, _, _), x in zip(docs, ids, strict=True):
        for start, length, crc in by_doc[d, len(x)]:
            candidates = [y for (e, _, _), y in zip(docs, ids, strict=True) if e == d and len(y) == len(x)]
            assert crc in {zlib.crc32(y[start : start + length].tobytes()) for y in candidates}


def test_packing_of_awkward_rows(spark):
    df = documents(spark)
    for sequence in (16, 2048):
        rows = pack(df, WORDS, sequence=sequence, window_sequences=2).collect()
        check_packing(rows, [(i, t, "s") for i, t in AWKWARD], sequence)
    assert pack(df.limit(0), WORDS).count() == 0


def test_windows_hold_the_target_shares(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    rows = pack(df, WORDS, sequence=2048, window_sequences=4).collect()
    check_packing(rows, docs, 2048)
    source, total, window = {d: s for d, _, s in docs}, {}, {}
    for r in rows:
        total[source[r["doc_id"]]] = total.get(source[r["doc_id"]], 0) + r["length"]
        key = (r["sequence_id"] // 4, source[r["doc_id"]])
        window[key] = window.get(key, 0) + r["length"]
    everything, windows = sum(total.values()), max(w for w, _ in window)
    for (w, s), n in window.items():
        if w < windows:
            assert abs(n - 8192 * total[s] / everything) < 200


def test_given_shares_then_the_rest():
    plan = Schedule({1: 1000, 2: 1000, 3: 500}, {1: 0.75, 2: 0.25}, 100)
    pieces = sorted(
        (place, length, q) for q, supply in ((1, 1000), (2, 1000), (3, 500)) for _, length, place in plan.pieces(q, 0, supply, 64)
    )
    at = 0
    for place, length, _ in pieces:
        assert place == at
        at += length
    assert at == 2500
    first = sum(length for place, length, q in pieces if place + length <= 1000 and q == 1)
    assert abs(first - 750) < 60


def test_places_are_running_totals(spark):
    rows = [(i, i % 2, 1 + i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "row long, queue int, n long")
    got = {r["row"]: r["before"] for r in queue_places(df, bucket_rows=40).collect()}
    for queue in (0, 1):
        spans = sorted((got[i], n) for i, q, n in rows if q == queue)
        at = 0
        for before, n in spans:
            assert before == at
            at += n


def test_sources_without_a_share_come_last_in_whole_pieces(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choice(["red", "green", "blue"]) for _ in range(400)), "abc"[i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pack(df, WORDS, shares={"a": 0.75, "b": 0.25}, sequence=64, window_sequences=4).collect()
    check_packing(got, [(i, t, s) for i, t, s in rows], 64)
    assert len(got) < 30 * 401 / 64 * 3
    place = {s: sorted(64 * r["sequence_id"] + r["offset"] for r in got if r["doc_id"] % 3 == "abc".index(s)) for s in "abc"}
    assert place["c"][0] > place["a"][-1] and place["c"][0] > place["b"][-1]
    first = sum(r["length"] for r in got if r["sequence_id"] < 40 and r["doc_id"] % 3 == 0)
    assert abs(first - 0.75 * 40 * 64) < 64
    # No source of the shares is in the table.
    check_packing(pack(df, WORDS, shares={"z": 1.0}, sequence=64).collect(), [(i, t, s) for i, t, s in rows], 64)
