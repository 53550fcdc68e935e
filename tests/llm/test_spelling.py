import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.helpers import AWKWARD, documents
from tidewatch.llm import spelling
from tidewatch.llm.fmindex import Vocabulary
from tidewatch.llm.spelling import roots_of, spelling_variants


def near(a, b):
    """Exactly one letter inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_part = {}
    for w in words:
        # Words one edit apart share what is left of either without some letter.
        for part in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} if len(w) < 200 else {w}:
            by_part.setdefault(part, set()).add(w)
    partners = {w: set() for w in words}
    for group in by_part.values():
        for a in group:
            partners[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(partners[w]), words.get(form[w])) for w, n in words.items())


def result(df):
    out = spelling_variants(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def invented(rng, n_words, n_docs, letters="abcdeé"):
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(n_words)]
    weights = [1 / (k + 1) for k in range(n_words)]
    return [(i, " ".join(rng.choices(words, weights, k=60))) for i in range(n_docs)]


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzäöüß"])
def test_index_equals_comparing_all(letters):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(250)})
    for w in words[:40]:
        at = rng.randrange(len(w) + 1)
        words.append(w[:at] + rng.choice(letters) + w[at:])
    words = sorted(set(words))
    queries = words + ["q" + w for w in words[:20]] + ["zzzzz", "z", words[0] * 3]
    index = Vocabulary(words)
    for left in (True, False):
        q, w = index.within_one(queries, left)
        got = list(zip(q.tolist(), w.tolist(), strict=True))
        assert len(got) == len(set(got))
        assert set(got) == {
            (i, j)
            for i, a in enumerate(queries)
            for j, b in enumerate(words)
            if near(a, b) and (b.startswith(a[: len(a) // 2]) if left else b.endswith(a[len(a) // 2 :]))
        }


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    rows = invented(rng, 400, 120) + [(900 + i, "Colour COLOUR color colour colours colourz éclair Éclair " * 2) for i in range(4)]
    assert result(documents(spark, rows).repartition(3)) == brute(rows)


def test_cut_halves_and_small_tasks_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = invented(rng, 500, 100, "ab") + [(i, f"prefixes{c}{d} " * 3) for i, c in enumerate("abcdefgh") for d in "abcdefgh"]
    want = brute(rows)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 5)
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    assert result(documents(spark, rows).repartition(3)) == want


def test_given_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert result(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_awkward_rows(spark):
    long = "y" * 3000
    rows = AWKWARD * 2 + [(21, f"{long} {long}a {long} {long} {long}a {long}a"), (None, "naïve ×÷×÷× Ÿabcde ŸABCDE naïve naïve ÀÀÀÀÀ ààààà " * 3)]
    got = result(documents(spark, rows))
    want = brute(rows)
    # Brute force does not pair the long words.
    assert [r[:1] + r[3:4] for r in got] == [r[:1] + r[3:4] for r in want]
    assert [r for r in got if len(r[0]) < 200] == [r for r in want if len(r[0]) < 200]
    assert {r[4] for r in got if len(r[0]) >= 3000} == {1}
    assert result(documents(spark, [(1, None), (2, ""), (3, "tiny words")])) == []
    assert result(documents(spark).limit(0)) == []


def test_roots_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(70)], "word string, form string")
    assert {(r["word"], r["root"]) for r in roots_of(forms).collect()} == {(f"w{i:03}", "w070") for i in range(70)}
