import random
import tracemalloc

import pytest

from tests.llm.helpers import AWKWARD, documents
from tidewatch.llm import decontaminate
from tidewatch.llm.decontaminate import Benchmark, budget, drop_leaks, find_leaks, normalised


def text_of(codes):
    return codes.tobytes().decode("utf-32-le")


def least_edits(pattern, text):
    before = [0] * (len(text) + 1)
    for c in pattern:
        now = [before[0] + 1]
        for j, x in enumerate(text):
            now.append(min(before[j] + (x != c), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_edited_copies_equal_the_plain_alignment(spark, sf):
    rng = random.Random(3)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    index = Benchmark.of(items)
    for k in range(60):
        item, text = rng.choice(items)
        chars = list(text.upper() if k % 3 == 0 else text)
        for _ in range(rng.randint(0, int(budget(len(text)) * 1.3) + 1)):
            r, kind = rng.randrange(len(chars)), rng.random()
            if kind < 0.4:
                chars[r] = rng.choice("abxyz")
            elif kind < 0.7:
                del chars[r]
            else:
                chars.insert(r, rng.choice("abxyz"))
        body = texts[k % 50][: rng.randint(0, 300)] + " \n " + "".join(chars) + "  " + texts[k % 50 + 1][: rng.randint(0, 300)]
        found = {index.ids[i]: (a, b, e) for _, i, a, b, e in index.hits([body])}
        pattern, own = text_of(index.items[index.ids.index(item)]), text_of(normalised(body)[0])
        edits = least_edits(pattern, own)
        assert (item in found) == (edits <= budget(len(pattern)))
        if item in found:
            a, b, e = found[item]
            assert e == edits and least_edits(pattern, text_of(normalised(body[a:b])[0])) == edits


def test_planted_items_and_clean_documents(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    benchmark = [(r["item_id"], r["text"]) for r in items.collect()]
    want = {(d["doc_id"], i) for d in docs.collect() for i, t in benchmark if t in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, items).collect()}
    assert want and got == want
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in want})


def test_short_items_beside_a_long_one():
    rng = random.Random(5)

    def prose(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)).replace("  ", "x ").strip()

    items = [(0, prose(2000)), *[(i, prose(60)) for i in range(1, 30)]]
    texts, want = [], {}
    for i in range(1, 30):
        own = items[i][1]
        near = own[:20] + "é" + own[21:40] + own[41:]
        for parts in ([own], [prose(40), own], [own, prose(40)], [near], [own, prose(15), own, own], [prose(70)], [items[0][1][:300]]):
            n = sum(p in (own, near) for p in parts)
            want |= {(len(texts), i): n} if n else {}
            texts.append(" ".join(parts))
    texts.append(prose(500) + items[0][1].replace("e", "é", 100))
    want[len(texts) - 1, 0] = 1
    order = list(range(len(texts)))
    # Which texts come together must not matter.
    for _ in range(3):
        rng.shuffle(order)
        got: dict = {}
        for t, i, start, end, edits in Benchmark.of(items).hits([texts[k] for k in order]):
            got[order[t], i] = got.get((order[t], i), 0) + 1
            assert edits == least_edits(items[i][1], texts[order[t]][start:end]) <= budget(len(items[i][1]))
        assert got == want


def test_copies_of_a_repetitive_item_are_all_found():
    item = "abc" * 33 + "a"
    got = [(a, b) for _, _, a, b, _ in Benchmark.of([(1, item)]).hits(["abc" * 67 + "a"])]
    assert got[:2] == [(0, 100), (102, 202)]


def test_awkward_rows_and_items(spark, monkeypatch):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "same"), (4, "SAME text same\ntext same text"), (5, "中文")], "item_id long, text string")
    docs = documents(spark)
    want = {(4, 3): 4, (5, 3): 4, (4, 4): 1, (5, 4): 1, (6, 5): 1}
    for chars in (4_000_000, 8):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        got: dict = {}
        for r in find_leaks(docs, items).collect():
            got[r["doc_id"], r["item_id"]] = got.get((r["doc_id"], r["item_id"]), 0) + 1
        # Document 4 is there twice.
        assert got == {k: n * (2 if k[0] == 4 else 1) for k, n in want.items()}
        assert sorted(r["doc_id"] or 0 for r in drop_leaks(docs, items).collect()) == [0, 1, 2, 3, 7, 8, 9]
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0
    assert drop_leaks(docs, items.limit(0)).count() == len(AWKWARD)


@pytest.mark.parametrize("length", [1, 7, 8, 12, 13, 20, 30, 100, 1000])
def test_budget_leaves_a_gram_to_count(length):
    e = budget(length)
    assert e <= 0.08 * length and (length < 8 or length + 1 - 8 * (e + 1) >= 1)


def test_repetitive_texts_take_bounded_memory(monkeypatch):
    rng = random.Random(12)
    items = [(1, "a" * 600), (2, "ab" * 200), (3, "some words that are not in there at all")]
    texts = ["a" * 5000, "ab" * 900 + "x", "b" + "a" * 599 + "c" * 50, "".join(rng.choice("ab") for _ in range(3000)), "", None]
    whole = list(Benchmark.of(items).hits(texts))
    assert {(t, i) for t, i, *_ in whole} >= {(0, 0), (1, 1), (2, 0)} and not [h for h in whole if h[1] == 2]
    monkeypatch.setattr(decontaminate, "MOST_HITS", 1000)
    assert list(Benchmark.of(items).hits(texts)) == whole
    monkeypatch.undo()
    index = Benchmark.of([(1, "a" * 2000)])
    tracemalloc.start()
    found = list(index.hits(["a" * 20_000]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 10 and peak < 600_000_000
