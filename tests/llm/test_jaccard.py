import os
import random
import re
import time
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tests.llm.helpers import AWKWARD, documents
from tidewatch.llm import jaccard
from tidewatch.llm.batches import pieces
from tidewatch.llm.components import connected
from tidewatch.llm.jaccard import bands_used, bits_apart, empty_segments, keep_one, leading, likely, ngram_components, segments, signatures, sketch
from tidewatch.llm.shingles import shingle_sets
from tidewatch.session import SHUFFLE_CLEANUP, scratch_path, shared_dir, stored


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[j : j + 5]) for j in range(len(words) - 4))


def brute(rows):
    """(id, size, least id reachable) by comparing all pairs that share a shingle."""
    sets, parent, where, groups = [shingles(t) for _, t in rows], list(range(len(rows))), defaultdict(list), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in where[x]:
                common[j] += 1
            where[x].append(i)
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))), key=repr)


def result(spark, rows):
    got = ngram_components(documents(spark, rows).repartition(3)).collect()
    return sorted((tuple(r) for r in got), key=repr)


def edited(rng, words, share):
    return [rng.choice(["new", "other", "third"]) + str(rng.random()) if rng.random() < share else w for w in words]


def family(rng, n_words, size, most):
    base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    return [" ".join(edited(rng, base, rng.random() * most)) for _ in range(size)]


def test_families_passages_and_lines_equal_brute_force(spark):
    rng = random.Random(5)
    line = "this line opens very many of all the documents here"
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for n_words in (7, 9, 12, 30, 150, 600):
        texts += family(rng, n_words, 60, 0.06)
        texts += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(n_words)) + " " + passage for _ in range(20)]
        texts += [line + " " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(n_words)) for _ in range(60)]
    texts += [texts[0]] * 30 + [texts[200]] * 3 + ["one two", "One  two", "", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_small_limits_send_everything_through_all_indexes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng = random.Random(6)
    texts = family(rng, 40, 50, 0.1) + family(rng, 8, 40, 0.2)
    rows = list(enumerate(texts))
    assert result(spark, rows) == brute(rows)


def test_a_large_family_puts_out_few_links(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(2000):
        own = list(base)
        for at in rng.sample(range(120), rng.randint(1, 3)):
            own[at] = f"x{i}_{at}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    links = []
    in_blocks = jaccard.in_blocks

    def counted(*args):
        out = in_blocks(*args)
        links.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "in_blocks", counted)
    got = result(spark, rows)
    assert got == brute(rows)
    # A set lies in two classes of at most six blocks, and a pair of blocks gives fewer links than it has sets.
    assert sum(links) < 12 * len(rows)


def test_awkward_rows(spark):
    assert result(spark, AWKWARD) == brute(AWKWARD)
    assert ngram_components(documents(spark).limit(0)).count() == 0


def test_pairs_at_the_threshold_share_signatures():
    rng = np.random.default_rng(3)
    for n in (4, 5, 8, 15, 16, 31, 33, 100, 257, 1000):
        for larger in range(n, n * 5 // 4 + 1):
            common = -(-4 * (n + larger) // 9)
            if common > n or rng.random() > 60 / n:
                continue
            pool = rng.integers(0, 2**63, n + larger - common, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n:]]))
            assert len(np.intersect1d(a, b)) * 100 >= 80 * len(np.union1d(a, b))
            shared = set(bands_used(len(a))) & set(bands_used(len(b)))
            assert shared
            for second in (False, True):
                keys = [np.concatenate([signatures(x, k, second) for k in shared]) for x in (a, b)]
                if second or leading(n) > 6:
                    assert len(np.intersect1d(*keys))


def test_shingle_sets_tell_texts_apart_as_words_do():
    texts = ["a b c d e f", "A b  c\nd e F", "a b c d e", "a b c", "ab c", "", None, "a b c d e f a b c d e f"]
    got = [frozenset(s.tolist()) for s in shingle_sets(texts)]
    want = [shingles(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 40)]
    got = {r["h"]: r["root"] for r in connected(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)}


def test_keep_one_keeps_least_and_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = documents(spark, [(3, text), (2, text), (2, text), (9, text + " end"), (5, "other text"), (None, text), (6, None)])
    got = keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted([2, 5, 6, None], key=repr)


def test_keep_one_judges_every_text_of_an_id(spark):
    w, u = (" ".join(f"{c}{i}" for i in range(30)) for c in "wu")
    rows = [(1, w), (2, w), (2, u), (3, u), (4, None), (4, None), (5, ""), (None, w)]
    got = keep_one(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted([(1, w), (2, u), (4, None), (5, ""), (None, w)], key=repr)
    assert keep_one(documents(spark, rows).limit(0)).count() == 0


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for n in (4, 31, 32, 33, 300, 2000):
        for apart in (0, 1, n // 4, n):
            pool = np.unique(rng.integers(0, 2**63, 2 * n + apart, np.uint64))
            a, b = pool[:n], np.sort(np.concatenate([pool[: n - apart // 2], pool[n : n + apart]]))
            assert bits_apart(sketch(a), sketch(b)) <= len(np.setxor1d(a, b))
            assert bits_apart(sketch(a), sketch(b)) == bits_apart(sketch(b), sketch(a))
        assert [empty_segments(a, k) for k in bands_used(n)] == [int((segments(a, k, False)[1] == 0).sum()) for k in bands_used(n)]


def test_unlike_pairs_are_dropped_before_their_texts_are_read(spark):
    pool = [np.arange(low, low + 200, dtype=np.uint64) for low in (0, 10, 120)]
    rows = [(i, len(s), bytearray(sketch(s))) for i, s in enumerate(pool)]
    texts = spark.createDataFrame(rows, "h long, n long, sketch binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    assert [tuple(r) for r in likely(pairs, texts).collect()] == [(0, 1)]


def group(rng, n, kinds, batches=10):
    """Entries of one group, as `repeated_keys` packs them, and the same as (key, handle)."""
    rows, packed = [], []
    for _ in range(batches):
        key = np.sort(rng.integers(0, kinds, n // batches).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        handle = rng.integers(-(2**40), 2**40, 300)[rng.integers(0, 300, len(key))]
        rows += zip(key.view(np.int64).tolist(), handle.tolist(), strict=True)
        packed.append(jaccard._packed(key, handle))
    return pa.chunked_array([pa.array(packed[:4], pa.binary()), pa.array(packed[4:], pa.binary())]), rows


def test_what_meets_in_a_group_equals_a_plain_count():
    for n, kinds in ((2000, 500), (60, 1000), (60, 1), (0, 1)):
        entries, rows = group(np.random.default_rng(n + kinds), n, kinds)
        held = defaultdict(set)
        for key, handle in rows:
            held[key].add(handle)
        want = sorted((k, h, min(v), len(v)) for k, v in held.items() if len(v) > 1 for h in v)
        assert sorted(tuple(r.values()) for r in jaccard.keys_met(entries).to_pylist()) == want
        root = {h: h for _, h, _, _ in want}

        def top(h, root=root):
            while root[h] != h:
                h = root[h]
            return h

        for _, h, pivot, _ in want:
            low, high = sorted((top(h), top(pivot)))
            root[high] = low
        assert {(r["a"], r["b"]) for r in jaccard.links_met(entries).to_pylist()} == {(h, top(h)) for h in root if top(h) != h}


def test_a_full_group_takes_little_memory():
    n = jaccard.GROUP_BYTES // 16
    entries, _ = group(np.random.default_rng(7), n, n // 2)
    for met in (jaccard.keys_met, jaccard.links_met):
        tracemalloc.start()
        met(entries)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80_000_000


def test_only_the_rows_of_a_piece_become_objects():
    batch = pa.RecordBatch.from_pydict({"text": [f"{i} " + "x" * 4000 for i in range(5000)]})
    tracemalloc.start()
    sizes = [sum(map(len, part["text"])) for part in pieces([batch], "text", 500_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert max(sizes) <= 500_000 and sum(sizes) > 20_000_000
    assert peak < 5_000_000


def test_unlike_sets_seldom_meet_in_the_second_index():
    rng = np.random.default_rng(9)
    for n in (18, 66, 130, 262, 520):
        held = defaultdict(int)
        for _ in range(150):
            own = np.sort(rng.integers(0, 2**63, n, dtype=np.uint64))
            for k in bands_used(n):
                for key in signatures(own, k, True).tolist():
                    held[key] += 1
        assert sum(c > 1 for c in held.values()) <= 6


def test_parts_of_a_band_cover_every_pair_that_may_link():
    for n in [*range(4, 140), 255, 256, 257, 322, 323, 407, 511, 512]:
        for larger in range(n, n * 5 // 4 + 1):
            band = bands_used(n)[0]
            assert band in bands_used(larger)
            mine = next(k for k in range(jaccard.PARTS) if jaccard.part_end(band, k) > n)
            assert mine in jaccard.parts_used(n, band) and mine in jaccard.parts_used(larger, band)


def test_texts_of_a_cluster_are_moved_twice_while_a_block_holds_them(spark):
    sets = spark.range(1500).selectExpr("id AS h", "'some text' AS text")
    apart = spark.range(1500).selectExpr("id AS h", "200 + id % 40 AS n", "id AS root", "0L AS cluster")
    assert jaccard.dealt(sets, apart).count() <= 2 * 1500
    assert jaccard.dealt(sets, apart.selectExpr("h", "n", "0L AS root", "cluster")).count() == 0
    # A block has as many elements as a worker can hold, whatever the sets' sizes.
    large = jaccard.dealt(sets.where("h < 90"), apart.where("h < 90").selectExpr("h", "20000L AS n", "root", "cluster"))
    assert max(r["count"] for r in large.groupBy("class", "low", "high").count().collect()) < 80


def test_a_crowded_cluster_is_split_by_another_partition(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rng = random.Random(12)
    texts = []
    for i in range(60):  # every text shares four shingles with the next one
        words = [f"w{i}_{j}" for j in range(100)]
        texts.append(" ".join([f"s{i}_{j}" for j in range(8)] + words + [f"s{i + 1}_{j}" for j in range(8)]))
    like = family(rng, 100, 30, 0.04)
    rows = [(i, len(shingles(t)), t) for i, t in enumerate(texts + like)]
    handles = [jaccard.handle_of(shingle_sets([t])[0], frozenset())[0] for _, _, t in rows]
    second = spark.createDataFrame([(h, n, t) for h, (_, n, t) in zip(handles, rows, strict=True)], "h long, n long, text string").distinct()
    turns = []

    def kept(df, label):
        turns.append(label)
        return stored(df, scratch_path(spark, label))

    roots = spark.createDataFrame([], "h long, root long")
    got = {r["h"]: r["cluster"] for r in jaccard.clustered(second, roots, kept, frozenset()).collect()}
    assert "clusters-1" in turns
    assert len({got[h] for h in set(handles[60:])}) == 1  # the family stays together
    assert sum(got.get(h) == got[handles[60]] for h in handles[:60]) == 0


def shuffle_files(spark):
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in top for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_of_a_stored_table_go_with_its_write(spark):
    before = shuffle_files(spark)
    got = stored(spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count(), scratch_path(spark, "stored-test"))
    limit = time.time() + 20
    while shuffle_files(spark) - before and time.time() < limit:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert got.count() == 10
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_work_tables_that_the_result_does_not_read_are_removed(spark):
    top = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    rng = random.Random(14)
    rows = list(enumerate(family(rng, 40, 30, 0.1)))
    got = ngram_components(documents(spark, rows))
    kinds = {re.sub("-[0-9a-f]{32}$", "", f) for f in set(os.listdir(top)) - before}
    assert {"ngram-sets", "ngram-distinct", "ngram-components"} <= kinds <= {"ngram-sets", "ngram-distinct", "ngram-components", "labels"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
