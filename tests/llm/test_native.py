import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, documents, mixed_texts
from tests.oracle import compare, connect
from tidewatch.llm import fingerprints as module
from tidewatch.llm.fingerprints import anchors, edit_report, fingerprints, likeness
from tidewatch.llm.pii import PII_SQL, find_pii, pii_report
from tidewatch.llm.queries import LLM_ORACLES
from tidewatch.llm.urls import RULES, judge_urls

TOKENS = [
    "a", "b.c", "@", "@", "x.com", ".org", "-", "1", "22", "255", "256", ".", ".", "4111111111111111", "4111 1111 1111 1111",
    "4111-1111-1111-1112", " ", "+", "(", "5", ")", "555", "1234567", "é", "\n", "_", "%", "GB82", "WEST", "1234", "5698", "7654", "32",
    "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "000", "card ", "",
]


def digits(v):
    return re.sub("[^0-9]", "", v)


def luhn(v):
    own = [int(c) for c in reversed(digits(v))]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(own)) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(v)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_equals_plain_expressions_and_sql(spark):
    rows = list(enumerate(mixed_texts(TOKENS, 3000, 16, 4)))
    got = {r["doc_id"]: r for r in pii_report(find_pii(documents(spark, rows))).collect()}
    for i, text in rows:
        want = brute(text)
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("iban")] == want, text
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    sql = con.sql(PII_SQL)
    assert sorted(sql.fetchall()) == sorted(tuple(got[i][c] for c in sql.columns) for i, _ in rows)


def test_pii_of_awkward_rows(spark):
    long = [(20, "4111111111111111 x " * 3000), (21, "1." * 20_000), (22, "+1" + " 2" * 30_000), (23, "a" * 50_000 + "@")]
    df = documents(spark, AWKWARD + long)
    got = pii_report(find_pii(df)).collect()
    assert len(got) == len(AWKWARD + long)
    by = {r["doc_id"]: r for r in got}
    assert by[20]["n_card"] == 3000 and by[21]["n_ip"] == 5000 and by[22]["n_phone"] == 0 and by[23]["n_email"] == 0
    assert by[1]["spans"] == by[2]["spans"] == ""
    assert find_pii(df.limit(0)).count() == 0


def test_pii_context_moves_the_score(spark):
    rows = [(1, "card number 4111111111111111"), (2, "number 4111111111111111"), (3, "account GB82WEST12345698765432")]
    got = {r["doc_id"]: r["spans"] for r in find_pii(documents(spark, rows)).collect()}
    assert got[1][0]["score"] > got[2][0]["score"] and got[3][0]["kind"] == "iban"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, sf) == ""


def edited(rows):
    out, rows = {}, sorted(rows, reverse=True)
    for i, (k, t) in enumerate(rows):
        cut, n = len(t) // 3, rows[(i + 1) % len(rows)][1]
        out[k] = hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest()
    return out


def test_fingerprints_of_edited_and_next_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet")
    got = edit_report(df).collect()
    want = edited([(r["doc_id"], r["text"]) for r in df.collect()])
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == want
    long = [r for r in got if r["n_chars"] > 500]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.4 and sum(r["near_next"] for r in long) / len(long) < 0.05
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_fingerprints_of_awkward_rows(spark):
    df = documents(spark)
    got = edit_report(df).collect()
    assert len(got) == len(AWKWARD) and edit_report(df.limit(0)).count() == 0
    same = [r["fingerprint"] for r in got if r["doc_id"] in (4, 5)]
    assert len(same) == 3 and len(set(same)) == 1
    assert {r["fingerprint"] for r in got if r["doc_id"] in (1, 2)} == {""}


def test_edits_do_not_move_other_anchors(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:150] + ["changed"] + words[151:])), (3, " ".join(reversed(words)))]
    own = fingerprints(documents(spark, rows)).select("doc_id", "neighbours")
    a, b = own.where("doc_id = 1"), own.where("doc_id > 1").toDF("other", "other_neighbours")
    near = a.join(b, how="cross").select("other", likeness("neighbours", "other_neighbours").alias("l"))
    got = {r["other"]: r["l"] for r in near.collect()}
    assert got[2] > 0.95 and got[3] < 0.1


def hashed(*values):
    """Hashes of texts and longs, chained as the seed of the next, as a signed number."""
    h = 42
    for v in values:
        h = xxhash.xxh64(v.encode() if isinstance(v, str) else (v % 2**64).to_bytes(8, "little"), seed=h).intdigest()
    return h - 2**64 if h >= 2**63 else h


def plainly(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text.replace("Σ", "σ").lower()).strip(" ")


def hashes_of(text, k=10, s=5):
    """The fingerprint of a text by comparing every k-mer with its inner substrings."""
    text = plainly(text)
    if not text:
        return set()
    found = []
    if len(text) < k:
        found = [(hashed(text) % 2**64 >> 29, 0)]
    else:
        inner = [hashed(text[i : i + s]) for i in range(len(text) - s + 1)]
        for i in range(len(text) - k + 1):
            if min(inner[i], inner[i + k - s]) <= min(inner[i + 1 : i + k - s]):
                found.append((hashed(inner[i], inner[i + k - s]) % 2**64 >> 29, i))
    pairs = [hashed(a, b, j - i) for (a, i), (b, j) in zip(found, found[1:], strict=False)]
    if found:
        pairs.append(hashed(found[-1][0]))
    return {p % 2**64 >> 32 for p in pairs}


def reported(rows):
    """(id, fingerprint, edited fingerprint, near_edited, near_next) in plain Python; ids of None come last."""
    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (hashed(r[1]), r[1]))
    rows.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    rows = [r for key in dict.fromkeys(r[0] for r in rows) for r in sorted((x for x in rows if x[0] == key), key=lambda r: (hashed(r[1]), r[1]))]
    out = []
    for (i, t), (_, following) in zip(rows, [*rows[1:], rows[0]] if rows else [], strict=True):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        own, after, changed = hashes_of(t), hashes_of(following), hashes_of(edited)
        out.append((i, hashlib.sha256(edited.encode()).hexdigest(), own, changed, round(like(own, changed), 9), round(like(own, after), 9)))
    return sorted(out, key=repr)


def report_of(df):
    def parts(v):
        return {int(v[j + 1 : j + 9], 16) for j in range(0, len(v), 9)}

    got = edit_report(df).collect()
    assert all(len(parts(r["fingerprint"])) * 9 == len(r["fingerprint"]) for r in got)
    assert {v for r in got for v in r["fingerprint"][::9]} <= {"1"}
    return sorted(
        (
            (r["doc_id"], r["edited_sha256"], parts(r["fingerprint"]), parts(r["edited_fingerprint"]), round(r["near_edited"], 9), round(r["near_next"], 9))
            for r in got
        ),
        key=repr,
    )


def test_fingerprints_equal_plain_python(spark, sf):
    rng = random.Random(8)
    pieces = ["Word ", "ΣΑΣ", " ", "\n\t", "x", "İ", "éa", "中文字", "0123456789", "the same line of text again "]
    rows = list(enumerate(mixed_texts(pieces, 250, 14, 9))) + [(1000 + i, " " * i + "ab" + " " * i) for i in range(6)]
    rows += [(2000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rng.shuffle(rows)
    assert report_of(documents(spark, rows)) == reported(rows)
    assert report_of(documents(spark, AWKWARD[:7] + AWKWARD[8:])) == reported(AWKWARD[:7] + AWKWARD[8:])


def test_only_the_seam_of_an_edited_text_is_read(spark):
    rng = random.Random(12)
    parts = ["", "a", "ab cd", "0123456789", *(plainly("".join(rng.choice("abcd ") for _ in range(n))) for n in (8, 11, 14, 19, 30, 45, 900))]
    ways = (("", ""), (" ", "xyz"), ("", "and so on it went"))
    rows = [(a, b, gap if a and b else "", a + more, b + more) for a in parts for b in parts for gap, more in ways]
    df = spark.createDataFrame(rows, "_front string, _back string, _gap string, mine string, after string")
    df = df.withColumns({c: F.expr(module.links(module.anchors(t))) for c, t in (("own", "mine"), ("next_own", "after"))})
    df = df.withColumns({f"{c}_hashes": F.expr(module.hashes(c)) for c in ("own", "next_own")})
    got = module.spliced(df).selectExpr("_front", "_gap", "_back", "edited", "own_hashes", "_rest", "size(_seam) AS seam").collect()
    assert len(got) == len(rows)
    for r in got:
        assert set(r["edited"]) == hashes_of(r["_front"] + r["_gap"] + r["_back"])
        assert set(r["edited"]) <= set(r["own_hashes"]) | set(r["_rest"])
        assert r["seam"] < 20


def test_neighbours_in_id_order_for_any_id(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE_ROWS", 5)
    rng = random.Random(10)
    texts = mixed_texts(["one ", "two ", "three ", "x"], 240, 12, 11)
    for key in (
        lambda i: None if i % 3 == 0 else 7 if i % 3 == 1 else i,
        lambda i: None if i % 5 == 0 else f"https://same.org/{rng.randrange(40):02}",
        lambda i: None,
    ):
        rows = [(key(i), t) for i, t in enumerate(texts)] + [(key(1), texts[1])] * 30
        kind = "string" if any(isinstance(i, str) for i, _ in rows) else "long"
        df = spark.createDataFrame([(i, t, 1) for i, t in rows], f"doc_id {kind}, text string, neighbours int")
        assert report_of(df) == reported(rows)
    cut = module.slices(df.withColumn("tie", module.F.xxhash64("text")), "doc_id", "tie")
    assert cut.groupBy("_slice", "_part").count().agg({"count": "max"}).first()[0] < 60


def near_next(spark, pairs):
    rows = [(2 * i + 1 - j, t) for i, pair in enumerate(pairs) for j, t in enumerate(pair)]
    got = {r["doc_id"]: r["near_next"] for r in edit_report(documents(spark, rows)).collect()}
    return [got[2 * i + 1] for i in range(len(pairs))]


def test_near_copies_of_any_length_and_script(spark):
    rng = random.Random(6)
    words = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    solid, burmese = ("".join(rng.choice(c) for _ in range(2000)) for c in ("abcdefghijklmnopqrstuvwxyz0123456789+/", "ကခဂဃငစဆဇဈညတထဒဓန"))
    pairs = [(words[:260], words[:250]), (words[:250], words[:260]), (words[:300], words[:200])]
    pairs += [(t, t[:900] + "xyz" + t[901:]) for t in (solid, burmese)]
    got = near_next(spark, pairs)
    assert min(got[:2]) > 0.9 and 0.6 < got[2] < 0.7 and min(got[3:]) > 0.95


def test_anchors_match_in_place_over_the_whole_text(spark):
    rng = random.Random(7)

    def prose(n):
        return [f"{rng.choice('bcdfg')}{rng.randrange(10**5)}" for _ in range(n)]

    long, passage = prose(5000), prose(80)
    moved = (" ".join(long), " ".join(["one", *long[:2500], "inserted", *long[2500:]]))
    shared = tuple(" ".join(prose(a) + passage + prose(b)) for a, b in ((1000, 3000), (3500, 500)))
    twice = near_next(spark, [moved, shared, (" ".join(prose(4000)), " ".join(prose(4000)))])
    assert twice[0] > 0.99 and 80 / 8080 * 0.7 < twice[1] < 80 / 8080 * 1.3 and twice[2] == 0


def by_rules(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "x", "http://", "http://A.com", "http://A.com/?q", "HTTPS://www.Example.COM/en/a?b=1#c", "http://b.example.com/en/", "http://n.net/es/é",
    "http://net/fr/", "http://xnet/fr/", "http://n.net/en/1", "http://n.org/en/" + "a" * 50_000, "http://h?x=/en/", "a://b://c/d",
]


def test_urls_by_rules_and_trees(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(i - 100, u) for i, u in enumerate(URLS)] + [(None, URLS[6]), (-94, URLS[6])], "page_id long, url string")
    rows = pages.union(extra).selectExpr("page_id", "url", "'x' AS host", "1 AS length", "'y' AS suffix", "0 AS label")
    urls = {r["page_id"]: r["url"] for r in rows.collect()}
    got = judge_urls(rows).collect()
    assert len(got) == rows.count()
    for r in got:
        host, path, rule, verdict = by_rules(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0.5 else "allow"))


def test_trees_agree_with_the_rules_they_learned(spark, sf):
    got = judge_urls(spark.read.parquet(f"{sf}/../sf0.01/pages.parquet")).where("rule IS NOT NULL").collect()
    right = [(r["score"] > 0.5) == (r["verdict"] == "block") for r in got]
    assert sum(right) / len(right) > 0.9


def test_urls_without_labels(spark):
    one = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in judge_urls(one).collect()} == {"allow"}
    assert judge_urls(one.limit(0)).count() == 0
    block = spark.createDataFrame([(1, "http://a.net/es/x"), (2, "http://b.org/")], "page_id long, url string")
    assert {r["verdict"] for r in judge_urls(block).collect()} == {"block"}


def test_hot_urls_are_drawn_once(spark):
    rows = [(i, "http://a.com/x" if i % 2 else "http://b.net/es/y") for i in range(30_000)] + [(-1, "http://c.org/z")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"))
    counts = {(r["rule"], r["verdict"]): r["count"] for r in got.groupBy("rule", "verdict").count().collect()}
    assert counts["com/", "allow"] == 15_000 and counts["net/es/", "block"] == 15_000 and sum(counts.values()) == 30_001


def test_bytewise_anchors_equal_those_cut_out_by_characters(spark):
    assert "substring(b, i, 5)" in anchors("t")
    plain = "the quick brown fox jumps over the lazy dog 0123456789 and so on until it ends"
    rows = [(t,) for t in ("", "a", "abcde", "abcdefghi", "abcdefghij", "a" * 40, plain)]
    # A wide character that only the end has leaves the anchors before it in their places.
    both = spark.createDataFrame(rows, "t string").selectExpr("t", "concat(t, 'é') AS w")
    for r in both.selectExpr("length(t) AS n", f"{anchors('t')} AS a", f"{anchors('w')} AS b").collect():
        if r.n < 10:
            assert len(r.a) == (r.n > 0)
        else:
            assert r.a == [x for x in r.b if x & (2**28 - 1) <= r.n - 10]
