import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, documents
from tidewatch.llm.language import SWITCH, fit_language_model, identify, keep_identified, label_texts, viterbi
from tidewatch.llm.quality import fit_quality_model, score_quality
from tidewatch.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def table(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def model(table):
    return fit_language_model(table)


def slow_viterbi(scores, switch):
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        move = best[:, None] - switch * (1 - np.eye(len(best)))
        back.append(move.argmax(axis=0))
        best = move.max(axis=0) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], best.max()


def cost(scores, path, switch):
    return scores[np.arange(len(path)), path].sum() - switch * np.count_nonzero(np.diff(path))


def test_viterbi_equals_the_plain_recursion():
    rng = np.random.default_rng(1)
    sizes = [1, 30, 5, 30, 2, 90]
    text = np.repeat(np.arange(len(sizes)), sizes)
    scores = rng.normal(0, 3, (len(text), 4)).astype(np.float32)
    got = viterbi(scores, text, 4.0)
    for t in range(len(sizes)):
        own = scores[text == t].astype(float)
        _, best = slow_viterbi(own, 4.0)
        assert cost(own, got[text == t], 4.0) == pytest.approx(best)


def test_held_out_accuracy(spark, sf, table):
    langs = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    rows = LLM_QUERIES["op3_language_id"](spark, sf).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([langs[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_spans_of_mixed_text(table, model):
    by = {r["lang"]: r["text"][:400] for r in table.where("n_chars > 600").collect()}
    text = " ".join(by[k] for k in ("en", "de", "fr"))
    _, score, spans = label_texts(model, [text], SWITCH)[0]
    assert [s["lang"] for s in spans] == ["en", "de", "fr"] and score < 0.6
    assert abs(spans[1]["start"] - 401) < 30 and abs(spans[2]["start"] - 802) < 30


def test_language_of_awkward_rows(spark, model):
    df = documents(spark)
    got = identify(df, model, keep=["doc_id", "score", "source"]).collect()
    assert len(got) == len(AWKWARD)
    for row, (_, text) in zip(got, AWKWARD, strict=True):
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    assert identify(df.limit(0), model).count() == 0
    empty = fit_language_model(df.limit(0))
    assert {r["lang_pred"] for r in identify(df, empty).collect()} == {"und"}


def test_stage_keeps_clean_documents(table, model):
    kept = keep_identified(table, model, 0.3)
    assert kept.columns == table.columns and kept.count() == table.count()


def test_quality_on_held_out_rows(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/../sf0.01/labels.parquet").collect()}
    rows = [r for r in LLM_QUERIES["op5_quality"](spark, f"{sf}/../sf0.01").collect()]
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_of_awkward_rows(spark, sf, table):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fitted = fit_quality_model(table, labels, label="quality")
    df = documents(spark)
    got = score_quality(df, fitted, keep=["doc_id", "spans"]).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert got[0]["score"] == got[1]["score"] == pytest.approx(fitted.labels.mean())
    assert got[4]["score"] == got[5]["score"] == got[6]["score"]
    none = fit_quality_model(table, labels.limit(0), label="quality")
    assert none is None and {r["score"] for r in score_quality(df, none).collect()} == {0.5}


def test_neighbours_are_exact(spark, sf, table):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fitted = fit_quality_model(table, labels, label="quality")
    texts = [r["text"] for r in table.limit(20).collect()]
    from tidewatch.llm.quality import NEIGHBOURS, PRIOR, SHARPNESS, counts_of

    cosine = fitted.project(counts_of(texts)) @ fitted.vectors.T
    for got, row in zip(fitted.scores(texts), cosine, strict=True):
        top = np.argsort(-row)[:NEIGHBOURS]
        vote = row[top].astype(float).clip(min=0) ** SHARPNESS
        want = ((vote * fitted.labels[top]).sum() + PRIOR * fitted.labels.mean()) / (vote.sum() + PRIOR)
        assert got == pytest.approx(want, abs=1e-4)


def test_documents_stay_where_no_language_is_known(spark):
    df = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    got = keep_identified(df, fit_language_model(df), 0.3)
    assert got.columns == df.columns
    letters = [(i, t) for i, t in AWKWARD if t and any(c.isalpha() for c in t)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(letters, key=repr)
    assert keep_identified(df.limit(0), fit_language_model(df.limit(0)), 0.3).count() == 0
