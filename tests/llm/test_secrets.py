import hashlib
import re

import pytest

from tests.llm.helpers import documents, mixed_texts
from tidewatch.llm.automaton import Automaton
from tidewatch.llm.secrets import RULES, find, redact_secrets, scan_secrets, secret_report

TOKENS = [
    "password", "pass", "passwd", "token", "secret", "api_key", "apikey", "PASSWORD", " ", " ", '"', "'", ":", "=", "=", "abc",
    "AKIA", "AKIA", "ABCDEF123456", "0123456789abcdef", "é", "\n", "x", "ghp_", "deadbeef", "-", ".", "",
]
BASE = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def brute(text):
    """Base spans by plain regular expressions, by start, then kind as listed."""
    hits = [
        (m.start(), i, m.end())
        for i, (_, pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [f"{BASE[i][0]}:{a}:{b}" for a, i, b in sorted(hits)]


@pytest.fixture(scope="module")
def automaton():
    return Automaton([r.pattern for r in RULES])


def test_base_spans_equal_plain_expressions(automaton):
    for text in mixed_texts(TOKENS, 5000, 25, 1):
        got = [f"{k}:{a}:{b}" for k, a, b, base in find(automaton, RULES, text) if base]
        assert got == brute(text), text


def test_added_kinds_and_offsets_in_code_points(automaton):
    text = "ééé ghp_" + "a1B2" * 10 + " -----BEGIN RSA PRIVATE KEY----- AIza" + "x" * 35 + " gho_short"
    got = {(k, text[a:b]) for k, a, b, _ in find(automaton, RULES, text)}
    assert got == {
        ("github", "ghp_" + "a1B2" * 10), ("private_key", "-----BEGIN RSA PRIVATE KEY-----"), ("google", "AIza" + "x" * 35),
    }


def test_rules_that_cannot_be_scanned_in_one_pass_are_refused():
    for pattern in ("ab*c|a", "[^a]", "é+", "a(?=b)"):
        with pytest.raises(ValueError):
            Automaton([pattern])


def test_report_on_awkward_rows(spark):
    df = documents(spark)
    got = secret_report(scan_secrets(df)).collect()
    assert len(got) == df.count()
    for row, (_, text) in zip(got, [(r["doc_id"], r["text"]) for r in df.collect()], strict=True):
        assert row["base_sha256"] == hashlib.sha256(",".join(brute(text)).encode()).hexdigest()
    assert scan_secrets(df.limit(0)).count() == 0


def test_redaction_masks_and_keeps_rows(spark):
    df = documents(spark, [(1, "a token = '0123456789abcdef0123' b"), (2, None), (3, "clean")])
    got = {r["doc_id"]: r for r in redact_secrets(df).collect()}
    assert got[1]["text"] == "a [secret]' b" and got[2]["text"] is None and got[3]["text"] == "clean"
    assert got[1]["spans"] == "kept"


def test_query_on_whole_table(spark, sf):
    from tidewatch.llm.queries import LLM_QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = LLM_QUERIES["op1_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k, *_ in BASE] == [sum(w.startswith(k) for w in want) for k, *_ in BASE]
