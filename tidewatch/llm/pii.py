"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score. Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCAL = "A-Za-z0-9._%+-"
#: Characters before a span in which context words are looked for.
NEAR = 40
#: Matches whose places are summed together.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """`gate` must be in a text for the pattern to be tried; `valid` is SQL over `v`, the matched text.

    Possessive quantifiers and look-behinds keep every pattern linear and free of recursion on long runs; each finds what
    its plain form finds, because a match that fails from the start of a run fails from within the run too.
    """

    name: str
    pattern: str
    valid: str
    score: float
    context: str
    gate: str | None = None
    base: bool = True


DIGITS = "regexp_replace(v, '[^0-9]', '')"
LUHN = f"""aggregate(sequence(1, length({DIGITS})), 0, (a, i) -> a + (
    CASE WHEN i % 2 = 1 THEN int(substr(reverse({DIGITS}), i, 1))
         WHEN substr(reverse({DIGITS}), i, 1) >= '5' THEN 2 * int(substr(reverse({DIGITS}), i, 1)) - 9
         ELSE 2 * int(substr(reverse({DIGITS}), i, 1)) END)) % 10 = 0"""
TURNED = "concat(substr(replace(v, ' ', ''), 5), substr(replace(v, ' ', ''), 1, 4))"
MOD_97 = f"""aggregate(transform(filter(split({TURNED}, ''), c -> c <> ''), c -> ascii(c)), 0,
    (a, c) -> CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1"""
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Patterns and checks as the contract gives them; the account number is ISO 13616.
KINDS = (
    Kind(
        "email",
        rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true", 0.8, "mail|contact|write|correo|kontakt", "@",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", rf"v rlike r'^{BYTE}(?:\.{BYTE}){{3}}$'", 0.5, r"\bip\b|host|server|address|login",
    ),
    Kind(
        "card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){15,}+",
        f"CASE WHEN length({DIGITS}) BETWEEN 16 AND 19 THEN {LUHN} ELSE false END", 0.7, "card|visa|credit|pay|karte|tarjeta|carte",
    ),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({DIGITS}) BETWEEN 8 AND 15", 0.6, "phone|call|tel|mobil|fax", "+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9_])",
        MOD_97, 0.9, "iban|account|bank|konto|cuenta|compte", None, False,
    ),
)
SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"


def find_pii(df: DataFrame, id: str = "doc_id", text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per row of `df`: `id` and `spans`, an array of (kind, start, end, score) by kind as listed, then start.

    Matches are leftmost and do not overlap within a kind; one that fails its check is dropped and not tried again.
    Offsets count code points, ends are exclusive. The score starts from the kind's own, rises by 0.15 when a context word
    stands in the 40 characters before the span and falls by 0.1 otherwise. A null or empty text has no spans, a null id
    stays, repeated rows each give a row, an empty table gives none; other columns are not read. No shuffle.
    """
    rows = df.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    none = F.expr("cast(array() as array<string>)")
    matched, gaps = {}, {}
    for k in kinds:
        found = F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0))
        matched[f"m_{k.name}"] = F.when(F.contains("_text", F.lit(k.gate)), found).otherwise(none) if k.gate else found
        some = F.size(f"m_{k.name}") > 0
        gaps[f"g_{k.name}"] = F.when(some, F.split("_text", k.pattern, -1)).otherwise(none)
    rows = rows.withColumns(matched).withColumns(gaps)
    for columns in zip(*[_ends(k) for k in kinds], strict=True):
        rows = rows.withColumns({name: F.expr(sql) for step in columns for name, sql in step.items()})
    spans = F.concat(*[F.expr(_checked(k)) for k in kinds])
    return rows.select(F.col("_id").alias(id), spans.alias("spans"))


def _ends(k: Kind) -> list[dict[str, str]]:
    """Where every match ends, as columns made one after the other: lengths of every match with the text between it and
    the one before, cut into runs of BLOCK; totals before each run; running sums within runs. Cheap for very many matches,
    as long as no column stands inside a lambda, where it would be worked out again for every element.
    """
    n = k.name
    lengths = f"zip_with(slice(g_{n}, 1, size(m_{n})), m_{n}, (g, v) -> cast(length(g) + length(v) as bigint))"
    runs = f"transform(sequence(0, (size(l_{n}) - 1) div {BLOCK}), b -> slice(l_{n}, b * {BLOCK} + 1, {BLOCK}))"
    total = "element_at(acc, -1) + aggregate(run, 0L, (a, x) -> a + x)"
    totals = f"aggregate(c_{n}, array(0L), (acc, run) -> concat(acc, array({total})))"
    inside = "aggregate(run, array(base), (acc, x) -> concat(acc, array(element_at(acc, -1) + x)))"
    ends = f"flatten(zip_with(c_{n}, slice(t_{n}, 1, size(c_{n})), (run, base) -> slice({inside}, 2, {BLOCK})))"
    return [{f"l_{n}": lengths}, {f"c_{n}": runs}, {f"t_{n}": totals}, {f"e_{n}": ends}]


def _checked(k: Kind) -> str:
    """Matches of one kind that pass their check, as spans."""
    m = f"m_{k.name}"
    near = f"lower(right(x.g, {NEAR}))"
    gaps = f"zip_with(slice(g_{k.name}, 1, size({m})), {m}, (g, v) -> struct(g, v))"
    placed = f"zip_with({gaps}, e_{k.name}, (x, e) -> named_struct('v', x.v, 'end', e, 'near', {near}))"
    valid = k.valid.replace("regexp_replace(v,", "regexp_replace(s.v,").replace("replace(v,", "replace(s.v,").replace("v rlike", "s.v rlike")
    return f"""CASE WHEN size({m}) = 0 THEN cast(array() as array<{SPAN}>) ELSE
        transform(filter({placed}, s -> {valid}), s -> named_struct('kind', '{k.name}', 'start', s.end - length(s.v), 'end', s.end,
            'score', round(least(1.0D, {k.score}D + CASE WHEN s.near rlike r'{k.context}' THEN 0.15D ELSE -0.1D END), 2))) END"""


def pii_report(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts per base kind, the digest of base spans and all spans as text, from the rows of `find_pii`."""
    base = [k.name for k in KINDS if k.base]
    shown = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    named = ", ".join(f"'{k}'" for k in base)
    return found.select(
        id,
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base],
        F.expr(f"sha2({shown.format(f'filter(spans, s -> s.kind in ({named}))')}, 256)").alias("base_sha256"),
        F.expr(shown.format("spans")).alias("spans"),
        F.expr("coalesce(array_max(transform(spans, s -> s.score)), 0.0D)").alias("top_score"),
    )


def _sql_kind(no: int, k: Kind, pattern: str, valid: str) -> str:
    return f"""SELECT r, {no} AS no, '{k.name}' AS kind, m[i] AS v, lower(right(g[i], {NEAR})) AS near,
      {k.score}::DOUBLE AS score, '{k.context}' AS words,
      list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM d),
      unnest(range(1, len(m) + 1)) AS u(i) WHERE {valid}"""


_SQL_DIGITS = "regexp_replace(m[i], '[^0-9]', '', 'g')"
_SQL_LUHN = f"""list_sum(list_transform(range(1, length({_SQL_DIGITS}) + 1), lambda j:
    CASE WHEN j % 2 = 1 THEN CAST(substr(reverse({_SQL_DIGITS}), j, 1) AS INT)
         ELSE (2 * CAST(substr(reverse({_SQL_DIGITS}), j, 1) AS INT)) // 10 + (2 * CAST(substr(reverse({_SQL_DIGITS}), j, 1) AS INT)) % 10
    END)) % 10 = 0"""
_SQL_TURNED = "concat(substr(replace(m[i], ' ', ''), 5), substr(replace(m[i], ' ', ''), 1, 4))"
_SQL_97 = f"""list_reduce(list_prepend(0::BIGINT, list_transform(string_split({_SQL_TURNED}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1"""
_PLAIN = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(m[i], '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0"),
    (r"[0-9]([ -]?[0-9]){15,}", f"CASE WHEN length({_SQL_DIGITS}) BETWEEN 16 AND 19 THEN {_SQL_LUHN} ELSE false END"),
    (r"\+[0-9][ ().0-9-]+[0-9]", f"length({_SQL_DIGITS}) BETWEEN 8 AND 15"),
    (r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)\b", _SQL_97),
)
_SHOWN = "coalesce(string_agg(concat(kind, ':', start, ':', start + length(v)), ',' ORDER BY no, start){}, '')"
PII_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
  spans AS ({" UNION ALL ".join(_sql_kind(i, k, *_PLAIN[i]) for i, k in enumerate(KINDS))})
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)},
    sha256({_SHOWN.format(" FILTER (WHERE no < 4)")}) AS base_sha256, {_SHOWN.format(" FILTER (WHERE no >= 0)")} AS spans,
    coalesce(max(round(least(1.0, score + CASE WHEN regexp_matches(near, words) THEN 0.15 ELSE -0.1 END), 2)) FILTER (WHERE no >= 0), 0.0) AS top_score
  FROM d LEFT JOIN spans USING (r) GROUP BY r, doc_id"""
