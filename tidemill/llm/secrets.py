"""Secret scan over a ledger of content-addressed blobs, native.

Every version of a path is addressed by the SHA-256 of its text. The ledger holds a row for each
(blob, rule version) that was ever scanned, with the spans found, also when there are none. A run
scans only pairs that the ledger lacks, each blob once however many paths or copies share it, and
joins the findings back to all paths.

Defined cases: null text is the empty blob; null paths and repeated rows are versions like others
(each gets the findings of its blob); an empty table gives an empty ledger and no findings; texts
are scanned whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settled, text_or_empty

SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping; with ``group``, only those whose
    group has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(words: str) -> str:
    """A pattern whose ASCII letters match in both cases, in any regular expression dialect."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The kinds that are asked for. The last two are written with the least length inside
# the pattern, which gives the same matches: a run that is too short holds no match at all.
_NAMES = either_case("(password|passwd|secret|token|api_?key)")
BASE = (
    Rule("assign", _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds: key blocks, signed web tokens, prefixed service tokens, passwords in addresses.
FURTHER = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"://[^/\x20\x09-\x0D:@]{1,128}:[^/\x20\x09-\x0D:@]{1,128}@"),
)
RULES: dict[str, tuple[Rule, ...]] = {"base-1": BASE, "further-1": FURTHER}


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of a rule as (start, number of the kind, end), in code points, end exclusive.

    The pieces between matches give the positions, as no function returns all of them."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    rows = F.zip_with(
        F.slice(gaps, 1, F.size(whole)),
        F.zip_with(whole, checked, lambda m, g: F.struct(F.length(m).alias("n"), F.length(g).alias("g"))),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["n"].alias("n"), (m["g"] >= rule.least).alias("ok")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
    found = F.aggregate(rows, start, lambda acc, r: F.struct(
        (acc["at"] + r["gap"] + r["n"]).alias("at"),
        F.when(r["ok"], F.array_append(acc["out"], F.struct(
            (acc["at"] + r["gap"]).alias("start"), F.lit(number).alias("kind"),
            (acc["at"] + r["gap"] + r["n"]).alias("end")))).otherwise(acc["out"]).alias("out")))
    return F.when(text.rlike(rule.pattern), found["out"]).otherwise(F.array().cast(SPANS))


def kinds(rules: Mapping[str, Sequence[Rule]] = RULES) -> list[str]:
    return [r.kind for version in rules.values() for r in version]


def scan_versions(
    versions: DataFrame, ledger: DataFrame | None = None, rules: Mapping[str, Sequence[Rule]] = RULES
) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows) for ``versions`` (path, text).

    Findings: path, blob, spans, a row for each row of ``versions``; spans are sorted by start and
    kind (the place of the kind in ``rules``). Ledger: blob, rule_version, spans. Append the new
    rows to the stored ledger and pass that to the next run.
    """
    order = kinds(rules)
    blob = F.sha2(text_or_empty().cast("binary"), 256)
    paths = settled(versions.select("path", blob.alias("blob")))
    firsts = paths.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is None:
        todo = firsts.withColumn("todo", F.array(*map(F.lit, rules)))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
        todo = firsts.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(F.array(*map(F.lit, rules)), F.coalesce("seen", F.array().cast("array<string>")))
        ).filter(F.size("todo") > 0)
    todo = todo.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "todo")
    texts = versions.select("path", text_or_empty().alias("text")).withColumn(
        "blob", F.sha2(F.col("text").cast("binary"), 256))
    unseen = texts.join(todo, F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob")))
    scanned = [
        F.when(F.array_contains("todo", version), F.struct(
            F.lit(version).alias("rule_version"),
            F.concat(*(_spans(F.col("text"), r, order.index(r.kind)) for r in of)).alias("spans")))
        for version, of in rules.items()
    ]
    new = settled(
        unseen.select("blob", F.explode(F.array_compact(F.array(*scanned))).alias("s"))
        .select("blob", "s.*").dropDuplicates(["blob", "rule_version"]))
    known = new if ledger is None else ledger.filter(F.col("rule_version").isin(*rules)).unionByName(new)
    hits = known.filter(F.size("spans") > 0).groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_found"))
    findings = paths.join(hits, "blob", "left").select(
        "path", "blob", F.coalesce("_found", F.array().cast(SPANS)).alias("spans"))
    return findings, new


def count_of(kind: str, order: Sequence[str]) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == order.index(kind))).cast("long")


def written(spans: Column, order: Sequence[str]) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, order))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def document_findings(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """The findings per document with counts and digest of the base kinds."""
    found, _ = scan_versions(docs.select(F.col("doc_id").alias("path"), "text"), ledger)
    order = kinds()
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *(count_of(r.kind, order).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(written(base, order), 256).alias("base_sha256"),
        written(F.col("spans"), order).alias("spans"),
    )


def oracle() -> str:
    """The same in the SQL of an embedded database."""
    parts = []
    for number, r in enumerate(r for of in RULES.values() for r in of):
        p = r.pattern.replace("'", "''")
        group = f"regexp_extract_all(t, '{p}', {r.group})" if r.group else "m"
        parts.append(f"""
  SELECT doc_id, {number} AS k, '{r.kind}' AS kind, s, s + length(m) AS e FROM (
    SELECT doc_id, m, g, i, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER v, 0) AS s FROM (
      SELECT doc_id, unnest(m) AS m, unnest(g) AS g, unnest(gaps[1:len(m)]) AS gap,
             generate_subscripts(m, 1) AS i FROM (
        SELECT doc_id, m, {group} AS g, regexp_split_to_array(t, '{p}') AS gaps FROM (
          SELECT doc_id, t, regexp_extract_all(t, '{p}') AS m FROM d) WHERE len(m) > 0))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i),
           v AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE length(g) >= {r.least}""")
    union = "\n  UNION ALL".join(parts)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    one = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({union}),
h AS (SELECT doc_id, {counts},
        string_agg({one}, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS b,
        string_agg({one}, ',' ORDER BY s, k) AS a FROM f GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN h ON d.doc_id = h.doc_id"""
