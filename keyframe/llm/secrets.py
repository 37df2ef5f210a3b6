"""Secret scans: patterns, and multipart credentials linked by where their parts stand.

Base kinds are reported by themselves: ``assign`` (a value given to a secret's name), ``access``
(an access identifier) and ``hex``.  Weak kinds are not: ``ident`` (a user or client name),
``key`` (a run of 40 letters and digits) and ``endpoint`` (a URL, host or address).  The scope of a
part is the text within ``SCOPE`` characters of it, and an interval join of parts decides:

* a key is reported with an access identifier, ident or endpoint in its scope,
* an ident with a secret (assign, hex or key) in its scope,
* an endpoint with both a secret and an identifier in its scope.

A weak candidate that overlaps a base span is dropped.

Matches become rows, one window sum over the lengths between them gives their places, and parts meet by text and by
the bins of ``SCOPE`` characters that they reach, so a part is compared with its neighbourhood only, however long
the text.  A text stands for itself by a digest of 128 bits: copies are looked at once, and a text that has no part
at all is not moved.  Spans count code points, ends are exclusive.

Defined results: a null text is an empty one and has no spans; repeated rows get equal results; a
match of several kinds is reported by each base kind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyframe.llm.stage import boxed, documents, staged, unboxed

SCOPE = 200
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
BASE = KINDS[:3]
PLACEHOLDER = "[SECRET]"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The part before a value: a name, maybe quoted, and an assignment.
_GIVES = "[\"']?\\x20*[:=]\\x20*[\"']?"
_SECRET_NAMES = _either_case("(password|passwd|secret|token|api_?key)")
_USER_NAMES = _either_case("(client_id|access_key_id|username|user|login)")
_HOST_NAMES = _either_case("(endpoint|hostname|host|server)")
# A dropped value must not be found again from a later start, so the length of a value is tested afterwards.
PATTERNS = {
    "assign": f"{_SECRET_NAMES}{_GIVES}([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
    "ident": f"{_USER_NAMES}{_GIVES}([A-Za-z0-9@_.-]+)",
    "key": "[A-Za-z0-9+/]{40,}",
    "endpoint": "([Hh][Tt][Tt][Pp][Ss]?://[^\\x20\\x09-\\x0D\"'<>]+"
    # "++": Java would go one call deeper for each repeat of a group that it may have to take back.
    f"|{_HOST_NAMES}{_GIVES}[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)++"
    "|[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3})",
}
LEAST_VALUE = {"assign": 12, "ident": 3}
KEY_LENGTH = 40

SPANS = "array<struct<start: int, rank: int, end: int>>"
_STEPS = "array<struct<rank: int, at: int, gap: int, size: int, good: boolean>>"


def _steps(text: Column, kind: str) -> Column:
    """The leftmost matches of a kind, in order: the characters before each since the last, its length, and its test."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind in LEAST_VALUE:
        good = F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE[kind])
    elif kind == "key":
        good = F.transform(found, lambda v: F.length(v) == KEY_LENGTH)
    else:
        good = F.transform(found, lambda v: F.lit(True))
    between = F.transform(F.split(text, PATTERNS[kind], -1), lambda v: F.length(v))
    # The piece behind the last match has no match of its own.
    zipped = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), F.transform(found, lambda v: F.length(v)).alias("size"), good.alias("good"))
    steps = F.transform(zipped, lambda s, k: F.struct(F.lit(KINDS.index(kind)).alias("rank"), k.alias("at"), s["gap"], s["size"], s["good"]))
    return F.when(text.rlike(PATTERNS[kind]), steps.cast(_STEPS)).otherwise(F.array().cast(_STEPS))


def _is(kinds: tuple[str, ...], rank: str = "rank") -> Column:
    return F.col(rank).isin([KINDS.index(k) for k in kinds])


def _binned(parts: DataFrame, scope: int, margin: int) -> DataFrame:
    """Each part once for each bin of ``scope`` characters that it reaches with its margin."""
    first = F.floor((F.col("start") - margin) / scope)
    last = F.floor((F.col("end") + margin) / scope)
    return parts.select("*", F.explode(F.sequence(first, last)).alias("bin"))


_PART = ("text_key", "rank", "start", "end")


def _joined(weak: DataFrame, parts: DataFrame, scope: int, margin: int) -> DataFrame:
    """Pairs of a weak part and a part (``_rank``) that reach each other within ``margin`` characters."""
    near = _binned(parts, scope, 0).select(F.col("text_key"), "bin", *[F.col(c).alias(f"_{c}") for c in ("rank", "start", "end")])
    pairs = _binned(weak, scope, max(margin, 0)).join(near, ["text_key", "bin"])
    return pairs.where((F.col("_start") <= F.col("end") + margin) & (F.col("_end") >= F.col("start") - margin))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def has_parts(text: Column) -> Column:
    """Whether any pattern is in a text."""
    return F.coalesce(reduce(Column.__or__, [text.rlike(p) for p in PATTERNS.values()]), F.lit(False))


def spans_of(texts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(text_key, spans) of all texts (one column ``text``) with spans, for each distinct text once."""
    c = F.col
    steps = F.flatten(F.array(*[_steps(c("text"), kind) for kind in KINDS]))
    # Copies send the same rows, which are made one before any of them meet.
    # Key and steps come first: beside the generator the text would go with each of its rows.
    keyed = texts.where(has_parts(c("text"))).select(_key(c("text")).alias("text_key"), steps.alias("steps"))
    rows = keyed.select("text_key", F.inline("steps")).distinct()
    before = Window.partitionBy("text_key", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum(c("gap") + c("size")).over(before), F.lit(0)) + c("gap")).cast("int")
    parts = rows.withColumn("start", start).where("good").select("text_key", "rank", "start", (c("start") + c("size")).alias("end"))
    # Written once: the joins below look at it from several sides.
    parts = staged(parts, "secrets-parts")
    base = parts.where(_is(BASE))
    weak = parts.where(~_is(BASE))
    hidden = _joined(weak, base, scope, -1).select(*_PART).distinct()
    weak = weak.join(hidden, list(_PART), "left_anti")
    seen = _joined(weak, base.unionByName(weak), scope, scope).groupBy(*_PART).agg(
        F.bool_or(_is(("assign", "hex", "key"), "_rank")).alias("secret"),
        F.bool_or(_is(("access", "ident"), "_rank")).alias("name"),
        F.bool_or(_is(("endpoint",), "_rank")).alias("place"),
    )
    linked = seen.where(
        (_is(("key",)) & (c("name") | c("place"))) | (_is(("ident",)) & c("secret")) | (_is(("endpoint",)) & c("secret") & c("name"))
    )
    spans = base.unionByName(linked.select(*_PART))
    whole = F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).cast(SPANS).alias("_spans")
    return spans.groupBy("text_key").agg(whole)


def with_spans(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: base spans and all spans, by start, then kind."""
    found = spans_of(docs.select(F.col(text).alias("text")), scope).select(F.col("text_key").alias("_key"), "_spans")
    joined = docs.withColumn("_own", _key(F.col(text))).join(found, F.col("_own") == F.col("_key"), "left").drop("_own", "_key")
    joined = joined.withColumn("_spans", F.coalesce("_spans", F.array().cast(SPANS)))
    return joined.withColumn("_base", F.filter("_spans", lambda x: x["rank"] < len(BASE)))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"]))
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text`` replaced by ``PLACEHOLDER``; other texts stay as they are."""

    def cut(seen: Column, span: Column) -> Column:
        start, end = F.greatest(span["start"], seen["at"]), F.greatest(span["end"], seen["at"])
        before = F.substring(F.col("text"), seen["at"] + 1, start - seen["at"])
        mark = F.when(span["end"] > seen["at"], F.lit(PLACEHOLDER)).otherwise(F.lit(""))
        return F.struct(end.alias("at"), F.concat(seen["out"], before, mark).alias("out"))

    whole = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        cut,
        lambda seen: F.concat(seen["out"], F.substring(F.col("text"), seen["at"] + 1, F.length("text"))),
    )
    given = boxed(docs, text=F.col(text))
    # Texts without any part stay where they are.
    plain = given.where(~has_parts(F.col("text"))).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
    found = with_spans(given.where(has_parts(F.col("text"))))
    found = unboxed(found, docs.columns, **{text: F.when(F.size("_spans") > 0, whole).otherwise(F.col("text"))})
    return plain.unionByName(found) if len(set(docs.columns)) == len(docs.columns) else plain.union(found)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of base kinds, a digest of base spans, and all spans."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # Only ids and keys of texts are moved to their spans.
    spans = spans_of(docs.select("text")).select(F.col("text_key").alias("_key"), "_spans")
    keyed = docs.select("doc_id", _key(F.col("text")).alias("_own"))
    found = keyed.join(spans, F.col("_own") == F.col("_key"), "left").withColumn("_spans", F.coalesce("_spans", F.array().cast(SPANS)))
    found = found.withColumn("_base", F.filter("_spans", lambda x: x["rank"] < len(BASE)))

    def number(rank: int) -> Column:
        return F.size(F.filter("_base", lambda x: x["rank"] == rank)).cast("long")

    counts = [number(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(as_text(F.col("_base")), 256).alias("base_sha256"), as_text(F.col("_spans")).alias("spans")
    )


def _sql_matches(kind: str) -> str:
    """Spans of a kind as a list of structs."""
    pattern = PATTERNS[kind].replace("'", "''").replace(")++", ")+")
    value = f"regexp_extract_all(text, '{pattern}', 2)"
    test = {
        "assign": f"length({value}[i]) >= 12", "ident": f"length({value}[i]) >= 3", "key": "length(found[i]) = 40"
    }.get(kind, "true")
    return f"""
    {kind}_found AS (
      SELECT row, text, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps
      FROM docs WHERE regexp_matches(text, '{pattern}')),
    {kind}_all AS (
      SELECT row, text, found, i, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
      FROM (SELECT row, text, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM {kind}_found)),
    {kind}_parts AS (
      SELECT row, {KINDS.index(kind)} AS rank, start, start + length(found[i]) AS stop FROM {kind}_all WHERE {test})"""


OP3_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
{",".join(_sql_matches(kind) for kind in KINDS)},
base AS (SELECT * FROM assign_parts UNION ALL SELECT * FROM access_parts UNION ALL SELECT * FROM hex_parts),
weak AS (
  SELECT w.* FROM (
    SELECT * FROM ident_parts UNION ALL SELECT * FROM key_parts UNION ALL SELECT * FROM endpoint_parts) w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = w.row AND b.start < w.stop AND b.stop > w.start)),
parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
near AS (
  SELECT w.row, w.rank, w.start, w.stop, bool_or(p.rank IN (0, 2, 4)) AS secret, bool_or(p.rank IN (1, 3)) AS name,
    bool_or(p.rank = 5) AS place
  FROM weak w JOIN parts p ON p.row = w.row AND p.start <= w.stop + {SCOPE} AND p.stop >= w.start - {SCOPE}
  GROUP BY ALL),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT row, rank, start, stop FROM near
  WHERE rank = 4 AND (name OR place) OR rank = 3 AND secret OR rank = 5 AND secret AND name),
named AS (
  SELECT row, rank, start, stop, (['assign', 'access', 'hex', 'ident', 'key', 'endpoint'])[rank + 1] || ':' || start::BIGINT
    || ':' || stop::BIGINT AS said FROM spans),
found AS (
  SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base,
    string_agg(said, ',' ORDER BY start, rank) AS spans
  FROM named GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (row)
"""
