"""Personal data: patterns propose spans, checksums confirm them, context adjusts a score.

Only built-in expressions. Kinds, in their fixed order: email, ip, card,
phone (the base kinds) and iban. Per kind, the proposals are the leftmost
non-overlapping matches; a proposal that fails its check is dropped without a
second try. Checks: ip parts at most 255; card 12 to 19 digits with a right
Luhn sum; phone 9 to 15 digits; iban remainder 1 modulo 97. A kind's prior
score rises when one of its context words, and falls when one of its
counter-words (whole words), stands in the ``WINDOW`` code points before or
after the span. Redaction masks every confirmed span of a base kind whatever
its score; the score decides about the kinds added to them.

The base patterns are, as usually written::

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)
    card   [0-9]([\\x20-]?[0-9])+
    phone  \\+[0-9][\\x20().0-9-]+[0-9]

Java's engine tries every start and recurses on repeated groups, so they are
stated here in equal forms that are linear and flat on texts of any length:
a match can only begin at the start of a run of its first character class (or
right after a match), and repeated groups become one character class read up
to the first place where the sequence breaks. A lone digit may then match as
a card; it fails the digit count.

Positions: the text is split by the same pattern; running sums of the lengths
of what lies between and of the matches give starts and ends in code points.

Defined cases: null or empty text has no spans. Repeated rows and repeated or
null ids give a row each. Spans of different kinds may overlap; redaction
replaces the union of overlapping spans by the mark of the first.

Scale: a map over whole texts; no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of

WINDOW = 40
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")

PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
              r"[A-Za-z0-9.-]*?(?<=[A-Za-z0-9-])(?=\z|[^A-Za-z0-9.-]|\.(?:\z|[^A-Za-z0-9-]))"),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]*?(?<=[0-9])(?=\z|[^0-9\x20-]|[\x20-](?:\z|[^0-9]))",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"),
}
#: A character without which the kind cannot occur; texts without it are not searched.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{10}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}"}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": r"mail|contact|write|kontakt|correo|courriel|schreib",
    "ip": r"\bip\b|address|host|server|login|adresse",
    "card": r"card|visa|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|call|tel|mobile|fax|whatsapp|ruf|llam|appel",
    "iban": r"iban|account|bank|transfer|konto|cuenta|compte",
}
COUNTER = {"ip": r"\b(?:version|release|chapter|section)\b", "card": r"\b(?:isbn|order|serial|tracking)\b", "phone": r"\b(?:order|serial|id)\b"}
BOOST, CUT = 0.2, 0.3
ADDED_SCORE = 0.5


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _digit(s: Column, i: Column) -> Column:
    return F.substring(s, i, F.lit(1)).cast("int")


def luhn_ok(digits: Column) -> Column:
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.when((n - i) % 2 == 1, _digit(digits, i) * 2).otherwise(_digit(digits, i)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def mod97_ok(code: Column) -> Column:
    """Remainder 1 of an IBAN's rearranged code, folded over its characters."""
    plain = F.regexp_replace(code, r"\x20", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def step(a, i):
        c = F.substring(moved, i, F.lit(1))
        v = F.ascii(c)
        return F.when(v < 65, (a * 10 + v - 48) % 97).otherwise((a * 100 + v - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _check(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.coalesce(F.regexp_extract(p, "^0*([0-9]{0,3})$", 1).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        d = _digits(s)
        return F.when(F.length(d).between(12, 19), luhn_ok(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "iban":
        return mod97_ok(s)
    return F.lit(True)


def _score(kind: str, text: Column, start: Column, end: Column) -> Column:
    left = F.greatest(start - WINDOW, F.lit(0))
    near = F.lower(F.concat(F.substring(text, left + 1, start - left), F.lit(" "), F.substring(text, end + 1, F.lit(WINDOW))))
    score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), F.lit(BOOST)).otherwise(F.lit(0.0))
    if kind in COUNTER:
        score = score - F.when(near.rlike(COUNTER[kind]), F.lit(CUT)).otherwise(F.lit(0.0))
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 3)


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, in order."""
    pattern, rank = PATTERNS[kind], KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("m"), F.slice(F.transform(gaps, lambda g: F.length(g)), 1, F.size(found)).alias("g"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["1"]
        end = start + F.length(x["0"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["0"].alias("value")))).alias("out"))

    numbered = F.transform(pairs, lambda x: F.struct(x["m"].alias("0"), x["g"].alias("1")))
    placed = F.aggregate(numbered, state, step, lambda acc: acc["out"])
    good = F.filter(placed, lambda x: _check(kind, x["value"]))
    out = F.transform(good, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"),
        _score(kind, text, x["start"], x["end"]).alias("score")))
    return F.when(text.rlike(NEEDS[kind]), out.cast(SPAN)).otherwise(F.array().cast(SPAN))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, kinds=KINDS, column: str = "text", out: str = "__spans") -> DataFrame:
    """``docs`` with one more column: the confirmed spans of ``kinds`` in order of start, then kind."""
    text = F.col("__text")
    found = docs.withColumn("__text", text_of(column))
    for kind in kinds:
        found = found.withColumn(f"__{kind}", spans_of(text, kind))
    return (found.withColumn(out, F.array_sort(F.concat(*[F.col(f"__{k}") for k in kinds])))
            .drop("__text", *[f"__{k}" for k in kinds]))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by ``<KIND>`` of its first span."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        fresh = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]),
                                             F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, state, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def redact(docs: DataFrame, least_score: float | None = None) -> DataFrame:
    """``docs`` with confirmed spans masked in ``text`` and ``n_chars`` (where there is
    one) set anew; a null text stays null. All spans of the base kinds are masked, and
    those of added kinds that score at least ``ADDED_SCORE``; a caller who gives
    ``least_score`` has the spans of every kind masked from that score on instead."""
    clash = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.startswith("__")}
    used = ((lambda x: (x["rank"] < len(BASE)) | (x["score"] >= ADDED_SCORE)) if least_score is None
            else (lambda x: x["score"] >= least_score))
    own = with_spans(docs.withColumnsRenamed(clash)).withColumn("__use", F.filter("__spans", used))
    new = own.withColumn("text", F.when(F.size("__use") > 0, redacted(F.col("text"), F.col("__use"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.size("__use") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return new.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])


def _ranked(i: int):
    return lambda x: x["rank"] == i


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, found (spans with scores), and the digest columns."""
    found = with_spans(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")))
    base = F.filter("__spans", lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.filter("__spans", _ranked(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"),
                        F.col("__spans").alias("found"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_iban", "base_sha256", "spans")


ORACLE_OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hit AS (
  SELECT doc_id, 0 AS rank, 'email' AS kind, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS m,
    regexp_split_to_array(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS g FROM d
  UNION ALL SELECT doc_id, 1, 'ip', regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
    regexp_split_to_array(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM d
  UNION ALL SELECT doc_id, 2, 'card', regexp_extract_all(text, '[0-9](?:[\x20-]?[0-9])+'),
    regexp_split_to_array(text, '[0-9](?:[\x20-]?[0-9])+') FROM d
  UNION ALL SELECT doc_id, 3, 'phone', regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'),
    regexp_split_to_array(text, '\+[0-9][\x20().0-9-]+[0-9]') FROM d
  UNION ALL SELECT doc_id, 4, 'iban', regexp_extract_all(text, '\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b'),
    regexp_split_to_array(text, '\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b') FROM d),
one AS (
  SELECT doc_id, rank, kind, i, m[i] AS v,
    list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM hit WHERE len(m) > 0)),
judged AS (
  SELECT doc_id, rank, kind, s, s + length(v) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS digits, v,
    regexp_replace(v, ' ', '', 'g') AS code FROM one),
good AS (
  SELECT * FROM judged WHERE CASE kind
    WHEN 'ip' THEN list_max(list_transform(string_split(v, '.'), lambda x: x::HUGEINT)) <= 255
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
      lambda i: CASE WHEN (length(digits) - i) % 2 = 0 THEN digits[i]::INT
                ELSE (2 * digits[i]::INT) // 10 + (2 * digits[i]::INT) % 10 END)) % 10 = 0
    WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(string_split(substr(code, 5) || substr(code, 1, 4), ''),
      lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)),
      lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1
    ELSE true END),
per AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
    count(*) FILTER (rank = 3) AS n_phone, count(*) FILTER (rank = 4) AS n_iban,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 4), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, coalesce(n_iban, 0) AS n_iban, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""
