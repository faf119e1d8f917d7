"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions. A kind's matches come from ``regexp_extract_all``, the text
between them from ``split`` with the same pattern, so a running sum of their lengths gives
every match's place in code points. Cards must pass Luhn, IBANs mod-97; every span's score
starts with its kind's, rises with a checksum and with a telling word close before it. Base
spans stay whatever their score; spans that the method adds (``iban``, and ``id`` for
labelled identity numbers) need ``MIN_SCORE``.

An IBAN's pattern finds only where one may begin. Of the 15 to 34 characters there, spaces
aside, that end where a word ends, those of its country's length (of any length, the longest
first, for a country not listed) are tried by mod-97, so what follows an IBAN is no part of it.

The patterns take runs possessively and start only where a run starts or where the last
match ended, so they run in linear time and constant stack on any text. Results are gathered
by runs of matches, and places in a text found by its pages, so that a very long text dense
in matches takes time in proportion to its length too.

Null text counts as empty: no spans; ``redact`` leaves it null. Repeated rows each get their
own result, spans that start together are ordered by kind. An empty table gives an empty
result. ``find`` adds (or replaces) the column ``pii_spans``; ``redact`` keeps every column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import documents, unused

# Kinds in their listed order, their patterns, first scores and telling words.
KINDS = ("email", "ip", "card", "phone", "iban", "id")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.4, "id": 0.3}
CHECKSUM, CONTEXT = 0.4, 0.3
MIN_SCORE = 0.6
WORDS = {
    "email": r"mail|contact|write|reply",
    "ip": r"\bip\b|host|server|address|login",
    "card": r"card|visa|master|credit|debit|pay",
    "phone": r"phone|tel|call|mobile|fax|whatsapp",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "id": r"ssn|social|security|identity|passport",
}
#: Characters that an IBAN may take with a space after each but the last, and one more.
MAX_IBAN = 34 + 33 + 1
#: Characters of the countries' IBANs.
IBAN_LENGTHS = {
    int(n): countries.split()
    for n, countries in (x.split(":") for x in (
        "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV", "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL",
        "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB NI PL SV", "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
    ))
}
#: Characters before a match in which a telling word counts.
NEAR = 40
#: Matches whose results are gathered together; characters of a page.
RUN, PAGE = 64, 256


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check: from the right, every second one doubled and its digits summed."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(i % 2 == 1, F.coalesce(x.try_cast("int"), F.lit(0)) * 2).otherwise(F.coalesce(x.try_cast("int"), F.lit(0))))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces passes mod-97: the first four characters go last, letters count 10 to 35."""
    moved = F.split(F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4))), "")
    value = lambda x: F.when(x.between("0", "9"), F.ascii(x) - 48).otherwise(F.ascii(x) - 55)
    return F.aggregate(moved, F.lit(0), lambda a, x: F.when(x == "", a).otherwise((a * F.when(value(x) > 9, 100).otherwise(10) + value(x)) % 97)) == 1


def iban_at(text: Column) -> Column:
    """The IBAN with which a text begins, as it is written there; null where there is none."""
    listed = [c for cs in IBAN_LENGTHS.values() for c in cs]
    country = F.left(text, F.lit(2))
    tried = []
    for n in range(34, 14, -1):
        fits = ~country.isin(listed)
        fits = fits | country.isin(IBAN_LENGTHS[n]) if n in IBAN_LENGTHS else fits
        tried.append(F.when(fits, F.regexp_extract(text, rf"^[A-Z0-9](?:\x20?[A-Z0-9]){{{n - 1}}}(?![A-Za-z0-9])", 0)).otherwise(""))
    return F.get(F.filter(F.array(*tried), lambda x: (x != "") & mod97(F.replace(x, F.lit(" "), F.lit("")))), F.lit(0))


def _holds(kind: str, x: Column) -> Column:
    n = F.length(_digits(x))
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.ltrim(p, F.lit("0")).try_cast("int").isNull() & (F.ltrim(p, F.lit("0")) == "") | (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & luhn(_digits(x))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x evaluated once however often, and in whatever lambda, f uses it."""
    return F.get(F.transform(F.array(x), lambda v: f(v)), F.lit(0))


def scan(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """array<kind>: what step(state, item) gives as (next state, out) for each item in order, without nulls.

    Results are gathered by runs of ``RUN`` items, so that what is copied grows with the
    items and not with their square.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, item: Column) -> Column:
        state, out = step(acc["state"], item)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out.cast(kind))).alias("out"))

    def run(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return bound(inner, lambda i: F.struct(i["state"].alias("state"), F.concat(acc["out"], F.array(i["out"])).alias("out")))

    def whole(it: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(it) - 1) / RUN).cast("int") + F.when(F.size(it) == 0, 1).otherwise(0)), lambda c: F.slice(it, c * RUN + 1, F.lit(RUN)))
        return F.filter(F.flatten(F.aggregate(runs, F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")), run, lambda acc: acc["out"])), lambda x: x.isNotNull())

    return bound(items, whole)


def pages(text: Column) -> Column:
    """array<string>: the text in pages of ``PAGE`` characters, as finding a place in a long text takes time that grows with the place."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def part_of(paged: Column, start: Column, length: Column) -> Column:
    """length characters from start (from 0) of a text in pages, or as many as there are."""
    first = F.floor(start / PAGE).cast("int")
    last = F.floor((start + length) / PAGE).cast("int")
    return F.substr(F.array_join(F.slice(paged, first + 1, last - first + 1), ""), start - first * PAGE + 1, length)


SPAN = "struct<start:int,kind:int,end:int,score:double>"


def _spans(kind: str, number: int, text: Column, paged: Column) -> Column:
    """array<struct<start, kind, end, score>> of one kind's confirmed matches."""
    pattern = F.lit(PATTERNS[kind])

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        gap, match = pair["gap"], pair["match"]
        start = at + F.length(gap)
        near = F.lower(F.right(gap, F.lit(NEAR))).rlike(WORDS[kind])
        score = SCORES[kind] + F.when(F.lit(kind in ("card", "iban")), CHECKSUM).otherwise(0.0) + F.when(near, CONTEXT).otherwise(0.0)
        end = start + F.length(match)
        span = lambda last: F.struct(start.alias("start"), F.lit(number).alias("kind"), last.alias("end"), F.least(F.lit(1.0), score).alias("score"))
        if kind == "iban":
            return end, F.when(score >= MIN_SCORE, bound(iban_at(part_of(paged, start, F.lit(MAX_IBAN))), lambda whole: F.when(whole.isNotNull(), span(start + F.length(whole)))))
        good = F.coalesce(_holds(kind, match), F.lit(False)) & (F.lit(number < 4) | (score >= MIN_SCORE))
        return end, F.when(good, span(end))

    def apart(free: Column, span: Column) -> tuple[Column, Column]:
        """Of IBANs that overlap, the first one."""
        return F.when(span["start"] >= free, span["end"]).otherwise(free), F.when(span["start"] >= free, span)

    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"))
    found = scan(pairs, F.lit(0), step, SPAN)
    found = scan(found, F.lit(0), apart, SPAN) if kind == "iban" else found
    return F.when(text.rlike(PATTERNS[kind]), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def pii_spans(text: Column) -> Column:
    """All spans of a text, sorted by start and then kind; those that the method adds overlap no base span."""

    def forward(end: Column, x: Column) -> tuple[Column, Column]:
        """Without the added spans that a base span before them reaches into."""
        base = x["kind"] < 4
        return F.when(base, F.greatest(end, x["end"])).otherwise(end), F.when(base | (x["start"] >= end), x)

    def backward(start: Column, x: Column) -> tuple[Column, Column]:
        """Without the added spans that reach into the base span after them."""
        base = x["kind"] < 4
        return F.when(base, x["start"]).otherwise(start), F.when(base | (x["end"] <= start), x)

    def spans(paged: Column) -> Column:
        each = [_spans(k, i, text, paged) for i, k in enumerate(KINDS)]
        clear = lambda found: F.reverse(scan(F.reverse(scan(found, F.lit(0), forward, SPAN)), F.lit(2**31 - 1), backward, SPAN))
        return bound(F.array_sort(F.concat(*each)), lambda found: F.when(F.exists(found, lambda x: x["kind"] >= 4), clear(found)).otherwise(found))

    return bound(F.when(text.rlike(PATTERNS["iban"]), pages(text)).otherwise(F.array().cast("array<string>")), spans)


def find(docs: DataFrame, text_col: str = "text", name: str = "pii_spans") -> DataFrame:
    """docs with the spans' column added."""
    return docs.withColumn(name, pii_spans(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first is named."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])

    def whole(paged: Column) -> Column:
        def step(at: Column, s: Column) -> tuple[Column, Column]:
            piece = F.concat(part_of(paged, at, s["start"] - at), F.element_at(names, s["kind"] + 1))
            return F.greatest(at, s["end"]), F.when(s["start"] >= at, piece)

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(scan(spans, F.lit(0), step, "string"), ""), part_of(paged, last, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(bound(pages(text), whole))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with personal data replaced in the text; null texts stay null."""
    name = unused(docs, "pii_spans")
    found = find(docs, text_col, name)
    return found.withColumn(text_col, F.when(F.col(text_col).isNotNull(), redacted(F.col(text_col), F.col(name)))).drop(name)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, KINDS))
    join = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("pii_spans", lambda x: x["kind"] == k)).cast("long")
    found = find(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "pii_spans")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(join(F.filter("pii_spans", lambda x: x["kind"] < 4)), 256).alias("base_sha256"), join(F.col("pii_spans")).alias("spans"),
        F.array_join(F.transform("pii_spans", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )


def _sql_matches(kind: str, pattern: str, proposed: str, length: str = "length(match)") -> str:
    """SQL for one kind's proposed matches with their places and the text before each."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {KINDS.index(kind)} AS number, match, start, start + {length} AS "end", text,
         substr(text, coalesce(lag(start + {length}) OVER p, 0) + 1, start - coalesce(lag(start + {length}) OVER p, 0)) AS gap
  FROM (SELECT *, (sum(length(gap) + length(match)) OVER (PARTITION BY doc_id ORDER BY i) - length(match))::bigint AS start
        FROM (SELECT doc_id, text, unnest(found) AS match, unnest(gaps[:len(found)]) AS gap, generate_subscripts(found, 1) AS i
              FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM d
                    WHERE regexp_matches(text, '{RARE.get(kind, pattern)}'))))
  WHERE {proposed} WINDOW p AS (PARTITION BY doc_id ORDER BY start)"""


#: In SQL, what texts with any match hold, where the pattern itself is common.
RARE = {"iban": r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11}", "id": "[0-9]{3}-[0-9]{2}-[0-9]{4}", "card": r"[0-9]([\x20-]?[0-9]){13}"}
_DIGITS = "regexp_replace(match, '[^0-9]', '', 'g')"
_MATCHES = " UNION ALL ".join((
    _sql_matches("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    _sql_matches("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "true"),
    _sql_matches("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) >= 14"),
    _sql_matches("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "true"),
    _sql_matches("iban", "[A-Za-z0-9]+", rf"regexp_matches(substr(text, start + 1, {MAX_IBAN}), '^[A-Z]{{2}}[0-9]{{2}}(\x20?[A-Z0-9]){{11}}')", "4"),
    _sql_matches("id", "[0-9-]+", "regexp_full_match(match, '[0-9]{3}-[0-9]{2}-[0-9]{4}')"),
))
_BY_KIND = lambda of: "CASE kind " + " ".join(f"WHEN '{k}' THEN {of(k)}" for k in KINDS) + " END"
_COUNTRIES = ", ".join(f"({n}, '{c}')" for n, cs in IBAN_LENGTHS.items() for c in cs)
#: DuckDB SQL for ids that do not repeat; the patterns are the contract's own.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_MATCHES}),
s AS (SELECT *, {_BY_KIND(lambda k: SCORES[k] + CHECKSUM * (k in ("card", "iban")))}
               + CASE WHEN {_BY_KIND(lambda k: f"regexp_matches(lower(right(gap, {NEAR})), '{WORDS[k]}')")} THEN {CONTEXT} ELSE 0 END AS score FROM m),
base AS (
  SELECT doc_id, kind, number, start, "end", score FROM s
  WHERE CASE kind WHEN 'ip' THEN list_bool_and(list_transform(string_split(match, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND right('0' || x, 3)::int <= 255))
                  WHEN 'card' THEN length({_DIGITS}) <= 19 AND list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda x, i:
                    CASE WHEN i % 2 = 1 THEN x::int WHEN x::int > 4 THEN 2 * x::int - 9 ELSE 2 * x::int END)) % 10 = 0
                  WHEN 'phone' THEN length({_DIGITS}) BETWEEN 10 AND 15 ELSE kind = 'email' END),
lengths(n, country) AS (VALUES {_COUNTRIES}),
tried AS (
  SELECT s.*, t.n, regexp_extract(substr(text, start + 1, {MAX_IBAN}), '^([A-Z0-9](?:\x20?[A-Z0-9]){{' || (t.n - 1) || '}})(?:[^A-Za-z0-9]|$)', 1) AS whole
  FROM s JOIN range(15, 35) AS t(n) ON (match[:2], t.n) IN (SELECT (country, n) FROM lengths) OR match[:2] NOT IN (SELECT country FROM lengths)
  WHERE kind = 'iban'),
valid AS (
  SELECT *, list_transform(string_split(replace(whole, ' ', '')[5:] || whole[:4], ''), lambda x: CASE WHEN x <= '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END) AS v
  FROM tried WHERE whole <> ''),
iban AS (
  SELECT doc_id, kind, number, start, start + length(arg_max(whole, n)) AS "end", score FROM valid
  WHERE list_reduce([0] || v, lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1 GROUP BY doc_id, kind, number, start, score),
more AS (
  SELECT doc_id, kind, number, start, "end", score FROM s WHERE kind = 'id'
  UNION ALL SELECT * FROM iban AS i WHERE NOT EXISTS (FROM iban AS o WHERE o.doc_id = i.doc_id AND o.start < i.start AND o."end" > i.start)),
spans AS (
  FROM base UNION ALL
  SELECT * FROM more AS m WHERE score >= {MIN_SCORE} AND NOT EXISTS (FROM base AS b WHERE b.doc_id = m.doc_id AND m.start < b."end" AND b.start < m."end"))
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS[:4])},
       sha256(coalesce(string_agg(concat_ws(':', kind, start, "end"), ',' ORDER BY start, number) FILTER (number < 4), '')) AS base_sha256,
       coalesce(string_agg(concat_ws(':', kind, start, "end"), ',' ORDER BY start, number), '') AS spans,
       coalesce(string_agg(printf('%.2f', least(1, score)::double), ',' ORDER BY start, number) FILTER (score IS NOT NULL), '') AS scores
FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id GROUP BY d.doc_id
"""
