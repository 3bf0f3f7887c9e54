"""Personal data: regular expressions propose spans, checksums confirm them,
context words before a span adjust its score.

Kinds email, ip, card and phone are the base: every confirmed match stays.
The method adds the kinds iban (confirmed by mod-97) and ssn, whose shape
alone scores too low: it needs a context word such as "ssn" in the 40 code
points before it.  DataFrame functions only: the matches come from
``regexp_extract_all``, the stretches between them from ``split`` on the
same expression, and running sums of their lengths, in steps, give the
positions: work grows with the number of matches, not with its square.  No
row meets another, so nothing is shuffled.

The expressions match what the plain ones in ``PLAIN`` match, with
look-behinds and possessive quantifiers that start each run of characters
once, so a long run costs linear time.  For card the number of digits is
part of the expression: a run of digit groups is maximal either way.

Defined cases: a null text counts as empty and has no spans; whole texts
are searched; equal rows give equal results; an empty table gives no rows;
columns other than the two named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import documents

#: The base expressions as given.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
BASE = ("email", "ip", "card", "phone")
MIN_SCORE = 0.5
CONTEXT_CHARS = 40


def luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right."""
    back = F.reverse(digits)

    def add(acc, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether the four leading characters moved to the end, letters read as
    10 to 35, leave remainder 1."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _parts_fit(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    context: str  # expression over the lower-cased text before a span
    lift: float = 0.4


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
         lambda m: F.lit(True), 0.6, "mail|contact|kontakt|correo"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _parts_fit, 0.5, "ip|host|server|addr"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
         lambda m: luhn(_digits(m)), 0.6, "card|visa|karte|carte|tarjeta"),
    Kind("phone", PLAIN["phone"],
         lambda m: F.length(_digits(m)).between(8, 15), 0.5, "phone|call|tel|mobil"),
    Kind("iban", PLAIN["iban"],
         lambda m: mod97(F.regexp_replace(m, " ", "")), 0.6, "iban|konto|account|cuenta|compte"),
    Kind("ssn", PLAIN["ssn"],
         lambda m: F.lit(True), 0.2, "ssn|social"),
)


#: Numbers summed in one step of a running sum.
STEP = 64
#: A match has five characters or more, so the context of one lies in its gap
#: and the last eight matches with theirs.
CONTEXT_MATCHES = 8


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda x, y: x + y)


def _sums_of(numbers: str) -> Column:
    """Totals of STEP numbers each."""
    return F.when(F.size(numbers) == 0, F.array().cast("array<int>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / STEP).cast("int")),
        lambda k: _total(F.slice(numbers, k * STEP + 1, F.lit(STEP)))))


def _before(numbers: str, base: str) -> Column:
    """For each number the sum of all before it; ``base`` has it for every
    STEP-th already."""
    def step(b, k):
        own = F.slice(numbers, k * STEP + 1, F.lit(STEP))
        return F.transform(own, lambda x, j: b + _total(F.slice(numbers, k * STEP + 1, j)))
    return F.flatten(F.transform(base, step))


def find_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end, score, text), by kind, then
    start; positions in code points, end exclusive."""
    got = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    got = got.select("doc_id", "t", *[
        F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0)).alias(k.name) for k in KINDS])

    def matches(i, kind):
        found = F.col(kind.name)
        gaps = F.when(F.size(found) > 0, F.split("t", kind.pattern, -1))
        return F.coalesce(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, m: F.struct(
            F.lit(i).alias("k"), gap.alias("gap"), m.alias("m"))), F.array())

    sizes = [F.size(k.name) for k in KINDS]
    got = got.select("doc_id", F.concat(*[matches(i, k) for i, k in enumerate(KINDS)]).alias("all"),
                     F.array(*[sum(sizes[:i], F.lit(0)) for i in range(len(KINDS))]).alias("first"))
    # where matches begin: running sums in steps of 64, of 64 times 64 and
    # beyond.  Catalyst keeps a column that is used twice as a column; one used
    # once must not stand inside a lambda, which would compute it for each row
    got = got.select("*", F.transform("all", lambda x: F.length(x["gap"]) + F.length(x["m"])).alias("n0"))
    got = got.select("*", _sums_of("n0").alias("n1"))
    got = got.select("*", _sums_of("n1").alias("n2"))
    got = got.select("doc_id", "all", "first", "n0", "n1", F.transform(
        "n2", lambda x, i: _total(F.slice("n2", F.lit(1), i))).alias("b2"))
    got = got.select("doc_id", "all", "first", "n0", _before("n1", "b2").alias("b1"))
    got = got.select("doc_id", "all", "first", _before("n0", "b1").alias("at"))

    def span(x, i):
        first = F.get("first", x["k"])
        start = F.get("at", i) - F.get("at", first) + F.length(x["gap"])
        low = F.greatest(first, i - CONTEXT_MATCHES)
        ahead = F.array_join(F.transform(F.slice("all", low + 1, i - low), lambda y: F.concat(
            _tail(y["gap"]), y["m"])), "")
        near = F.lower(_tail(F.concat(ahead, _tail(x["gap"]))))
        score, keep, name = F.lit(0.0), F.lit(False), F.lit("")
        for n, kind in enumerate(KINDS):
            own = x["k"] == n
            value = F.lit(kind.score) + F.when(near.rlike(kind.context), kind.lift).otherwise(0.0)
            score = F.when(own, value).otherwise(score)
            keep = F.when(own, kind.confirm(x["m"])).otherwise(keep)
            name = F.when(own, F.lit(kind.name)).otherwise(name)
        return F.struct(name.alias("kind"), start.alias("start"), (start + F.length(x["m"])).alias("end"),
                        score.alias("score"), x["m"].alias("text"), keep.alias("keep"))

    spans = F.filter(F.transform("all", span), lambda s: s["keep"] & (s["score"] >= MIN_SCORE))
    return got.select("doc_id", F.transform(spans, lambda s: s.dropFields("keep")).alias("spans"))


def _tail(text: Column) -> Column:
    return F.substring(text, F.lit(-CONTEXT_CHARS), F.lit(CONTEXT_CHARS))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = find_spans(documents(spark, sf_dir, "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _sql_kind(kind: str, valid: str, context: str | None = None) -> str:
    """Matches of one expression with their positions, in DuckDB."""
    near = (f"AND regexp_matches(lower(substr(t, greatest(1, start - {CONTEXT_CHARS - 1})::BIGINT, "
            f"least(start, {CONTEXT_CHARS})::BIGINT)), '{context}')" if context else "")
    return f"""
  SELECT rid, '{kind}' AS kind, {list(PLAIN).index(kind)} AS k, start, start + length(m) AS stop FROM (
    SELECT rid, t, list_extract(ms, i::INT) AS m,
           list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT rid, t, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT rid, t, regexp_extract_all(t, '{PLAIN[kind]}') AS ms,
             string_split_regex(t, '{PLAIN[kind]}') AS gaps FROM d)))
  WHERE {valid} {near}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j:
    CASE WHEN j % 2 = 1 THEN substr(reverse({_DIGITS}), j, 1)::INT
         WHEN substr(reverse({_DIGITS}), j, 1)::INT * 2 > 9 THEN substr(reverse({_DIGITS}), j, 1)::INT * 2 - 9
         ELSE substr(reverse({_DIGITS}), j, 1)::INT * 2 END)) % 10 = 0"""
_TURNED = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
# the number has up to 70 digits: fold it like a long division
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split(array_to_string(list_transform(
    string_split({_TURNED}, ''), lambda c: CASE WHEN c >= 'A' THEN (ascii(c) - 55)::VARCHAR ELSE c END), ''), ''),
    lambda c: c::INT)), lambda a, b: (a * 10 + b) % 97) = 1"""

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_sql_kind('email', 'true')} UNION ALL
{_sql_kind('ip', "len(list_filter(string_split(m, '.'), lambda p: try_cast(p AS HUGEINT) > 255 OR try_cast(p AS HUGEINT) IS NULL)) = 0")} UNION ALL
{_sql_kind('card', f'length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}')} UNION ALL
{_sql_kind('phone', f'length({_DIGITS}) BETWEEN 8 AND 15')} UNION ALL
{_sql_kind('iban', _MOD97)} UNION ALL
{_sql_kind('ssn', 'true', 'ssn|social')}),
g AS (SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (k < 4) AS base,
             {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)}
      FROM s GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""
