"""Personal data in texts: proposed by patterns, confirmed by checksums, scored by context.

DataFrame functions only.  A kind's pattern proposes spans (leftmost, not overlapping);
a validator confirms them (address parts, Luhn, digit counts, mod-97); words near a
span raise its score.  The base kinds count whenever their validator holds; the kinds
that the method adds count from a score of ``MIN_SCORE``.

Positions are code points, end exclusive.  The text is split at the matches of the
pattern, so a match starts at the sum of the lengths before it.  The patterns are written
so that matching takes time in proportion to the text: runs are possessive, and a match
may begin inside a run only where the match before it ended.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import text_column

MIN_SCORE = 0.6
#: Characters before and after a span that are searched for context words.
CONTEXT = 48
#: Signs of the shortest match; so many matches may lie in a context.
SHORTEST = 2
#: Matches that are placed one after another; longer lists are placed in blocks of this size.
BLOCK = 500


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _byte_part(x: Column) -> Column:
    bare = F.regexp_replace(x, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))


def is_ip(x: Column) -> Column:
    return F.forall(F.split(x, "\\."), _byte_part)


def _check_sum(digits: Column) -> Column:
    """Luhn: from the right, every second digit doubled, less 9 if over 9."""
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i + F.lit(1), F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def is_card(x: Column) -> Column:
    n = F.length(_digits(x))
    return F.when((n < 12) | (n > 19), F.lit(False)).otherwise(_check_sum(_digits(x)) % 10 == 0)


def is_phone(x: Column) -> Column:
    return F.length(_digits(x)).between(9, 15)


def is_iban(x: Column) -> Column:
    """The first four signs moved to the end, letters as 10 to 35: 1 modulo 97."""
    bare = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))

    def step(rest, c):
        value = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, (rest * 10 + value) % 97).otherwise((rest * 100 + value) % 97)

    split = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.length(bare).between(15, 34) & (F.aggregate(split, F.lit(0), step) == 1)


def is_ssn(x: Column) -> Column:
    return ~x.rlike("^(000|666|9)") & ~x.rlike("-00-") & ~x.rlike("-0000$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    guard: str               # a sign that every match holds
    valid: Callable[[Column], Column] | None
    score: float             # without context
    words: str               # context words, as a pattern over lower-cased text
    base: bool = True


# The base patterns, and context words of each kind.
KINDS = (
    Kind("email",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", None, 0.9, r"mail|contact|write|send"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         ".", is_ip, 0.7, r"\bip\b|address|server|host|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", is_card, 0.8,
         r"card|visa|master|amex|credit|debit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", is_phone, 0.7,
         r"phone|tel|call|mobile|fax|cell"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}"
                 r"(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "", is_iban, 0.8, r"iban|account|bank|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", is_ssn, 0.4,
         r"\bssn\b|social security|insurance|tax", False),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


_SPAN = ("array<struct<start:long,rank:int,kind:string,stop:long,base:boolean,"
         "score:double,value:string>>")


def _placed(cells: Column, base: Column, rank: int, kind: Kind) -> Column:
    """Cells of (gap, match, before, after) to spans and the length of all cells, from position ``base``."""
    empty = F.expr(f"cast(array() as {_SPAN})")
    start = F.struct(base.cast("long").alias("at"), empty.alias("spans"))

    def step(acc, cell):
        begin = acc["at"] + F.length(cell["gap"])
        stop = begin + F.coalesce(F.length(cell["match"]), F.lit(0))
        near = F.lower(cell["before"]).rlike(kind.words) | F.lower(cell["after"]).rlike(kind.words)
        score = F.lit(kind.score) + F.when(near, 0.25).otherwise(0.0)
        ok = cell["match"].isNotNull()
        if kind.valid:
            ok = ok & kind.valid(cell["match"])
        if not kind.base:
            ok = ok & (score >= MIN_SCORE)
        span = F.struct(
            begin.cast("long").alias("start"), F.lit(rank).alias("rank"),
            F.lit(kind.name).alias("kind"), stop.cast("long").alias("stop"),
            F.lit(kind.base).alias("base"), F.least(score, F.lit(1.0)).alias("score"),
            cell["match"].alias("value"))
        return F.struct(
            stop.cast("long").alias("at"),
            F.when(ok, F.concat(acc["spans"], F.array(span).cast(_SPAN)))
            .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(cells, start, step)


def _in_context(cells: Column) -> Column:
    """Cells of (gap, match) with the ``CONTEXT`` characters before and after the match.

    Only the ends of a cell can lie in the context of another one.
    """
    def whole(cell):
        return F.concat(cell["gap"], F.coalesce(cell["match"], F.lit("")))

    ends = F.transform(cells, lambda c: F.struct(
        F.right(whole(c), F.lit(CONTEXT)).alias("tail"),
        F.left(whole(c), F.lit(CONTEXT)).alias("head")))
    most = CONTEXT // SHORTEST + 1

    def placed(cells, ends):
        def with_context(cell, i):
            first = F.greatest(i - most, F.lit(0))
            tails = F.transform(F.slice(ends, first + 1, i - first), lambda e: e["tail"])
            heads = F.transform(F.slice(ends, i + 2, F.lit(most)), lambda e: e["head"])
            before = F.right(F.concat(F.array_join(tails, ""), cell["gap"]), F.lit(CONTEXT))
            after = F.left(F.array_join(heads, ""), F.lit(CONTEXT))
            return F.struct(cell["gap"].alias("gap"), cell["match"].alias("match"),
                            before.alias("before"), after.alias("after"))

        return F.transform(cells, with_context)

    both = F.struct(cells.alias("cells"), ends.alias("ends"))
    return _let(both, lambda b: placed(b["cells"], b["ends"]))


def _shifted(block: Column, by: Column) -> Column:
    return F.transform(block["spans"], lambda s: F.struct(
        (s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"),
        (s["stop"] + by).alias("stop"), s["base"].alias("base"), s["score"].alias("score"),
        s["value"].alias("value")))


def _spans(text: Column, rank: int, kind: Kind) -> Column:
    """Confirmed spans of one kind in the text."""
    cells = F.zip_with(F.split(text, kind.pattern, -1),
                       F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
                       lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def in_blocks(cells):
        n = ((F.size(cells) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n), lambda i: _placed(
            F.slice(cells, i * BLOCK + 1, F.lit(BLOCK)), F.lit(0), rank, kind))
        zero = F.struct(F.lit(0).cast("long").alias("at"),
                        F.expr(f"cast(array() as array<{_SPAN}>)").alias("lists"))
        joined = F.aggregate(blocks, zero, lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"),
            F.concat(acc["lists"], F.array(_shifted(b, acc["at"])).cast(f"array<{_SPAN}>"))
            .alias("lists")))
        return F.flatten(joined["lists"])

    none = F.expr(f"cast(array() as {_SPAN})")
    found = _let(_let(cells, _in_context), in_blocks)
    return F.when(F.contains(text, F.lit(kind.guard)), found).otherwise(none) \
        if kind.guard else F.when(text.rlike("[0-9]"), found).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the column ``into``: spans by start, then kind.

    A span has ``start``, ``stop``, ``kind``, ``base``, ``score`` and ``value``.  A null or
    empty text has an empty array.  Rows are handled one by one: repeated rows and null
    ids have no effect.  A column of ``docs`` named like ``into`` is replaced.
    """
    value = text_column(docs, text)
    lists = [_spans(value, rank, kind) for rank, kind in enumerate(KINDS)]
    return docs.withColumn(into, F.array_sort(F.concat(*lists)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The texts with every span replaced by its kind in brackets.

    Overlapping spans become one, named by the first.  A text without spans, or a
    null text, stays as it is.
    """
    names = docs.columns
    found = find_pii(docs, text, "_pii")
    source = F.col(text)
    zero = F.struct(F.lit(0).cast("long").alias("at"),
                    F.expr("cast(array() as array<string>)").alias("parts"))

    def step(acc, s):
        before = F.substring(source, (acc["at"] + 1).cast("int"),
                             (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(acc["parts"], F.array(before, mark)))
            .otherwise(acc["parts"]).alias("parts"))

    def join(acc):
        rest = F.substring(source, (acc["at"] + 1).cast("int"), F.length(source))
        return F.concat(F.array_join(acc["parts"], ""), rest)

    clean = F.aggregate("_pii", zero, step, join)
    return found.withColumn(text, F.when(F.size("_pii") > 0, clean).otherwise(source)) \
        .select(*names)


def digests(found: DataFrame, pii: str = "pii") -> list[Column]:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(pii, lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    base = F.filter(pii, lambda s: s["base"])
    counts = [count(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return [*counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
            joined(F.col(pii)).alias("spans")]
