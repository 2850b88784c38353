"""Row caps.

The pipelines cap the rows they hand to a relational target.  ``limit_rows``
is the plain cap (any n rows are a correct answer; Catalyst pushes the local
limit below a left-join chain, so only about n rows per partition are read
from the fact side).  ``limit_ordered`` is the repeatable form: the first n
rows in the order of all columns.

A plain ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every
task keeps its n best rows and one last task merges them - n rows times the
number of input partitions, which grows with the data (20,000 x 500,000
splits is ten billion rows in one task).  ``limit_ordered`` therefore cuts the
first sort key before the merge (see ``limit_ordered``).

Through an inner join no limit is pushed: ``join(...).limit(n)`` shuffles the whole fact
table first.  ``limit_joined`` joins a prefix of the fact and takes more of it until the
cap is reached.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDE_TABLE_CAP = 20_000
QUERY_LOAD_CAP = 50_000
PREVIEW_ROWS = 20


def limit_rows(df: DataFrame, n: int = WIDE_TABLE_CAP) -> DataFrame:
    return df.limit(n)


# Rows sampled to place the cutoff, and the slack above the expected rank.
CUTOFF_SAMPLE_ROWS = 200_000
CUTOFF_SLACK = 1.5
# Above this many rows per wanted row at the cutoff, ties are split by the next key.
TIE_FACTOR = 4


def limit_ordered(
    df: DataFrame,
    n: int = WIDE_TABLE_CAP,
    order_by: Sequence[str] | None = None,
    sample_rows: int = CUTOFF_SAMPLE_ROWS,
) -> DataFrame:
    """The first ``n`` rows in ascending, nulls-first order of ``order_by``
    (default: all columns), returned in that order.  Exact; no task merges more
    than a few times n rows.

    One path at every size.  The order is cut on its first key: a cutoff is
    placed from a bounded sample so that about ``1.5 n`` rows fall at or before
    it, and an exact count confirms at least ``n`` do; a cutoff that is too low
    is placed twice as deep.  The rows up to it are a prefix of the order, so
    they hold the answer; only they enter the final top-n (the filter reaches
    the scan).  When many rows tie at the cutoff, the rows before it are all in
    the answer and the rest is the top of the tied rows by the next keys.
    """
    cols = list(order_by) if order_by else df.columns
    return _top_n(df, n, cols, sample_rows)


def _literal(value, data_type: T.DataType) -> Column:
    """A collected value as a literal of the key's own type.

    A wall-clock (``timestamp_ntz``) value goes through its ISO text, which
    casts exactly; ``lit(datetime)`` would be read in the Python process's
    zone and shifted by the session zone.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)


def _order(cols: Sequence[str]) -> list:
    return [F.col(f"`{c}`").asc_nulls_first() for c in cols]


def _top_n(df: DataFrame, n: int, cols: Sequence[str], sample_rows: int) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    if not cols:
        return df.limit(n)  # rows equal on every key: any n of them
    key = F.col(f"`{cols[0]}`")
    fraction = min(1.0, sample_rows / max(1, df.count()))
    keys = df.select(key.alias("k"))
    if fraction < 1:
        keys = keys.sample(fraction=fraction, seed=17)
    rank = int(n * fraction * CUTOFF_SLACK) + 1
    while True:
        # The rank-th smallest key of the sample; a null result means only
        # nulls (which sort first) are needed.
        cut = (
            keys.orderBy(F.col("k").asc_nulls_first()).limit(rank)
            .agg(F.count(F.lit(1)).alias("got"), F.max("k").alias("cut"))
            .first()
        )
        if cut["got"] < rank:  # the input has few rows more than the answer: no cutoff
            return df.orderBy(*_order(cols)).limit(n)
        c = cut["cut"]
        if c is not None:
            c = _literal(c, df.schema[cols[0]].dataType)
        upto = key.isNull() | (key <= c) if c is not None else key.isNull()
        kept = df.filter(upto).count()
        if kept >= n:
            break
        rank *= 2
    if kept <= TIE_FACTOR * n:
        return df.filter(upto).orderBy(*_order(cols)).limit(n)
    # Too many rows at or before the cutoff: split at the cutoff value.
    before = key.isNull() | (key < c) if c is not None else F.lit(False)
    head = df.filter(before)
    m = head.count()
    if m >= n:
        return _top_n(head, n, cols, sample_rows)
    tied = key == c if c is not None else key.isNull()
    rest = _top_n(df.filter(tied), n - m, cols[1:], sample_rows)
    return head.unionByName(rest).orderBy(*_order(cols)).limit(n)


#: Fact rows joined first for each wanted row, and by how much the prefix then grows.
PREFIX_SLACK = 2
PREFIX_GROWTH = 4


@dataclass(frozen=True)
class Capped:
    """Rows of a capped query, and what each attempt joined: (files or None, fact rows)."""

    rows: DataFrame
    attempts: tuple[tuple[int | None, int], ...]


def _rows_seen(seen: Observation) -> int:
    """Rows of an observed part; none where the optimizer found that it need not be read."""
    try:
        return int(seen.get["rows"])
    except Py4JJavaError:
        return 0


def limit_joined(
    fact: DataFrame,
    join: Callable[[DataFrame], DataFrame],
    n: int,
    path: str,
    read: Callable[[list[str]], DataFrame] | None = None,
) -> Capped:
    """``join(fact).limit(n)``: any ``n`` rows of the join, all of them if there are fewer.

    ``join`` must give each fact row's results from that row alone (inner or left joins from
    the fact, filters, projections), so rows of a part of the fact are rows of the whole.
    The first attempt joins ``PREFIX_SLACK * n`` fact rows of the first file, the next ones
    whole files, ``PREFIX_GROWTH`` times as many each time, and the last one the whole fact,
    whose result is final.  So a join that keeps most rows reads a bounded part of the fact, and
    one that drops nearly all reads at most a third more than the whole.  Each attempt's
    result is written below ``path`` and counted there; what is counted is returned.

    ``read`` reads some of the fact's files as ``fact`` reads them all (default: its files
    as Parquet under its schema).
    """
    spark = fact.sparkSession
    files = sorted(fact.inputFiles())
    read = read or (lambda some: spark.read.schema(fact.schema).parquet(*some))
    attempts: list[tuple[int | None, int]] = []
    steps: list[tuple[int | None, DataFrame]] = []
    if files:
        steps.append((1, read(files[:1]).limit(PREFIX_SLACK * n)))
        taken = 1
        while taken * PREFIX_GROWTH <= len(files):
            steps.append((taken, read(files[:taken])))
            taken *= PREFIX_GROWTH
    for i, (taken, part) in enumerate([*steps, (None, fact)]):
        seen = Observation()
        part = part.observe(seen, F.count(F.lit(1)).alias("rows"))
        target = f"{path.rstrip('/')}/attempt_{i}"
        capped = join(part).limit(n)
        capped.write.mode("overwrite").parquet(target)
        rows = spark.read.schema(capped.schema).parquet(target)
        attempts.append((taken, _rows_seen(seen)))
        if taken is None or rows.count() >= n:
            break
        if len(files) == 1 and 0 < attempts[-1][1] < PREFIX_SLACK * n:
            break  # the prefix was the whole fact
    return Capped(rows, tuple(attempts))


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> list:
    """The first ``n`` rows for a log line (reads only as far as needed)."""
    return df.take(n)
