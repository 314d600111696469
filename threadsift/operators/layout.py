"""How rows are spread over tasks and files before a write."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_KEY = ("year", "month")
# Salted keys are hashed to tasks; with several per task the shares come out even.
_SALTS_PER_TASK = 16
# Pieces of a month when the size of the feed is not known.
_FEWEST_PIECES = 8
# A month is cut so that one with all rows has pieces of so many advisory partition sizes.
_SIZES_PER_PIECE = 32
_PIECE = "_piece"
# Among so many shares of a month's pieces its groups are dealt out.
_SHARES = 8
# Where sizes are known: advisory partition sizes in a piece of a month. Up to so many the whole feed needs no pieces.
_SIZES_PER_FILE = 2

REBALANCE = "rebalance"
AS_READ = "as_read"


def _adaptive(df: DataFrame) -> bool:
    needed = ["spark.sql.adaptive.enabled"]
    if df.isStreaming:
        needed.append("spark.sql.adaptive.streaming.stateless.enabled")
    return all(df.sparkSession.conf.get(key, "true").lower() == "true" for key in needed)


def pieces_of_month(spark: SparkSession, source_bytes: int | None) -> int:
    """Into how many pieces to cut a month of a feed of that size."""
    if not source_bytes:
        return _FEWEST_PIECES
    return max(_FEWEST_PIECES, -(-source_bytes // (_SIZES_PER_PIECE * advisory_bytes(spark))))


def advisory_bytes(spark: SparkSession) -> int:
    """The size of file that the session asks for."""
    return _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))


def needs_no_pieces(spark: SparkSession, source_bytes: int | None) -> bool:
    """Whether a month with the whole feed would still be a file of usual size."""
    return source_bytes is not None and source_bytes <= _SIZES_PER_FILE * advisory_bytes(spark)


@dataclass(frozen=True)
class Pieces:
    """Into how many pieces to cut each month, the same for all that are not named."""

    default: int = 1
    by_month: dict[tuple[int | None, int | None], int] = field(default_factory=dict)

    def column(self) -> Column:
        """Looked up by the number of the month, in an array that travels with the plan; a NULL month has an entry of its own."""
        known = {12 * y + m: n for (y, m), n in self.by_month.items() if y is not None and m is not None}
        undated = F.lit(self.by_month.get((None, None), self.default))
        if not known:
            return F.when(F.col("year").isNull(), undated).otherwise(self.default)
        first, last = min(known), max(known)
        if last - first > _MOST_MONTHS:  # odd times far from the others
            known = dict(sorted(known.items(), key=lambda x: -x[1])[:_MOST_MONTHS])
            table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
            return F.when(F.col("year").isNull(), undated).otherwise(F.coalesce(table[F.col("year") * 12 + F.col("month")], F.lit(self.default)))
        counts = F.array(*[F.lit(known.get(k, self.default)) for k in range(first, last + 1)])
        at = F.col("year") * 12 + F.col("month") - F.lit(first)
        inside = at.between(0, last - first)
        return F.when(F.col("year").isNull(), undated).when(inside, F.get(counts, at)).otherwise(self.default)


# Months in the array; 2,000 years have 24,000.
_MOST_MONTHS = 2400


def measured_pieces(spark: SparkSession, month_bytes: dict[tuple[int | None, int | None], float], whole: bool = False) -> Pieces:
    """Pieces of one or two files each, from the bytes of every month.

    Months that a sample has missed are cut like the largest known one, which costs them some small files at worst; with
    ``whole`` there are no others.
    """
    size = _SIZES_PER_FILE * advisory_bytes(spark)
    found = {month: max(1, -(-int(n) // size)) for month, n in month_bytes.items()}
    return Pieces(1 if whole else max(found.values(), default=_FEWEST_PIECES), found)


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def by_month(
    df: DataFrame,
    layout: str = REBALANCE,
    partitions: int | None = None,
    salt_columns: tuple[str, ...] = (),
    pieces: int | Pieces | Column = _FEWEST_PIECES,
    near: str | None = None,
) -> DataFrame:
    """Brings the rows of a month together so that a month gets few, full files.

    ``rebalance`` shuffles once by month and a piece of it, a hash of ``salt_columns`` below
    ``pieces``; so a month that holds all rows is still that many tasks, whatever the number of
    partitions, and one that is known to be small is one file. Adaptive execution merges small pieces and splits what is larger than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` where it can see that. With adaptive execution
    off every task gets its share of every month, at the price of more files.

    With ``near`` the rows of one value of that column lie in an eighth of a month's pieces, so most files can be skipped
    when it is asked for, and a value with a third of the rows makes no piece larger than about three usual ones.

    ``as_read`` moves nothing: right for a feed whose files are already in time order.
    """
    if layout == AS_READ:
        return df
    if layout != REBALANCE:
        raise ValueError(f"layout is {REBALANCE!r} or {AS_READ!r}, not {layout!r}")
    salt = F.xxhash64(*(salt_columns or df.columns))
    if _adaptive(df):
        number_of = pieces.column() if isinstance(pieces, Pieces) else pieces if isinstance(pieces, Column) else F.lit(pieces)
        if near is not None:
            share = F.greatest(F.call_function("div", number_of, F.lit(_SHARES)), F.lit(1))
            salt = F.pmod(F.xxhash64(near), number_of) + F.pmod(salt, share)
        cut = df.withColumn(_PIECE, F.pmod(salt, number_of))
        number = () if partitions is None else (partitions,)
        return cut.hint("rebalance", *number, *MONTH_KEY, _PIECE).drop(_PIECE)
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *MONTH_KEY, F.pmod(salt, F.lit(_SALTS_PER_TASK * tasks)))
