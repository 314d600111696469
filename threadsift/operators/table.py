"""Raw feed to analytical table in one counted pass, the same for a batch and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadsift.operators.clean import CAST_RULES, CLEANING_RULES, REJECT, keep_tagged, tag, typed_columns
from threadsift.operators.features import all_features, analytical_columns, month_columns
from threadsift.operators.layout import MONTH_KEY, REBALANCE, Pieces, by_month, pieces_of_month
from threadsift.operators.quality import present_fields, reject_counts
from threadsift.spec import CORRUPT, DEFAULT, FeedSpec

RULES = CLEANING_RULES + CAST_RULES
STATUS, RECORD = "reject", "record"
KEPT = "kept"


def counted_table(
    raw: DataFrame,
    observation: Observation | str,
    spec: FeedSpec = DEFAULT,
    drop_empty: bool = False,
    layout: str = REBALANCE,
    partitions: int | None = None,
    source_bytes: int | None = None,
    pieces: Pieces | None = None,
    quarantine: bool = False,
    cluster: bool = False,
) -> DataFrame:
    """The analytical table laid out by month, its rejects counted on the way.

    With ``quarantine`` rejected rows stay, with the first rule that they break in ``reject`` and the record as it was read in ``record``:
    the line itself if it was broken, else its fields as JSON. Kept rows have ``kept`` and NULL there.

    With ``cluster`` a group's rows of a month lie together, in the order of time.

    Only typed values, the month and the reject reason are computed before the shuffle by
    month; counters and features come after it. Rows to drop travel along for that, without
    their text. The counters have to sit there: when an executor is lost Spark runs its map
    tasks again and would count their rows twice, whereas each partition of the writing
    stage is counted exactly once. Which fields have any value at all is counted with them.
    """
    carried = [c for c in (*spec.fields, CORRUPT) if c in raw.columns]
    has_values, bits = present_fields([c for c in spec.fields if c in raw.columns])
    record = F.to_json(F.struct(*[c for c in spec.fields if c in raw.columns]), {"ignoreNullFields": "false"})
    record = F.coalesce(F.col(CORRUPT), record) if CORRUPT in raw.columns else record
    tagged = (
        raw.select(*carried, bits, *[record.alias(RECORD)] * quarantine)
        .transform(typed_columns, spec)
        .transform(month_columns)
        .transform(tag, RULES, spec, drop_empty=drop_empty)
        .withColumn(spec.text, F.when(F.col(REJECT).isNull(), F.col(spec.text)))
        .drop(spec.event_time, spec.score, CORRUPT)
    )
    rejected = F.col(REJECT).isNotNull()
    if quarantine:
        undated = {c: F.when(~rejected, F.col(c)) for c in MONTH_KEY}
        tagged = tagged.withColumns({RECORD: F.when(rejected, F.col(RECORD)), **undated})
    salt = next(((c,) for c in (spec.id, spec.text) if c in tagged.columns), ())
    by_size = pieces_of_month(raw.sparkSession, source_bytes)
    cut = pieces or by_size
    if quarantine:  # rejected rows have no month and may be many
        cut = F.when(rejected, by_size).otherwise(cut.column() if isinstance(cut, Pieces) else cut)
    cluster = cluster and spec.group in tagged.columns
    placed = by_month(tagged, layout, partitions, salt, cut, spec.group if cluster else None)
    counted = placed.observe(observation, *reject_counts(RULES), *has_values)
    order = [*MONTH_KEY, spec.group, "created_utc_long"]
    if not quarantine:
        kept = keep_tagged(counted).transform(all_features, spec).transform(analytical_columns, spec)
        return kept.sortWithinPartitions(*order) if cluster else kept
    full = counted.transform(all_features, spec)
    dates = {c: F.when(~rejected, F.col(c)) for c in MONTH_KEY}
    full = full.withColumns(dates).withColumn(STATUS, F.coalesce(F.col(REJECT), F.lit(KEPT)))
    full = full.select(*[c for c in spec.analytical_types if c in full.columns], STATUS, RECORD)
    return full.sortWithinPartitions(STATUS, *order) if cluster else full
