"""Benchmark decontamination by winnowing.

The words of a text are hashed in runs of k; of each window of w consecutive runs the least hash is kept. Two texts that
share k + w - 1 consecutive words keep the same hash for that window, so joining the kept hashes of documents and
items finds every such pair. Hits are extended: in documents with a common hash the windows of words around it are
compared, as text, with the windows of the items. All of it is DataFrame functions.

An item of at least ``window`` words is looked for by its windows of that many words; a shorter one is a single window
of all its words, found with smaller k and w.

Defined results: a NULL text or one without words has no words and no hit, an item without words occurs nowhere;
repeated rows get equal results each; several items with the same window all count; an item with NULL item_id is looked
for like others, so its hits are in the spans and contaminate, but it has no id to be listed by; an empty table gives no
rows, an empty benchmark no hits; rows with NULL doc_id are treated like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.tables import settled, small_side

WINDOW = 10
#: What separates words, before and after A-Z became a-z.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAPS), "")


def exact_words(text: Column) -> Column:
    """Words with A-Z as a-z and all other letters as they are."""
    return _words(F.translate(text, _UPPER, _LOWER))


def folded_words(text: Column) -> Column:
    """Words in lower case throughout, which is cheaper: equal exact words are equal here too, at equal places.
    The one letter whose lower case depends on its neighbours is replaced first."""
    return _words(F.lower(F.replace(text, F.lit("Σ"), F.lit("σ"))))


def run_sizes(window: int) -> tuple[int, int]:
    """k and w with k + w - 1 == window."""
    k = (window + 1) // 2
    return k, window - k + 1


def _run_hashes(words: str, k: int) -> Column:
    """Hashes of the runs of k words, by where they begin."""
    at = F.col(words)
    hashed = F.transform(at, lambda x, i: F.xxhash64(x, *(F.get(at, i + d) for d in range(1, k))))
    return F.slice(hashed, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))


def _kept(runs: str, w: int) -> Column:
    """The least hash of every window of w runs, each once."""
    at = F.col(runs)
    least = at if w == 1 else F.transform(at, lambda x, i: F.least(x, *(F.get(at, i + d) for d in range(1, w))))
    return F.array_distinct(F.slice(least, 1, F.greatest(F.size(runs) - (w - 1), F.lit(0))))


def fingerprints(words: DataFrame, window: int) -> DataFrame:
    """``words`` (with a column _words) and a column _kept."""
    k, w = run_sizes(window)
    runs = words.withColumn("_runs", _run_hashes("_words", k))
    return runs.withColumn("_kept", _kept("_runs", w)).drop("_runs")


def _windows(words: str, size: Column, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice(F.col(words), i + 1, size), " ").alias("window")))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, window, _words): the windows to look for."""
    items = benchmark.select(F.col("item_id").alias("item_id"), exact_words(F.col("text")).alias("_words")).filter(F.size("_words") > 0)
    items = items.withColumn("size", F.least(F.size("_words"), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size("_words") - F.col("size"))
    exploded = items.select("item_id", "size", F.explode_outer(_windows("_words", F.col("size"), starts)).alias("_w"))
    return exploded.select("item_id", "size", "_w.window").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, spans, items): one row per row of ``docs``. ``spans`` are the hit runs of words as
    (first word, word after the last), apart from each other; ``items`` the ids of the items that occur."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    base = docs.select("doc_id", key.alias("text_key"), "text")
    looked_for = settled(item_windows(benchmark, window), "windows")
    sizes = sorted(r["size"] for r in looked_for.select("size").distinct().collect())  # at most ``window`` values
    folded = base.select("doc_id", "text_key", folded_words(F.col("text")).alias("_words"))
    counts = folded.select("doc_id", "text_key", F.size("_words").cast("long").alias("n_words"))
    found = []
    for size in sizes:
        k, _ = run_sizes(size)
        wanted = looked_for.filter(F.col("size") == size)
        as_words = wanted.select(F.split(F.lower(F.replace("window", F.lit("Σ"), F.lit("σ"))), " ").alias("_words"))
        # the outer forms: an inner one makes the optimizer test the array's size in a filter that repeats its making
        marks = fingerprints(as_words, size).select(F.explode_outer("_kept").alias("mark")).distinct()
        ours = fingerprints(folded, size).select("doc_id", "text_key", F.explode_outer("_kept").alias("mark"))
        common = ours.join(marks, "mark", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set("mark").alias("_marks"))
        common = settled(common, "common")
        near = base.join(
            small_side(common.toDF("_id", "_key", "_marks"), F.size("_marks")),
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")),
        ).select("doc_id", "text_key", "text", "_marks")
        near = near.dropDuplicates(["doc_id", "text_key"])
        near = near.withColumn("_words", folded_words(F.col("text"))).withColumn("_runs", _run_hashes("_words", k))
        at = F.filter(F.sequence(F.lit(0), F.size("_runs") - 1), lambda i: F.array_contains("_marks", F.get("_runs", i)))
        last = F.size("_words") - size
        around = F.transform(at, lambda p: F.sequence(F.greatest(p - (size - k), F.lit(0)), F.least(p, last)))
        near = near.select(
            "doc_id", "text_key", exact_words(F.col("text")).alias("_words"), F.array_distinct(F.flatten(around)).alias("_starts")
        )
        windows = near.select("doc_id", "text_key", F.explode_outer(_windows("_words", F.lit(size), F.col("_starts"))).alias("_w"))
        windows = windows.select("doc_id", "text_key", "_w.start", "_w.window")
        hits = windows.join(wanted.select("window", "item_id"), "window")
        found.append(hits.select("doc_id", "text_key", "start", (F.col("start") + size).alias("end"), "item_id"))
    if not found:
        nothing = F.array().cast("array<struct<start:int,end:int>>")
        return counts.select("*", nothing.alias("spans"), F.array().cast(f"array<{_type(benchmark)}>").alias("items"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    merged = hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_all"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    results = merged.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), _union("_all").alias("spans"), "items")
    results = settled(results, "hits")
    joined = counts.join(
        small_side(results, F.size("spans") + F.size("items")), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left"
    )
    none = F.array().cast(results.schema["items"].dataType)
    return joined.select(
        "doc_id", "text_key", "n_words", F.coalesce("spans", F.array().cast(results.schema["spans"].dataType)).alias("spans"),
        F.coalesce("items", none).alias("items"),
    )


def _type(benchmark: DataFrame) -> str:
    return benchmark.schema["item_id"].dataType.simpleString()


def _union(spans: str) -> Column:
    """Sorted spans joined where they overlap or touch."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end"] < s["start"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        )

    return F.aggregate(F.col(spans), empty, add)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no item's window occurs."""
    found = contamination(docs, benchmark, window).filter(F.size("spans") > 0)
    hit = settled(found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_key"))
    return docs.join(small_side(hit), same, "left_anti")
