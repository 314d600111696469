"""Line deduplication by a segment-partition edit join.

A line that equals an earlier one, or is within ``EDITS`` edits of one, is removed. Lines come in the order of doc_id
and place; every line is judged against the input, not against what is left. Near lines have at least ``MIN_CHARS``
characters; shorter ones of at least ``EXACT_WORDS`` words are removed where they equal an earlier line.

Equal lines are found by an aggregate over 128-bit hashes. For near lines each distinct line is cut into edits + 1
segments, of which at most ``edits`` can be touched, so a line within reach has one of them unchanged, at a place that
differs by at most the shift that the lengths allow. (length, segment number, segment) are the index; each line probes
the lengths and places where a segment of an earlier line could be. A key that very many lines share, such as the start
of a template, says little: what is left of its lines without the shared segment is within reach too, so it is cut into
segments once more, and the lines meet under both keys, and so on. Lines that meet under a key are compared in blocks
of bounded size inside expressions: first by their sets of three-character runs, of which an edit changes at most six,
then by a banded bit-parallel edit distance. A line needs one witness, so no pairs are put out. All of it is DataFrame
functions.

Lines that are at least a ten-thousandth of all lines (so at most ten thousand of them) enter the index once,
by a broadcast of that list; this keeps repeated lines from gathering at a key.

Defined results: rows with NULL doc_id come last, rows with equal or no doc_id in the order of a hash of the text; NULL
and empty texts have no lines to remove and stay as they are; rows that agree in doc_id and text are the same document,
so their lines do not remove each other; an empty table gives no rows. Line breaks are ``\\n`` only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadsift.llm.tables import settled, small_side

MIN_CHARS = 32
EXACT_WORDS = 3
EDITS = 2
#: Lines in one side of a block comparison.
BLOCK = 64
#: One of so many lines is frequent enough to be indexed from a list.
FREQUENT = 10_000
#: Lines at a key beyond which it is made finer, and how often.
HOT = 256
LEVELS = 4
_GRAM = 3  # characters
_GRAM_WORDS = 8  # 64-bit words of the set of character grams
_GAP = bytes(4)  # stands where a shared segment was


def lines_of(docs: DataFrame, min_chars: int, exact_words: int | None = None) -> DataFrame:
    """(doc_id, text_key, pos, line) of the lines that take part: those of ``min_chars`` characters or, if given, of
    ``exact_words`` words; pos counts all lines from 0."""
    # the outer form: for an inner one the optimizer splits twice, to leave out empty arrays first
    split = docs.select("doc_id", _text_key(docs).alias("text_key"), F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    takes_part = F.length("line") >= min_chars
    if exact_words is not None:
        takes_part = takes_part | (F.size(F.array_remove(F.split("line", r"\s+"), "")) >= exact_words)
    return split.filter(takes_part)


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"])


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "pos")


def _hashes(line: str = "line") -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def wide(line: str) -> Column:
    """The line with four bytes per character, so that parts of it are found without counting characters."""
    return F.encode(F.col(line), "UTF-32")


def segment_keys(lines: DataFrame, edits: int, min_chars: int, rest: bool = False) -> DataFrame:
    """(name, index, key) from (name, _wide): the keys that each line probes; those with ``index`` below edits + 1 are
    its own segments. With ``rest`` also the line without the segment."""
    n = edits + 1
    whole = lambda a, b: F.call_function("div", a, F.lit(b)).cast("int")
    length = whole(F.octet_length("_wide"), 4)
    for shorter in range(n):  # sizes of the segments of a line that is so much shorter; the later ones are the longer
        lines = lines.withColumns({f"_q{shorter}": whole(length - shorter, n), f"_r{shorter}": F.pmod(length - shorter, F.lit(n))})
    index, others, places = [], [], {}
    for shorter in range(n):
        size, longer = F.col(f"_q{shorter}"), F.col(f"_r{shorter}")
        other = size * n + longer
        for i in range(n):
            start = size * i + F.greatest(longer + (i - n), F.lit(0))
            own = size + F.when(longer >= n - i, 1).otherwise(0)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                key = F.xxhash64(other, F.lit(i), F.substring("_wide", start * 4 + (4 * shift + 1), own * 4))
                if shorter or shift:
                    others.append(F.when(other >= min_chars, key))
                else:
                    index.append(key)
                places[shorter, shift, i] = (start + shift, own)
    keys = F.posexplode_outer(F.array(*index, *others)).alias("index", "key")
    if not rest:
        return lines.select("name", keys)
    order = [x for x in places if not (x[0] or x[1])] + [x for x in places if x[0] or x[1]]
    ends = [F.array(*[places[x][k] for x in order]).alias(f"_{k}") for k in (0, 1)]
    cut = lines.select("name", "_wide", *ends, keys)
    start, size = (F.get(f"_{k}", F.col("index")) for k in (0, 1))
    left = F.substring("_wide", F.lit(1), start * 4)
    right = F.substring("_wide", (start + size) * 4 + 1, F.octet_length("_wide"))
    return cut.select("name", "index", "key", F.concat(left, F.lit(_GAP), right).alias("rest"))


def code_points(line: str) -> Column:
    return F.transform(F.split(F.col(line), ""), lambda c: F.ascii(c))


def character_grams(chars: str) -> Column:
    """The set of runs of ``_GRAM`` characters, hashed to 64 * ``_GRAM_WORDS`` numbers."""
    own = F.col(chars)
    gram = lambda c, i: F.pmod(F.xxhash64(c, *(F.get(own, i + d) for d in range(1, _GRAM))), F.lit(64 * _GRAM_WORDS)).cast("int")
    return F.array_distinct(F.transform(own, gram))


def as_bits(numbers: str, word: int) -> Column:
    """The numbers from 64 * word on, as bits of one number."""
    own = F.filter(F.col(numbers), lambda b: F.floor(b / 64) == word)
    one = F.lit(1).cast("long")
    return F.aggregate(own, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(b, F.lit(64)))))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two texts, given as arrays of code points, is at most ``edits``.

    Bit d of state e says that the first i characters of ``a`` become the first i + d - edits of ``b`` by at most e
    edits; one step takes the next character of ``a`` for all diagonals of the band at once.
    """
    band = (1 << (2 * edits + 1)) - 1
    start = F.struct(*(F.lit(((1 << (e + 1)) - 1) << edits & band).alias(f"r{e}") for e in range(edits + 1)))

    def diagonals(own: Column, i: Column) -> Column:
        same = F.lit(0)
        for d in range(2 * edits + 1):
            same = same.bitwiseOR(F.when(own == F.get(b, i + (d - edits)), 1 << d).otherwise(0))
        return same

    def step(state: Column, same: Column) -> Column:
        rows = []
        for e in range(edits + 1):
            now = state[f"r{e}"].bitwiseAND(same)
            if e:
                fewer = state[f"r{e - 1}"]
                now = now.bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1)).bitwiseOR(F.shiftleft(rows[-1], 1)).bitwiseAND(F.lit(band))
            rows.append(now)
        return F.struct(*(r.alias(f"r{e}") for e, r in enumerate(rows)))

    final = F.aggregate(F.transform(a, diagonals), start, step, lambda s: s[f"r{edits}"])
    apart = F.size(b) - F.size(a) + edits
    reached = F.call_function("shiftright", final, F.greatest(apart, F.lit(0)))
    return (apart >= 0) & (apart <= 2 * edits) & (reached.bitwiseAND(F.lit(1)) == 1)


def within_edits_trimmed(a: Column, b: Column, edits: int) -> Column:
    """``within_edits``, measured without halves or quarters at the start and the end that both have."""
    least = F.least(F.size(a), F.size(b))

    def same(side: int) -> Column:
        out = F.lit(0)
        for share in (4, 2):
            n = F.call_function("div", least, F.lit(share)).cast("int")
            start = F.lit(1) if side > 0 else F.least(-n, F.lit(-1))
            out = F.when((n > 0) & (F.slice(a, start, F.greatest(n, F.lit(0))) == F.slice(b, start, F.greatest(n, F.lit(0)))), n).otherwise(out)
        return out

    cut = lambda x, t: F.slice(x, t["front"] + 1, F.size(x) - t["front"] - t["back"])
    # through arrays of one, so that each part is made once
    ends = F.array(F.struct(same(1).alias("front"), same(-1).alias("back")))
    middles = F.transform(ends, lambda t: F.struct(cut(a, t).alias("a"), cut(b, t).alias("b")))
    return F.exists(middles, lambda t: within_edits(t["a"], t["b"], edits))


def meetings(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(key, name, index, n) from (name, _wide): names that share a key, how many they are, and whether the name is an
    entry of the index there.

    A key of more than ``HOT`` names is replaced by finer ones: two lines within reach that share a segment are still within
    reach without it, so what is left of the shorter one has a segment that the other probes. At the last level, what is
    still frequent stays as it is.
    """
    rows, found, least = lines.select("name", F.lit(True).alias("entry"), F.lit(None).cast("long").alias("above"), "_wide"), [], min_chars
    for level in range(LEVELS):
        held = rows.select(F.struct("name", "entry", "above").alias("name"), "_wide")
        met = settled(_met(_chained(segment_keys(held, edits, least), edits)), "met")
        counts = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        if level == LEVELS - 1 or counts.filter(F.col("n") > HOT).isEmpty():
            return reduce(DataFrame.unionByName, [*found, met.join(counts, "key")])
        counts = settled(counts, "counts")
        found.append(met.join(counts.filter(F.col("n") <= HOT), "key"))
        hot = small_side(settled(counts.filter(F.col("n") > HOT).select("key"), "hot"))
        finer = _chained(segment_keys(held, edits, least, rest=True), edits).join(hot, "key", "left_semi")
        rows, least = settled(finer.select("name", "entry", F.col("key").alias("above"), F.col("rest").alias("_wide")), "finer"), 0


def _chained(keys: DataFrame, edits: int) -> DataFrame:
    """Keys with those of the levels above; only entries of the index above are entries here."""
    key = F.when(F.col("name.above").isNull(), F.col("key")).otherwise(F.xxhash64("name.above", "key"))
    entry = F.col("name.entry") & (F.col("index") <= edits)
    others = [c for c in keys.columns if c not in ("name", "index", "key")]
    return keys.filter("key is not null").select(key.alias("key"), F.col("name.name").alias("name"), entry.alias("entry"), *others)


def _met(keys: DataFrame) -> DataFrame:
    """(key, name, index) where a key has more than one name."""
    one = F.lit(1).cast("long")
    # the lowest bit says that the row is an entry of the index
    bits = keys.select("key", F.shiftleft("name", 1).bitwiseOR(F.when(F.col("entry"), one).otherwise(0)).alias("bits"))
    by_key = Window.partitionBy("key")
    own = F.shiftright("bits", 1)
    met = bits.select("key", "bits", F.min(own).over(by_key).alias("_a"), F.max(own).over(by_key).alias("_b")).filter("_a <> _b")
    return met.groupBy("key", own.alias("name")).agg((F.max(F.col("bits").bitwiseAND(one)) == 1).alias("index"))


def near_lines(docs: DataFrame, distinct: DataFrame, total: int, edits: int, min_chars: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within reach."""
    lines = lines_of(docs, min_chars).select("doc_id", "text_key", "pos", "line", *_hashes())
    frequent = distinct.filter(F.col("n") * FREQUENT > total).select(F.col("h1").alias("_f1"), F.col("h2").alias("_f2"), F.col("first").alias("_first"))
    # at most FREQUENT rows
    kept = lines.join(F.broadcast(frequent), (F.col("h1") == F.col("_f1")) & (F.col("h2") == F.col("_f2")), "left")
    kept = kept.filter(F.col("_first").isNull() | F.col("_first").eqNullSafe(_place()))
    # a line is named by 62 bits of its hash
    met = meetings(kept.select(F.shiftright("h1", 2).alias("name"), wide("line").alias("_wide")), edits, min_chars)
    names = settled(met.select("name").distinct(), "names")
    texts = lines.withColumn("name", F.shiftright(F.shiftleft(F.shiftright("h1", 2), 1), 1))
    texts = texts.join(small_side(names), "name", "left_semi").groupBy("name", "line").agg(F.min(_place()).alias("first"))
    words = [f"p{i}" for i in range(_GRAM_WORDS)]
    texts = texts.withColumn("chars", code_points("line"))
    # columns of a table, so that the optimizer cannot move their making into a loop over characters
    texts = settled(texts, "texts").withColumn("grams", character_grams("chars"))
    texts = settled(texts.select("name", "line", "first", "chars", *(as_bits("grams", i).alias(w) for i, w in enumerate(words))), "texts")
    members = met.join(texts, "name").select("key", "n", "index", "line", "chars", "first", *words)
    # all lines of a key in one array, or those of a frequent key in blocks, whose pairs are dealt out anew
    fields = F.collect_list(F.struct("line", "chars", "first", "index", *words))
    few = members.filter(F.col("n") <= BLOCK).groupBy("key").agg(fields.alias("lines"))
    block = F.pmod(F.xxhash64("line"), F.ceil(F.col("n") / BLOCK))
    blocks = members.filter(F.col("n") > BLOCK).groupBy("key", block.alias("block")).agg(fields.alias("lines"))
    earlier = blocks.select(F.col("key").alias("_key"), F.col("block").alias("before"), F.col("lines").alias("earlier"))
    pairs = blocks.join(earlier, F.col("key") == F.col("_key"))
    pairs = pairs.repartition("key", "block", "before").select("lines", "earlier")
    pairs = pairs.unionByName(few.select("lines", F.col("lines").alias("earlier")))

    def reached(p: Column) -> Column:
        def witness(q: Column) -> Column:
            changed = [F.bit_count(p[w].bitwiseXOR(q[w])) for w in words]
            some, all_of_them = (sum(x[1:], x[0]) <= 2 * _GRAM * edits for x in (changed[: _GRAM_WORDS // 4], changed))
            # the index holds the segments of the shorter line of a pair, which may be either
            comes_first = (q["first"] < p["first"]) & (p["line"] != q["line"]) & (p["index"] | q["index"])
            return comes_first & some & all_of_them & within_edits_trimmed(q["chars"], p["chars"], edits)

        return F.exists("earlier", witness)

    found = pairs.select(F.explode_outer(F.filter("lines", reached)).alias("_p")).select(F.col("_p.line").alias("line"))
    return found.filter("line is not null").select(*_hashes()).distinct()


def removed_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, exact_words: int | None = EXACT_WORDS) -> DataFrame:
    """(doc_id, text_key, removed): the lines that go, as (pos, h1) members, for documents that lose any."""
    places = lines_of(docs, min_chars, exact_words).select("doc_id", "text_key", "pos", *_hashes())
    distinct = places.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = settled(distinct, "lines")
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    near = settled(near_lines(docs, distinct, total, edits, min_chars), "near").withColumn("near", F.lit(True))
    marked = distinct.join(near, ["h1", "h2"], "left").filter("n > 1 or near")
    marked = settled(marked.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), "first", F.coalesce("near", F.lit(False)).alias("near")), "marked")
    gone = places.join(small_side(marked), (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")))
    gone = gone.filter(F.col("near") | ~F.col("first").eqNullSafe(_place()))
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("pos", "h1")).alias("removed"))


def without_repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, exact_words: int | None = EXACT_WORDS) -> DataFrame:
    """``docs`` with what is left of each text, and _n_lines and _n_removed."""
    removed = settled(removed_lines(docs, edits, min_chars, exact_words), "removed")
    removed = removed.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("removed").alias("_removed"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (_text_key(docs) == F.col("_key"))
    joined = docs.join(small_side(removed, F.size("_removed")), same, "left")
    split = F.split(docs["text"], "\n")
    kept = F.filter(split, lambda line, i: ~F.array_contains("_removed", F.struct(i.alias("pos"), F.xxhash64(line).alias("h1"))))
    joined = joined.withColumn("_kept", F.when(F.col("_removed").isNotNull(), kept))
    text = F.when(F.col("_kept").isNull(), docs["text"]).otherwise(F.array_join("_kept", "\n"))
    n_lines = F.when(docs["text"].isNull(), 0).otherwise(F.size(split))
    others = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    n_removed = F.when(F.col("_kept").isNull(), 0).otherwise(n_lines - F.size("_kept"))
    return joined.select(*others, n_lines.cast("long").alias("_n_lines"), n_removed.cast("long").alias("_n_removed"))
