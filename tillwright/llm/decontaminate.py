"""Benchmark decontamination by winnowing (DataFrame only).

Of every WINNOW consecutive GRAM-word hashes the smallest is kept as a fingerprint,
for documents and items alike. Any shared run of GRAM + WINNOW - 1 = SPAN words has
the same hashes on both sides, so it keeps the same fingerprint: no shared window of
SPAN words is missed. Documents that share a fingerprint are read again, each hit is
extended to all windows of SPAN words around it, and these are compared word by word
with the item windows. An item of fewer words than SPAN is one window; documents are
searched for those lengths exactly, as they are too short to be winnowed.

Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z
lowered. The first pass lowers by ``lower()``, which only merges more words, so it
can add candidates and lose none; a capital sigma, which alone ``lower()`` turns into
one or another letter by what follows its word, is replaced before.

Defined results: null and empty texts have no words and no hits; items without words
hit nothing; items without an id are not listed; repeated item ids are one item;
a repeated document row gets a result of its own; with an empty benchmark every
document is clean; other columns are not read unless ``carry`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import keep, tidy

SPAN = 10
GRAM = 8
WINNOW = SPAN - GRAM + 1

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Benchmark fingerprints or windows are broadcast up to this many (64 bits, or
#: some 70 bytes of text, each); a larger benchmark is joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Short items up to this many are looked for inside the arrays of a document's runs.
FEW_SHORT = 200


def words(text: Column) -> Column:
    """The words of a text, A-Z lowered."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _lowered(text: Column) -> Column:
    """The text in lower case, equal words in equal letters whatever stands next to them."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u03a3"), F.lit("\u03c3")))


def _positions(length: Column, size: int) -> Column:
    """1, 2, ... of every run of ``size`` in an array of that length; none if shorter."""
    last = length - (size - 1)
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _cut(rows: DataFrame, text: Column, *keys: str) -> DataFrame:
    """The keys and the words ``own`` of a text, as they are written in it.

    Splitting costs half of extracting; an empty first or last part is no word.
    """
    parts = rows.select(*keys, F.split(text, BETWEEN).alias("parts"))
    head = (F.get("parts", F.lit(0)) == "").cast("int")
    tail = ((F.size("parts") > 1) & (F.element_at("parts", -1) == "")).cast("int")
    return parts.select(*keys, F.slice("parts", head + 1, F.size("parts") - head - tail).alias("own"))


def _ahead(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _folded(rows: DataFrame, column: str, size: int, pair) -> DataFrame:
    """``column``, with every place now standing for ``size`` places from there on.

    Runs are doubled by pairing the array with itself moved ahead; only the first
    ``len - size + 1`` places hold full runs. One step reads one stored array, so each
    is computed once.
    """
    others = [c for c in rows.columns if c != column]
    own, reach = F.col(column), 1
    while reach * 2 <= size:
        rows = rows.select(*others, F.zip_with(own, _ahead(own, reach), pair).alias(column))
        reach *= 2
    if reach < size:  # the rest overlaps
        rows = rows.select(*others, F.zip_with(own, _ahead(own, size - reach), pair).alias(column))
    return rows


def gram_hashes(rows: DataFrame) -> DataFrame:
    """``hashes`` of every GRAM words of ``own``, in order; GRAM is a power of two."""
    others = [c for c in rows.columns if c != "own"]
    single = rows.select(
        *others, F.size("own").alias("n_own"), F.transform("own", lambda w: F.xxhash64(w)).alias("hashes")
    )
    folded = _folded(single, "hashes", GRAM, lambda a, b: F.xxhash64(a, b))
    full = F.slice("hashes", 1, F.greatest(F.col("n_own") - (GRAM - 1), F.lit(0)))
    return folded.select(*others, full.alias("hashes"))


def fingerprints(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key and fingerprint of its ``text``."""
    own = _cut(rows, _lowered(F.col("text")), *key)
    hashed = gram_hashes(own)
    counted = hashed.select(*key, F.size("hashes").alias("n_hashes"), "hashes")
    least = _folded(counted, "hashes", WINNOW, lambda a, b: F.least(a, b))
    full = F.slice("hashes", 1, F.greatest(F.col("n_hashes") - (WINNOW - 1), F.lit(0)))
    return least.select(*key, F.explode(F.array_distinct(full)).alias("print"))


def _window_text(own: str, start: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(F.col(own), start, size), " ")


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, window text and its number of words, distinct."""
    own = items.select("item_id", words(F.col("text")).alias("own")).where(F.size("own") > 0)
    size = F.least(F.size("own"), F.lit(SPAN))
    starts = own.select(
        "item_id", "own", size.alias("size"),
        F.explode(F.sequence(F.lit(1), F.size("own") - size + 1)).alias("start"),
    )
    return starts.select(
        "item_id", _window_text("own", F.col("start"), F.col("size")).alias("window"), "size"
    ).distinct()


def _small(df: DataFrame) -> DataFrame:
    """Broadcast after its rows were counted, else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _short_hits(rows: DataFrame, windows: DataFrame) -> DataFrame | None:
    """Occurrences of the items that have fewer than SPAN words, by exact runs of that length.

    One pass for all lengths. With up to FEW_SHORT items a run is looked at only where a
    word is the first of some item, and stays in an array until its hash is that of an item;
    so a row is made for a hit only, and its text is compared. More items are found by a join
    of all runs of those lengths.
    """
    short = windows.where(F.col("size") < SPAN).select("window", "size").distinct()
    wanted = short.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # nine lengths at most
    if not wanted:
        return None
    key = ["doc_id", "text_key"]
    sizes = sorted(r["size"] for r in wanted)
    own = rows.select(*key, words(F.col("text")).alias("own"))
    if sum(r["n"] for r in wanted) <= FEW_SHORT:
        # Bounded by FEW_SHORT, so the hashes are literals of the plan.
        few = short.select(
            F.xxhash64("window").alias("whole"), F.xxhash64(F.substring_index("window", " ", 1)).alias("first")
        ).collect()
        wholes = F.array(*map(F.lit, sorted({r["whole"] for r in few})))
        firsts = F.array(*map(F.lit, sorted({r["first"] for r in few})))
        starts = F.filter(
            _positions(F.size("own"), sizes[0]),
            lambda i: F.array_contains(firsts, F.xxhash64(F.element_at(F.col("own"), i))),
        )

        def runs_at(i: Column) -> Column:
            return F.filter(
                F.array(*[F.struct(i.alias("start"), F.lit(s).alias("size")) for s in sizes]),
                lambda r: (i + r["size"] - 1 <= F.size("own"))
                & F.array_contains(wholes, F.xxhash64(_window_text("own", i, r["size"]))),
            )

        runs = F.flatten(F.transform(starts, runs_at))
    else:

        def runs_of(size: int) -> Column:
            def run(i):
                return F.struct(i.alias("start"), F.lit(size).alias("size"))

            return F.transform(_positions(F.size("own"), size), run)

        runs = F.concat(*map(runs_of, sizes))
    found = own.select(*key, "own", F.explode(runs).alias("run")).select(
        *key, "run.start", "run.size", _window_text("own", F.col("run.start"), F.col("run.size")).alias("window")
    )
    return found.join(_small(short), ["window", "size"], "left_semi").select(*key, "start", "size", "window")


def occurrences(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, size, window) of every item window in a document."""
    windows = keep(item_windows(items), "item-windows")
    marks = keep(fingerprints(items.select("item_id", "text"), ["item_id"]).select("print").distinct(), "item-prints")
    shared = fingerprints(rows, ["doc_id", "text_key"]).join(_small(marks), "print", "left_semi")
    hits = keep(
        shared.groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("prints")), "shared-prints"
    )
    # Only documents with a shared fingerprint are read again. Their hashes are those
    # of the first pass, so the hits are where a hash is one of the shared ones.
    again = rows.join(
        hits, rows["doc_id"].eqNullSafe(hits["doc_id"]) & (rows["text_key"] == hits["text_key"])
    ).select(rows["doc_id"], rows["text_key"], rows["text"], hits["prints"])
    key = ["doc_id", "text_key", "prints", "text"]
    hashed = gram_hashes(_cut(again, _lowered(F.col("text")), *key)).select(
        "doc_id", "text_key", "prints", words(F.col("text")).alias("own"), "hashes"
    )
    at = F.filter(
        F.sequence(F.lit(1), F.size("hashes")),
        lambda i: F.array_contains(F.col("prints"), F.element_at(F.col("hashes"), i)),
    )
    hit = hashed.select("doc_id", "text_key", "own", at.alias("at"))
    # A window that holds a hit starts at it or at most WINNOW - 1 words before.
    around = F.array_distinct(
        F.flatten(
            F.transform("at", lambda i: F.sequence(F.greatest(i - (WINNOW - 1), F.lit(1)), i))
        )
    )
    starts = hit.select("doc_id", "text_key", "own", F.explode(around).alias("start"))
    spans = starts.where(F.col("start") + (SPAN - 1) <= F.size("own")).select(
        "doc_id", "text_key", "start", F.lit(SPAN).alias("size"),
        _window_text("own", F.col("start"), SPAN).alias("window"),
    )
    wanted = _small(windows.where(F.col("size") == SPAN).select("window").distinct())
    found = spans.join(wanted, "window", "left_semi")
    short = _short_hits(rows, windows)
    if short is not None:
        found = found.unionByName(short)
    return keep(found, "occurrences"), windows


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    carry: list[Column] | None = None,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and what ``carry`` names."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.col(text).alias("text"),
        *(carry or []),
    )
    extra = rows.columns[3:]
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    with tidy(docs.sparkSession):
        found, windows = occurrences(rows, asked)
        key = ["doc_id", "text_key"]
        ends = found.select(*key, "start", (F.col("start") + F.col("size")).alias("stop")).distinct()
        before = Window.partitionBy(*key).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
        fresh = F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0)))
        covered = ends.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*key).agg(
            F.sum("fresh").alias("n_hit")
        )
        named = (
            found.select(*key, "window", "size").distinct()
            .join(windows.where("item_id is not null"), ["window", "size"])
            .select(*key, F.col("item_id").cast("string").alias("item")).distinct()
            .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
        )
        hits = keep(
            covered.join(
                named, covered["doc_id"].eqNullSafe(named["doc_id"]) & (covered["text_key"] == named["text_key"]), "left"
            ).select(covered["doc_id"], covered["text_key"], "n_hit", "items"),
            "hits",
            stays=True,
        )
    counted = _cut(rows, F.coalesce("text", F.lit("")), "doc_id", "text_key", *extra).select(
        "doc_id", "text_key", *extra, F.size("own").cast("long").alias("n_words")
    )
    none = F.array().cast("array<string>")
    hit_items = F.coalesce("items", none)
    return counted.join(
        hits, counted["doc_id"].eqNullSafe(hits["doc_id"]) & (counted["text_key"] == hits["text_key"]), "left"
    ).select(
        counted["doc_id"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(hit_items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", hit_items), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        *extra,
    )
