"""Benchmark decontamination with DataFrame functions: a broadcast hash set of test windows, scanned by token windows.

Each window of a document is looked up by its hash and verified by its words. One scan of the documents gives a row
per document and a row per verified hit; only those are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import column, lower_ascii, stored

WINDOW = 13
#: A hash set above this many bytes is broadcast in several parts, each in a scan of its own.
BROADCAST_BYTES = 32 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def grams(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(h, len, gram, items): each distinct window of the items and the sorted ids of the items that hold it.

    An item of fewer words than a window, but not none, is one window. Null texts have none. Items without an id give
    windows, but no id.
    """
    held = items.select(column(id_col).alias("item"), words(column(text_col)).alias("w")).where(F.size("w") > 0)
    held = held.withColumn("len", F.least(F.size("w"), F.lit(window)))
    held = held.select("item", "len", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("at"))
    part = F.slice("w", F.col("at"), F.col("len"))
    held = held.select("item", "len", F.xxhash64(part).alias("h"), F.array_join(part, " ").alias("gram"))
    return held.groupBy("h", "len", "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """A row (id, key, at 0, n_words) for each document, and (id, key, at, len, items) for each verified window.

    ``key`` is a hash of the text: repeated rows of one id and text share it. ``at`` counts words from 1.
    """
    known = stored(grams(items, item_id, item_text, window), "grams")
    sizes = known.agg(
        F.sum(F.octet_length("gram") + 8 * F.size("items") + 64).alias("bytes"), F.collect_set("len").alias("lens")
    ).first()  # one row; there are at most ``window`` lengths
    parts = -(-(sizes["bytes"] or 1) // BROADCAST_BYTES)
    lens = sorted({window, *sizes["lens"]})
    text = column(text_col)
    base = docs.select(
        column(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), words(text).alias("w")
    )
    base = base.withColumn("n_words", F.size("w").cast("long"))
    base = base.select("*", F.explode(F.array(*map(F.lit, lens))).alias("len"))
    # The longest windows also carry the row of the document itself, at 0.
    first = F.when(F.col("len") == window, 0).otherwise(1)
    last = F.greatest(F.size("w") - F.col("len") + 1, F.lit(0))
    base = base.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("at"))
    window_words = F.slice("w", F.greatest(F.col("at"), F.lit(1)), F.col("len"))
    base = base.withColumn("h", F.when(F.col("at") > 0, F.xxhash64(window_words)))

    def scan(part: int) -> DataFrame:
        own = known.where(F.pmod("h", F.lit(parts)) == part).select(
            "h", F.col("len").alias("gram_len"), "gram", "items"
        )
        same = (
            (base["h"] == own["h"])
            & (base["len"] == own["gram_len"])
            & (F.array_join(window_words, " ") == own["gram"])
        )
        found = base.join(F.broadcast(own), same, "left")
        found = found.where(F.col("gram").isNotNull() | ((F.col("at") == 0) & F.lit(part == 0)))
        return found.select("id", "key", "n_words", "at", "len", "items")

    return reduce(DataFrame.unionAll, map(scan, range(parts)))


def _joined(rows: DataFrame) -> DataFrame:
    """Rows with the number of words that each hit adds to those before it, ``new``."""
    own = Window.partitionBy("id", "key").orderBy("at", "len")
    end = F.when(F.col("at") > 0, F.col("at") + F.col("len")).otherwise(1)  # behind the last word
    rows = rows.withColumn("end", end)
    before = F.coalesce(F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1))
    new = F.when(F.col("at") > 0, F.greatest(F.col("end") - F.greatest(before, F.col("at")), F.lit(0))).otherwise(0)
    return rows.withColumn("new", new.cast("long"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = 20) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of each document.

    A document is contaminated if at least one in ``share`` of its words lies in a window of an item. Null and empty
    texts have no words. Repeated rows each get their result. Other columns are not read. Empty tables: without
    documents no rows, without items no hits.
    """
    rows = _joined(hits(docs, items, id_col, text_col, item_id, item_text, window))
    own = rows.groupBy("id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.sum("new").alias("n_hit"),
        F.count(F.when(F.col("at") == 0, 1)).alias("copies"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return own.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "key",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, items, id_col, text_col, **how).where("contaminated")
    bad = bad.select(F.col(id_col).alias("__bad_id"), F.col("key").alias("__bad_key")).distinct()
    same = column(id_col).eqNullSafe(F.col("__bad_id")) & (
        F.xxhash64(F.coalesce(column(text_col), F.lit(""))) == F.col("__bad_key")
    )
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """All documents, without the words of verified windows and the separators that follow them."""
    rows = _joined(hits(docs, items, id_col, text_col, **how)).where("new > 0")
    spans = rows.groupBy("id", "key").agg(
        F.array_sort(F.collect_set(F.struct((F.col("end") - F.col("new")).alias("a"), F.col("end").alias("b")))).alias("__cut")
    )
    spans = spans.select(F.col("id").alias("__cut_id"), F.col("key").alias("__cut_key"), "__cut")
    text = column(text_col)
    same = column(id_col).eqNullSafe(F.col("__cut_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__cut_key"))
    # A unit is a word and what follows it; what stands before the first word is unit 0.
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    units = F.regexp_extract_all(text, F.lit(rf"({word}+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), F.lit(1))
    lead = F.regexp_extract(text, r"\A([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1)
    kept = F.filter(
        units, lambda u, i: ~F.exists(F.col("__cut"), lambda c: (i + 1 >= c["a"]) & (i + 1 < c["b"]))
    )
    new = F.when(F.col("__cut").isNull(), text).otherwise(F.concat(lead, F.array_join(kept, "")))
    joined = docs.join(spans, same, "left")
    return joined.select(*[new.alias(c) if c == text_col else column(c) for c in docs.columns])
