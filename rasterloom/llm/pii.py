"""Personal data by fixed patterns and by bootstrapped contexts, with DataFrame functions only.

One scan turns each text into rows: the text itself, its matches of the fixed kinds, and its tokens that look like
identifiers, each with the length of the gap before it and the two words before it. Offsets are running sums of gaps
and matches per text. The words before a match are its lexical patterns. Patterns and distinct values form a graph,
grouped once over the whole corpus; in each round a pattern is as good as the share of known values among its
values, and a value that good patterns hold becomes known. Tokens whose value became known are spans of kind
``context``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import column, stored

#: The kinds in the order of results. The first four are the fixed kinds.
KINDS = ["email", "ip", "card", "phone", "context"]
# Equal to the plain forms in what they match. Possessive loops and starts at the head of a run keep the time linear
# in the text: a later start within the same run fails for the same reason.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # A token with the digit groups that follow it, one space apart, if none of the other kinds can end in between.
    "context": r"(?<![^\x20\x09-\x0D])(?:"
    r"[^\x20\x09-\x0D0-9@.]*+[0-9][^\x20\x09-\x0D@.]*+(?<=[0-9])"
    r"(?:\x20[0-9]++(?:-[0-9]++)*+(?=[^\p{L}\p{N}@\x20\x09-\x0D]*+(?:[\x20\x09-\x0D]|\z)))++"
    r"|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)",
}
_PROBES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "context": "[0-9@]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: The last two words of a gap, or its only one.
_LEAD = r"(?<!\S)(?:\S++\s++)?\S++\s*+\z"
#: Digits that a token without an at sign must have to be a candidate.
DIGITS = 3


def _rows(text: Column, number: int, kind: str) -> Column:
    """(kind, nth, value, gap, before) of each match of one pattern."""
    pattern = _PATTERNS[kind]
    both = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"), F.split(text, pattern, -1).alias("gap")
    )
    each = F.transform(
        F.filter(both, lambda x: x["value"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("nth"),
            x["value"].alias("value"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.lower(F.regexp_extract(x["gap"], _LEAD, 0)).alias("before"),
        ),
    )
    return F.when(text.rlike(_PROBES[kind]), each).otherwise(F.expr("array()").cast(_ROW))


_ROW = "array<struct<kind:int,nth:int,value:string,gap:bigint,before:string>>"


def _is_base() -> Column:
    """Whether a match of a fixed kind passes its test."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(F.col("kind") == 1, True)
        .when(F.col("kind") == 2, F.col("value").rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"))
        .when(F.col("kind") == 3, n.between(13, 19) & F.expr("luhn_check(regexp_replace(value, '[^0-9]', ''))"))
        .when(F.col("kind") == 4, n.between(9, 15))
        .otherwise(False)
    )


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digits: int = DIGITS) -> DataFrame:
    """(id, key, kind, start, end, value, before, copies): a row of kind 0 for each text, and all its matches.

    Kinds 1 to 4 have passed their tests; kind 5 are tokens of ``digits`` digits (1 at least) or more, or with an at sign, that overlap
    none of the others; digit groups one space apart are one token. ``copies`` counts repeated rows of the same id and text.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    base = docs.select(column(id_col).alias("id"), text.alias("t"))
    none = F.array(
        F.struct(
            F.lit(0).alias("kind"), F.lit(0).alias("nth"), F.lit("").alias("value"),
            F.lit(0).cast("long").alias("gap"), F.lit("").alias("before"),
        )
    )
    found = F.concat(none, *(_rows(F.col("t"), i + 1, k) for i, k in enumerate(KINDS)))
    rows = base.select("id", F.xxhash64("t").alias("key"), F.explode(found).alias("m")).select("id", "key", "m.*")
    # All windows and groups below find the rows of a text together.
    rows = rows.repartition("id", "key").groupBy("id", "key", "kind", "nth")
    rows = rows.agg(
        *(F.first(c).alias(c) for c in ("value", "gap", "before")), F.count(F.lit(1)).alias("copies")
    )
    so_far = Window.partitionBy("id", "key", "kind").orderBy("nth")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    edge = r"[^\p{L}\p{N}]"
    lead = F.length(F.regexp_extract("value", rf"\A({edge}*+)", 1))
    bare = F.regexp_replace("value", rf"\A{edge}++|(?<!{edge}){edge}++\z", "")
    token = F.col("kind") == 5
    rows = rows.withColumn("start", F.col("end") - F.length("value") + F.when(token, lead).otherwise(0))
    rows = rows.withColumn("value", F.when(token, bare).otherwise(F.col("value")))
    rows = rows.withColumn("end", F.col("start") + F.length("value")).withColumn("base", _is_base())
    wide = F.length(F.regexp_replace("value", "[^0-9]", "")) >= digits
    rows = rows.where((F.col("kind") == 0) | F.col("base") | (token & (wide | F.col("value").contains("@"))))
    own = Window.partitionBy("id", "key").orderBy("start", "kind", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(own.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(own.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("free", (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end")))
    rows = rows.where(~token | F.col("free"))
    return rows.select("id", "key", "kind", "start", "end", "value", "before", "copies")


def _edges(found: DataFrame) -> DataFrame:
    """(pattern, value, known): the graph of lexical patterns and distinct values."""
    words = F.split(F.regexp_replace(F.trim(F.regexp_replace("before", r"\s+", " ")), "[0-9]+", "0"), " ")
    one = F.element_at(words, -1)
    two = F.concat_ws(" ", F.slice(F.concat(F.array(F.lit("^")), words), -2, 2))
    rows = found.where("kind > 0").select(
        F.explode(F.array_distinct(F.array(one, two))).alias("pattern"),
        F.lower("value").alias("value"),
        (F.col("kind") < 5).alias("known"),
    )
    return rows.groupBy("pattern", "value").agg(F.max("known").alias("known"))


def bootstrap(found: DataFrame, rounds: int = 1000, support: int = 3, purity: float = 0.5, score: float = 0.7) -> DataFrame:
    """(value): the values that became known in rounds, the last of which finds none.

    If ``rounds`` of them all find some, a RuntimeError says so.
    A pattern counts if it holds ``support`` known values and they are at least a ``purity`` of its values, one more
    unknown one added. A value becomes known if the chance that one of its patterns is right reaches ``score``.
    """
    # A value that is known anywhere is known with every pattern.
    edges = _edges(found)
    seeds = edges.where("known").select("value").distinct().withColumn("seed", F.lit(True))
    edges = edges.drop("known").join(seeds, "value", "left").select(
        "pattern", "value", F.coalesce("seed", F.lit(False)).alias("known"), F.lit(False).alias("new")
    )
    edges = stored(edges, "pii-graph")
    for _ in range(rounds):
        patterns = edges.groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("known"), 1)).alias("k")
        )
        patterns = patterns.withColumn("right", F.col("k") / (F.col("n") + 1))
        patterns = patterns.where((F.col("k") >= support) & (F.col("right") >= purity))
        scored = edges.where(~F.col("known")).join(patterns, "pattern").groupBy("value")
        scored = scored.agg((1 - F.exp(F.sum(F.log1p(-F.col("right"))))).alias("score"))
        fresh = stored(scored.where(F.col("score") >= score).select("value", F.lit(True).alias("fresh")), "pii-fresh")
        if not fresh.limit(1).count():
            break
        edges = edges.join(fresh, "value", "left").select(
            "pattern",
            "value",
            (F.col("known") | F.coalesce("fresh", F.lit(False))).alias("known"),
            (F.col("new") | F.coalesce("fresh", F.lit(False))).alias("new"),
        )
        edges = stored(edges, "pii-graph")
    else:
        raise RuntimeError(f"values are still being found after {rounds} rounds")
    return edges.where("new").select("value").distinct()


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digits: int = DIGITS, **how) -> DataFrame:
    """(id, key, kind, start, end, copies): a row of kind 0 for each text and a row for each span of kinds 1 to 5."""
    found = stored(occurrences(docs, id_col, text_col, digits), "pii-matches")
    fresh = bootstrap(found, **how)
    new = found.where("kind = 5").join(fresh, F.lower(found["value"]) == fresh["value"], "left_semi")
    return found.where("kind < 5").unionAll(new).select("id", "key", "kind", "start", "end", "copies")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Counts and spans of each text.

    (id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context). Spans are kind:start:end in code points, end
    exclusive, by kind and start. A null text counts as empty. Repeated rows each get their result. Other columns are
    not read. An empty table gives no rows.
    """
    rows = spans(docs, id_col, text_col, **how)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.greatest(F.col("kind"), F.lit(1)))
    said = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct("kind", "start", "end", said.alias("said"))
    rows = rows.groupBy("id", "key").agg(
        *(F.count(F.when(F.col("kind") == i + 1, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.array_sort(F.collect_list(F.when(F.col("kind") > 0, item))).alias("all"),
        F.max(F.when(F.col("kind") == 0, F.col("copies"))).alias("copies"),
    )
    base = F.transform(F.filter("all", lambda x: x["kind"] < 5), lambda x: x["said"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(
        F.col("id").alias(id_col),
        *(f"n_{k}" for k in KINDS[:4]),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.transform("all", lambda x: x["said"]), ",").alias("spans"),
        "n_context",
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """All rows and columns, with each span of personal data replaced by its kind in angle brackets.

    Null texts stay null. Repeated rows stay, each with its replaced text. An empty table stays empty.
    """
    rows = spans(docs, id_col, text_col, **how).where("kind > 0")
    own = Window.partitionBy("id", "key").orderBy("start", "end", "kind")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("start") >= before)
    rows = rows.withColumn("part", F.sum(opens.cast("int")).over(own))
    rows = rows.groupBy("id", "key", "part").agg(
        F.min("start").alias("a"), F.max("end").alias("b"), F.min(F.struct("start", "end", "kind"))["kind"].alias("kind")
    )
    cuts = rows.groupBy("id", "key").agg(F.array_sort(F.collect_list(F.struct("a", "b", "kind"))).alias("__cut"))
    cuts = cuts.select(F.col("id").alias("__cut_id"), F.col("key").alias("__cut_key"), "__cut")
    text = column(text_col)
    same = column(id_col).eqNullSafe(F.col("__cut_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__cut_key"))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def piece(cut: Column, i: Column) -> Column:
        last = F.coalesce(F.get("__cut", i - 1)["b"], F.lit(0).cast("long"))
        kept = text.substr((last + 1).cast("int"), (cut["a"] - last).cast("int"))
        return F.concat(kept, F.element_at(names, cut["kind"]))

    tail = text.substr((F.element_at("__cut", -1)["b"] + 1).cast("int"), F.length(text))
    new = F.concat(F.array_join(F.transform("__cut", piece), ""), tail)
    joined = docs.join(cuts, same, "left")
    changed = F.when(F.col("__cut").isNull(), text).otherwise(new)
    return joined.select(*[changed.alias(c) if c == text_col else column(c) for c in docs.columns])
