"""N-gram Jaccard join by adaptive multi-match prefixes.

With the shingles of all documents in one order, two sets that overlap in ``t`` or more shingles share at least ``l`` of
their first ``n - t + l`` ones, for any ``l`` up to ``t``; with two lengths, the smaller one counts. A longer prefix thus
asks for more matches before a pair is looked at.

1. Equal sets are one class. In the order of hashes, each set sends a prefix that asks for a tenth of it; a class that
   does not meet enough of its prefix in other classes has no partner and is done.
2. The others are numbered by how much of their prefix others hold, the most common text first, and linked with the first
   class of their min-hash group. Most copies of a text become one component here, without pairs among them.
3. Each class that is like the most common one its groups lead to, the pivot, is described by what it lacks and adds, its
   differences. The farther two classes are from the pivot, the more differences they must share to link, so each class looks
   up the fewer of its rarest ones, the farther the others are; the differences verify the pairs.
4. What may still link lies with different pivots, in different units. Shingles that one unit holds alone come first in the order, the others by
   the number of classes that hold them. Each class picks the length of its prefix by the estimated cost: the classes met
   on its shingles, times a verification for every ``l`` of them. Pairs of different units that share enough prefix
   shingles are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rasterloom.llm.common import blocks, column, emit, ship, sifted, stored
from rasterloom.llm.components import components
from rasterloom.llm.hashing import Hashes, chained, mixed

SHINGLE, SHARE = 5, 80
#: In the first order a set of n shingles asks for n / TENTH matches.
TENTH = 10
#: Min-hash groups in which copies are linked with one class, and in which they look for a pivot; most matches that a prefix asks for.
LED, GROUPS, MATCHES = 2, 4, 16
#: Hundredths of the union that a class shares with its pivot at least, to be described by it.
PIVOT = 50
#: Prefix shingles that a task compares, at 12 bytes each.
COMPARED = 1 << 21
#: Stand for two classes of a block that share a shingle.
_SEVERAL = np.array([0, 1], np.uint64)


def shingle_set(text: str, hashes: Hashes, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's distinct shingles in ascending order; with fewer words, that of the whole sequence."""
    words = text.encode().lower().split()  # of bytes: A-Z and the six ASCII white space characters only
    if not words:
        return np.zeros(0, np.uint64)
    own, width = hashes.of(words), min(shingle, len(words))
    n = len(words) - width + 1
    return np.unique(chained(np.full(n, width, np.uint64), *(own[i : i + n] for i in range(width))))


def overlap(n, share: int = SHARE):
    """The least number of shingles that a set of n shares with any set it links to."""
    return (share * n + 99) // 100


def _asked(n: int) -> int:
    return max(1, n // TENTH)


def _sketch(parts: int, shingle: int, share: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (id, text, n, key), of matches within a block (short, matches) and of prefixes (rem, keys)."""
    hashes, turn = Hashes(), 0

    def rows(block: pa.Table):
        nonlocal turn
        seen, prefixes = {}, []
        columns = (block.column(c).to_pylist() for c in ("id", "text", "hash"))
        for id_, text, hash_ in zip(*columns, strict=True):
            own = shingle_set(text, hashes, shingle)
            key, n, turn = xxhash.xxh3_128_digest(own.tobytes()), len(own), turn + 1
            yield 64, (turn % parts, id_, hash_, n, key, int.from_bytes(key[:8], "little", signed=True), None, None, None)
            if n and key not in seen:
                seen[key] = len(prefixes)
                prefixes.append(own[: n - overlap(n, share) + _asked(n)])
        if not seen:
            return
        short = np.frombuffer(b"".join(seen), np.uint64)[::2]
        token = np.concatenate(prefixes)
        owner = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        heads = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(heads, len(token)))
        matches = np.bincount(owner[np.repeat(size > 1, size)], minlength=len(prefixes))
        for i in np.flatnonzero(matches).tolist():
            yield 24, (turn % parts, None, None, None, None, int(short[i : i + 1].view(np.int64)[0]), int(matches[i]), None, None)
        # A shingle of several classes of the block is sent twice, whatever their number.
        several = token[heads[size > 1]]
        sent = np.concatenate([token[heads[size == 1]], several, several])
        keys = np.concatenate([short[owner[heads[size == 1]]], np.repeat(_SEVERAL, len(several))])
        part = (sent >> np.uint64(32)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        sent, keys, part = sent[order].astype(np.uint32), keys[order], part[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        for a, b in zip(cuts.tolist(), np.append(cuts, len(part))[1:].tolist(), strict=True):
            yield 12 * (b - a), (int(part[a]), None, None, None, None, None, None, sent[a:b].tobytes(), keys[a:b].tobytes())

    for block in blocks(batches):
        yield from emit(schema, rows(block))


def _matched(group: pa.Table) -> pa.Table:
    """Documents as they are, and the matches of the prefixes' classes in one part of the shingles."""
    rest = group.filter(pa.compute.is_null(group.column("rem"))).select(["id", "text", "n", "key", "short", "matches"])
    own = group.filter(pa.compute.is_valid(group.column("rem")))
    rem = np.frombuffer(b"".join(own.column("rem").to_pylist()), np.uint32)
    keys = np.frombuffer(b"".join(own.column("keys").to_pylist()), np.uint64)
    order = np.lexsort((keys, rem))
    rem, keys = rem[order], keys[order]
    once = np.concatenate(([True], (rem[1:] != rem[:-1]) | (keys[1:] != keys[:-1]))) if len(rem) else np.zeros(0, bool)
    rem, keys = rem[once], keys[once]
    heads = np.flatnonzero(np.concatenate(([True], rem[1:] != rem[:-1]))) if len(rem) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(rem)))
    short, n = np.unique(keys[np.repeat(size > 1, size)], return_counts=True)
    real = short > 1
    found = {"short": pa.array(short[real].view(np.int64)), "matches": pa.array(n[real].astype(np.int64))}
    nulls = {f.name: pa.nulls(int(real.sum()), f.type) for f in rest.schema if f.name not in found}
    return pa.concat_tables([rest, pa.table(found | nulls).select(rest.schema.names)])


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, share: int = SHARE, compared: int = COMPARED) -> DataFrame:
    """Rows (id, text, n, key, short) of all documents, key standing for the set, short for the key and text for the text,
    and rows (short, matches): how many of a class's prefix shingles others hold."""
    ship(docs.sparkSession)
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A prefix is about a third of a set, a word about six bytes.
    parts = max(1, -(-size // (18 * compared)))
    kind = rows.schema["id"].dataType
    fields = [("part", "long"), ("id", kind.simpleString()), ("text", "long"), ("n", "long"), ("key", "binary"), ("short", "long"),
              ("matches", "long"), ("rem", "binary"), ("keys", "binary")]
    types = {"long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f, to_arrow_type(kind) if f == "id" else types[t]) for f, t in fields])
    out = ", ".join(f"{f} {t}" for f, t in fields)
    found = rows.mapInArrow(partial(_sketch, parts, shingle, share, schema), out)
    kept = ", ".join(f"{f} {t}" for f, t in fields[1:7])
    return stored(found.groupBy("part").applyInArrow(lambda group: _matched(group), kept), "sketches")


def _sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(c, key, n, shingles, groups) of the classes whose document is ``chosen`` (key, id, text, rarity).

    ``c`` numbers the classes by rarity, from 0 to 127, then in any order. A bitmap picks the documents, so no other text
    is shuffled; some others that it lets pass are no document of the join.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), text.alias("text"))
    own = ["own", "own_text"]  # 64 bits of hash each
    wanted = chosen.select(F.xxhash64("id", "text").alias("own"), F.col("text").alias("own_text"), "rarity")
    rows = rows.select("text", F.xxhash64("id", F.xxhash64("text")).alias("own"), F.xxhash64("text").alias("own_text"))
    rows = sifted(rows, F.col("own"), wanted.select(F.col("own").alias("hash")))
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64())), ("groups", pa.list_(pa.int64())), *((c, pa.int64()) for c in own)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()

        def each():
            for block in blocks(batches):
                for text, *row in zip(*(block.column(c).to_pylist() for c in ["text", *own]), strict=True):
                    held = shingle_set(text, hashes, shingle)
                    least = [int(mixed(held ^ np.uint64(i + 1)).min().view(np.int64)) for i in range(GROUPS)]
                    yield 8 * len(held), (xxhash.xxh3_128_digest(held.tobytes()), len(held), held.view(np.int64), least, *row)

        yield from emit(schema, each())

    found = rows.mapInArrow(run, "key binary, n long, shingles array<long>, groups array<long>, own long, own_text long").dropDuplicates(own)
    rarity = F.shiftleft(F.coalesce("rarity", F.lit(127)).cast("long"), 54)
    found = found.join(wanted, own).drop(*own)
    return stored(found.withColumn("c", rarity + F.monotonically_increasing_id()).drop("rarity"), "sets")


def _similar(share: int) -> Column:
    shared = F.size(F.array_intersect("shingles", "other"))
    return 100 * shared >= share * (F.col("n") + F.col("other_n") - shared)


def _component(sets: DataFrame, links: DataFrame | None) -> DataFrame:
    """The sets with their component, the smallest class reached so far."""
    if links is None:
        return sets.withColumn("component", F.col("c"))
    roots = components(links).select(F.col("node").alias("c"), "root")
    return sets.join(roots, "c", "left").withColumn("component", F.coalesce("root", "c")).drop("root")


def _led(sets: DataFrame, group: int, share: int) -> DataFrame:
    """Links (a, b) between the sets of a min-hash group and its smallest class, where these are not connected yet."""
    own = sets.withColumn("g", F.col("groups")[group])
    led = own.groupBy("g").agg(F.min("c").alias("b"), F.min_by("component", "c").alias("led"), F.min("component").alias("low"), F.max("component").alias("high"))
    led = stored(led.where("low != high").select("g", "b", "led"), "led")
    heads = led.join(sets.select(F.col("c").alias("b"), F.col("n").alias("other_n"), F.col("shingles").alias("other")), "b")
    pairs = own.select("g", "c", "component", "n", "shingles").join(heads, "g").where("component != led")
    return pairs.where(_similar(share)).select(F.col("c").alias("a"), "b")


def _pivoted(sets: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of classes with their pivots, and (c, pivot, n, other_n, far, away) of those like their pivot.

    ``away`` are the shingles that a class adds to its pivot, and the complements of those that it lacks: ``far`` of them.
    """
    own = sets.select("c", "component", F.posexplode("groups").alias("i", "g"))
    # The first class of a component is its number.
    led = stored(own.groupBy("i", "g").agg(F.min("component").alias("pivot")), "pivots")
    led = stored(own.join(led, ["i", "g"]).groupBy("c").agg(F.min("pivot").alias("pivot")), "pivots")
    heads = sets.select(F.col("c").alias("pivot"), F.col("n").alias("other_n"), F.col("shingles").alias("other"))
    both = sets.select("c", "component", "n", "shingles").join(led, "c").join(heads, "pivot")
    shared = F.size(F.array_intersect("shingles", "other"))
    near = 100 * shared >= PIVOT * (F.col("n") + F.col("other_n") - shared)
    away = F.concat(F.array_except("shingles", "other"), F.transform(F.array_except("other", "shingles"), F.bitwise_not))
    both = stored(both.where(near).select("c", "component", "pivot", "n", "other_n", away.alias("away")), "pivoted").withColumn("far", F.size("away"))
    new = ~_too_far("far", "n", "other_n", share) & (F.col("component") != F.col("pivot"))
    return both.where(new).select(F.col("c").alias("a"), F.col("pivot").alias("b")), both.drop("component")


def _too_far(far: str, n: str, other_n: str, share: int) -> Column:
    """Whether sets of two sizes that differ by ``far`` shingles share too little."""
    return F.expr(f"{100 + share} * ({far}) > {100 - share} * ({n} + {other_n})")


_APART = "far + other_far - 2 * size(array_intersect(away, other))"


def _led_away(sets: DataFrame, pivoted: DataFrame, seed: int, share: int) -> DataFrame:
    """Links (a, b) between classes of one pivot with the same least differing shingle, and the first of them."""
    known = pivoted.join(sets.select("c", "component"), "c")
    own = known.withColumn("g", F.array_min(F.transform("away", lambda h: F.xxhash64(h, F.lit(seed))))).where("g is not null")
    led = own.groupBy("pivot", "g").agg(F.min("c").alias("b"), F.min_by("component", "c").alias("led"), F.min("component").alias("low"), F.max("component").alias("high"))
    led = stored(led.where("low != high").select("pivot", "g", "b", "led"), "led")
    heads = led.join(pivoted.select(F.col("c").alias("b"), F.col("n").alias("other_n"), F.col("far").alias("other_far"), F.col("away").alias("other")), "b")
    pairs = own.drop("other_n").join(heads, ["pivot", "g"]).where("component != led")
    return pairs.where(~_too_far(_APART, "n", "other_n", share)).select(F.col("c").alias("a"), "b")


def _within(sets: DataFrame, pivoted: DataFrame, share: int) -> DataFrame:
    """Links (a, b) between classes of one pivot and different components.

    Let x and y be f and g shingles away from their pivot, of size p, and d shingles apart; they share (f + g - d) / 2 of
    these differences. With k = (100 - share) / (100 + share), x and y link if d <= k (|x| + |y|), which is if they share
    (e(x) + e(y)) / 2 of their differences, where e(x) = f - k |x|. One of them, say x, is not linked with the pivot, so
    e(x) > k p; e(y) is -k p at least, for y has at most g shingles more than the pivot. What both must share thus depends
    on how far x is, so the far ones have levels of doubling e, and y looks up as many of its rarest differences in each
    level as the nearest x of the level asks for: none, if y holds fewer than they must share.
    """
    known = pivoted.join(sets.select("c", "component"), "c").withColumn("open", _too_far("far", "n", "other_n", share))
    # All in parts of 2 (100 + share) a shingle: e, and e beyond k p.
    unit = 2 * (100 + share)
    known = known.withColumn("e", F.expr(f"{100 + share}L * far - {100 - share}L * n")).withColumn("edge", F.expr(f"{100 - share}L * other_n"))
    own = ["c", "component", "pivot", "open", "e", "edge"]
    rows = known.select(*own, F.explode("away").alias("h"))
    held = rows.groupBy("pivot", "h").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("df"))
    held = stored(held.where("low != high").select("pivot", "h", "df"), "held")
    first = rows.join(held, ["pivot", "h"]).groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("all"))
    first = first.select(*own, F.size("all").alias("size"), F.posexplode("all").alias("at", "x"))
    # ``left``: how many differences can still be shared from here on; ``room``: how far a partner may be for that to do.
    first = first.select(*own, F.col("x.h").alias("h"), (F.col("size") - F.col("at")).cast("long").alias("left"))
    first = first.withColumn("room", F.expr(f"{unit} * left - e - edge"))
    level = lambda x: f"cast(floor(log2(greatest({x}, 0) div {unit} + 1)) AS INT)"
    first = stored(first.withColumn("level", F.expr(f"if(open, {level('e - edge')}, 0)")), "differences")
    sizes = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("component", "e", "left")]
    a = first.where("room > 0").withColumn("top", F.expr(level("room"))).where("level <= top")
    a = a.select("pivot", "h", F.col("c").alias("a"), "open", *sizes("a"), F.explode(F.sequence("level", "top")).alias("level"))
    b = first.where(f"open and {unit} * left >= e - edge").select("pivot", "h", "level", F.col("c").alias("b"), *sizes("b"))
    pairs = a.join(b, ["pivot", "h", "level"]).where("component_a != component_b and (not open or e_a < e_b or e_a = e_b and a < b)")
    pairs = stored(pairs.where(f"{unit} * least(left_a, left_b) >= e_a + e_b").select("a", "b").distinct(), "candidates")
    pairs = pairs.join(known.select(F.col("c").alias("a"), "n", "far", "away"), "a")
    pairs = pairs.join(known.select(F.col("c").alias("b"), F.col("n").alias("other_n"), F.col("far").alias("other_far"), F.col("away").alias("other")), "b")
    return pairs.where(~_too_far(_APART, "n", "other_n", share)).select("a", "b")


def _prefixes(sets: DataFrame, share: int) -> DataFrame:
    """(h, c, component, unit, n, l): the prefix shingles of each set that other units hold too, ``l`` the matches asked."""
    rows = sets.select("c", "component", "unit", "n", F.explode("shingles").alias("h"))
    held = rows.groupBy("h").agg(F.min("unit").alias("low"), F.max("unit").alias("high"), F.count(F.lit(1)).alias("df"))
    held = stored(held.where("low != high").select("h", "df"), "shared")
    own = rows.join(held, "h").groupBy("c").agg(F.first("component").alias("component"), F.first("unit").alias("unit"), F.first("n").alias("n"), F.collect_list(F.struct("df", "h")).alias("all"))
    own = own.withColumn("spare", F.size("all") - F.expr(f"({share} * n + 99) div 100")).where("spare >= 0")
    cost = "struct(aggregate(slice(all, 1, cast(spare + l AS INT)), 0D, (s, x) -> s + x.df - 1) * (1 + n / l) AS cost, l AS l)"
    own = own.withColumn("all", F.array_sort("all"))
    own = own.withColumn("l", F.expr(f"array_min(transform(sequence(1, least({MATCHES}, cast(n - {100 - share} * n div 100 AS INT))), l -> {cost})).l"))
    own = own.select("c", "component", "unit", "n", "l", F.explode(F.expr("slice(all, 1, cast(spare + l AS INT))")).alias("x"))
    return stored(own.select("x.h", "c", "component", "unit", "n", "l"), "prefixes")


def _candidates(prefixes: DataFrame, share: int) -> DataFrame:
    """(a, b): classes of different units and components that share as many prefix shingles as the less demanding one asks.

    A prefix that asks for l matches of sets that share ``overlap`` asks for as many more as the two sizes make them share.
    The unit with most classes on a shingle is never paired with itself, so a shingle of many copies and few others
    costs their product.
    """
    counts = prefixes.groupBy("h", "unit").agg(F.count(F.lit(1)).alias("many"))
    major = counts.groupBy("h").agg(F.max_by("unit", F.struct("many", "unit")).alias("major"), F.count(F.lit(1)).alias("apart"))
    major = stored(major.where("apart > 1").select("h", "major"), "major")
    known = stored(prefixes.join(major, "h"), "prefixes").withColumn("more", F.expr(f"l - ({share} * n + 99) div 100"))
    fields = {"c": "{}", "component": "of_{}", "unit": "in_{}", "n": "n_{}", "more": "more_{}"}
    a, b = (known.select("h", "major", *(F.col(f).alias(t.format(x)) for f, t in fields.items())) for x in "ab")
    a = a.where("in_a != major").drop("major")
    near = 100 * F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b")
    met = a.join(b, "h").where("in_a != in_b and of_a != of_b and (in_b = major or a < b)").where(near)
    both = F.expr(f"({share} * (n_a + n_b) + {99 + share}) div {100 + share}")  # what sets of these sizes share at least
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (both + F.least("more_a", "more_b")).alias("l"))
    return stored(met.groupBy("a", "b", "l").count().where("count >= l").select("a", "b"), "candidates")


def links(sets: DataFrame, share: int = SHARE) -> DataFrame:
    """(a, b): verified links between classes (c, n, shingles, groups) that connect all that any link would connect."""
    found = None
    for group in range(LED):
        own = stored(_led(_component(sets, found), group, share), "pairs")
        found = own if found is None else stored(found.unionAll(own), "pairs")
    own, pivoted = _pivoted(_component(sets, found), share)
    found = stored(found.unionAll(own), "pairs")
    for seed in range(LED):
        own = _led_away(_component(sets, found).select("c", "component"), pivoted, seed, share)
        found = stored(found.unionAll(own), "pairs")
    found = stored(found.unionAll(_within(_component(sets, found).select("c", "component"), pivoted, share)), "pairs")
    units = _component(sets, found).drop("groups", "key").join(pivoted.select("c", "pivot"), "c", "left")
    # Units of pivots are odd, those of components even.
    units = units.withColumn("unit", F.coalesce(2 * F.col("pivot") + 1, 2 * F.col("component"))).drop("pivot")
    own = _candidates(_prefixes(stored(units, "sets"), share), share)
    own = own.join(sets.select(F.col("c").alias("a"), "n", "shingles"), "a")
    own = own.join(sets.select(F.col("c").alias("b"), F.col("n").alias("other_n"), F.col("shingles").alias("other")), "b")
    return stored(found.unionAll(own.where(_similar(share)).select("a", "b")), "pairs")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, share: int = SHARE, compared: int = COMPARED) -> DataFrame:
    """(id, n_shingles, component_id) of each row: the smallest id reachable over sets of like shingles.

    Two sets link if they share ``share`` hundredths of their union. Null and empty texts have no shingles and are linked
    with nothing, not even each other. Rows without an id take part, but give no id; a component of such rows only is
    null. Repeated rows each get their result. An empty table gives no rows. Only the named columns are read. Shingles
    are told apart by 64 bits of hash, sets by 128.
    """
    found = sketches(docs, id_col, text_col, shingle, share, compared)
    rows = found.where("key is not null")
    classes = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("first"), F.min(F.struct("id", "text")).alias("own"), F.first("n").alias("n"), F.first("short").alias("short"))
    classes = stored(classes, "classes")
    matches = found.where("matches is not null").groupBy("short").agg(F.sum("matches").alias("matches"))
    # A partner has at least as many shingles as it must share, and may ask for no more than a tenth of these.
    asked = F.expr(f"greatest(1, ({share} * n + 99) div 100 div {TENTH})")
    prefix = F.expr(f"n - ({share} * n + 99) div 100 + greatest(1, n div {TENTH})")
    rarity = F.least(F.greatest(127 - F.floor(127 * F.col("matches") / prefix), F.lit(0)), F.lit(127)).alias("rarity")
    chosen = stored(classes.join(matches, "short").where(F.col("matches") >= asked).select("key", "own.id", "own.text", rarity), "chosen")
    sets = _sets(docs, chosen, id_col, text_col, shingle)
    roots = components(links(sets, share))
    named = classes.select("key", "first").join(sets.select("key", "c"), "key", "left").join(roots.withColumnRenamed("node", "c"), "c", "left")
    named = stored(named.select("key", "first", F.coalesce("root", "c").alias("root")), "classes")
    alone, named = named.where("root is null"), named.where("root is not null")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(stored(least, "least"), "root").select("key", "component")
    named = stored(named.unionAll(alone.select("key", F.col("first").alias("component"))), "classes")
    rows = rows.select("id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))
    rows = rows.join(named, "key", "left").withColumn("component", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
