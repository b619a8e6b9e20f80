"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to owner stages by how common they are. Items travel in bundles: at each stage a
cogroup brings a bundle's sparse scores of one shard of documents together with the posting lists that the stage owns
and the bundle asks for. The stage adds its integer contributions and passes the scores on; the last one selects.
The rarest terms come first, so that a document that cannot reach the best ``top`` of its shard any more, whatever the
later stages add, is not carried further.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from rasterloom.llm.common import blocks, column, ship, stored

TOP = 50
#: Items of a bundle, documents of a shard; a shard holds no more text than a block either.
BUNDLE, SHARD = 256, 8192
#: Terms of items above this many bytes are sought in several scans.
VOCABULARY_BYTES = 32 << 20
#: Owner stages: terms in up to one document of 100, of 8, the others.
RARE = (100, 8)
# Fixed value: ASCII letters in lower case, digits and all bytes of other characters stay, the rest separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order; null has none."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _item_terms(items: DataFrame, item_id: str, item_text: str, size: int) -> DataFrame:
    """(bundle, slot, item, term): each distinct term of each row of ``items``."""
    rows = items.select(column(item_id).alias("item"), column(item_text).alias("text"))
    schema = pa.schema([("item", to_arrow_type(rows.schema["item"].dataType)), ("row", pa.int64()), ("terms", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            found = [sorted({t.decode() for t in terms(x)}) for x in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("item"), pa.array(range(at, at + len(found)), pa.int64()), pa.array(found, pa.list_(pa.string()))], schema=schema)
            at += len(found)

    kind = rows.schema["item"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item {kind}, row long, terms array<string>")
    # Bundles are runs of rows of one task: no numbering over all items is needed.
    place = F.spark_partition_id().cast("long") * (1 << 40) + F.col("row")
    found = found.select((place - F.pmod(place, F.lit(size))).alias("bundle"), F.pmod(place, F.lit(size)).cast("int").alias("slot"), "item", "terms")
    return stored(found, "item-terms").select("bundle", "slot", "item", F.explode("terms").alias("term"))


def postings(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD) -> DataFrame:
    """Posting lists by shard, for the terms of ``wanted`` (term).

    A row without a term describes a shard: the ids of its documents in ascending order, the number of terms of each
    (``doc``), their sum (``n``), and how many are not 0 (``holding``). A row with a term holds the places of its documents
    in the shard (``doc``), how often each holds the term (``tf``), the highest of these numbers (``n``) and how many there
    are (``holding``). Ids may be of any ordered type.
    """
    ship(docs.sparkSession)
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("ids", pa.list_(to_arrow_type(rows.schema["id"].dataType))),
                        ("doc", pa.binary()), ("tf", pa.binary()), ("n", pa.int64()), ("holding", pa.int64())])
    held = wanted.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    parts = max(1, -(-held // VOCABULARY_BYTES))

    def scan(part: int) -> DataFrame:
        own = wanted.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part)
        names = [r.term for r in own.select("term").distinct().collect()]  # at most VOCABULARY_BYTES
        shared = docs.sparkSession.sparkContext.broadcast(names)
        kind = rows.schema["id"].dataType.simpleString()
        out = f"shard long, term string, ids array<{kind}>, doc binary, tf binary, n long, holding long"
        found = rows.mapInArrow(partial(_shards, shared, schema, part == 0, size), out)
        # A task counts its shards from 0; with the number of the scan's partition they are unique, in each scan the same.
        return found.withColumn("shard", F.spark_partition_id().cast("long") * (1 << 32) + F.col("shard"))

    return stored(reduce(DataFrame.unionAll, map(scan, range(parts))), "postings")


def _shards(shared, schema: pa.Schema, describe: bool, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = shared.value
    known = {name.encode(): i for i, name in enumerate(names)}
    shard = 0
    for block in blocks(batches):
        for low in range(0, block.num_rows, size):
            cut = block.slice(low, size)
            ids, texts = cut.column("id").to_pylist(), cut.column("text").to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
            lengths, found = np.zeros(len(ids), np.int64), []
            for place, i in enumerate(order):
                words = terms(texts[i])
                lengths[place] = len(words)
                own = np.array([t for t in map(known.get, words) if t is not None], np.int64)
                found.append(own << 32 | place)
            code, tf = np.unique(np.concatenate(found), return_counts=True)
            term, doc = code >> 32, (code & 0xFFFFFFFF).astype(np.int32)
            heads = np.flatnonzero(np.diff(term, prepend=-1))
            ends = np.append(heads, len(term))[1:]
            rows = [(shard, None, [ids[i] for i in order], lengths.tobytes(), None, int(lengths.sum()), int((lengths > 0).sum()))] if describe else []
            for a, b in zip(heads.tolist(), ends.tolist(), strict=True):
                n = tf[a:b].astype(np.int64)
                rows.append((shard, names[term[a]], None, doc[a:b].tobytes(), n.tobytes(), int(n.max()), b - a))
            for at in range(0, len(rows), 4096):
                columns = zip(*rows[at : at + 4096], strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            shard += 1


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", top: int = TOP, bundle: int = BUNDLE, shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` highest-scoring documents of each row of ``items``.

    Equal scores rank by ascending id. Null, empty and separator-only texts have no terms: such documents are never
    found, such items find nothing. Documents without an id count in all statistics, but are not returned. Repeated
    documents each take a rank, repeated items each get their rows. Empty tables give no rows. Only the named columns
    are read. A bundle holds ``bundle`` items, a shard ``shard`` documents and no more text than a block.
    """
    asked = _item_terms(items, item_id, item_text, bundle)
    lists = postings(docs, asked.select("term").distinct(), id_col, text_col, shard)
    shards = lists.where("term is null")
    n_docs, n_terms = (x or 0 for x in shards.agg(F.sum("holding"), F.sum("n")).first())
    known = lists.where("term is not null").groupBy("term").agg(F.sum("holding").alias("df"), F.max("n").alias("tf"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    stage = F.when(F.col("df") * RARE[0] <= n_docs, 0).when(F.col("df") * RARE[1] <= n_docs, 1).otherwise(2)
    # No document's m is below 50, so no contribution of the term is above this.
    most = F.col("w") * F.expr("1000000000 * tf div (1000 * tf + 1000)")
    known = stored(known.select("term", "tf", weight.alias("w"), stage.alias("stage")).withColumn("most", most), "terms")
    asked = stored(asked.join(known, "term"), "asked")
    later = [F.sum(F.when(F.col("stage") > s, F.col("most")).otherwise(0)).alias(f"later{s}") for s in range(3)]
    slots = asked.groupBy("bundle", "slot").agg(F.first("item").alias("item"), *later)
    bundles = slots.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("slot", "item", "later0", "later1", "later2"))).alias("items"))
    shared = lists.select("term", "shard").join(asked.select("term", "bundle").distinct(), "term").select("bundle", "shard").distinct()
    state = shared.join(shards.select("shard", "ids", F.col("doc").alias("lengths")), "shard").join(bundles, "bundle")
    state = state.select("bundle", "shard", "ids", "lengths", "items", F.lit(None).cast("binary").alias("carried"))
    wanted = asked.groupBy("stage", "bundle", "term", "w").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    kinds = {"id": docs.select(column(id_col)).schema[0].dataType.simpleString(), "item": items.select(column(item_id)).schema[0].dataType.simpleString()}
    for s in range(3):
        own = lists.join(wanted.where(F.col("stage") == s), "term")
        own = own.select(F.col("bundle").alias("own_bundle"), F.col("shard").alias("own_shard"), "doc", "tf", "w", "slots")
        schema = state.schema if s < 2 else f"bundle long, slot int, item {kinds['item']}, id {kinds['id']}, score long"
        step = partial(_stage, s, n_docs, n_terms, top)
        state = state.groupBy("bundle", "shard").cogroup(own.groupBy("own_bundle", "own_shard")).applyInArrow(step, schema)
    ranked = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), "id")
    best = state.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return best.select(F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score")


def _stage(stage: int, n_docs: int, n_terms: int, top: int, state: pa.Table, lists: pa.Table) -> pa.Table:
    """Adds the contributions of the stage's posting lists to the scores of one bundle in one shard.

    All arrays are bounded by the items of a bundle times the documents of a shard.
    """
    row = state.slice(0, 1).combine_chunks()
    length = np.frombuffer(row.column("lengths")[0].as_py(), np.int64)
    norm = 20 * (50 + (50 * length * n_docs) // max(n_terms, 1))
    items = row.column("items")[0].as_py()
    later = {i["slot"]: i[f"later{stage}"] for i in items}
    score = np.zeros((max(later) + 1, len(length)), np.int64)
    carried = row.column("carried")[0].as_py()
    if carried:
        kept = np.frombuffer(carried, np.int64).reshape(3, -1)
        score[kept[0], kept[1]] = kept[2]
    for batch in lists.to_batches():
        for doc, tf, w, slots in zip(*(batch.column(c).to_pylist() for c in ("doc", "tf", "w", "slots")), strict=True):
            doc, tf = np.frombuffer(doc, np.int32), np.frombuffer(tf, np.int64)
            more = w * ((1000000000 * tf) // (1000 * tf + norm[doc]))
            for slot in slots:
                score[slot, doc] += more
    slots, docs, scores = [], [], []
    last = stage == len(RARE)
    ids = row.column("ids")[0].values if last else None
    if last:
        score[:, np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))] = 0
    for slot, bound in later.items():
        own = score[slot]
        doc = np.flatnonzero(own)
        if last and len(doc) > top:
            doc = np.sort(doc[np.argsort(-own[doc], kind="stable")[:top]])  # places rise with the ids
        elif len(doc) > top:
            doc = doc[own[doc] + bound >= np.partition(own[doc], -top)[-top]]
        slots.append(np.full(len(doc), slot))
        docs.append(doc)
        scores.append(own[doc])
    slots, docs, scores = np.concatenate(slots), np.concatenate(docs), np.concatenate(scores)
    if not last:
        carried = pa.array([np.stack([slots, docs, scores]).astype(np.int64).tobytes()], pa.binary())
        return row.set_column(row.schema.get_field_index("carried"), "carried", carried)
    asked = {i["slot"]: i["item"] for i in items}
    kind = row.schema.field("items").type.value_type.field("item").type
    return pa.table({
        "bundle": pa.array(np.full(len(slots), row.column("bundle")[0].as_py(), np.int64)),
        "slot": pa.array(slots.astype(np.int32)),
        "item": pa.array([asked[s] for s in slots.tolist()], kind),
        "id": ids.take(pa.array(docs)),
        "score": pa.array(scores),
    })
