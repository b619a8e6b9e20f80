"""Quotation linking with DataFrame functions: quoted passages find the messages they come from.

A message is split into lines; the marks at the head of a line give its quote level. A passage is a run of lines of one
level without a blank one between them. Passages are normalised, which undoes their wrapping, and hashed, as are their lines;
a quoted passage is joined to those written earlier in the same conversation, so passages that many conversations share
never meet. Where only a part was quoted, its lines are joined instead. A level may quote several messages; each is a link
with the lines that come from it.
The message from which most lines of the first level come is the one replied to; what that one quoted in turn stands one
level deeper. Conversations follow the replies: a message comes after the one it replies to, without its quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import column, lower_ascii, stored

#: Turns of a block.
TURNS = 1024
_MARK = r"\A((?:[ \t]*>)+)"


def level(line: Column) -> Column:
    """The number of quote marks at the head of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARK, 1), "[ \t]", ""))


def normalised(line: Column) -> Column:
    """A line without its quote marks, A-Z in lower case, white space runs as one space; ``\\0`` and ``\\1`` go."""
    bare = F.translate(F.regexp_replace(line, _MARK, ""), "\0\1", "")
    return F.trim(F.regexp_replace(lower_ascii(bare), r"[\x20\x09-\x0D]+", " "))


def lines(messages: DataFrame, conv_col="conv_id", turn_col="turn", text_col="text") -> DataFrame:
    """(conv, turn, key, level, hash, whole): the lines of each message that are not blank, and the passages they stand in.

    Hashes have 16 bytes. Passages are cut within the row, in time that follows the length of the text.
    """
    base = messages.select(
        column(conv_col).alias("conv"), column(turn_col).alias("turn"), F.coalesce(column(text_col), F.lit("")).alias("text")
    ).withColumn("key", F.xxhash64("text"))
    raw = F.split("text", r"\r\n|\r|\n")
    read = F.transform(raw, lambda x: F.struct(level(x).alias("level"), normalised(x).alias("line")))
    none = F.array(F.struct(F.lit(-1).alias("level"), F.lit("").alias("line")))
    both = F.arrays_zip(read.alias("own"), F.slice(F.concat(none, read), 1, F.size(raw)).alias("before"))

    def put(r: Column) -> Column:
        own, before = r["own"], r["before"]
        starts = (own["level"] != before["level"]) | (before["line"] == "")
        head = F.when(starts, F.concat(F.lit("\0"), own["level"].cast("string"), F.lit("\1"))).otherwise(F.lit("\n"))
        return F.when(own["line"] == "", F.lit("\0")).otherwise(F.concat(head, own["line"]))

    passages = F.filter(F.split(F.array_join(F.transform(both, put), ""), "\\x00"), lambda p: p != "")
    rows = base.select("conv", "turn", "key", F.explode(passages).alias("passage"))
    body = F.substring_index("passage", "\1", -1)
    rows = rows.select(
        "conv", "turn", "key", F.substring_index("passage", "\1", 1).cast("int").alias("level"),
        F.unhex(F.md5(F.translate(body, "\n", " "))).alias("whole"), F.explode(F.split(body, "\n")).alias("line"),
    )
    return rows.select("conv", "turn", "key", "level", F.unhex(F.md5("line")).alias("hash"), "whole")


def links(rows: DataFrame) -> DataFrame:
    """(conv, turn, key, level, source, lines): for each message and quote level, all messages quoted there.

    Each quoted passage goes to the latest earlier turn that wrote it, where none did, each of its lines to the latest
    earlier turn that wrote the line. Lines that no earlier turn wrote have a null source.
    """
    written = rows.where("level = 0").select("conv", "turn", F.explode(F.array("hash", "whole")).alias("sought")).distinct()
    quoted = rows.where("level > 0").groupBy("conv", "turn", "key", "level", "hash", "whole").agg(F.count(F.lit(1)).alias("n"))
    ways = F.when(F.col("hash") == F.col("whole"), F.array("hash")).otherwise(F.array("hash", "whole"))
    quoted = quoted.withColumn("sought", F.explode(ways))
    both = stored(quoted.unionByName(written, allowMissingColumns=True), "quote-lines")
    found = _last_before(both, ["conv", "sought"], F.col("level").isNull(), "source").where(F.col("level").isNotNull())
    found = found.groupBy("conv", "turn", "key", "level", "hash", "whole").agg(
        F.max("n").alias("n"),
        F.coalesce(F.max(F.when(F.col("sought") == F.col("whole"), F.col("source"))), F.max("source")).alias("source"),
    )
    return found.groupBy("conv", "turn", "key", "level", "source").agg(F.sum("n").alias("lines"))


def _last_before(rows: DataFrame, keys: list[str], marked: Column, name: str) -> DataFrame:
    """Adds the last turn of a marked row of the same keys before each row's turn.

    Found within blocks of turns, and for the first rows of a block from the last turns of the blocks before it, so
    a conversation of very many turns is not one task's work.
    """
    rows = rows.withColumn("__block", F.floor(F.col("turn") / TURNS)).withColumn("__mark", F.when(marked, F.col("turn")))
    own = Window.partitionBy(*keys, "__block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__near", F.max("__mark").over(own))
    ends = rows.groupBy(*keys, "__block").agg(F.max("__mark").alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "__block", F.max("__end").over(earlier).alias("__far"))
    rows = rows.join(ends, [*keys, "__block"])
    return rows.withColumn(name, F.coalesce("__near", "__far")).drop("__block", "__mark", "__near", "__far")


def conversations(messages: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", rounds: int = 40) -> DataFrame:
    """(conv, turn, role, reply_to, depth, root, n_quoted, n_linked, deepest, links, text) of each message.

    ``reply_to`` is the turn that most lines of the first level come from, the later one of equals, else the turn before,
    null for the first one. ``n_linked`` counts the quoted lines that any earlier turn wrote. ``links`` holds
    ``level:source:lines`` of each quoted message, ``-`` for lines of unknown origin, as sorted strings. ``depth`` counts
    replies up to the ``root`` of the thread: (conv, root, depth, turn) is the order by replies. ``text`` is without quoted lines and without the lines that introduce them.

    Null texts are empty messages. Repeated rows of one conversation and turn: the same text gives one row; different texts
    each get a row with the same links as any message of that turn. Rows without a conversation or turn are left out.
    Other columns are not read. An empty table gives no rows.
    """
    messages = messages.where(column(conv_col).isNotNull() & column(turn_col).isNotNull())
    found = links(lines(messages, conv_col, turn_col, text_col))
    text = F.coalesce(column(text_col), F.lit(""))
    heads = messages.select(
        column(conv_col).alias("conv"), column(turn_col).alias("turn"), column(role_col).alias("role"),
        F.xxhash64(text).alias("key"), unquoted(text).alias("text"),
    )
    known = F.col("source").isNotNull()
    named = F.concat_ws(":", "level", F.coalesce(F.col("source").cast("string"), F.lit("-")), "lines")
    sums = found.groupBy("conv", "turn", "key").agg(
        F.max(F.when(known & (F.col("level") == 1), F.struct("lines", "source")))["source"].alias("source"),
        F.sum("lines").alias("n_quoted"),
        F.sum(F.when(known, F.col("lines")).otherwise(0)).alias("n_linked"),
        F.max("level").alias("deepest"),
        F.array_sort(F.collect_list(named)).alias("links"),  # no more than the message has quoted lines
    )
    sums = stored(sums, "quote-counts")
    turns = heads.select("conv", "turn").distinct()
    turns = turns.join(sums.groupBy("conv", "turn").agg(F.max("source").alias("source")), ["conv", "turn"], "left")
    turns = _last_before(stored(turns, "turns"), ["conv"], F.lit(True), "last")
    turns = turns.select("conv", "turn", F.coalesce("source", "last").alias("up"))
    threads = _threads(stored(turns, "replies"), rounds)
    # Texts travel once, to the few numbers of their turn, and without their quotes.
    heads = heads.repartition("conv", "turn").groupBy("conv", "turn", "key")
    heads = heads.agg(F.min("role").alias("role"), F.first("text").alias("text"))
    heads = heads.join(threads, ["conv", "turn"]).join(sums, ["conv", "turn", "key"], "left")
    return heads.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "role", F.col("up").alias("reply_to"), "depth", "root",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quoted", "n_linked", "deepest")),
        F.coalesce("links", F.array().cast("array<string>")).alias("links"), "text",
    )


def _threads(turns: DataFrame, rounds: int) -> DataFrame:
    """(conv, turn, up, root, depth) by pointer doubling: each round a turn learns of twice as many turns above it.

    Sources are earlier turns, so there are no rings and a few rounds suffice: 2 ** rounds replies.
    """
    state = turns.select("conv", "turn", "up", F.col("up").alias("far"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    state = state.withColumn("root", F.col("turn"))
    for _ in range(rounds):
        # What has reached its root stays as it is; only the others are joined again.
        above = state.select("conv", F.col("turn").alias("far"), F.col("far").alias("next"), F.col("depth").alias("more"), F.col("root").alias("top"))
        moved = state.where(F.col("far").isNotNull()).join(above, ["conv", "far"]).select(
            "conv", "turn", "up", F.col("next").alias("far"), (F.col("depth") + F.col("more")).alias("depth"), F.col("top").alias("root")
        )
        state = stored(state.where(F.col("far").isNull()).unionAll(moved), "replies")
        if not state.where(F.col("far").isNotNull()).limit(1).count():
            break
    return state.select("conv", "turn", "up", "root", "depth")


def unquoted(text: Column) -> Column:
    """A text without quoted lines, without the line that introduces them, and without blank lines at its ends."""
    rows = F.split(text, r"\r\n|\r|\n")
    quotes = F.transform(rows, lambda x: x.rlike(_MARK))
    intro = r"(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*\z"
    kept = F.filter(
        F.arrays_zip(rows.alias("x"), F.slice(F.concat(quotes, F.array(F.lit(False))), 2, F.size(rows)).alias("then")),
        lambda r: ~r["x"].rlike(_MARK) & ~(r["then"] & r["x"].rlike(intro)),
    )
    return F.regexp_replace(F.array_join(F.transform(kept, lambda r: r["x"]), "\n"), r"\A\s*\n|\s+\z", "")


#: Turns that the fixture looks back.
_BACK = 4


def quoting(messages: DataFrame, conv_col="conv_id", turn_col="turn", text_col="text") -> DataFrame:
    """The messages as mail that quotes earlier ones.

    A fixture for tables whose turns hold no quotes. Each message quotes the one that stands one to three before it, wrapped
    anew after two words; every sixth turn quotes one more, two levels deep, every fourth a second message, every
    fifth a line that nobody wrote. Null texts are empty. Turns are gone through in blocks; the last ones of a block are
    shown to the next block too.
    """
    text, turn = F.coalesce(column(text_col), F.lit("")), column(turn_col)
    block = F.floor(turn / TURNS)
    shown = F.when(F.pmod(turn, F.lit(TURNS)) >= TURNS - _BACK, F.array(block, block + 1)).otherwise(F.array(block))
    rows = messages.withColumn("__at", block).withColumn("__block", F.explode(shown))
    own = Window.partitionBy(column(conv_col), "__block").orderBy(turn, text)
    back = [F.lag(text, i).over(own) for i in range(1, _BACK + 1)]

    def quoted(marks: str, x: Column) -> Column:
        return F.concat(F.lit(marks), F.replace(x, F.lit("\n"), F.lit("\n" + marks)))

    third = F.pmod(turn, F.lit(3))
    one = F.when(third == 0, back[0]).when(third == 1, back[1]).otherwise(back[2])
    parts = F.concat_ws(
        "\n\n",
        quoted(">> ", F.when(F.pmod(turn, F.lit(6)) == 0, back[1])),
        quoted("> ", F.regexp_replace(one, r"\A([^ \n]+ [^ \n]+) ", "$1\n")),
        quoted("> ", F.when(F.pmod(turn, F.lit(4)) == 3, back[3])),
        F.when(F.pmod(turn, F.lit(5)) == 2, F.lit("> Nobody here wrote this.")),
    )
    mail = F.when(parts == "", text).otherwise(F.concat(F.lit("A message wrote:\n"), parts, F.lit("\n\n"), text))
    rows = rows.withColumn("__mail", mail).where(F.col("__at") == F.col("__block"))
    return rows.select(*[F.col("__mail").alias(c) if c == text_col else column(c) for c in messages.columns])
