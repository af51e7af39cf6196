"""Chat formatting by quotation linking, in DataFrame functions only.

Lines that begin with ``>`` marks are quotes; the number of marks is their level.
Consecutive lines of one level are a passage; a blank line ends it. Passages, and
their single lines, are normalised (lower case, white space collapsed), hashed,
and joined to the first message of the conversation that says them unquoted. A
message replies to the source of its least nested linked quotes: the one with most
quoted characters, then the latest. Without a link it replies to the message
before it. The result lists each conversation in reply order (a reply and all that
follows from it stand behind the message it answers, earlier replies first), with
quotes and the lines that announce them (``On ... wrote:``) taken out.

How it scales: nothing is gathered per conversation. Originals are a minimum per
passage, combined before the shuffle, so a common passage is one row there and no
pairs arise. Messages and siblings are numbered by sorted ranges, and neighbours
meet by an equality join of numbers. Reply order comes from the tour around the
tree as a linked list, ranked by pointer jumping: each round doubles the reach,
and no key has more than one row.

Defined cases: messages without a conversation are one conversation; NULL turns
come first; NULL texts are empty. Messages that agree in conversation, turn and
author are ordered by the hash of their text; equal rows are messages of their
own. The source of a quote is always an earlier message. Empty tables give empty
results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import SPACE, written

MARKS = r"^((?:[ \t]*>)*)"
ANNOUNCES = r"^[ \t]*On\b.*\bwrote:[ \t\r]*$"


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with numbers 0, 1, 2, ... in the given order; rows that tie are numbered as they come.

    Rows are cut into ranges and counted; only one row per range is summed in order.
    """
    split = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = split.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    kept = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("_at", 33)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    joined = kept.withColumn("_part", part).join(firsts, "_part")
    place = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(name, place).drop("_at", "_part", "_first")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), f"{SPACE}+", " "))


def lines_of(messages: DataFrame) -> DataFrame:
    """One row per line of ``id``, ``t`` and ``text``: level, the line without marks, and the number of its passage."""
    each = messages.select("id", "t", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    each = each.withColumn("marks", marks).withColumn("level", F.char_length("marks") - F.char_length(F.translate("marks", ">", "")))
    each = each.withColumn("said", F.when(F.col("level") > 0, F.expr("substring(line, char_length(marks) + 1)")).otherwise(F.col("line")))
    each = each.withColumn("plain", normal(F.col("said"))).drop("marks")
    order = Window.partitionBy("id").orderBy("at")
    after = F.lead("level").over(order)
    each = each.withColumn("announces", F.coalesce(F.col("said").rlike(ANNOUNCES) & (after > F.col("level")), F.lit(False)))
    new = (F.coalesce(F.lag("level").over(order), F.lit(-1)) != F.col("level")) | (F.col("plain") == "") | F.col("announces")
    return each.withColumn("new", new.cast("int")).withColumn("passage", F.sum("new").over(order)).drop("new")


def linked(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id`` and ``source`` of the replies that a quote shows; and per id the numbers of quoted and of linked passages."""
    said = lines.filter((F.col("plain") != "") & ~F.col("announces"))
    passages = said.groupBy("id", "t", "level", "passage").agg(F.sort_array(F.collect_list(F.struct("at", "plain"))).alias("parts"))
    whole = passages.select("id", "t", "level", "passage", F.array_join("parts.plain", " ").alias("plain"))
    pieces = whole.unionByName(said.select("id", "t", "level", "passage", "plain")).distinct()
    pieces = pieces.withColumn("hash", F.xxhash64("plain"))
    originals = pieces.filter("level = 0").groupBy("t", "hash").agg(F.min("id").alias("source"))
    quotes = pieces.filter("level > 0").select("id", "t", "level", "passage", "hash", F.char_length("plain").alias("size"))
    found = quotes.join(originals, ["t", "hash"], "left").withColumn("source", F.when(F.col("source") < F.col("id"), F.col("source")))
    counts = (found.groupBy("id", "passage").agg(F.count("source").alias("n"))
                   .groupBy("id").agg(F.count(F.lit(1)).alias("n_quoted"), F.count(F.when(F.col("n") > 0, 1)).alias("n_linked")))
    sources = found.filter("source IS NOT NULL").groupBy("id", "level", "source").agg(F.sum("size").alias("size"))
    best = sources.groupBy("id").agg(F.max_by("source", F.struct(-F.col("level"), "size", "source")).alias("source"))
    return best, counts


def ranked(arcs: DataFrame) -> DataFrame:
    """Sums of ``w`` and ``d`` from each arc ``a`` of linked lists to the end of its list (``next`` NULL), itself included."""
    now = written(arcs, "arcs")
    while not now.filter("next IS NOT NULL").isEmpty():
        ahead = now.select(F.col("a").alias("_a"), F.col("w").alias("_w"), F.col("d").alias("_d"), F.col("next").alias("_next"))
        moved = now.filter("next IS NOT NULL").join(ahead, F.col("next") == F.col("_a")).select(
            "a", (F.col("w") + F.col("_w")).alias("w"), (F.col("d") + F.col("_d")).alias("d"), F.col("_next").alias("next"))
        now = written(now.filter("next IS NULL").select("a", "w", "d", "next").unionByName(moved), "arcs")
    return now


def reply_order(tree: DataFrame) -> DataFrame:
    """``id``, ``behind`` (messages from this one to the end of its conversation, in reply order) and ``depth`` of a tree
    given as ``id`` and ``parent`` (NULL for the first of a conversation)."""
    kids = numbered(tree.filter("parent IS NOT NULL").select("id", "parent"), ["parent", "id"], "k")
    first = kids.groupBy("parent").agg(F.min("id").alias("child")).withColumnRenamed("parent", "p")
    after = kids.select((F.col("k") - 1).alias("k"), F.col("parent").alias("p"), F.col("id").alias("sibling"))
    siblings = kids.join(after, "k").filter("parent = p").select(F.col("id").alias("i"), "sibling")
    nodes = tree.select("id", "parent").join(first, F.col("id") == F.col("p"), "left").join(siblings, F.col("id") == F.col("i"), "left")
    down, up = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = nodes.select(F.explode(F.array(
        F.struct(down.alias("a"), F.lit(1).cast("bigint").alias("w"), F.lit(1).cast("bigint").alias("d"),
                 F.coalesce(F.col("child") * 2, up).alias("next")),
        F.struct(up.alias("a"), F.lit(0).cast("bigint").alias("w"), F.lit(-1).cast("bigint").alias("d"),
                 F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next")))).alias("arc")).select("arc.*")
    return ranked(arcs).filter("a % 2 = 0").select((F.col("a") / 2).cast("bigint").alias("id"), F.col("w").alias("behind"), (-F.col("d")).alias("depth"))


def conversations(messages: DataFrame, thread: str = "conv_id", turn: str = "turn", author: str = "role", text: str = "text") -> DataFrame:
    """thread, turn, author, position (from 0, in reply order), depth, reply_to (a turn), n_quoted, n_linked and body."""
    rows = messages.select(F.col(thread).alias("thread"), F.col(turn).alias("turn"), F.col(author).alias("author"),
                           F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.coalesce(F.concat(F.lit("="), F.col("thread").cast("string")), F.lit("")))
    own = written(numbered(rows, ["thread", "t", "turn", "author", "text"], "id"), "messages")
    lines = written(lines_of(own), "lines")
    best, counts = linked(lines)
    before = own.select((F.col("id") + 1).alias("id"), F.col("t").alias("tb"))
    tree = (own.select("id", "t").join(before, "id", "left").join(best, "id", "left")
               .select("id", F.coalesce("source", F.when(F.col("tb") == F.col("t"), F.col("id") - 1)).alias("parent")))
    tree = written(tree, "replies")
    order = reply_order(tree)
    sizes = own.groupBy("t").agg(F.count(F.lit(1)).alias("size"))
    said = (lines.filter((F.col("level") == 0) & ~F.col("announces"))
                 .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("parts"))
                 .select("id", F.array_join("parts.line", "\n").alias("body")))
    to = own.select(F.col("id").alias("parent"), F.col("turn").alias("reply_to"))
    return (own.join(order, "id").join(sizes, "t").join(said, "id", "left").join(counts, "id", "left")
               .join(tree, "id").join(to, "parent", "left")
               .select(F.col("thread").alias(thread), F.col("turn").alias(turn), F.col("author").alias(author),
                       (F.col("size") - F.col("behind")).alias("position"), "depth", "reply_to",
                       F.coalesce("n_quoted", F.lit(0)).cast("bigint").alias("n_quoted"),
                       F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), F.coalesce("body", F.lit("")).alias("body")))
