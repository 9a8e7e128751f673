"""Conversations as training examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
reply is trainable. A conversation is formatted once, as a stream of pieces with places, and an example
says which part of the stream it reads: from 0 to ``loss_to``, trainable from ``loss_from``.
``expanded`` writes examples out in full, and replies are read back from there. Written out, the
contexts of a conversation of n turns hold of the order of n * n turns.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.operators.prefix import exclusive_prefix

ASSISTANT = "assistant"
MARK, GAP, END = "### ", ": ", " </turn>\n"
# Turns are summed up in blocks of this many neighbouring turn numbers.
BLOCK_BITS = 12
TURN_BITS = 64 - BLOCK_BITS

ROLE_SIGNS = {"\\": "\\s", ":": "\\c", "#": "\\h", "<": "\\l"}


def escaped(text: Column) -> Column:
    """A backslash before every backslash and every control string of the template."""
    return F.regexp_replace(text, r"\\|###|</turn>", r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\|###|</turn>)", "$1")


def escaped_role(role: Column) -> Column:
    for sign, name in ROLE_SIGNS.items():
        role = F.replace(role, F.lit(sign), F.lit(name))
    return role


def unescaped_role(role: Column) -> Column:
    for sign, name in reversed(ROLE_SIGNS.items()):
        role = F.replace(role, F.lit(name), F.lit(sign))
    return role


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, offset, turn, piece, loss_from, loss_to): the stream of every conversation.

    Takes (conv_id, turn, role, text) and ignores other columns. A turn reads ``### role: text
    </turn>`` and a line end; control strings inside texts and roles are escaped. ``offset`` is the
    place of the piece in its conversation, in code points. A piece of an assistant has the place of
    its reply in ``loss_from`` .. ``loss_to``, all others have nulls there.

    Turns come in order of their number, those without one last, ties by role, then text; repeated
    rows are turns like any other. Null texts and roles count as empty, a null conv_id is a
    conversation like any other, any whole number may be a turn. An empty table gives no rows.

    Offsets are running sums inside blocks of neighbouring turn numbers; sums of blocks go through
    the same step, so one huge conversation is spread like many small ones.
    """
    empty = F.lit("")
    role, text = F.coalesce(turns["role"].cast("string"), empty), F.coalesce(turns["text"].cast("string"), empty)
    head = F.concat(F.lit(MARK), escaped_role(F.col("_role")), F.lit(GAP))
    turn = F.col("turn")
    # Blocks of negative numbers come first, that of missing numbers last.
    block = F.coalesce(F.shiftright(turn, BLOCK_BITS) + (1 << (TURN_BITS - 1)), F.lit(1 << TURN_BITS))
    rows = (
        turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), role.alias("_role"), text.alias("_text"))
        .withColumn("_head", F.length(head))
        .withColumn("piece", F.concat(head, escaped(F.col("_text")), F.lit(END)))
        .withColumn("_chars", F.length("piece").cast("long"))
        .withColumn("_conv", F.coalesce("conv_id", F.lit(0)))
        .withColumn("_none", F.col("conv_id").isNull())
        .withColumn("_block", block)
    )
    by = ["_conv", "_none"]
    sums = rows.groupBy(*by, "_block").agg(F.sum("_chars").alias("_sum"))
    base = exclusive_prefix(sums, "_block", "_sum", "_base", by, id_bits=TURN_BITS + 1, block_bits=20).select(*by, "_block", "_base")
    before = Window.partitionBy(*by, "_block").orderBy("turn", "_role", "_text").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("_inside", F.coalesce(F.sum("_chars").over(before), F.lit(0)))
        .join(base, [*by, "_block"])
        .withColumn("offset", F.col("_base") + F.col("_inside"))
    )
    reply = F.col("_role") == ASSISTANT
    start = F.col("offset") + F.col("_head")
    return placed.select(
        "conv_id",
        "offset",
        "turn",
        "piece",
        F.when(reply, start).alias("loss_from"),
        F.when(reply, F.col("offset") + F.col("_chars") - len(END)).alias("loss_to"),
    )


def examples(stream: DataFrame) -> DataFrame:
    """(conv_id, turn, loss_from, loss_to): one row per assistant turn.

    The example reads its conversation's stream from 0 to ``loss_to``: all turns before, and the
    reply; the loss mask covers ``loss_from`` .. ``loss_to`` alone.
    """
    return stream.where("loss_from is not null").select("conv_id", "turn", "loss_from", "loss_to")


def expanded(stream: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, turn, text, loss_from, loss_to) of the chosen examples, written out in full.

    An example's text is as long as its context, and that is what a task holds at a time.
    """
    by = ["_conv", "_none"]  # a null conversation meets itself; one exchange serves the join and the sums
    conv = [F.coalesce("conv_id", F.lit(0)).alias("_conv"), F.col("conv_id").isNull().alias("_none")]
    pieces = stream.select(*conv, "offset", "piece")
    asked = chosen.select(*conv, "conv_id", "turn", "loss_from", "loss_to")
    keys = [*by, "conv_id", "turn", "loss_from", "loss_to"]
    joined = asked.join(pieces, by).where(F.col("offset") < F.col("loss_to"))
    written = joined.groupBy(*keys).agg(F.expr("listagg(piece) within group (order by offset)").alias("text"))
    return written.select("conv_id", "turn", F.substring("text", F.lit(1), F.col("loss_to").cast("int")).alias("text"), "loss_from", "loss_to")


def read_back(stream: DataFrame) -> DataFrame:
    """The stream with ``role`` and ``text`` parsed from its pieces, and ``reply`` cut by the mask."""
    piece, inner = F.col("piece"), F.col("_inner")
    colon = F.locate(":", inner)
    reply = F.substring(piece, (F.col("loss_from") - F.col("offset") + 1).cast("int"), (F.col("loss_to") - F.col("loss_from")).cast("int"))
    return (
        stream.withColumn("_inner", F.substring(piece, F.lit(len(MARK) + 1), F.length(piece) - len(MARK) - len(END)))
        .withColumn("role", unescaped_role(F.substring(inner, F.lit(1), colon - 1)))
        .withColumn("text", unescaped(F.substring(inner, colon + len(GAP), F.length(inner))))
        .withColumn("reply", unescaped(reply))
        .drop("_inner")
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long"
)


def trained(written: DataFrame) -> DataFrame:
    """(conv_id, offset, reply): what the mask of each written example covers, unescaped."""
    size = F.col("loss_to") - F.col("loss_from")
    reply = F.substring("text", (F.col("loss_from") + 1).cast("int"), size.cast("int"))
    return written.select("conv_id", F.col("loss_from").alias("offset"), unescaped(reply).alias("reply"))


def digests(stream: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """One row per conversation: counts, and digests of the turns and replies read back.

    Replies come from the ``written`` examples; without them from the stream, by the same mask. A
    digest runs over its conversation in order. Rows of a conversation are sorted by Spark and pass
    through the digest one by one, so memory does not grow with the conversation.
    """
    parsed = read_back(stream).select("conv_id", "offset", "role", "text", "reply", F.length("piece").alias("chars"))
    if written is not None:
        # Rows of examples have no role; their places lie between those of their own and the next turn.
        parsed = parsed.drop("reply").unionByName(trained(written), allowMissingColumns=True)
    placed = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "offset")

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text", "reply", "chars")))

        def finished():
            for conv, found in itertools.groupby(rows(), lambda row: row[0]):
                turns, replies, n = hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0]
                for _, role, text, reply, chars in found:
                    if role is not None:
                        turns.update(f"{role}\n{text}\n".encode())
                        n[0], n[2] = n[0] + 1, n[2] + chars
                    if reply is not None:
                        replies.update(reply.encode())
                        n[1], n[3] = n[1] + len(reply), n[3] + 1
                yield conv, n[0], turns.hexdigest(), n[1], replies.hexdigest(), n[2], n[3]

        names = [part.split()[0] for part in DIGESTS.split(", ")]
        done = finished()
        while some := list(itertools.islice(done, 10_000)):
            columns = [pa.array(x, pa.string() if "sha256" in name else pa.int64()) for name, x in zip(names, zip(*some))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return placed.mapInArrow(run, DIGESTS)
