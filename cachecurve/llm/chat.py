"""Chat formatting with typed content parts, in DataFrame expressions only.

A message is a list of parts (text, image, audio or document). A visitor turns every part
into text: text parts are escaped, the others become an ordered placeholder naming their
kind and number, and are recorded as attachments with the reference and the number of
tokens they expand to. The template is::

    <|im_start|>{role}\\n{content}<|im_end|>\\n

Inside roles and contents a backslash gets a second one and every ``<`` gets a backslash after it,
whatever follows, so that no text holds a control string, nor do texts of parts that stand next to each other; a
line break in a role becomes ``<n``. Unescaping reads from left to right and is the exact inverse, part by part.

The loss mask covers the text parts of assistant messages. Its spans are kept as (turn,
offset in that turn's formatted text, length), which stays exact and cheap to read however
long a conversation is.

Results: turns are ordered by turn number, equal numbers by role and content, null first. A null role
or text is empty; a conversation of empty messages keeps its turns; rows whose
conversation id is null form one conversation. Repeated rows stay repeated turns. An empty
table gives no conversations. Extra columns of any name are not read. A conversation is one row by definition; nothing larger is
collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
#: Kinds of parts that stand as a placeholder.
ATTACHED = ("image", "audio", "document")
PART_TYPE = "struct<kind:string,text:string,ref:string,tokens:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(<)\\|\\(\\)", "$1$2")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<n"))


def unescape_role(role: Column) -> Column:
    """Undoes :func:`escape_role`; after a ``<`` there is a backslash or the ``n`` of a line break."""
    return unescape(F.replace(role, F.lit("<n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A plain text column as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(0).cast("bigint").alias("tokens")))


def visit(parts: Column) -> Column:
    """Each part with its number among the parts of its kind and the text it stands for.

    An unknown kind is treated as text; a null list as no parts.
    """
    parts = F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>"))

    def visited(part: Column, at: Column) -> Column:
        kind = F.coalesce(part["kind"], F.lit("text"))
        attached = kind.isin(*ATTACHED)
        before = F.size(F.filter(F.slice(parts, F.lit(1), at), lambda p: p["kind"] == kind))
        mark = F.concat(F.lit("<|"), kind, F.lit(":"), before.cast("string"), F.lit("|>"))
        return F.struct(
            kind.alias("kind"), before.alias("number"), part["ref"].alias("ref"),
            F.coalesce(part["tokens"], F.lit(0)).cast("bigint").alias("tokens"),
            attached.alias("attached"),
            F.when(attached, mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))
            .alias("shown"))

    return F.transform(parts, visited)


def format_chat(rows: DataFrame, parts: Column | None = None) -> DataFrame:
    """One row a conversation: ``conv_id``, ``formatted``, ``loss_spans`` (``turn_no start
    length``), ``attachments`` (``turn_no kind number ref tokens``) and ``attached_tokens``.

    ``rows`` has ``conv_id turn role`` and, without ``parts``, ``text``.
    """
    parts = text_part(F.col("text")) if parts is None else parts
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = rows.select(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"),
                        role.alias("role"), visit(parts).alias("visited"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    content = F.array_join(F.transform("visited", lambda p: p["shown"]), "")
    turns = turns.select("conv_id", "turn", "role", "visited", head.alias("head"),
                         content.alias("content"))

    def spans() -> Column:
        """Text parts of an assistant message: offset and length inside the turn."""
        lengths = F.transform("visited", lambda p: F.length(p["shown"]))
        texts = F.filter(F.transform("visited", lambda p, i: F.struct(
            (F.length("head") + F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0),
                                            lambda a, b: a + b)).alias("start"),
            F.length(p["shown"]).alias("length"), p["attached"].alias("attached"))),
            lambda s: ~s["attached"])
        return F.when(F.col("role") == "assistant", texts) \
            .otherwise(F.filter(texts, lambda s: F.lit(False)))

    turns = turns.select(
        "conv_id", F.struct("turn", "role", "content").alias("place"),
        F.concat("head", "content", F.lit(STOP + "\n")).alias("piece"),
        spans().alias("spans"), F.filter("visited", lambda p: p["attached"]).alias("attached"))
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "piece", "spans", "attached"))).alias("turns"))
    loss = F.flatten(F.transform("turns", lambda t, i: F.transform(
        t["spans"], lambda s: F.struct(i.alias("turn_no"), s["start"].alias("start"),
                                       s["length"].alias("length")))))
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(
        t["attached"], lambda p: F.struct(i.alias("turn_no"), p["kind"].alias("kind"),
                                          p["number"].alias("number"), p["ref"].alias("ref"),
                                          p["tokens"].alias("tokens")))))
    return gathered.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        loss.alias("loss_spans"), attachments.alias("attachments"),
    ).withColumn("attached_tokens", F.aggregate(
        "attachments", F.lit(0).cast("bigint"), lambda a, p: a + p["tokens"]))


def read_chat(chats: DataFrame) -> DataFrame:
    """Turns (``role text``) and loss texts read back from the formatted conversation.

    Texts come back with placeholders in the place of attachments.
    """
    marks = F.split(F.col("formatted"), r"<\|im_start\|>", -1)
    pieces = F.slice(marks, F.lit(2), F.greatest(F.size(marks) - 1, F.lit(0)))
    chats = chats.withColumn("pieces", pieces)

    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        body = F.substring(piece, cut + 1, F.length(piece) - cut - len(STOP) - 1)
        return F.struct(unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"),
                        unescape(body).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.get(F.col("pieces"), s["turn_no"]), s["start"] - len(START) + 1, s["length"])))
    return chats.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"),
                        loss.alias("loss_texts"), "attachments", "attached_tokens")


def chat_digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`read_chat` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return chats.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                        F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("bigint").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("bigint").alias("formatted_chars"))
