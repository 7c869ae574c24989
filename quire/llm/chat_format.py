"""Chat formatting of typed content parts (native DataFrame functions only).

A turn is an array of parts (``PART``): text, image, audio or document.  A
visitor over the array flattens it: text parts are escaped, every other part
becomes an ordered placeholder ``<|kind:n|>``, where n is the part's number in
its conversation.  Attachments are recorded with reference, number, turn and
the tokens that their placeholder expands to.  The formatted conversation is one
string::

    ### User: escaped text<|image:1|>escaped text</turn>\\n### Assistant: ...

The loss mask is a list of spans over the text pieces of the trained role.

Escapes are reversible.  Control strings get a backslash inside (``</turn>`` is
written ``<\\/turn>``, ``### `` as ``##\\# ``, ``<|`` as ``<\\|``), backslashes are
doubled; so no control string stands in an escaped text, and whoever reads can
split at them literally.  Neighbouring text parts are kept apart by ``<|+|>``.

Defined results: null text is empty; empty text parts give no piece; a null
array is a turn without pieces; a part of null or unknown kind is text; a part
without measures expands to one token; a null role is the empty role; roles
other than the known ones are written escaped after ``@``; a null ``conv_id`` is
a conversation of its own; turns are ordered by turn (null first), role and
content, so ties and repeated rows are turns each; an empty table gives no
conversation; columns other than conv_id, turn, role and text or parts are not
looked at.  A conversation is one record: its formatted string is one value,
built in one task, and has Spark's limit of 2 GB for a string.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import let

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_ATTACHED = ("image", "audio", "document")


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings and expansion sizes."""

    head: str = "### "
    after_role: str = ": "
    close: str = "</turn>"
    end: str = "\n"
    open: str = "<|"
    shut: str = "|>"
    #: how known roles are shown
    roles: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
    )
    trained: str = "assistant"
    #: image pixels of a token's side, audio tokens a second, tokens of a document page
    patch: int = 28
    audio_rate: float = 12.5
    page_tokens: int = 256


TEMPLATE = ChatTemplate()


def text_parts(rows: DataFrame) -> DataFrame:
    """Rows with a ``text`` column as turns of one text part each."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.col("text"),
        F.lit(None).cast("string").alias("ref"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))],
    )
    return rows.select("conv_id", "turn", "role", F.array(part).cast(f"array<{PART}>").alias("parts"))


# -- escapes ---------------------------------------------------------------------


def _quoted(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != " " else c for c in s)


def escape(text: Column, t: ChatTemplate = TEMPLATE) -> Column:
    """Backslashes doubled, control strings broken by a backslash before their last characters."""
    out = F.regexp_replace(text, r"\\", r"\\\\")
    for s, at in ((t.head, len(t.head) - 2), (t.close, 1), (t.open, 1)):
        out = F.regexp_replace(out, f"({_quoted(s[:at])})({_quoted(s[at:])})", r"$1\\$2")
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _shown_role(role: Column, t: ChatTemplate) -> Column:
    role = F.coalesce(role, F.lit(""))
    other = F.regexp_replace(escape(role, t), f"({_quoted(t.after_role[:1])})({t.after_role[1:]})", r"$1\\$2")
    out = F.concat(F.lit("@"), other)
    for name, shown in t.roles.items():
        out = F.when(role == name, F.lit(shown)).otherwise(out)
    return out


def _read_role(shown: Column, t: ChatTemplate) -> Column:
    out = unescape(F.substring(shown, 2, 2**31 - 1))
    for name, s in t.roles.items():
        out = F.when(shown == s, F.lit(name)).otherwise(out)
    return out


# -- the visitor -----------------------------------------------------------------


def _is_text(p: Column) -> Column:
    return F.coalesce(~p["kind"].isin(*_ATTACHED), F.lit(True))


def _kept(parts: Column) -> Column:
    full = F.filter(parts, lambda p: ~_is_text(p) | (F.coalesce(p["text"], F.lit("")) != ""))
    return F.coalesce(full, F.array().cast(f"array<{PART}>"))


def expanded_tokens(p: Column, t: ChatTemplate = TEMPLATE) -> Column:
    """Tokens that the placeholder of an attached part stands for; 1 where its size is not known."""
    image = F.ceil(p["width"] / t.patch) * F.ceil(p["height"] / t.patch)
    size = (
        F.when(p["kind"] == "image", image)
        .when(p["kind"] == "audio", F.ceil(p["seconds"] * t.audio_rate))
        .when(p["kind"] == "document", p["pages"].cast("bigint") * t.page_tokens)
    )
    return F.greatest(F.coalesce(size.cast("bigint"), F.lit(1)), F.lit(1).cast("bigint"))


def _visit(parts: Column, base: Column, t: ChatTemplate) -> Column:
    """Pieces of a turn in order: kind, piece, tokens, ref, number, lead (characters before a text)."""

    def each(kept: Column):
        def piece(p: Column, i: Column) -> Column:
            number = (base + i).cast("bigint")
            follows = (i > 0) & _is_text(F.get(kept, i - 1))
            gap = F.when(follows, F.lit(f"{t.open}+{t.shut}")).otherwise(F.lit(""))
            mark = F.concat(F.lit(t.open), p["kind"], F.lit(":"), number.cast("string"), F.lit(t.shut))
            return F.struct(
                F.when(_is_text(p), F.lit("text")).otherwise(p["kind"]).alias("kind"),
                F.when(_is_text(p), F.concat(gap, escape(p["text"], t))).otherwise(mark).alias("piece"),
                F.when(_is_text(p), F.lit(0).cast("bigint")).otherwise(expanded_tokens(p, t)).alias("tokens"),
                p["ref"].alias("ref"),
                number.alias("number"),
                F.when(_is_text(p), F.char_length(gap)).otherwise(F.lit(0)).alias("lead"),
            )

        return F.transform(kept, piece)

    return let(parts, each)


def _starts(pieces: Column, first: Column) -> Column:
    """Where each piece begins, from ``first`` on."""
    empty = F.array().cast("array<int>")
    run = F.aggregate(
        pieces,
        F.struct(first.alias("at"), empty.alias("all")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["piece"])).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")
        ),
        lambda acc: acc["all"],
    )
    # a turn of one piece, as most are, needs no running sum
    return F.when(F.size(pieces) == 1, F.array(first)).otherwise(run)


def format_turns(rows: DataFrame, t: ChatTemplate = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), role, line, start (in the conversation), spans, attachments.

    ``rows``: conv_id, turn, role, parts.  ``spans``: the text under the loss mask as
    (turn, start, at, length), start counted in the conversation and at in the
    turn, in code points.  ``attachments``: (turn, number, kind, ref, start, tokens).
    """
    kept = rows.select("conv_id", "turn", "role", _kept(F.col("parts")).alias("kept"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", F.col("kept").cast("string"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    numbered = kept.select(
        "conv_id",
        "role",
        (F.row_number().over(w) - 1).alias("seq"),
        F.coalesce(F.sum(F.size("kept")).over(before), F.lit(0)).alias("base"),
        "kept",
    )
    head = F.concat(F.lit(t.head), _shown_role(F.col("role"), t), F.lit(t.after_role))
    pieces = numbered.select(
        "conv_id", "seq", "role", head.alias("head"), _visit(F.col("kept"), F.col("base"), t).alias("pieces")
    )
    body = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    lines = pieces.select(
        "conv_id",
        "seq",
        F.coalesce(F.col("role") == t.trained, F.lit(False)).alias("trained"),
        F.concat("head", body, F.lit(t.close + t.end)).alias("line"),
        F.arrays_zip("pieces", _starts(F.col("pieces"), F.char_length("head")).alias("at")).alias("pieces"),
    )
    order = Window.partitionBy("conv_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn(
        "start", F.coalesce(F.sum(F.char_length("line")).over(order), F.lit(0)).cast("bigint")
    )
    seq, start = F.col("seq"), F.col("start")
    spans = F.transform(
        F.filter("pieces", lambda x: F.col("trained") & (x["pieces"]["kind"] == "text")),
        lambda x: F.struct(
            seq.alias("turn"),
            (start + x["at"] + x["pieces"]["lead"]).alias("start"),
            (x["at"] + x["pieces"]["lead"]).alias("at"),
            (F.char_length(x["pieces"]["piece"]) - x["pieces"]["lead"]).alias("length"),
        ),
    )
    attachments = F.transform(
        F.filter("pieces", lambda x: x["pieces"]["kind"] != "text"),
        lambda x: F.struct(
            seq.alias("turn"),
            x["pieces"]["number"].alias("number"),
            x["pieces"]["kind"].alias("kind"),
            x["pieces"]["ref"].alias("ref"),
            (start + x["at"]).alias("start"),
            x["pieces"]["tokens"].alias("tokens"),
        ),
    )
    return placed.select("conv_id", "seq", "line", "start", spans.alias("spans"), attachments.alias("attachments"))


def format_chats(rows: DataFrame, t: ChatTemplate = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, attached_tokens."""
    turns = format_turns(rows, t)
    all_turns = F.array_sort(F.collect_list(F.struct("seq", "line", "spans", "attachments")))
    whole = turns.groupBy("conv_id").agg(all_turns.alias("turns"))
    attached = F.flatten(F.transform("turns", lambda x: x["attachments"]))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["line"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda x: x["spans"])).alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attached_tokens"),
    )


# -- reading back ----------------------------------------------------------------


def turn_lines(formatted: Column, t: ChatTemplate = TEMPLATE) -> Column:
    """The turns of a formatted conversation, without their ends."""
    cut = F.split(formatted, _quoted(t.close) + t.end, -1)
    return F.slice(cut, F.lit(1), F.size(cut) - 1)


def _read_part(segment: Column, t: ChatTemplate) -> Column:
    """What follows a placeholder's opening: its part and the text after it."""
    mark = F.substring_index(segment, t.shut, 1)
    rest = F.substring(segment, F.char_length(mark) + len(t.shut) + 1, F.char_length(segment))
    none = F.lit(None).cast("bigint")
    text = F.struct(F.lit("text").alias("kind"), unescape(rest).alias("text"), none.alias("number"))
    placeholder = F.struct(
        F.substring_index(mark, ":", 1).alias("kind"),
        F.lit(None).cast("string").alias("text"),
        F.try_element_at(F.split(mark, ":"), F.lit(2)).cast("bigint").alias("number"),
    )
    return F.when(mark == "+", F.array(text)).when(rest == "", F.array(placeholder)).otherwise(
        F.array(placeholder, text)
    )


def read_turn(line: Column, t: ChatTemplate = TEMPLATE) -> Column:
    """(role, parts) of a turn's line; parts as (kind, text, number of the attachment)."""
    # the header is before the first separator: a role holds none
    shown = F.substring_index(F.substring(line, len(t.head) + 1, F.char_length(line)), t.after_role, 1)
    skip = F.char_length(shown) + len(t.head) + len(t.after_role) + 1
    body = F.substring(line, skip, F.char_length(line))
    cut = F.split(body, _quoted(t.open), -1)
    first = F.filter(
        F.array(
            F.struct(
                F.lit("text").alias("kind"), unescape(cut[0]).alias("text"), F.lit(None).cast("bigint").alias("number")
            )
        ),
        lambda p: p["text"] != "",
    )
    more = F.flatten(F.transform(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0))), lambda s: _read_part(s, t)))
    return F.struct(_read_role(shown, t).alias("role"), F.concat(first, more).alias("parts"))


def read_chats(chats: DataFrame, t: ChatTemplate = TEMPLATE) -> DataFrame:
    """conv_id, formatted, turns (role, parts) and loss_text, read from the formatted strings and the mask."""

    def read(lines: Column) -> Column:
        under_mask = F.transform(
            "loss_spans", lambda s: unescape(F.substring(F.get(lines, s["turn"]), s["at"] + 1, s["length"]))
        )
        return F.struct(
            F.transform(lines, lambda x: read_turn(x, t)).alias("turns"),
            F.array_join(under_mask, "").alias("loss_text"),
        )

    back = let(turn_lines(F.col("formatted"), t), read).alias("r")
    return chats.select("conv_id", "formatted", back).select("conv_id", "formatted", "r.*")


def conversation_digests(rows: DataFrame, t: ChatTemplate = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted conversations.

    ``rows``: conv_id, turn, role, text.  Every figure is read from the output.
    """
    back = read_chats(format_chats(text_parts(rows), t), t)
    words = lambda parts: F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    said = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), words(x["parts"]), F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
