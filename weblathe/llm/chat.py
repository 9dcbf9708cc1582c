"""Chat formatting with budgeted windows, in DataFrame expressions only.

A conversation's turns are laid out in windows of at most ``budget`` tokens. Prefix sums of turn tokens choose spans of
whole turns: a window repeats the system turn and the last turns before it (``history`` tokens of them at most), then
takes new turns while the sum stays within the budget. A turn that is longer than a window's budget stands in a window
of its own, after the system turn if there is one, and such windows are the only ones over the budget. A turn's tokens are
those of a tokenizer where ``tokens`` names a column of counts, worked out upstream; without one, runs of A-Z, a-z and 0-9
and every other character but white space count as one each. Repeated turns are never trained on: the loss mask covers the new assistant texts only, so each counts once.

A turn is written ``<s>[role]`` newline text ``</s>`` newline. In roles and texts ``&``, ``<``, ``[`` and ``]`` become
``&amp;``, ``&lt;``, ``&#91;`` and ``&#93;``, so no control string of this or a similar template can come from a text, and
undoing the four gives back exactly the text.

Cases: null text or role is empty, a null or negative count of tokens is 0; turns are in order of turn, role, text, nulls first, and repeated rows stay; a null
conv_id is one conversation; empty tables give no rows; extra columns are ignored, whatever their names. One conversation is one training
example and its digest covers it all, hence its rows meet in one task; nothing gathers more than one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template: order matters, the ampersand goes first and comes back last.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))
TOKEN = "[A-Za-z0-9]+|[^A-Za-z0-9\\s]"


def escape(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


#: Tokens that the marks around a turn count as.
MARKS = 4


def format_chats(df: DataFrame, budget: int = 512, history: int = 128, tokens: str | None = None) -> DataFrame:
    """Return conv_id, window (from 0), n_repeated (turns that the window repeats), text and loss_spans.

    loss_spans: (start, end) in code points of the window's text, end exclusive.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    own = F.regexp_count(text, F.lit(TOKEN)) if tokens is None else F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(0))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"), (own + F.lit(MARKS)).cast("bigint").alias("tokens"))
    convs = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.withColumn("lead", F.when(F.col("turns")[0]["role"] == "system", 1).otherwise(0))

    # a fold over the turns keeps, per window, where its new turns begin and where its history begins
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.lit(0).alias("i"), zero.alias("used"), F.expr("CAST(array() AS ARRAY<STRUCT<first: INT, from: INT>>)").alias("windows"),
        F.lit(0).alias("from"), zero.alias("held"),
    )

    def step(s: Column, t: Column) -> Column:
        turns, lead = F.col("turns"), F.col("lead")
        fits = (F.size(s["windows"]) > 0) & (s["used"] + t["tokens"] <= F.lit(budget))
        system = F.when(lead == 1, turns[0]["tokens"]).otherwise(zero)
        # history is given up where it leaves no room for the turn
        room = s["held"] + system + t["tokens"] <= F.lit(budget)
        since, held = F.when(room, s["from"]).otherwise(s["i"]), F.when(room, s["held"]).otherwise(zero)
        first = F.when(s["i"] == 0, zero).otherwise(system)
        later = _slide(s, t, lead, history)
        return F.struct(
            (s["i"] + 1).alias("i"),
            F.when(fits, s["used"] + t["tokens"]).otherwise(first + held + t["tokens"]).alias("used"),
            F.when(fits, s["windows"]).otherwise(F.array_append(s["windows"], F.struct(s["i"].alias("first"), since.alias("from")))).alias("windows"),
            later["from"].alias("from"),
            later["held"].alias("held"),
        )

    convs = convs.withColumn("windows", F.aggregate("turns", start, step, lambda s: s["windows"]))

    def window(w: Column, k: Column) -> Column:
        windows, turns, lead = F.col("windows"), F.col("turns"), F.col("lead")
        end = F.coalesce(F.get(windows, k + 1)["first"], F.size(turns))
        system = F.when((lead == 1) & (w["first"] > 0), F.slice(turns, 1, 1)).otherwise(F.slice(turns, 1, 0))
        past = F.slice(turns, w["from"] + 1, w["first"] - w["from"])
        return F.struct(k.alias("window"), (F.size(system) + F.size(past)).alias("n_repeated"), F.concat(system, past, F.slice(turns, w["first"] + 1, end - w["first"])).alias("turns"))

    rows = convs.select("conv_id", F.inline(F.transform("windows", window)))
    heads = F.transform("turns", lambda t: F.concat(F.lit("<s>["), escape(t["role"]), F.lit("]\n")))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    rows = rows.select("conv_id", "window", "n_repeated", F.transform("turns", lambda t: t["role"]).alias("roles"), heads.alias("heads"), bodies.alias("bodies"))
    tail = F.lit("</s>\n")
    text = F.array_join(F.transform("heads", lambda h, i: F.concat(h, F.get(F.col("bodies"), i), tail)), "")

    def span(s: Column, h: Column) -> Column:
        body = F.get(F.col("bodies"), s["i"])
        at = s["at"] + F.length(h)
        to = at + F.length(body)
        mask = (F.get(F.col("roles"), s["i"]) == "assistant") & (s["i"] >= F.col("n_repeated"))
        return F.struct((s["i"] + 1).alias("i"), (to + F.length(tail)).alias("at"), F.when(mask, F.array_append(s["spans"], F.struct(at.alias("start"), to.alias("end")))).otherwise(s["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, end: INT>>)").alias("spans"))
    return rows.select("conv_id", "window", "n_repeated", text.alias("text"), F.aggregate("heads", none, span, lambda s: s["spans"]).alias("loss_spans"))


def _slide(s: Column, t: Column, lead: Column, history: int) -> Column:
    """The history that a window beginning after turn ``t`` would repeat: (from, held)."""
    turns = F.col("turns")
    begin = F.struct(F.when(s["i"] < lead, s["i"] + 1).otherwise(s["from"]).alias("from"), F.when(s["i"] < lead, F.lit(0).cast("bigint")).otherwise(s["held"] + t["tokens"]).alias("held"))
    # drop turns from the front until the rest fits
    first = F.aggregate(
        F.slice(turns, begin["from"] + 1, s["i"] + 1 - begin["from"]),
        begin,
        lambda a, x: F.when(a["held"] > F.lit(history), F.struct((a["from"] + 1).alias("from"), (a["held"] - x["tokens"]).alias("held"))).otherwise(a),
    )
    return F.when(begin["from"] <= s["i"], first).otherwise(begin)


def read_chats(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars.

    Turns that a window repeats are left out; text under the loss mask is unescaped and joined in order.
    """
    parts = F.slice(F.split("text", "</s>\n", -1), F.col("n_repeated") + 1, F.greatest(F.size(F.split("text", "</s>\n", -1)) - 1 - F.col("n_repeated"), F.lit(0)))
    # what is left of "<s>[role]\ntext": the role ends at the first "]", since roles hold no bare one
    turns = F.transform(parts, lambda p: F.concat(unescape(F.substring_index(F.substr(p, F.lit(5)), "]", 1)), F.lit("\n"), unescape(F.substr(p, F.locate("]", p) + F.lit(2))), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    read = windows.select("conv_id", "window", F.size(parts).alias("n"), F.array_join(turns, "").alias("turns"), F.array_join(loss, "").alias("loss"), F.length("text").alias("chars"))
    row = F.sort_array(F.collect_list(F.struct("window", "turns", "loss")))
    read = read.groupBy("conv_id").agg(F.sum("n").cast("bigint").alias("n_turns"), row.alias("w"), F.sum("chars").cast("bigint").alias("formatted_chars"))
    whole = F.array_join(F.transform("w", lambda x: x["turns"]), "")
    loss = F.array_join(F.transform("w", lambda x: x["loss"]), "")
    return read.select("conv_id", "n_turns", F.sha2(whole, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
