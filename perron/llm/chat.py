"""Chat formatting with budgeted windows.

A conversation's turns are written with a template and dealt into windows of at most ``budget`` tokens (a single
longer turn keeps a window of its own, without context). A token is estimated as four UTF-8 bytes. Windows are cut at
turns by prefix sums of turn tokens. Each window repeats the system turn and up to ``history`` tokens of the turns before
it, where they fit; what is repeated is context and is masked from the loss, so each assistant text is a target once. Only DataFrame functions are used.

Template: ``### role: text</turn>``, one turn a line. Control strings in roles and texts are escaped reversibly with a
backslash, so none of them ever occurs unescaped in a text: backslash as ``\\b``, ``###`` as ``\\h``, ``</turn>`` as
``\\t``, and in roles a colon as ``\\c`` and a line feed as ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")]
ROLE_ESCAPES = [(":", "\\c"), ("\n", "\\n")]
BUDGET, HISTORY = 2048, 256
#: Turns in a block of the two-level prefix sum.
BLOCK = 512


def _replace_all(col: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def escape(col: Column, role: bool = False) -> Column:
    return _replace_all(col, ESCAPES + (ROLE_ESCAPES if role else []))


def unescape(col: Column, role: bool = False) -> Column:
    pairs = [(b, a) for a, b in (ROLE_ESCAPES if role else [])] + [(b, a) for a, b in ESCAPES[::-1]]
    return _replace_all(col, pairs)


def estimate_tokens(text: Column) -> Column:
    """Four UTF-8 bytes a token, rounded up, and the template's own."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + 6


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window (rising, with gaps), text, loss array<struct<start, end>> (code points of text, end exclusive), n_context
    (leading turns that repeat others), n_turns (all turns of the window), n_tokens.

    ``turns``: conv_id, turn, role, text; further columns are ignored. Turns are ordered by turn (null first), role and
    text; rows that repeat are turns too. Rows with a null conv_id are one conversation. A conversation's null turns lie in
    one block of the prefix sum. The system turn is not repeated where it would leave ``history`` tokens or less beside the
    history, nor beside a single turn that leaves no room for it. Null roles and texts count as empty. The system turn is a conversation's first
    turn if its role is system. An empty table has no windows.
    """
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.select("*", F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit(SEP)).alias("head"), escape(F.col("text")).alias("body"))
    t = t.withColumn("tokens", estimate_tokens(F.concat("head", "body")))
    t = t.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
    # prefix sums in two levels: in blocks of turns, then over the blocks of a conversation
    in_block = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("k", F.row_number().over(in_block).cast("long")).withColumn("lead", F.coalesce(F.sum("tokens").over(before), F.lit(0))))
    over = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (t.groupBy("conv_id", "block").agg(F.sum("tokens").alias("s"), F.count("*").alias("c"))
            .select("conv_id", "block", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("s0"), F.coalesce(F.sum("c").over(over), F.lit(0)).alias("c0")))
    t = t.join(sums.select(F.col("conv_id").alias("cid"), F.col("block").alias("blk"), "s0", "c0"), F.col("conv_id").eqNullSafe(F.col("cid")) & (F.col("block") == F.col("blk")))
    t = t.select("conv_id", (F.col("c0") + F.col("k") - 1).alias("i"), "role", "head", "body", "tokens", (F.col("s0") + F.col("lead")).alias("at"))

    system = t.where("i = 0 and role = 'system'").select(F.col("conv_id").alias("sid"), F.lit(True).alias("has"), F.col("tokens").alias("stokens"), F.struct("head", "body", "tokens").alias("sys"))
    t = t.join(system, F.col("conv_id").eqNullSafe(F.col("sid")), "left").drop("sid")
    # a window holds the turns that start in its stretch of the prefix sum; one that would run over the end, or over the
    # room beside a long system turn, stands alone
    # a system turn that leaves no more than that much room is not repeated
    beside = F.when(F.col("stokens") <= budget - 2 * history, F.col("stokens"))
    room = F.greatest(F.lit(budget - history) - F.coalesce(beside, F.lit(0)), F.lit(history))
    t = t.withColumn("sys", F.when(beside.isNotNull(), F.col("sys")))
    t = t.withColumn("room", room).withColumn("slot", F.floor(F.col("at") / F.col("room")))
    t = t.withColumn("over", (F.floor((F.col("at") + F.col("tokens") - 1) / F.col("room")) > F.col("slot")).cast("int"))
    # history: a turn may be context of the windows after its own that begin within ``history`` tokens from its start;
    # as a stretch is no shorter than that, they lie in its own stretch or in the next
    to = lambda slot, over, context: F.struct(slot.alias("slot"), F.lit(over).alias("over") if isinstance(over, int) else over.alias("over"), F.lit(context).alias("context"))
    own, after = to(F.col("slot"), F.col("over"), 0), F.col("slot") + 1
    later = F.filter(F.array(to(F.col("slot"), 1, 1), to(after, 0, 1), to(after, 1, 1)), lambda x: (
        ((x["slot"] > F.col("slot")) | (x["over"] > F.col("over"))) & ~((F.col("i") == 0) & F.coalesce("has", F.lit(False))) & (F.col("tokens") <= history)))
    dealt = t.select("conv_id", "i", "role", "head", "body", "tokens", "at", "sys", F.explode(F.concat(F.array(own), later)).alias("to"))
    dealt = dealt.select("conv_id", F.col("to.slot").alias("slot"), F.col("to.over").alias("over"), F.col("to.context").alias("context"), "i", "role", "head", "body", "tokens", "at", "sys")
    # where a window's own turns begin; context must end within ``history`` tokens before
    member = Window.partitionBy("conv_id", "slot", "over")
    dealt = dealt.withColumn("begin", F.min(F.when(F.col("context") == 0, F.col("at"))).over(member))
    dealt = dealt.where((F.col("context") == 0) | ((F.col("at") < F.col("begin")) & (F.col("begin") - F.col("at") <= history)))

    turn = F.struct("i", "context", "role", "head", "body", "tokens")
    w = dealt.groupBy("conv_id", "slot", "over").agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.min("begin").alias("begin"), F.first("sys", True).alias("sys"))
    # what is repeated has to fit beside the window's own turns: first the system turn, then the history
    count = lambda context: F.aggregate(F.filter("turns", lambda x: x["context"] == context), F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    w = w.withColumn("own", count(0)).withColumn("past", count(1))
    has_system = F.col("sys").isNotNull() & (F.col("begin") > 0) & (F.col("own") + F.col("sys.tokens") <= budget)
    has_past = F.col("own") + F.col("past") + F.when(has_system, F.col("sys.tokens")).otherwise(0) <= budget
    w = w.withColumn("turns", F.when(has_past, F.col("turns")).otherwise(F.filter("turns", lambda x: x["context"] == 0)))
    sys_turn = F.struct(F.lit(-1).cast("long").alias("i"), F.lit(1).alias("context"), F.lit("system").alias("role"), F.col("sys.head").alias("head"), F.col("sys.body").alias("body"), F.col("sys.tokens").alias("tokens"))
    w = w.withColumn("turns", F.when(has_system, F.concat(F.array(sys_turn), F.col("turns"))).otherwise(F.col("turns")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("loss"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        target = (x["role"] == "assistant") & (x["context"] == 0)
        return F.struct((end + len(CLOSE)).alias("at"), F.when(target, F.concat(a["loss"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(a["loss"]).alias("loss"))

    text = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    return w.select("conv_id", (F.col("slot") * 2 + F.col("over")).cast("long").alias("window"), text.alias("text"), F.aggregate("turns", start, step)["loss"].alias("loss"),
                    F.size(F.filter("turns", lambda x: x["context"] == 1)).alias("n_context"), F.size("turns").alias("n_turns"),
                    F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("n_tokens"))


def parse_turns(window: Column) -> Column:
    """The (role, text) turns of a formatted window, unescaped."""
    pieces = F.split(window, F.lit("</turn>\n"), -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), SEP, 1), True).alias("role"),
        unescape(F.substring(p, F.locate(SEP, p) + F.lit(len(SEP)), F.lit(2**31 - 1))).alias("text")))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, from :func:`format_windows` alone.

    The digests are of whole conversations, so one conversation's output meets in one row here, and only here.
    """
    own = F.slice(parse_turns(F.col("text")), F.col("n_context") + 1, F.col("n_turns"))
    lines = F.array_join(F.transform(own, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    parts = windows.select("conv_id", "window", F.size(own).cast("long").alias("n"), lines.alias("lines"), loss.alias("loss_text"), F.length("text").cast("long").alias("chars"))
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "lines", "loss_text"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    joined = lambda f: F.array_join(F.transform("w", lambda x: x[f]), "")
    return whole.select("conv_id", "n_turns", F.sha2(joined("lines"), 256).alias("turns_sha256"), F.length(joined("loss_text")).cast("long").alias("loss_chars"), F.sha2(joined("loss_text"), 256).alias("loss_sha256"), "formatted_chars")
