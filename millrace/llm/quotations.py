"""Messages linked to what they quote, and conversations in the order of replies, without the quotes.

A line's quote level is the number of ``>`` before it.  Consecutive lines of one level, up to a blank one, form a passage.
The text of a level, its passages, their lines and their sentences are normalised (case, blanks) and hashed, quoted and
own ones alike, so wrapping is no matter and parts of a line are found.  For parts of sentences, runs of ``RUN`` words are
hashed and winnowed: quotes that share ``RUN + WINDOW - 1`` words in a row share one of them.  A quoted hash belongs to the latest message of the same conversation that is earlier and has the hash among its
own: found by one sort of each (conversation, hash), never by pairs.  A message answers the message that the words of its
lowest quoted level come from most, each word counted once; the later one of equals.  Parents are always earlier, so replies form trees; their
roots and depths come from pointer jumping.

Only DataFrame operations.  Nothing is gathered per conversation: the result is one row per message, whose order within
its conversation is (``root_turn``, ``depth``, ``turn``): each message after the one it answers.

Defined cases: a null text is empty; messages without conversation or turn are never linked and start a thread of their
own; repeated rows are repeated, with the same links; quotes of nothing known are removed from the text and not linked; a
line that announces a quote ("On ... wrote:") goes with it, what follows the mark of a forwarded message is one level of quotes
more, and the headers there are linked to nothing; a message of quotes only has an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialise
from .common import swept

_MARKS = r"^(?:[ \t]*>)+[ ]?"
_QUOTED = r"(?m)^[ \t]*>"
# Lines that mail programs put before what they quote or forward, and the headers of a forwarded message.
_WROTE = r"^[ \t]*On\b.{1,300}\bwrote:[ \t]*$"
_FORWARDED = r"^[ \t]*-{2,}[ \t]*(?:Original|Forwarded) [Mm]essage[ \t]*-{2,}[ \t]*$"
_HEADER = r"^[ \t]*(?:From|Sent|Date|To|Cc|Subject|Reply-To):"
RUN, WINDOW = 8, 4


def _normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _with_lines(messages: DataFrame) -> DataFrame:
    """``messages`` with ``lines`` of their ``body``: level, text behind the marks, normalised text, and whether the line
    only announces a quote.  The arrays are columns of their own, so that no line splits the text anew."""

    def line(x: Column, i: Column) -> Column:
        marks = F.regexp_extract(x, _MARKS, 0)
        body = F.regexp_replace(x, _MARKS, "")
        behind = (F.col("mark") > 0) & (i + 1 >= F.col("mark"))
        level = F.char_length(F.regexp_replace(marks, "[^>]", "")) + behind.cast("int")
        then, later = (F.coalesce(F.get("raw", i + k), F.lit("")) for k in (1, 2))
        quoted = then.rlike(_QUOTED) | ((F.trim(then) == "") & later.rlike(_QUOTED))
        note = (behind & ((i + 1 == F.col("mark")) | x.rlike(_HEADER))) | (~behind & x.rlike(_WROTE) & quoted)
        level = F.when(note, F.greatest(level, F.lit(1))).otherwise(level)
        return F.struct(level.alias("level"), body.alias("body"), F.when(note, "").otherwise(_normal(body)).alias("normal"), note.alias("note"))

    split = messages.withColumn("raw", F.split("body", "\r?\n", -1))
    marked = split.withColumn("mark", F.array_position(F.transform("raw", lambda x: x.rlike(_FORWARDED)), True).cast("int"))
    return marked.withColumn("lines", F.transform("raw", line)).drop("raw", "mark")


def _winnowed(words: Column) -> Column:
    """Hash and position of the runs of words that are least within some ``WINDOW`` of them."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - RUN),
        lambda i: F.struct(F.xxhash64(F.slice(words, i + 1, RUN)).alias("unit"), i.alias("from")),
    )
    windows = F.sequence(F.lit(0), F.greatest(F.size(words) - RUN + 1 - WINDOW, F.lit(0)))
    picks = F.transform(windows, lambda i: F.array_min(F.slice(runs, i + 1, WINDOW)))
    return F.when(F.size(words) >= RUN, F.array_distinct(picks))


def _units(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, level, unit (hash), from, to: the words of the level's text that each unit is; 0 for own units.
    ``lines``: keys, pos, level, normal."""
    ordered = Window.partitionBy(*keys).orderBy("pos")
    before = F.lag("level").over(ordered)
    blank_before = F.lag("normal").over(ordered) == ""
    starts = F.when(before.isNull() | (before != F.col("level")) | blank_before, 1).otherwise(0)
    runs = lines.withColumn("new", starts).withColumn("passage", F.sum("new").over(ordered))
    n = F.size(F.split("normal", " ")).cast("long")
    within = Window.partitionBy(*keys, "level").orderBy("pos")
    filled = runs.where("normal <> ''").withColumn("to", F.sum(n).over(within)).withColumn("from", F.col("to") - n)

    def joined(*by: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct("pos", "normal"))).alias("x")
        grouped = filled.groupBy(*keys, "level", *by).agg(parts, F.min("from").alias("from"), F.max("to").alias("to"))
        return grouped.withColumn("t", F.array_join(F.transform("x", lambda x: x["normal"]), " ")).drop("x")

    passages, whole = joined("passage"), joined()
    parts = passages.select(*keys, "level", "passage", "from", F.posexplode(F.split("t", r"(?<=[.!?])[ ]", -1)).alias("s", "t"))
    m = F.size(F.split("t", " ")).cast("long")
    end = F.sum(m).over(Window.partitionBy(*keys, "level", "passage").orderBy("s"))
    sentences = parts.withColumn("to", F.col("from") + end).withColumn("from", F.col("to") - m)
    texts = [d.select(*keys, "level", "t", "from", "to") for d in (whole, passages, sentences, filled.withColumnRenamed("normal", "t"))]
    every = texts[0]
    for d in texts[1:]:
        every = every.unionByName(d)
    every = every.select(*keys, "level", F.xxhash64("t", F.length("t")).alias("unit"), "from", "to")
    picked = whole.select(*keys, "level", F.explode(_winnowed(F.split("t", " "))).alias("p"))
    start = F.col("p.from").cast("long")
    every = every.unionByName(picked.select(*keys, "level", "p.unit", start.alias("from"), (start + RUN).alias("to")))
    place = [F.when(F.col("level") > 0, F.col(c)).otherwise(0).alias(c) for c in ("from", "to")]
    return every.select(*keys, "level", "unit", *place).distinct()


def link_quotations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text (without quotes), parent_turn, root_turn, depth, n_quoted_lines, formatted."""
    body = F.coalesce(F.col(text), F.lit(""))
    plain = messages.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        body.alias("body"),
        F.xxhash64(F.col(conv), F.col(turn), F.col(role), body, F.length(body)).alias("mid"),
    )
    with swept(messages.sparkSession):
        tree = _tree(plain)
    out = _with_lines(plain).join(tree, ["conv", "mid"], "left")
    unquoted = F.trim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n"))
    quoted = F.size(F.filter("lines", lambda x: (x["level"] > 0) & ~x["note"]))
    clean = F.regexp_replace(F.regexp_replace(unquoted, r"^\s+", ""), r"\s+$", "")
    out = out.withColumn("clean", F.when(quoted > 0, clean).otherwise(F.col("body")))
    return out.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "role",
        F.col("clean").alias("text"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        quoted.alias("n_quoted_lines"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("clean"), F.lit("\n<|end|>")).alias("formatted"),
    )


def _tree(plain: DataFrame) -> DataFrame:
    """conv, mid, parent_turn, root_turn, depth of the messages that answer one."""
    keys = ["conv", "turn", "mid"]
    linkable = plain.where("conv IS NOT NULL AND turn IS NOT NULL").select(*keys, "body")
    # Conversations in which somebody quotes, written first: a small number of them needs no shuffle of the texts.
    quotes = F.col("body").rlike(_QUOTED) | F.col("body").rlike("(?m)" + _FORWARDED)
    quoting = materialise(linkable.where(quotes).select("conv").distinct(), label="quoting")
    active = _with_lines(linkable.join(quoting, "conv", "left_semi"))
    lines = active.select(*keys, F.posexplode("lines").alias("pos", "line")).select(*keys, "pos", "line.level", "line.normal")
    # Repeats of a message go here; only lines of quoting conversations are shuffled, once.
    lines = materialise(lines.distinct(), label="lines")
    units = materialise(_units(lines, keys), label="units")
    discard(lines)

    # Per conversation and hash, in the order of turns: the latest earlier message that has it among its own.  Own units
    # of a turn sort behind the quotes of the same turn.
    own = F.col("level") == 0
    when = Window.partitionBy("conv", "unit").orderBy("turn", own.cast("int"), "mid").rowsBetween(Window.unboundedPreceding, -1)
    source = F.last(F.when(own, F.struct("turn", "mid")), ignorenulls=True).over(when)
    matched = units.withColumn("source", source).where("level > 0 AND source IS NOT NULL")
    # Units overlap: a word counts once.
    along = Window.partitionBy("conv", "mid", "level", "source").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("to").over(along), F.lit(0))
    matched = matched.withColumn("fresh", F.greatest(F.col("to") - F.greatest("from", reach), F.lit(0)))
    votes = matched.groupBy("conv", "mid", "level", "source").agg(F.sum("fresh").alias("weight"))
    best = F.max(F.struct(-F.col("level"), F.col("weight"), F.col("source"))).alias("best")
    parents = votes.groupBy("conv", "mid").agg(best)
    parents = parents.select("conv", "mid", F.col("best.source.turn").alias("parent_turn"), F.col("best.source.mid").alias("up"))
    parents = materialise(parents, label="parents")

    # Pointer jumping: every link is doubled until it ends at a root.
    jumps = parents.select("conv", "mid", "up", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth"))
    while True:
        further = jumps.select("conv", F.col("mid").alias("up"), F.col("up").alias("up2"), F.col("root_turn").alias("turn2"), F.col("depth").alias("depth2"))
        longer = jumps.join(further, ["conv", "up"], "left")
        jumped = materialise(
            longer.select(
                "conv",
                "mid",
                F.coalesce("up2", "up").alias("up"),
                F.coalesce("turn2", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
                F.col("up2").isNotNull().alias("moved"),
            ),
            label="jumps",
        )
        jumps = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            break

    return parents.drop("up").join(jumps.drop("up"), ["conv", "mid"])
