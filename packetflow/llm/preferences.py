"""Preference pairs of conversations: one prompt, and two completions with loss masks.

Columns and joins only, no Python in tasks. The turns of both conversations of a pair are laid side
by side under ``(pair, turn)``, so a pair of any length is spread over tasks; the first turn that
differs is a minimum, which Spark aggregates before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetflow.operators.ranking import number_within
from packetflow.session import work_dir

#: What stands around a turn.
HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"


def whole_turns(turns: DataFrame, key: str) -> DataFrame:
    """``key, turn, role, text`` with one row for each turn.

    Of rows that repeat a turn the smallest role and text count; a null role or text is an empty
    one; rows without a key or a turn belong to no conversation.
    """
    said = F.struct(
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return (
        turns.select(F.col(key).alias(key), "turn", said.alias("said"))
        .filter(F.col(key).isNotNull() & F.col("turn").isNotNull())
        .groupBy(key, "turn").agg(F.min("said").alias("said"))
        .select(key, "turn", "said.role", "said.text")
    )


def preference_segments(
    chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant", unique: bool = False
) -> DataFrame:
    """Both sides as rendered turns.

    Columns: ``pair_id, part, turn, role, rendered, trained_from, prompt_end``.
    ``chosen`` and ``rejected`` have ``pair_id, turn, role, text``. Turns are aligned by number.
    Those before the first that differs (in role, text, or by being absent on one side) are the
    ``prompt`` and come once; the others are the completions ``chosen`` and ``rejected``. In turns
    of ``trained_role`` in a completion the loss counts from character ``trained_from`` of
    ``rendered`` to its end; null: it does not count. ``prompt_end`` is the first turn that
    differs, null if none does. A pair with one side only has no preference and no rows. Repeated
    turns, nulls: see :func:`whole_turns`; ``unique`` says that both sides come from there.

    Turns are compared by digest, so texts are moved once for each side, to meet the end of the
    prompt of their pair.
    """
    if not unique:
        chosen, rejected = (whole_turns(side, "pair_id") for side in (chosen, rejected))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.unhex(F.sha2(said, 256))

    def of_side(number: int) -> Column:
        return F.min(F.when(F.col("side") == number, F.col("digest")))

    sides = [
        side.select("pair_id", "turn", digest.alias("digest"), F.lit(number).alias("side"))
        for number, side in enumerate((chosen, rejected))
    ]
    laid = (
        sides[0].unionByName(sides[1]).groupBy("pair_id", "turn")
        .agg(of_side(0).alias("chosen"), of_side(1).alias("rejected"))
    )
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    ends = (
        laid.groupBy("pair_id")
        .agg(
            F.min(F.when(differs, F.col("turn"))).alias("prompt_end"),
            F.count("chosen").alias("__chosen"), F.count("rejected").alias("__rejected"),
        )
        .filter("__chosen > 0 AND __rejected > 0").drop("__chosen", "__rejected")
    )
    after = F.coalesce(F.col("turn") >= F.col("prompt_end"), F.lit(False))
    part = F.when(after, "chosen").otherwise("prompt")
    others = rejected.join(ends, "pair_id").filter(after)
    parts = (
        chosen.join(ends, "pair_id").withColumn("part", part)
        .unionByName(others.withColumn("part", F.lit("rejected")))
    )
    head = F.concat(F.lit(HEAD), F.col("role"), F.lit("\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return parts.select(
        "pair_id", "part", "turn", "role",
        F.concat(head, F.col("text"), F.lit(TAIL)).alias("rendered"),
        F.when(trained, F.length(head)).cast("long").alias("trained_from"),
        "prompt_end",
    )


def preference_rows(segments: DataFrame) -> DataFrame:
    """One row for each pair: ``prompt``, ``chosen``, ``rejected`` and the spans that are trained.

    Spans are ``(start, end)`` in characters of the completion. A row holds a whole conversation,
    which is one training example, and nothing larger.
    """
    held = F.array_sort(F.collect_list(F.struct("turn", "rendered", "trained_from")))
    parts = segments.groupBy("pair_id", "part").agg(held.alias("turns"))
    empty = F.lit("")

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda t: t["rendered"]), "")

    def spans(turns: Column) -> Column:
        start = F.struct(
            F.lit(0).cast("long").alias("at"),
            F.expr("cast(array() AS array<struct<start: bigint, end: bigint>>)").alias("spans"),
        )

        def add(done: Column, turn: Column) -> Column:
            end = done["at"] + F.length(turn["rendered"])
            own = F.struct((done["at"] + turn["trained_from"]).alias("start"), end.alias("end"))
            more = F.when(turn["trained_from"].isNull(), done["spans"]).otherwise(
                F.concat(done["spans"], F.array(own))
            )
            return F.struct(end.alias("at"), more.alias("spans"))

        return F.aggregate(turns, start, add, lambda done: done["spans"])

    def one(part: str, value: Column) -> Column:
        return F.max(F.when(F.col("part") == part, value))

    rows = parts.select(
        "pair_id", "part", text(F.col("turns")).alias("text"), spans(F.col("turns")).alias("spans")
    )
    sides = ("chosen", "rejected")
    none = F.expr("cast(array() AS array<struct<start: bigint, end: bigint>>)")
    return rows.groupBy("pair_id").agg(
        *[F.coalesce(one(p, F.col("text")), empty).alias(p) for p in ("prompt", *sides)],
        *[F.coalesce(one(p, F.col("spans")), none).alias(f"{p}_spans") for p in sides],
    )


def _partners(turns: DataFrame) -> DataFrame:
    """``pair_id, conv_id``: each conversation with a reply, and the next such one by id."""
    replied = turns.filter("role = 'assistant'").select("conv_id").distinct()
    ranked = number_within(replied, [], "conv_id", "rank")
    total = F.broadcast(ranked.agg(F.max("rank").alias("total")))
    following = (F.col("rank") % F.col("total") + 1).alias("rank")
    nexts = (
        ranked.crossJoin(total).filter("total > 1")
        .select(F.col("conv_id").alias("pair_id"), following)
    )
    return nexts.join(ranked, "rank").select("pair_id", "conv_id")


def ranked_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs out of plain conversations: each that has a reply against the next one.

    Conversations with an assistant turn are ranked by id, and the last is followed by the first, so
    each is chosen once and rejected once, whatever ids are missing. Both sides are whole: all their
    own turns, in their own roles and number. One conversation alone has no pair.
    """
    turns = whole_turns(conversations, "conv_id")
    partners = _partners(turns)
    own = F.col("conv_id").alias("pair_id")
    return (
        turns.join(partners.select(F.col("pair_id").alias("conv_id")), "conv_id")
        .select(own, "turn", "role", "text"),
        turns.join(partners, "conv_id").select("pair_id", "turn", "role", "text"),
    )


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """:func:`preference_rows` of :func:`ranked_pairs`: completions of both sides with spans."""
    return preference_rows(preference_segments(*ranked_pairs(conversations), unique=True))


#: Turn numbers of one conversation whose lengths are added up in one step.
STEP_TURNS = 4096


def _with_starts(placed: DataFrame, step: int) -> DataFrame:
    """Add ``start``: the characters of the part before a turn.

    A conversation may hold any share of the rows, so it is cut at every ``step`` turn numbers: sums
    of the pieces are partial aggregates, a running sum over them and one within each give the rest.
    """
    group = ["pair_id", "part"]
    cut = placed.withColumn("__piece", F.floor(F.col("turn") / step))
    earlier = Window.partitionBy(*group).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    pieces = (
        cut.groupBy(*group, "__piece").agg(F.sum("size").alias("__size"))
        .withColumn("__base", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
        .drop("__size")
    )
    within = Window.partitionBy(*group, "__piece").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1
    )
    own = F.coalesce(F.sum("size").over(within), F.lit(0))
    return (
        cut.join(pieces, [*group, "__piece"])
        .withColumn("start", F.col("__base") + own)
        .drop("__piece", "__base")
    )


def preference_pieces(
    conversations: DataFrame, trained_role: str = "assistant", step: int = STEP_TURNS
) -> DataFrame:
    """The paired completions of :func:`ranked_pairs`, turn by turn, with masks in characters.

    Columns: ``pair_id, other_id, part, turn, role, rendered, start, trained_start, trained_end,
    prompt_end``. A pair sets a conversation that has a reply (``pair_id``, chosen) against the next
    one by id (``other_id``, rejected). The turns both begin with are the ``prompt``, which comes
    once; from ``prompt_end``, the first turn that differs, the rest of each is its completion. The
    text of a part is its ``rendered`` turns in order; a turn begins at ``start`` there, and the loss
    counts from ``trained_start`` to ``trained_end``, null where it does not count. So pairs of
    conversations of any length are whole, and spread over tasks. Nulls and repeated turns: see
    :func:`whole_turns`; one conversation alone, or an empty table, has no pair.

    The deduplicated turns are written once; prompts, places and masks are found on digests and
    lengths, and texts are moved once for each side, dealt out by conversation and turn.
    """
    spark = conversations.sparkSession
    folder = work_dir(spark, "preferences")
    found = whole_turns(conversations, "conv_id")
    found.write.parquet(folder)
    turns = spark.read.schema(found.schema).parquet(folder)
    partners = _partners(turns).checkpoint()
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    head = F.concat(F.lit(HEAD), F.col("role"), F.lit("\n"))
    trained = F.when(F.col("role") == trained_role, F.length(head))
    narrow = turns.select(
        "conv_id", "turn",
        F.struct(
            F.unhex(F.sha2(said, 256)).alias("digest"),
            (F.length(head) + F.length("text") + len(TAIL)).cast("long").alias("size"),
            trained.cast("long").alias("from"),
        ).alias("one"),
    )
    own = partners.select("pair_id", F.col("conv_id").alias("other_id"))
    sides = [
        narrow.join(own.withColumn("conv_id", F.col(key)), "conv_id")
        .select("pair_id", "other_id", "turn", "one", F.lit(number).alias("side"))
        for number, key in enumerate(("pair_id", "other_id"))
    ]

    def of_side(number: int) -> Column:
        return F.min(F.when(F.col("side") == number, F.col("one")))

    laid = (
        sides[0].unionByName(sides[1]).groupBy("pair_id", "other_id", "turn")
        .agg(of_side(0).alias("chosen"), of_side(1).alias("rejected"))
        .checkpoint()
    )
    differs = ~F.col("chosen.digest").eqNullSafe(F.col("rejected.digest"))
    ends = laid.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("prompt_end"))
    after = F.coalesce(F.col("turn") >= F.col("prompt_end"), F.lit(False))

    def part(name: str, one: str) -> Column:
        return F.struct(
            F.lit(name).alias("part"), F.col(f"{one}.size").alias("size"),
            F.when(F.lit(name != "prompt"), F.col(f"{one}.from")).alias("from"),
        )

    parts = F.when(~after, F.array(part("prompt", "chosen"))).otherwise(
        F.array_compact(
            F.array(
                *[F.when(F.col(n).isNotNull(), part(n, n)) for n in ("chosen", "rejected")]
            )
        )
    )
    placed = laid.join(ends, "pair_id").select(
        "pair_id", "other_id", "turn", "prompt_end", F.inline(parts)
    )
    placed = _with_starts(placed, step)
    conversation = F.when(F.col("part") == "rejected", F.col("other_id")).otherwise(
        F.col("pair_id")
    )
    texts = turns.select("conv_id", "turn", "role", F.concat(head, "text", F.lit(TAIL)).alias("rendered"))
    return placed.withColumn("conv_id", conversation).join(texts, ["conv_id", "turn"]).select(
        "pair_id", "other_id", "part", "turn", "role", "rendered", "start",
        (F.col("start") + F.col("from")).alias("trained_start"),
        F.when(F.col("from").isNotNull(), F.col("start") + F.col("size")).alias("trained_end"),
        "prompt_end",
    )
