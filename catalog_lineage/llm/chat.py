"""Chat formatting (operator 4, native): turn-aligned windows of a token budget, with the loss mask on each reply once.

A turn is written as <|im_start|>role\\ntext<|im_end|>\\n. Inside a text, a backslash is put into every `<|`, `<\\|`, `<\\\\|` ..., so no
control string is left and taking one away gives the text back; roles escape %, < and line breaks as %25, %3C and %0A.

Turns are numbered in order; prefix sums of their tokens (words plus OVERHEAD) choose the windows: a window takes turns while they fit
BUDGET less the system turn and the repeated history, one turn at least, and no turn is ever split. Every window but the first begins
with the conversation's system turn, if its first turn is one, and the turns right before it that fit HISTORY tokens. The loss covers
the texts of assistant turns where they are new; repeated ones are masked.

Where windows open depends on all turns before, so the prefix sums of a conversation, eight bytes for each turn, meet in one row. Its
texts never do: the opening places join the turns as marks, every turn is sent to its window and to those whose history it belongs to,
and a window holds at most BUDGET / OVERHEAD turns besides the system turn, whatever the length of the conversation.

Defined results: turns go by turn number (null first), then role, then text; null texts and roles are empty; rows without a
conversation id are one conversation; repeated rows are turns each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from catalog_lineage.llm.common import WORD_PATTERN, table, text_or_empty

BUDGET, HISTORY, OVERHEAD = 512, 64, 4
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<\\$1|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<\\(\\*)\|"), F.lit("<$1|"))


def escape_role(role: Column) -> Column:
    for plain, coded in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def opening_turns(summed: DataFrame, budget: int, history: int) -> DataFrame:
    """conv_id, n, opens: the turns at which windows open and the tokens before them, from summed(conv_id, upto, kept)."""
    sums = summed.groupBy("conv_id").agg(F.array_sort(F.collect_list("upto")).alias("sums"), F.max("kept.tokens").alias("kept"))
    room = F.lit(budget - history).cast("long") - F.coalesce("kept", F.lit(0).cast("long"))
    nothing = F.array().cast("array<struct<n:int,opens:bigint>>")
    zero = F.lit(0).cast("long")

    def pack(state: Column, upto: Column) -> Column:
        opens = (state["n"] == 0) | (upto - state["begin"] > state["room"])
        mark = F.struct((state["n"] + 1).alias("n"), state["upto"].alias("opens"))
        return F.struct(
            F.when(opens, F.concat(state["marks"], F.array(mark))).otherwise(state["marks"]).alias("marks"),
            F.when(opens, state["upto"]).otherwise(state["begin"]).alias("begin"), upto.alias("upto"), (state["n"] + 1).alias("n"), state["room"].alias("room"),
        )

    start = F.struct(nothing.alias("marks"), zero.alias("begin"), zero.alias("upto"), F.lit(0).alias("n"), room.alias("room"))
    return sums.select("conv_id", F.inline(F.aggregate("sums", start, pack, lambda s: s["marks"])))


def chat_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window (their order), formatted, repeated (turns at its start that an earlier window has as new), tokens, loss (array of
    start and end code point, end exclusive). One shuffle, by conversation, which the prefix sums read again."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), text_or_empty()
    in_order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("n", F.row_number().over(in_order))
    head, body = escape_role(F.col("role")), escape(F.col("text"))
    pieces = numbered.select(
        "conv_id", "n", (F.regexp_count("text", F.lit(WORD_PATTERN)) + OVERHEAD).cast("long").alias("tokens"),
        F.concat(F.lit(START), head, F.lit("\n"), body, F.lit(END)).alias("piece"),
        (F.char_length(head) + len(START) + 1).alias("lead"), F.char_length(body).alias("length"),
        (F.col("role") == "assistant").alias("target"), ((F.col("n") == 1) & (F.col("role") == "system")).alias("system"),
    )
    by_turn = W.partitionBy("conv_id").orderBy("n")
    so_far = by_turn.rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = pieces.withColumns({
        "upto": F.sum("tokens").over(so_far), "kept": F.first(F.when(F.col("system"), F.struct("piece", "tokens"))).over(so_far),
    })
    marked = summed.unionByName(opening_turns(summed, budget, history), allowMissingColumns=True)
    # A mark has the number of the turn that it opens a window at; equal numbers are peers of a range frame.
    placed = marked.withColumns({
        "window": F.count("opens").over(by_turn.rangeBetween(W.unboundedPreceding, W.currentRow)) - 1,
        "later": F.collect_list("opens").over(by_turn.rangeBetween(1, max(1, history // OVERHEAD))),
    }).where("opens is null")
    repeats = F.filter("later", lambda opens: (opens - F.col("upto") + F.col("tokens") <= history) & ~F.col("system"))
    own = F.array(F.struct("window", F.lit(True).alias("new")))
    again = F.transform(repeats, lambda _, i: F.struct((F.col("window") + i + 1).alias("window"), F.lit(False).alias("new")))
    turn = F.struct("n", "new", "tokens", "piece", "lead", "length", "target")
    sent = placed.select("*", F.inline(F.concat(own, again)).alias("in_window", "new")).drop("window")
    grouped = sent.groupBy("conv_id", F.col("in_window").alias("window")).agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.first("kept").alias("kept"))
    made = grouped.withColumn("front", F.when(F.col("window") > 0, F.col("kept")))

    def mark(state: Column, t: Column) -> Column:
        begin = state["at"] + t["lead"]
        return F.struct(
            (state["at"] + F.char_length(t["piece"])).alias("at"),
            F.when(t["target"] & t["new"], F.concat(state["loss"], F.array(F.struct(begin.alias("start"), (begin + t["length"]).alias("end"))))).otherwise(state["loss"]).alias("loss"),
        )

    piece = F.coalesce("front.piece", F.lit(""))
    zero = F.struct(F.char_length(piece).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    return made.select(
        "conv_id", F.col("window").cast("int").alias("window"),
        F.concat(piece, F.array_join(F.transform("turns", lambda t: t["piece"]), "")).alias("formatted"),
        (F.size(F.filter("turns", lambda t: ~t["new"])) + F.when(F.col("front").isNotNull(), 1).otherwise(0)).alias("repeated"),
        (F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t["tokens"]) + F.coalesce("front.tokens", F.lit(0).cast("long"))).alias("tokens"),
        F.aggregate("turns", zero, mark, lambda s: s["loss"]).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Adds turns (role and text of the new turns) and targets (unescaped texts under the loss mask), read from the formatted text."""
    cut_up = F.split("formatted", r"<\|im_start\|>")
    parts = F.slice(cut_up, F.col("repeated") + 2, F.size(cut_up))

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.char_length(head) + 2, F.char_length(part) - F.char_length(head) - 1 - len(END))
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    targets = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"])))
    return windows.withColumn("turns", F.transform(parts, turn)).withColumn("targets", targets)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = f"<|im_end|>{START}assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = read_back(chat_windows(turns))
    digest = read.select(
        "conv_id", F.struct(
            "window", F.size("turns").alias("n"), F.char_length("formatted").alias("chars"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), F.array_join("targets", "").alias("loss"),
        ).alias("w"),
    )
    # One row per conversation, as the contract digests it whole.
    windows = digest.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda field: F.array_join(F.transform("w", lambda w: w[field]), "")
    summed = lambda field: F.aggregate("w", F.lit(0).cast("long"), lambda s, w: s + w[field])
    return windows.select(
        "conv_id", summed("n").alias("n_turns"), F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), summed("chars").alias("formatted_chars"),
    )


#: The windows' starts by recursion.
ORACLES = {
    "op4_chat_format": rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), counted AS (
  SELECT *, row_number() OVER w AS n, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {OVERHEAD} AS tokens,
    length('{START}' || replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A')) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + {len(END)} AS chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), turns AS MATERIALIZED (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) AS upto, sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) - tokens AS before FROM counted
), kept AS MATERIALIZED (
  SELECT conv_id, coalesce(sum(tokens) FILTER (n = 1 AND role = 'system'), 0) AS kept_tokens, coalesce(sum(chars) FILTER (n = 1 AND role = 'system'), 0) AS kept_chars FROM turns GROUP BY conv_id
), starts AS (
  SELECT conv_id, 1::BIGINT AS first FROM kept
  UNION ALL
  SELECT conv_id, next FROM (
    SELECT s.conv_id, (SELECT min(t.n) FROM turns t, turns b, kept k WHERE t.conv_id = s.conv_id AND b.conv_id = s.conv_id AND k.conv_id = s.conv_id AND b.n = s.first AND t.n > s.first
      AND t.upto - b.before > {BUDGET - HISTORY} - k.kept_tokens) AS next FROM starts s
  ) WHERE next IS NOT NULL
), again AS (
  SELECT s.conv_id, sum(k.kept_chars + coalesce((SELECT sum(t.chars) FROM turns t, turns b WHERE t.conv_id = s.conv_id AND b.conv_id = s.conv_id AND b.n = s.first AND t.n < s.first
      AND b.before - t.before <= {HISTORY} AND NOT (t.n = 1 AND t.role = 'system')), 0)) AS chars
  FROM starts s JOIN kept k ON k.conv_id = s.conv_id WHERE s.first > 1 GROUP BY s.conv_id
)
SELECT t.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256, (sum(t.chars) + coalesce(any_value(a.chars), 0))::BIGINT AS formatted_chars
FROM turns t LEFT JOIN again a ON a.conv_id = t.conv_id GROUP BY t.conv_id
""",
}
