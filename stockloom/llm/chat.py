"""Chat formatting: a finite-state machine checks the order of roles, a declarative template writes the turns.

Everything on the main path is built from Spark's own functions. A formatted conversation is an array of segments, each
with a loss flag; the joined segments are the text. Control strings of the template that stand inside a message are
escaped by one more backslash, which :func:`read_back` takes away again, so a message can never open or close a turn.

Defined results: turns are ordered by (turn, role, text), nulls first, so ties and repeated rows are turns of their own
in a fixed order; a null role or text counts as empty; rows with a null conversation id form one conversation with that
id; conversations that break the turn order are formatted all the same and marked ``valid = false`` with the first
offending turn; an empty table gives an empty result; columns other than the four named ones are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

START, DEAD = "start", "dead"


@dataclass(frozen=True)
class ChatTemplate:
    """What a turn of each role is wrapped in, which roles are learned, and which role may follow in which state.

    ``roles`` maps a role to its opening and closing control string; ``other`` wraps any other role, whose name is then
    written between ``other[0]`` and ``other[1]``. ``moves`` maps (state, role) to the next state.
    """

    roles: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str, str] = ("[TURN]", "[AS]", "[/TURN]")
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            (START, "system"): "briefed",
            (START, "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("asked", "answered")

    def controls(self) -> list[str]:
        return [c for pair in self.roles.values() for c in pair] + list(self.other)


def _any_of(strings: list[str]) -> str:
    return "|".join(re.escape(s) for s in sorted(strings, key=len, reverse=True))


def escape(text: Column, template: ChatTemplate) -> Column:
    """Put one more backslash before each control string and the backslashes it already has."""
    return F.regexp_replace(text, rf"(\\*(?:{_any_of(template.controls())}))", r"\\$1")


def unescape(text: Column, template: ChatTemplate) -> Column:
    return F.regexp_replace(text, rf"\\(\\*(?:{_any_of(template.controls())}))", "$1")


def _lookup(pairs: dict[str, str], key: Column, otherwise: Column) -> Column:
    out = otherwise
    for name, value in pairs.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def _step(template: ChatTemplate, state: Column, role: Column) -> Column:
    out = F.lit(DEAD)
    for (source, name), target in template.moves.items():
        out = F.when((state == source) & (role == name), F.lit(target)).otherwise(out)
    return out


def format_conversations(rows: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, bad_turn (position from 0, or null), segments.

    ``segments`` is an array of (text, loss). Only the message of a learned role carries the flag; control strings and
    the blanks beside them never do. A conversation is the unit of output, so its turns meet in one row.
    """
    template = template or ChatTemplate()
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def advance(acc: Column, row: Column) -> Column:
        state = _step(template, acc["state"], row["role"])
        bad = F.when(acc["bad"].isNull() & (state == DEAD), acc["at"]).otherwise(acc["bad"])
        return F.struct(state.alias("state"), (acc["at"] + 1).alias("at"), bad.alias("bad"))

    first = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    turns = turns.withColumn("run", F.aggregate("turns", first, advance))

    def pieces(row: Column) -> Column:
        opening = _lookup({r: o for r, (o, _) in template.roles.items()}, row["role"], F.lit(None))
        named = F.concat(F.lit(template.other[0] + " "), escape(row["role"], template), F.lit(" " + template.other[1]))
        closing = _lookup({r: c for r, (_, c) in template.roles.items()}, row["role"], F.lit(template.other[2]))
        learned = row["role"].isin(list(template.learned))
        return F.array(
            F.struct(F.concat(F.coalesce(opening, named), F.lit(" ")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(row["text"], template).alias("text"), learned.alias("loss")),
            F.struct(F.concat(F.lit(" "), closing).alias("text"), F.lit(False).alias("loss")),
        )

    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        (F.col("run.bad").isNull() & F.col("run.state").isin(list(template.accepting))).alias("valid"),
        F.col("run.bad").alias("bad_turn"),
        F.flatten(F.transform("turns", pieces)).alias("segments"),
    )


def segment_rows(formatted: DataFrame) -> DataFrame:
    """The long form: conv_id, segment (from 0), text, loss."""
    return formatted.select("conv_id", F.posexplode("segments").alias("segment", "s")).select(
        "conv_id", "segment", "s.text", "s.loss"
    )


def joined_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(text: Column, template: ChatTemplate | None = None) -> Column:
    """The array of (role, text) that a formatted text holds."""
    template = template or ChatTemplate()
    open_role = f"{re.escape(template.other[0])} (?s:.*?) {re.escape(template.other[1])}"
    opening = f"(?:{_any_of([o for o, _ in template.roles.values()])}|{open_role})"
    closing = f"(?:{_any_of([c for _, c in template.roles.values()] + [template.other[2]])})"
    block = F.lit(rf"\G({opening}) ((?s:.*?)) {closing}")
    heads, bodies = F.regexp_extract_all(text, block, F.lit(1)), F.regexp_extract_all(text, block, F.lit(2))
    name = rf"^{re.escape(template.other[0])} (?s:(.*)) {re.escape(template.other[1])}$"

    def turn(head: Column, body: Column) -> Column:
        other = unescape(F.regexp_extract(head, name, 1), template)
        role = _lookup({o: r for r, (o, _) in template.roles.items()}, head, other)
        return F.struct(role.alias("role"), unescape(body, template).alias("text"))

    return F.zip_with(heads, bodies, turn)


def learned_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    template = template or ChatTemplate()
    kept = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return F.array_join(kept, "")


def op1_chat_format(spark, folder: str) -> DataFrame:
    """All conversations and the probe -1, read back from the formatted output."""
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    formatted = format_conversations(rows.unionByName(probe))
    out = formatted.select("conv_id", "valid", "segments", joined_text(F.col("segments")).alias("formatted"))
    out = out.withColumn("turns", read_back(F.col("formatted"))).withColumn("learned", learned_text(F.col("segments")))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


#: The same result from the rows themselves, with the template's strings and escapes spelled out.
OP1_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *,
    lag(role) over w as before,
    row_number() over w as n,
    length(regexp_replace(text, '(\\*(?:<</SYS>>|<<SYS>>|\[/INST\]|\[/TURN\]|\[INST\]|\[TURN\]|</s>|\[AS\]|<s>))', '\\\1', 'g')) as body,
    case role when 'system' then 17 when 'user' then 15 when 'assistant' then 9
      else 21 + length(regexp_replace(role, '(\\*(?:<</SYS>>|<<SYS>>|\[/INST\]|\[/TURN\]|\[INST\]|\[TURN\]|</s>|\[AS\]|<s>))', '\\\1', 'g')) end as frame
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(body + frame)::bigint as formatted_chars,
  bool_and(case when n = 1 then role in ('system', 'user') when role = 'assistant' then before = 'user'
                when role = 'user' then before in ('system', 'assistant') else false end)
    and max_by(role, n) <> 'system' as valid
from sized group by conv_id
"""
