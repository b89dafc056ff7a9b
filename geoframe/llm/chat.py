"""Chat formatting [native]: a finite-state machine over roles.

A ``Template`` declares how each role's turn opens and closes, which roles are
learned from, which role may follow which, and the control strings.  The turns
of a conversation become text segments, each with a loss flag; the formatted
text is the segments one after the other.  Control strings inside a text (and
the escape character itself) are escaped, so a text can be cut back into turns.

Cases: null texts and roles count as empty; turns are taken in the order of
``turn`` (nulls first), repeated turns in that of role and text, and all are
kept; a conversation whose roles break the machine is formatted all the same
and marked ``valid = false``; roles that the template does not name are opened
like any other and not learned from; an empty table gives an empty result.  A
conversation is one row of the result, so its own turns meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import query, table

ESCAPE = "%"


@dataclass(frozen=True)
class Template:
    """``open_`` + role + ``head`` + text + ``close`` per turn.  Control strings
    must not overlap themselves and must not hold the escape character."""
    open_: str = "<|im_start|>"
    head: str = "\n"
    close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>")
    learned: tuple[str, ...] = ("assistant",)
    #: state -> roles that may come next; the state is the last role
    moves: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)),
        ("assistant", ("user", "tool")), ("tool", ("assistant", "tool")))
    #: roles a conversation may end with
    last: tuple[str, ...] = ("assistant",)

    def codes(self) -> list[tuple[str, str]]:
        """What is replaced by what, in order: the escape character itself, the
        line end (in roles only it matters), then every control string's first
        character."""
        code = lambda c: f"{ESCAPE}{ord(c):02X}"
        return [(ESCAPE, code(ESCAPE))] + [(c, code(c[0]) + c[1:]) for c in self.controls]

    def escape(self, text: Column) -> Column:
        for a, b in self.codes():
            text = F.replace(text, F.lit(a), F.lit(b))
        return text

    def unescape(self, text: Column) -> Column:
        for a, b in reversed(self.codes()):
            text = F.replace(text, F.lit(b), F.lit(a))
        return text

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit(self.head), F.lit(f"{ESCAPE}{ord(self.head[0]):02X}"))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit(f"{ESCAPE}{ord(self.head[0]):02X}"), F.lit(self.head)))

    def allowed(self, before: Column, role: Column) -> Column:
        ok = F.lit(False)
        for state, roles in self.moves:
            ok = ok | ((before == state) & role.isin(*roles))
        return ok


CHATML = Template()


def format_chats(turns: DataFrame, template: Template = CHATML, conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, ``segments`` (array of text and loss
    flag), ``formatted``, ``valid`` and ``first_bad_turn`` (place from 0, null if
    all turns follow the machine; the number of turns if only the end is bad)."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = turns.groupBy(conv).agg(F.sort_array(F.collect_list(one)).alias("_c_turns"))
    df = df.withColumn("_c_roles", F.col("_c_turns.role"))

    def segments(t):
        learned = t["role"].isin(*template.learned)
        return F.array(
            F.struct(F.concat(F.lit(template.open_), template.escape_role(t["role"]), F.lit(template.head))
                     .alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escape(t["text"]).alias("text"), learned.alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))

    steps = F.zip_with(F.concat(F.array(F.lit("")), F.slice("_c_roles", 1, F.size("_c_roles") - 1)),
                       "_c_roles", template.allowed)
    bad = F.array_position(steps, False)
    end = F.element_at("_c_roles", -1).isin(*template.last)
    df = (df.withColumn("segments", F.flatten(F.transform("_c_turns", segments)))
          .withColumn("first_bad_turn", F.when(bad > 0, bad - 1)
                      .when(~end, F.size("_c_roles").cast("long"))))
    return df.select(conv, "segments", F.array_join("segments.text", "").alias("formatted"),
                     F.col("first_bad_turn").isNull().alias("valid"), "first_bad_turn")


def parse_chats(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """Adds ``turns`` (array of role and text), read back from ``formatted``."""
    body = F.split("formatted", r"\Q" + template.close + r"\E", -1)

    def turn(piece):
        inner = F.substring(piece, F.lit(len(template.open_) + 1), F.length(piece))
        at = F.instr(inner, template.head)
        return F.struct(template.unescape_role(F.substring(inner, F.lit(1), at - 1)).alias("role"),
                        template.unescape(F.substring(inner, at + F.lit(len(template.head)), F.length(inner)))
                        .alias("text"))

    return (chats.withColumn("_c_body", body)
            .withColumn("turns", F.transform(F.slice("_c_body", 1, F.size("_c_body") - 1), turn))
            .drop("_c_body"))


SQL_OP5 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(replace(replace(replace(text, '%', '%25'), '<|im_start|>', '%3C|im_start|>'),
                           '<|im_end|>', '%3C|im_end|>')) AS chars,
         lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS learned,
         CAST(sum(12 + length(role) + 1 + chars + 11) AS BIGINT) AS formatted_chars,
         bool_and((before = '' AND role IN ('system', 'user')) OR (before = 'system' AND role = 'user')
                  OR (before = 'user' AND role = 'assistant')
                  OR (before = 'assistant' AND role IN ('user', 'tool'))
                  OR (before = 'tool' AND role IN ('assistant', 'tool')))
           AND last(role ORDER BY turn NULLS FIRST, role, text) = 'assistant' AS valid
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars, valid
FROM g
"""


@query("op5_chat_format", SQL_OP5)
def op5(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{marks}' AS text "
                    "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    chats = parse_chats(format_chats(turns.unionByName(own)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                                F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                       lambda s: CHATML.unescape(s["text"])), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                        F.sha2(said, 256).alias("turns_sha256"),
                        F.length(learned).cast("long").alias("loss_chars"),
                        F.sha2(learned, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"), "valid")
