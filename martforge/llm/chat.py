"""Chat formatting by a finite-state machine, in DataFrame functions only.

A ``Template`` declares, as data: the label of each role, the strings that open
and close a turn, the roles whose text is learned (the loss mask), and the
allowed transitions between states (a state is the role of the last turn).
``format_conversations`` walks the turns of a conversation through the machine
and emits segments of text with a loss flag; the formatted text is their
concatenation.  Control strings inside texts are broken by a backslash and
backslashes are doubled, so ``read_back`` recovers every role and text.

Defined results: turns sort by turn (null first), ties by role and text; a null
text or role is empty; a role without a label is written as ``@`` and itself;
a conversation that breaks the turn order is formatted all the same, with
``valid`` false and the number of its first bad turn.  One conversation is one
output text, so it is the one thing held whole in a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    labels: dict[str, str] = field(default_factory=lambda: {
        "system": "System", "user": "User", "assistant": "Assistant"})
    mark: str = "### "
    after_label: str = ": "
    close: str = "</turn>"
    newline: str = "\n"
    loss: tuple[str, ...] = ("assistant",)
    start: tuple[str, ...] = ("system", "user")
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def transitions(self) -> dict[str, str]:
        """'state>role' -> next state."""
        table = {f">{r}": r for r in self.start}
        for state, roles in self.follows.items():
            table |= {f"{state}>{r}": r for r in roles}
        return table


CHAT = Template()


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def escape(text: Column, t: Template) -> Column:
    """No control string is left in the result; ``unescape`` undoes it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (t.close, t.mark):
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _label(role: Column, t: Template) -> Column:
    own = F.concat(F.lit("@"), F.regexp_replace(escape(role, t), ":", r"\\:"))
    return F.coalesce(F.try_element_at(_map(t.labels), role), own)


def format_conversations(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, segments (array of text, loss), formatted, valid, first_bad."""
    t = template
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    table = _map(t.transitions())
    begin = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, x: Column) -> Column:
        nxt = F.try_element_at(table, F.concat(acc["state"], F.lit(">"), x["role"]))
        return F.struct(x["role"].alias("state"), (acc["at"] + 1).alias("at"),
                        F.coalesce(acc["bad"], F.when(nxt.isNull(), acc["at"])).alias("bad"))

    def emit(x: Column) -> Column:
        text = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
        return F.array(
            text(F.concat(F.lit(t.mark), _label(x["role"], t), F.lit(t.after_label)), F.lit(False)),
            text(escape(x["text"], t), x["role"].isin(*t.loss)),
            text(F.lit(t.close + t.newline), F.lit(False)))

    out = (whole.withColumn("fsm", F.aggregate("turns", begin, step))
           .withColumn("segments", F.flatten(F.transform("turns", emit))))
    return out.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("fsm.bad").isNull().alias("valid"), F.col("fsm.bad").alias("first_bad"))


def read_back(formatted: str, template: Template = CHAT) -> Column:
    """The turns (array of role, text) that a formatted text was made of."""
    t = template
    close = "".join("\\" + c if not c.isalnum() and c != "\n" else c for c in t.close + t.newline)
    parts = F.filter(F.split(F.col(formatted), close), lambda p: p != "")
    back = _map({v: k for k, v in t.labels.items()})
    mark = len(t.mark)

    def turn(p: Column) -> Column:
        label = F.regexp_extract(F.substring(p, F.lit(mark + 1), F.length(p)),
                                 r"(?s)^((?:[^:\\]|\\.)*)" + t.after_label, 1)
        role = F.coalesce(F.try_element_at(back, label), unescape(F.substring(label, F.lit(2), F.length(label))))
        text = F.substring(p, F.lit(mark + 1 + len(t.after_label)) + F.length(label), F.length(p))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def report(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    out = format_conversations(turns, template)
    out = out.withColumn("back", read_back("formatted", template)).withColumn(
        "learned", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                            lambda s: unescape(s["text"])), ""))
    said = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"),
                      F.length("learned").cast("long").alias("loss_chars"),
                      F.sha2("learned", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"),
                      "valid", "first_bad")
