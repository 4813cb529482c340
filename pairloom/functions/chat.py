"""Conversations as arrays of (role, content) turns, and their rendering for model families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the default system prompt.
SYSTEM_PROMPT = (
    "You are a helpful SQL assistant. Given a natural language question and an optional database schema, "
    "generate a correct SQL query that answers the question. Output only the SQL query, without explanation."
)
# Names of the model families, and the roles of the turn format with from and value.
FAMILIES = {"llama": "llama", "llama3": "llama", "llama3.1": "llama", "mistral": "mistral", "mixtral": "mistral", "phi": "phi", "phi3": "phi", "phi-3": "phi"}
SHARED_ROLES = {"user": "human", "assistant": "gpt"}


def user_content(nl: Column, schema: Column | None = None, difficulty: Column | None = None) -> Column:
    """The question, after the schema if there is one, before a hint of the difficulty if there is one."""
    parts = []
    if schema is not None:
        parts.append(F.when(F.coalesce(schema, F.lit("")) != "", F.concat(F.lit("Schema:\n"), schema, F.lit("\n"))))
    parts.append(F.coalesce(nl, F.lit("")))
    if difficulty is not None:
        parts.append(F.concat(F.lit("\n[Difficulty: "), difficulty, F.lit("]")))
    return F.array_join(F.array_compact(F.array(*parts)), "\n")


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def conversation(user: Column, answer: Column, system: str = SYSTEM_PROMPT) -> Column:
    return F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", answer))


def shared_turns(turns: Column) -> Column:
    """Turns as (from, value), with the roles' other names."""

    def named(t: Column) -> Column:
        role = t["role"]
        for ours, theirs in SHARED_ROLES.items():
            role = F.when(t["role"] == ours, F.lit(theirs)).otherwise(role)
        return F.struct(role.alias("from"), t["content"].alias("value"))

    return F.transform(turns, named)


def prompt_text(user: Column, system: str = SYSTEM_PROMPT) -> Column:
    return F.concat(F.lit(f"{system}\n\n"), user) if system else user


def llama(turns: Column) -> Column:
    text = F.transform(turns, lambda t: F.concat(F.lit("<|start_header_id|>"), t["role"], F.lit("<|end_header_id|>\n\n"), t["content"], F.lit("<|eot_id|>")))
    return F.concat(F.lit("<|begin_of_text|>"), F.array_join(text, ""))


def phi(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["content"], F.lit("<|end|>"))), "\n")


def mistral(turns: Column) -> Column:
    """A fold over the turns: a system text waits for the next user turn, a user turn for the next assistant turn."""
    none = F.lit(None).cast("string")
    start = F.struct(F.lit("<s>").alias("text"), none.alias("system"), none.alias("user"))

    def opened(user: Column) -> Column:
        return F.coalesce(F.concat(F.lit("[INST] "), user, F.lit(" [/INST]")), F.lit(""))

    def step(s: Column, t: Column) -> Column:
        role, content = t["role"], t["content"]
        asked = F.coalesce(F.concat(s["system"], F.lit("\n\n"), content), content)
        return F.struct(
            F.when(role == "assistant", F.concat(s["text"], opened(s["user"]), content, F.lit("</s>"))).otherwise(s["text"]).alias("text"),
            F.when(role == "system", content).when(role == "user", none).otherwise(s["system"]).alias("system"),
            F.when(role == "user", asked).when(role == "assistant", none).otherwise(s["user"]).alias("user"),
        )

    return F.aggregate(turns, start, step, lambda s: F.concat(s["text"], opened(s["user"])))


RENDER = {"llama": llama, "mistral": mistral, "phi": phi}


def family(name: str) -> str:
    key = name.strip().lower()
    if key not in FAMILIES:
        raise ValueError(f"unknown model family {name!r}; known: {sorted(set(FAMILIES.values()))}")
    return FAMILIES[key]


def render(turns: Column, family_name: str) -> Column:
    return RENDER[family(family_name)](turns)


def few_shot(examples: Column, style: str = "numbered") -> Column:
    """An array of (natural_language, sql, difficulty) as a prompt block: numbered, labelled or json."""
    empty = F.lit("(No few-shot examples available.)")
    if style == "json":
        block = F.to_json(examples)
    elif style == "labelled":
        block = F.array_join(F.transform(examples, lambda e: F.concat(F.lit("NL: "), e["natural_language"], F.lit("\nSQL: "), e["sql"])), "\n---\n")
    elif style == "numbered":

        def entry(e: Column, i: Column) -> Column:
            level = F.when(F.coalesce(e["difficulty"], F.lit("")) != "", F.concat(F.lit("\n  Difficulty: "), e["difficulty"])).otherwise(F.lit(""))
            return F.concat(F.lit("Example "), (i + 1).cast("string"), F.lit(":\n  Question: "), e["natural_language"], F.lit("\n  SQL: "), e["sql"], level)

        block = F.array_join(F.transform(examples, entry), "\n\n")
    else:
        raise ValueError("style must be numbered, labelled or json")
    return F.when(F.coalesce(F.size(examples), F.lit(0)) == 0, empty).otherwise(block)
