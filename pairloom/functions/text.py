"""Text columns: keys, tokens, normal forms, prompts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.runtime import col

# Fixed value: the characters that count as white space at the ends of a text.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
TOKEN = r"[\p{L}\p{N}_]+"
UNKNOWN = "__unknown__"

# The prompt of a benchmark question, and the chat prompt of the server, in parts.
BENCHMARK_PROMPT = (
    "Convert the following natural language question into a SQL query.\n"
    "Output ONLY the SQL query, with no explanation or markdown formatting.\n\nQuestion: ",
    "\n\nSQL:",
)


def strip(c: Column) -> Column:
    """Without white space at either end; null stays null."""
    return F.trim(c, F.lit(BLANKS))


def value_key(name: str) -> Column:
    """A field as text, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def group_key(name: str, missing: str = UNKNOWN) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(missing))


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores; null gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))


def fingerprint(names: list[str]) -> Column:
    """SHA-256 of the fields, joined by NUL."""
    joined = reduce(lambda a, b: F.concat(a, F.lit("\x00"), b), [value_key(n) for n in names])
    return F.sha2(joined, 256)


def normalize_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), r"\s+", " ")


def normalize_sql(c: Column) -> Column:
    """Lower case, no comments, no final semicolons, single blanks; string literals keep comment marks they hold."""
    text = strip(F.regexp_replace(F.lower(strip(c)), r";+$", ""))
    bare = F.regexp_replace(text, r"('(?:[^']|'')*')|--[^\n]*|/\*[\s\S]*?\*/", "$1")
    return strip(F.regexp_replace(bare, r"\s+", " "))


def first_line(c: Column) -> Column:
    return strip(F.split(strip(c), "\n")[0])


def slug(c: Column, default: str = "model") -> Column:
    made = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(made, F.lit("")) == "", F.lit(default)).otherwise(made)


def benchmark_prompt(c: Column) -> Column:
    return F.concat(F.lit(BENCHMARK_PROMPT[0]), c, F.lit(BENCHMARK_PROMPT[1]))


# The server's prompt, around the system text, the schema and the question.
CHAT_PROMPT = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n",
    "<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n### Schema:\n",
    "\n\n### Question:\n",
    "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
)


def chat_prompt(question: Column, schema: Column, system: str) -> Column:
    """A question with its schema as an open chat turn, ready for a model's answer."""
    return F.concat(F.lit(CHAT_PROMPT[0] + system + CHAT_PROMPT[1]), strip(schema), F.lit(CHAT_PROMPT[2]), strip(question), F.lit(CHAT_PROMPT[3]))


# What is shown of a gate result and of a repair.
PASS, FAIL, NO_REPAIR, REPAIRED, UNREPAIRED = "[PASS]", "[FAIL:{0}]", "[PASS: no repair needed]", "[REPAIRED after {0} attempt(s)]", "[FAIL after {0} attempt(s): {1}]"


def filled(template: str, *values: Column) -> Column:
    """A text with columns in place of {0}, {1} and so on, in this order."""
    out, rest = [], template
    for k, value in enumerate(values):
        head, rest = rest.split(f"{{{k}}}", 1)
        out += [F.lit(head), value.cast("string")]
    return F.concat(*out, F.lit(rest))


def shown_result(passed: Column, status: Column, message: Column) -> Column:
    """The verdict of the gate, and the message of a failure."""
    told = F.when(F.coalesce(message, F.lit("")) != "", F.concat(F.lit(" "), message)).otherwise(F.lit(""))
    return F.when(passed, F.lit(PASS)).otherwise(F.concat(filled(FAIL, status), told))


def shown_repair(passed: Column, attempts: Column, status: Column) -> Column:
    """The outcome of a repair."""
    return F.when(passed & (attempts == 0), F.lit(NO_REPAIR)).when(passed, filled(REPAIRED, attempts)).otherwise(filled(UNREPAIRED, attempts, status))
