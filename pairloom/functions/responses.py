"""Parsers of model responses, as column expressions that never fail: what can't be parsed gives null or a default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.text import strip

INT_MAX = (1 << 31) - 1
EXAMPLES = "array<struct<natural_language:string,sql:string,difficulty:string,category:string>>"


def is_json(c: Column) -> Column:
    """Whether the whole text is one JSON value."""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))  # the parser alone would stop after a first value
    return listed.isNotNull() & F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()


def unfence(c: Column) -> Column:
    """Without a JSON code fence around the text."""
    text = strip(c)
    inner = F.when(text.startswith("```json"), F.substring(text, 8, INT_MAX)).when(text.startswith("```"), F.substring(text, 4, INT_MAX)).otherwise(text)
    inner = strip(inner)
    return strip(F.when(inner.endswith("```"), inner.substr(F.lit(1), F.length(inner) - 3)).otherwise(inner))


def quality_score(c: Column) -> Column:
    """Score of 1 to 5: the JSON's score (3 if missing) clamped, else the first digit from 1 to 5 that stands alone, else 3.

    A bare JSON number scores 3.
    """
    text = unfence(c)
    is_object = text.startswith("{") & is_json(text)
    given = F.get_json_object(text, "$.score").try_cast("double")
    clamped = F.least(F.greatest(F.coalesce(given, F.lit(3.0)), F.lit(1.0)), F.lit(5.0))
    lone = F.filter(F.split(text, "[^A-Za-z0-9_]+"), lambda w: w.isin("1", "2", "3", "4", "5"))
    bare = text.try_cast("double").isNotNull()
    return F.when(is_object, clamped).when(bare | (F.size(lone) == 0), F.lit(3.0)).otherwise(F.try_element_at(lone, F.lit(1)).cast("double"))


def judgement(c: Column) -> Column:
    """The judge's struct of score and criteria, or null where the JSON is broken or its score is not 1 to 5."""
    text = F.regexp_replace(F.regexp_replace(strip(unfence(c)), r",\s*\}", "}"), r",\s*\]", "]")
    whole = text.startswith("{") & is_json(text)
    score = F.floor(F.get_json_object(text, "$.score").try_cast("double")).cast("int")
    field = lambda n: F.coalesce(F.get_json_object(text, f"$.{n}"), F.lit("")).alias(n)
    made = F.struct(score.alias("score"), *[field(n) for n in ("correctness", "efficiency", "readability", "edge_cases", "overall")])
    return F.when(whole & score.between(1, 5), made)


def examples(c: Column) -> Column:
    """Examples in a response: its JSON array or object with trailing commas mended, else each flat object in the text."""
    text = unfence(c)
    framed = F.regexp_extract(text, r"(\[[\s\S]*\])", 1)
    body = F.regexp_replace(F.when(framed != "", framed).otherwise(text), r",\s*([}\]])", "$1")
    whole = is_json(body)
    listed = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    parsed = F.from_json(listed, EXAMPLES)
    pieces = F.regexp_extract_all(body, F.lit(r"(\{[^{}]+\})"), F.lit(1))
    loose = F.filter(
        F.transform(pieces, lambda p: F.from_json(p, EXAMPLES[6:-1])), lambda e: e.isNotNull() & e["natural_language"].isNotNull() & e["sql"].isNotNull()
    )
    return F.when(whole, parsed).otherwise(loose)


def kept_examples(c: Column, difficulty: str, strategy: str) -> Column:
    """The usable examples of a response: stripped, both texts given, with default labels and the strategy's name."""
    made = F.transform(
        examples(c),
        lambda e: F.struct(
            strip(e["natural_language"]).alias("natural_language"),
            strip(e["sql"]).alias("sql"),
            F.coalesce(e["difficulty"], F.lit(difficulty)).alias("difficulty"),
            F.coalesce(e["category"], F.lit("")).alias("category"),
            F.lit(strategy).alias("strategy"),
        ),
    )
    return F.filter(made, lambda e: (F.coalesce(e["natural_language"], F.lit("")) != "") & (F.coalesce(e["sql"], F.lit("")) != ""))


def extracted_sql(c: Column) -> Column:
    """What stands in the first fenced block, without the block's language name, or the text without a leading label."""
    text = strip(c)
    inside = F.split(text, "```")  # outside, inside, outside, ...
    block = F.try_element_at(inside, F.lit(2))
    fenced = F.when(F.lower(block).startswith("sql"), F.substring(block, 4, INT_MAX)).otherwise(block)
    word = F.when(F.lower(text).startswith("sql"), 3).when(F.lower(text).startswith("query"), 5).otherwise(0)
    rest = strip(text.substr(word + 1, F.length(text)))
    labelled = (word > 0) & (rest.startswith(":") | rest.startswith("-"))
    return F.when(F.size(inside) > 2, strip(fenced)).when(labelled, strip(F.substring(rest, 2, INT_MAX))).otherwise(text)


def served_sql(c: Column) -> Column:
    """Generated SQL without fence lines, with a final semicolon; empty stays empty."""
    text = strip(c)
    lines = F.filter(F.split(text, r"\r\n|\n|\r"), lambda ln: ~strip(ln).startswith("```"))
    bare = F.when(text.startswith("```"), strip(F.array_join(lines, "\n"))).otherwise(text)
    return F.when((bare != "") & ~bare.endswith(";"), F.concat(bare, F.lit(";"))).otherwise(bare)
