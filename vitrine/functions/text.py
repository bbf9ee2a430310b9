"""Text cleaning, shortening, prompt building and answer parsing."""

from __future__ import annotations

import html
import re
from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Whitespace as Python's str.split and str.strip see it.
SPACE_CLASS = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WHITESPACE = SPACE_CLASS + "+"

# Markup pattern and the five predefined entities, ampersand last so
# that "&amp;lt;" becomes "&lt;" and no more.
TAG_PATTERN = r"<[^>]+>"
COMMON_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
TERMINATED = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+)|([0-9A-Za-z]+));")

# Lengths of summaries and answers.
SUMMARY_WORDS = 20
TITLE_CHARS = 60
TREND_ROWS = 20
REPORT_ROWS = 10
ANSWER_STRIP = "- •0123456789. "
ANSWER_MIN_CHARS = 5
ANSWER_LINES = 3


def strip_space(c: Column) -> Column:
    """Trim whitespace of every kind at both ends."""
    return F.regexp_replace(c, f"^{WHITESPACE}|{WHITESPACE}$", "")


@F.pandas_udf(StringType())
def unescape_entities(s: pd.Series) -> pd.Series:
    """Decode every HTML entity; Spark has no built-in for the full table."""
    return s.map(html.unescape, na_action="ignore")


def terminated(text: str) -> str:
    """The text with its entities decoded, but for those without a semicolon, such as an `&amp` cut off at the end."""
    return TERMINATED.sub(lambda m: m[0] if m[1] and m[1] + ";" not in html5 else html.unescape(m[0]), text)


@F.pandas_udf(StringType())
def unescape_terminated(s: pd.Series) -> pd.Series:
    return s.map(terminated, na_action="ignore")


def strip_html(c: Column, all_entities: bool = False, unterminated: bool = True) -> Column:
    """Text without tags, entities decoded, trimmed.

    The five common entities stay in generated code; `all_entities` decodes the
    whole table through Arrow batches, with `unterminated` also the old names that need no semicolon.
    """
    bare = F.regexp_replace(c, TAG_PATTERN, "")
    if all_entities:
        return strip_space((unescape_entities if unterminated else unescape_terminated)(bare))
    return strip_space(reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), COMMON_ENTITIES, bare))


def words(c: Column) -> Column:
    """Whitespace-separated words; none for blank text."""
    return F.filter(F.split(c, WHITESPACE), lambda w: w != "")


def first_words(c: Column, n: int = SUMMARY_WORDS) -> Column:
    """The first n words, with an ellipsis if there are more."""
    parts = words(c)
    return F.concat(F.array_join(F.slice(parts, 1, n), " "), F.when(F.size(parts) > n, "…").otherwise(""))


def short_summary(name: Column, description: Column) -> Column:
    """`name : first words of the description`, or just the name."""
    blank = F.coalesce(description, F.lit("")) == ""
    return F.when(blank, name).otherwise(F.concat(name, F.lit(" : "), first_words(description)))


def prompt_key(prompt: Column, prefix: str) -> Column:
    """Cache key of a prompt: model prefix and md5 of the text."""
    return F.concat(F.lit(prefix + ":"), F.md5(prompt.cast("binary")))


def distinct_prompts(df: DataFrame, prompt: str, prefix: str) -> DataFrame:
    """Each different prompt once, with its key and how often it occurs."""
    return df.groupBy(prompt_key(F.col(prompt), prefix).alias("key")).agg(
        F.first(prompt).alias(prompt), F.count(F.lit(1)).alias("n"))


# Prompt wording, which the cache key depends on.
SUMMARY_PROMPT = (
    "Résume ce produit en 1-2 phrases concises.\n"
    "Raisonnement : identifie d'abord les caractéristiques clés, puis synthétise-les en une phrase fluide.\n"
    "Nom: %s\nDescription: %s\nCatégorie: %s\nRésumé:"
)
TREND_PROMPT_HEAD = (
    "Analyse les tendances produit suivantes étape par étape :\n"
    "1. Examine chaque produit et sa catégorie.\n"
    "2. Regroupe les produits par similarité.\n"
    "3. Identifie les 3 tendances principales avec justification.\n"
)
TREND_PROMPT_TAIL = "\nTop 3 tendances:"
REPORT_PROMPT_HEAD = (
    "Génère un rapport stratégique concis à partir de ce top 10 produits.\n"
    "Raisonnement : analyse d'abord les tendances de prix, notes et catégories, "
    "puis formule des recommandations justifiées.\n"
)
REPORT_PROMPT_TAIL = "\nRapport stratégique (paragraphe concis avec recommandations) :"


def summary_prompt(name: Column, description: Column, category: Column) -> Column:
    return F.format_string(SUMMARY_PROMPT, *[F.coalesce(c, F.lit("")) for c in (name, description, category)])


def joined_lines(df: DataFrame, line: Column, order: str, limit: int, head: str, tail: str) -> DataFrame:
    """One prompt from the first `limit` rows: head, one line per row, tail."""
    rows = df.select(F.col(order).alias("_o"), line.alias("_l")).orderBy("_o").limit(limit)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_o", "_l"))), lambda e: e["_l"])
    return rows.agg(F.concat_ws("\n", F.lit(head), F.array_join(lines, "\n"), F.lit(tail)).alias("prompt"))


def trend_prompt(df: DataFrame, order: str = "rank") -> DataFrame:
    """One trend prompt over the first rows: `- name (category)` per line."""
    line = F.concat(F.lit("- "), F.coalesce("title", F.lit("")), F.lit(" ("),
                    F.coalesce("category", F.lit("")), F.lit(")"))
    return joined_lines(df, line, order, TREND_ROWS, TREND_PROMPT_HEAD, TREND_PROMPT_TAIL)


def report_prompt(top: DataFrame, order: str = "rank", score: str = "composite_score") -> DataFrame:
    """One report prompt over the top rows: `rank. name - price€ - Score: score`."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))

    line = F.concat(F.col(order).cast("string"), F.lit(". "), F.coalesce("title", F.lit("")), F.lit(" - "),
                    shown("price"), F.lit("€ - Score: "), shown(score))
    return joined_lines(top, line, order, REPORT_ROWS, REPORT_PROMPT_HEAD, REPORT_PROMPT_TAIL)


def parse_answer(answer: Column) -> Column:
    """The first few points of a free-text answer, list markers removed."""
    lines = F.transform(F.split(answer, "\n"), lambda x: F.btrim(x, F.lit(ANSWER_STRIP)))
    return F.slice(F.filter(lines, lambda x: F.length(x) > ANSWER_MIN_CHARS), 1, ANSWER_LINES)
