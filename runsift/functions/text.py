"""Tokens, chunks, escapes and display text as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from runsift.schemas import MAX_TOKEN_CHARS, QUERY_PIECE, SPECIAL_CHARS, TOKEN, WORD_CHARS

# Logs above this size are cut into lines before they are tokenised, so no row holds a huge array; only for tokenizers
# whose tokens never reach over a line end.
CHUNK_BYTES = 1 << 20
# A block of lines has at least so many characters.
BLOCK_CHARS = 1 << 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` so that ``body`` may use it often while it is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split_long(tokens: Column) -> Column:
    whole = F.lit(f"(?s).{{1,{MAX_TOKEN_CHARS}}}")
    return F.when(
        F.exists(tokens, lambda t: F.length(t) > MAX_TOKEN_CHARS),
        F.flatten(F.transform(tokens, lambda t: F.regexp_extract_all(t, whole, F.lit(0)))),
    ).otherwise(tokens)


@dataclass(frozen=True)
class Tokenizer:
    """Tokens by pattern; those over the length limit are cut.

    ``line_safe`` promises that a token never holds a line break nor depends on what stands beyond
    one. Only then may large texts be tokenised line by line.
    """

    pattern: str
    line_safe: bool = False

    def __call__(self, text: Column) -> Column:
        return _let(F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0)), _split_long)


def pattern_tokenizer(pattern: str, line_safe: bool = False) -> Tokenizer:
    return Tokenizer(pattern, line_safe)


#: The case-sensitive word tokenizer.
tokens = Tokenizer(TOKEN, line_safe=True)


def chunks(text: Column, line_safe: bool = True) -> Column:
    """The text as one chunk, or in lines when it is large and may be cut; nothing is lost.

    A chunk ends before a word character, so neither a token nor the gap between two tokens is cut.
    """
    if not line_safe:
        return F.array(text)
    line = F.lit(rf"[^\n]*\n[^{WORD_CHARS}]*|[^\n]+")
    return F.when(F.octet_length(text) <= CHUNK_BYTES, F.array(text)).otherwise(
        F.regexp_extract_all(text, line, F.lit(0))
    )


def blocks(text: Column, line_safe: bool = True) -> Column:
    """As `chunks`, but in runs of lines of BLOCK_CHARS or more: few enough to be counted one against another."""
    if not line_safe:
        return F.array(text)
    lines = F.lit(rf"(?s:.{{{BLOCK_CHARS}}})[^\n]*\n[^{WORD_CHARS}]*|(?s:.+)")
    return F.when(F.octet_length(text) <= CHUNK_BYTES, F.array(text)).otherwise(
        F.regexp_extract_all(text, lines, F.lit(0))
    )


def pieces(text: Column) -> Column:
    """Cut text into tokens and the gaps between them; joined, the pieces give the text again."""
    piece = F.lit(f"{TOKEN}|[^{WORD_CHARS}]+")
    part = F.lit(f"(?s).{{1,{MAX_TOKEN_CHARS}}}")

    def long_token(p: Column) -> Column:
        return (F.length(p) > MAX_TOKEN_CHARS) & p.rlike(f"^[{WORD_CHARS}]")

    def cut(found: Column) -> Column:
        return F.when(
            F.exists(found, long_token),
            F.flatten(
                F.transform(
                    found,
                    lambda p: F.when(long_token(p), F.regexp_extract_all(p, part, F.lit(0))).otherwise(
                        F.array(p)
                    ),
                )
            ),
        ).otherwise(found)

    return _let(F.regexp_extract_all(text, piece, F.lit(0)), cut)


def parameter_text(parameters: Column) -> Column:
    """Every parameter value followed by a blank; a missing value reads ``null``."""
    values = F.transform(parameters, lambda p: F.concat(F.coalesce(p["value"], F.lit("null")), F.lit(" ")))
    return F.when(parameters.isNotNull(), F.array_join(values, ""))


def escape_special(text: Column) -> Column:
    return F.regexp_replace(text, f"([{SPECIAL_CHARS}])", r"\\$1")


def query_pieces(q: Column) -> Column:
    """array<struct<field, text>>: the field part ('' if none) and the text of each piece."""
    pattern = F.lit(QUERY_PIECE)
    return F.arrays_zip(
        F.regexp_extract_all(q, pattern, F.lit(1)).alias("field"),
        F.regexp_extract_all(q, pattern, F.lit(2)).alias("text"),
    )


def escaped_query(q: Column) -> Column:
    """The query with special characters neutralised in every text part, never in field parts."""
    parts = F.transform(query_pieces(q), lambda p: F.concat(p["field"], escape_special(p["text"])))
    return strip(F.array_join(parts, " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Blank-separated words, empty ones dropped."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def hit_url(root: Column, url: Column) -> Column:
    """Root and relative URL with exactly one slash where they meet."""
    return F.concat(
        F.regexp_replace(root, "/$", ""), F.lit("/"), F.regexp_replace(url, "^/", "")
    )


def html_line_ends(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n|\n|\r", "<br/>")


def job_label(parent: Column, name: Column, root: str) -> Column:
    """``folder >> job``, or only ``job`` at the root."""
    inside = parent.isNotNull() & (F.lower(parent) != root.lower())
    return F.when(inside, F.concat(parent, F.lit(" >> "), name)).otherwise(name)


def count_label(n: Column, page_size: int) -> Column:
    return F.when(n >= page_size, F.concat(n.cast("string"), F.lit("+"))).otherwise(n.cast("string"))


def expand_variables(pattern: Column, variables: dict[str, Column]) -> Column:
    """Replace $NAME and ${NAME}; unknown names stay as they are."""
    for name, value in sorted(variables.items(), key=lambda kv: -len(kv[0])):
        pattern = F.replace(pattern, F.lit("${" + name + "}"), value)
        pattern = F.regexp_replace(pattern, F.lit(rf"\${name}(?![A-Za-z0-9_])"), value)
    return pattern
