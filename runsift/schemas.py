"""Table schemas and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# They decide results, so they are stated once, here.
PAGE_SIZE = 100
MAX_FRAGMENTS = 5
FRAGMENT_CHARS = 100
MAX_TOKEN_CHARS = 255
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DECIMALS = 4
# A query piece: an optional field part that ends in a colon, then one word or one quoted text.
QUERY_PIECE = r'(\S+:)?([^"]\S*|".+?")\s*'
# Characters with a meaning in the query language; they are neutralised in the text part of a piece.
SPECIAL_CHARS = r'\\+\-!():^\[\]"{}~*?|&/'
# A token: letters, marks, numbers and underscore. Some marks join two letters, others two digits.
WORD_CHARS = r"\p{L}\p{M}\p{N}_"
LETTER_JOINS = ".'’:·"
NUMBER_JOINS = ".,;'’"
TOKEN = (
    rf"[{WORD_CHARS}]+(?:(?:(?<=[\p{{L}}\p{{M}}])[{LETTER_JOINS}](?=\p{{L}})"
    rf"|(?<=\p{{N}})[{NUMBER_JOINS}](?=\p{{N}}))[{WORD_CHARS}]+)*"
)

KEY = ["project", "number"]

PARAMETERS = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
)

RUNS = T.StructType(
    [
        T.StructField("project", T.StringType(), False),
        T.StructField("number", T.LongType(), False),
        T.StructField("display_name", T.StringType()),
        T.StructField("parameters", PARAMETERS),
        T.StructField("console", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

JOBS = T.StructType(
    [
        T.StructField("full_name", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("parent_name", T.StringType()),
    ]
)

QUERIES = T.StructType(
    [T.StructField("qid", T.LongType(), False), T.StructField("q", T.StringType(), False)]
)

FAILED_TESTS = T.StructType(
    [
        T.StructField("project", T.StringType(), False),
        T.StructField("number", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("error_details", T.StringType()),
    ]
)

RUN_EVENTS = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("project", T.StringType(), False),
        T.StructField("number", T.LongType()),
        T.StructField("j", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("d", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("c", T.StringType()),
    ]
)
