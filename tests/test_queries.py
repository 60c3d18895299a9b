import pytest

from runsift.operators import queryterms as Q

# The escape vectors of the reference behaviour.
ESCAPES = [
    ("job", "job"),
    ("j:job", "j:job"),
    ("job c:job", "job c:job"),
    ("folder/job c:job", r"folder\/job c:job"),
    ("j:folder/job", r"j:folder\/job"),
    ('j:"this is a job"', r"j:\"this is a job\""),
    ("j:folder/job c:something", r"j:folder\/job c:something"),
    ("j:folder/job AND c:something", r"j:folder\/job AND c:something"),
]

# query -> (occur, field, terms) per clause, or None if it is rejected
CLAUSES = {
    "linux* OR *linux": [("should", None, ["linux"]), ("should", None, ["linux"])],
    "a OR b AND c": [("should", None, ["a"]), ("must", None, ["b"]), ("must", None, ["c"])],
    "NOT c:foo bar": [("must_not", "c", ["foo"]), ("must", None, ["bar"])],
    "-c:foo x": [("must_not", "c", ["foo"]), ("must", None, ["x"])],
    "!c:foo x": [("must_not", "c", ["foo"]), ("must", None, ["x"])],
    "+c:foo x": [("must", "c", ["foo"]), ("must", None, ["x"])],
    "-foo x": [("must", None, ["foo"]), ("must", None, ["x"])],
    "c:http://x:80": None,
    '"a:b c"': None,
    "foo:": [("must", None, ["foo"])],
    "foo: bar": [("must", "foo", ["bar"])],
    "c:  bar": [("must", "c", ["bar"])],
    '"abc': [("must", None, ["abc"])],
    "n:[1 TO 5]": [("must", "n", ["1"]), ("must", None, ["TO"]), ("must", None, ["5"])],
    "foo && bar": [("must", None, ["foo"]), ("must", None, ["bar"])],
    'j:"this is"': [("must", "j", ["this"]), ("must", None, ["is"])],
    "folder/job": [("must", None, ["folder", "job"])],
    "a AND NOT b": [("must", None, ["a"]), ("must_not", None, ["b"])],
    "a OR": None,
    "OR a": None,
    "AND": None,
    "NOT NOT a": None,
    "NOT -c:x": None,
    "a AND OR b": None,
    "c:AND x": None,
    "": None,
    "   ": None,
}


@pytest.fixture(scope="module")
def parsed(spark):
    texts = [q for q, _ in ESCAPES] + list(CLAUSES)
    rows = spark.createDataFrame(list(enumerate(texts)), "qid bigint, q string")
    return {r.q: r for r in Q.parse(rows, "q").collect()}


@pytest.mark.parametrize("query,escaped", ESCAPES)
def test_escape(parsed, query, escaped):
    assert parsed[query].escaped == escaped


@pytest.mark.parametrize("query", list(CLAUSES))
def test_clauses(parsed, query):
    expected = CLAUSES[query]
    row = parsed[query]
    assert row.valid == (expected is not None)
    if expected is not None:
        assert [(c.occur, c.field, c.terms) for c in row.clauses] == expected
