"""Line de-duplication within one edit, by deletion neighbourhoods.

A line is dropped when the same line stands earlier, whatever its length, or, from `min_chars` characters on, when a line
of at least as many characters at edit distance 1 does. "Earlier" goes by document id (null first), then by a hash of the
text where ids are null or shared, then by line number. Two lines are within one edit exactly if
  * deleting the character at the same position makes them equal (substitution), or
  * deleting one character of the longer gives the shorter (insertion, deletion).
All deletion variants are emitted as hashed keys (two 64-bit hashes) and equal variants are joined. In a group of equal
variants only the earliest member is compared with the others, which is enough to know who has an earlier neighbour, so
no pairs are formed within a group. Every link is then verified with `levenshtein`.

A line of L characters has L variants. Emitting them for all lines is avoided without losing a link: the same
neighbourhood is first taken with whole pieces (halves, then sixteenths of a line) deleted instead of characters. Lines
within one edit share such a coarse variant, so a line that shares none needs no fine ones.

Defined cases: a null text has one empty line; lines of nothing but blanks, tabs and carriage returns separate paragraphs
and are never dropped; one edit in a short line changes what it says, so those go only where they repeat exactly; equal rows
(same id, same text) count as one document and come out alike, rows of one id with different texts, or without an id, are
documents of their own; a document that loses all lines keeps its row with an empty text; other columns, whatever their names, pass unchanged; empty tables give
empty results. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import free_names, text_or_empty, written_small
from runsift.session import written

MIN_CHARS = 32
COARSE_PIECES = (2, 16)
LINE = ["h1", "h2"]
PLACE = ["doc_id", "row_key", "line_no"]
BLANKS = " \t\r"


def _hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)


def _numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, line_no, line, h1, h2): every line of every document."""
    text = text_or_empty("text")
    lines = F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    rows = docs.select("doc_id", F.xxhash64(text).alias("row_key"), lines)
    h1, h2 = _hashes(F.col("line"))
    return rows.withColumns({"h1": h1, "h2": h2})


def coarse_keys(line: Column, length: Column, pieces: int) -> Column:
    """Keys of the line with one of its pieces left out, as the shorter and as the longer line of a pair."""
    keys = []
    for shorter in (length, length - 1):
        for j in range(pieces):
            begin = F.floor(shorter * j / pieces).cast("int")
            rest = shorter - F.floor(shorter * (j + 1) / pieces).cast("int")
            head = F.substring(line, F.lit(1), begin)
            tail = F.substring(line, length - rest + 1, rest)
            keys.append(F.xxhash64(shorter, F.lit(j), head, F.lit(0), tail))
    return F.array(*keys)


def _sharing(lines: DataFrame, keys: Column, label: str) -> DataFrame:
    """(h1, h2, pos): lines that share a key with another line."""
    keyed = lines.select(*LINE, "pos", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = written_small(shared.where("low <> high").select("key"), f"{label}-keys", 16)
    return keyed.join(shared, "key", "left_semi").select(*LINE, "pos").distinct()


def _with_text(docs: DataFrame, lines: DataFrame, label: str) -> DataFrame:
    """(h1, h2, pos, line): the text of given lines, taken at their earliest place."""
    wanted = written_small(
        lines.select(*LINE, *[F.col(f"pos.{c}").alias(f"at_{c}") for c in PLACE]), label, 56
    )
    rows = _numbered_lines(docs).alias("r").join(
        wanted.alias("w"),
        F.col("r.doc_id").eqNullSafe(F.col("w.at_doc_id"))
        & (F.col("r.row_key") == F.col("w.at_row_key"))
        & (F.col("r.line_no") == F.col("w.at_line_no"))
        & (F.col("r.h1") == F.col("w.h1"))
        & (F.col("r.h2") == F.col("w.h2")),
    )
    rows = rows.select("r.h1", "r.h2", F.struct(*[f"r.{c}" for c in PLACE]).alias("pos"), "line")
    return rows.dropDuplicates(LINE)


def near_links(lines: DataFrame) -> DataFrame:
    """(h1, h2, e1, e2): a line and an earlier line within one edit; `lines` holds (h1, h2, pos, line), texts distinct."""
    places = F.sequence(F.lit(1), F.length("line"))
    variants = F.transform(
        places,
        lambda i: F.struct(
            i.alias("place"),
            F.concat(F.substring("line", F.lit(1), i - 1), F.substring("line", i + 1, F.length("line"))).alias("rest"),
        ),
    )
    rows = lines.select(*LINE, "pos", F.explode(variants).alias("v"))
    v1, v2 = _hashes(F.col("v.rest"))
    rows = written(rows.select(*LINE, "pos", F.col("v.place").alias("place"), v1.alias("v1"), v2.alias("v2")), "variants")
    earliest = rows.groupBy("v1", "v2", "place").agg(
        F.min(F.struct("pos", *LINE)).alias("e"), F.count("*").alias("n")
    )
    substituted = (
        rows.join(earliest.where("n > 1"), ["v1", "v2", "place"])
        .where(F.struct("pos", *LINE) != F.col("e"))
        .select(*LINE, F.col("e.h1").alias("e1"), F.col("e.h2").alias("e2"))
    )
    whole = lines.select(F.col("h1").alias("v1"), F.col("h2").alias("v2"), F.col("pos").alias("whole_pos"))
    inserted = rows.join(whole, ["v1", "v2"])
    later = F.col("pos") > F.col("whole_pos")
    inserted = inserted.select(
        F.when(later, F.col("h1")).otherwise(F.col("v1")).alias("h1"),
        F.when(later, F.col("h2")).otherwise(F.col("v2")).alias("h2"),
        F.when(later, F.col("v1")).otherwise(F.col("h1")).alias("e1"),
        F.when(later, F.col("v2")).otherwise(F.col("h2")).alias("e2"),
    )
    return substituted.union(inserted).distinct()


def _verified(links: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2): lines whose earlier neighbour is within one edit by the texts themselves."""
    own = lines.select(*LINE, "line")
    other = lines.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("earlier"))
    distance = F.levenshtein("line", "earlier", 1)
    return links.join(own, LINE).join(other, ["e1", "e2"]).where(distance.between(0, 1)).select(*LINE).distinct()


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int = 1) -> DataFrame:
    """(doc_id, row_key, dropped): numbers of the lines that go, for documents that lose any."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    length = F.length("line")
    judged = _numbered_lines(docs).where(F.ltrim("line", F.lit(BLANKS)) != "")
    first_pieces = COARSE_PIECES[0]
    lines = written(
        judged.groupBy(*LINE).agg(
            F.min(F.struct(*PLACE)).alias("pos"),
            F.count("*").alias("n"),
            F.min(length).alias("chars"),
            F.min(coarse_keys(F.col("line"), length, first_pieces)).alias("keys"),
        ),
        "distinct-lines",
    )
    repeated = lines.where("n > 1").select(*LINE, "pos", F.lit(False).alias("near"))
    if max_edits:
        likely = _sharing(lines.where(F.col("chars") >= min_chars), F.col("keys"), "halves")
        for pieces in COARSE_PIECES[1:]:
            texts = written(_with_text(docs, likely, "likely-lines"), "line-texts")
            likely = _sharing(texts, coarse_keys(F.col("line"), length, pieces), "pieces")
            likely = written_small(likely, "likely-lines")
            texts = texts.join(likely.select(*LINE), LINE, "left_semi")
        texts = written(texts, "neighbour-texts")
        near = _verified(near_links(texts), texts).withColumn("near", F.lit(True))
        near = near.withColumn("pos", F.lit(None).cast(lines.schema["pos"].dataType))
        repeated = repeated.unionByName(near).groupBy(*LINE).agg(F.max("near").alias("near"), F.max("pos").alias("pos"))
    fate = written_small(repeated, "line-fate", 56)
    here = F.struct(*PLACE)
    gone = judged.drop("line").join(fate, LINE).where(F.col("near") | (here != F.col("pos")))
    return gone.groupBy("doc_id", "row_key").agg(F.collect_set("line_no").alias("dropped"))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int = 1) -> DataFrame:
    """The documents without the lines that go: all columns of `docs`, then lines kept and lines dropped."""
    doc, row, lost = free_names(docs, "lost_from", "lost_row", "lost_lines")
    gone = dropped_lines(docs.select("doc_id", "text"), min_chars, max_edits)
    gone = gone.select(F.col("doc_id").alias(doc), F.col("row_key").alias(row), F.col("dropped").alias(lost))
    gone = written_small(gone, "dropped-lines", 64 + 8 * F.size(lost))
    text = text_or_empty(docs["text"])
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(row)), "left")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.col(lost), i))
    changed = F.col(lost).isNotNull()
    left = F.when(changed, F.array_join(kept, "\n")).otherwise(docs["text"]).alias("text")
    columns = [left if c == "text" else docs[c] for c in docs.columns]
    n_gone = F.when(changed, F.size(lost)).otherwise(0)
    return joined.select(
        *columns, (F.size(lines) - n_gone).cast("long").alias("lines_kept"), n_gone.cast("long").alias("lines_dropped")
    )
