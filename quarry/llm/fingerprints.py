"""Document fingerprints as Merkle trees (operator 1), native expressions only.

Paragraphs are lines.  A paragraph's hash is the md5 of its text; sections are
runs of paragraphs that end where a paragraph's hash starts with one of four
hex digits (cut by content, so an edit moves no other section); a section's
hash is the md5 of its paragraphs' hashes; the root is the SHA-256 of the
section hashes.  Equal roots mean equal texts, differing sections and
paragraphs locate edits.  Below the paragraphs stand leaves: clauses, and parts
of clauses of over 96 characters, cut by content: at blanks behind one of a
quarter of the ASCII letters and digits, and what is still over 64 characters
long, such as text without blanks, behind every code point divisible by 8 and
at the latest after 64 characters.  A leaf is a number of 32 hash bits and its
length; leaves count as often as they occur, and the likeness of two trees is
the share of their lengths that lies in common leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ordered

#: Longest clause and longest part of one; bits of a leaf's length (and one
#: more) and of its count.
CLAUSE, PART, LENGTH_BITS, COUNT_BITS = 96, 64, 7, 24


def paragraphs(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda p: F.md5(p.cast("binary")))


def sections(paragraph_hashes: Column) -> Column:
    joined = F.regexp_replace(F.array_join(paragraph_hashes, " "), "(?<![0-9a-f])([0-3][0-9a-f]{31}) ", "$1\n")
    return F.transform(F.split(joined, "\n", -1), lambda s: F.md5(s.cast("binary")))


def root(section_hashes: Column) -> Column:
    return F.sha2(F.array_join(section_hashes, " ").cast("binary"), 256)


def leaf_texts(text: Column) -> Column:
    """The texts of the leaves in order: all of the text but the line ends, and
    the blanks that end a leaf."""
    lines = lambda c, at: F.split(F.regexp_replace(c, at, "$1\n"), "\n", -1)

    def within(chars: Column) -> Column:  # places to cut behind, counted from 1; the end is one
        chosen = F.filter(F.sequence(F.lit(1), F.size(chars)), lambda i: (i == F.size(chars)) | (F.ascii(F.get(chars, i - 1)) % 8 == 0))

        def between(ends: Column) -> Column:
            def part(e: Column, j: Column) -> Column:
                first = F.when(j == 0, F.lit(0)).otherwise(F.get(ends, j - 1))
                return F.transform(F.sequence(first, e - 1, F.lit(PART)), lambda lo: F.array_join(
                    F.slice(chars, lo + 1, F.least(F.lit(PART), e - lo)), ""))

            return F.flatten(F.transform(ends, part))

        return F.transform(F.array(chosen), between)[0]

    def small(c: Column) -> Column:
        chars = F.array(F.regexp_extract_all(c, F.lit("(?s)."), 0))
        return F.when(F.length(c) <= PART, F.array(c)).otherwise(F.transform(chars, within)[0])

    def cut(c: Column) -> Column:
        return F.flatten(F.transform(lines(c, "([048DHLPTXdhlptx]) "), small))

    return F.flatten(F.transform(lines(text, "([.,;:!?|]) "), lambda c: F.when(F.length(c) <= CLAUSE, F.array(c)).otherwise(cut(c))))


def leaves(text: Column) -> Column:
    """The text's leaves, ascending: each different one once, as hash, length
    and count in one number."""
    def number(c: Column) -> Column:
        bits = F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return bits * F.lit(1 << LENGTH_BITS) + F.length(c).cast("bigint") + 1

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def counted(at: Column) -> Column:
            return F.transform(at, lambda p, r: F.get(s, p) * F.lit(1 << COUNT_BITS) + F.least(
                F.coalesce(F.get(at, r + 1), F.size(s)) - p, F.lit((1 << COUNT_BITS) - 1)).cast("bigint"))

        return F.transform(F.array(starts), counted)[0]

    return F.transform(F.array(F.sort_array(F.transform(leaf_texts(text), number))), runs)[0]


_COUNT = (1 << COUNT_BITS) - 1


def _each(leaf_numbers: Column) -> Column:
    """A number for every occurrence of a leaf: its first, its second, ..."""
    return F.flatten(F.transform(leaf_numbers, lambda x: F.transform(
        F.sequence(F.lit(1).cast("bigint"), x.bitwiseAND(F.lit(_COUNT).cast("bigint"))),
        lambda k: x - x.bitwiseAND(F.lit(_COUNT).cast("bigint")) + k)))


def _length(x: Column) -> Column:
    return F.shiftright(x, COUNT_BITS).bitwiseAND(F.lit((1 << LENGTH_BITS) - 1).cast("bigint"))


def _total(numbers: Column, each: bool) -> Column:
    count = (lambda x: F.lit(1).cast("bigint")) if each else (lambda x: x.bitwiseAND(F.lit(_COUNT).cast("bigint")))
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda s, x: s + _length(x) * count(x))


def likeness(a: Column, b: Column) -> Column:
    """Dice share of common leaves by length, 0 to 1; a leaf is common as often
    as both have it."""
    return F.lit(2.0) * _total(F.array_intersect(_each(a), _each(b)), True) / (_total(a, False) + _total(b, False))


def document_trees(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id``, ``fingerprint`` (root),
    ``sections`` and ``paragraphs`` (hashes in order), ``leaves``.  A null
    text counts as empty: one empty paragraph."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("paragraphs", paragraphs(F.col("text")))
    t = t.withColumn("sections", sections(F.col("paragraphs")))
    return t.select("doc_id", root(F.col("sections")).alias("fingerprint"), "sections", "paragraphs",
                    leaves(F.col("text")).alias("leaves"))


def changed(a: Column, b: Column) -> Column:
    """Branches of tree level ``a`` that ``b`` lacks: where an edit lies."""
    return F.array_except(a, b)


def next_documents(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text_hash, n_chars)`` -> one row per distinct
    (doc_id, text_hash) with ``prev_id``, ``prev_hash``, ``prev_chars`` of the
    document before it in ascending doc_id (null ids first, then by text
    hash); the first follows the last."""
    d = docs.groupBy("doc_id", "text_hash").agg(F.max("n_chars").alias("n_chars"))
    d = ordered(d, [F.col("doc_id"), F.col("text_hash")])
    me = F.struct("doc_id", "text_hash", "n_chars")
    inside = Window.partitionBy("_part").orderBy("_pos")
    d = d.withColumn("prev", F.lag(me).over(inside)).withColumn("me", me)
    # one row per range partition: its last document precedes the next partition's first
    ends = d.groupBy("_part").agg(F.max(F.struct("_pos", "me")).alias("end"))
    w = Window.orderBy("_part")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(F.col("_part").alias("_p"),
                       F.coalesce(F.lag("end.me").over(w), F.last("end.me").over(whole)).alias("before"))
    d = d.join(ends, d["_part"] == ends["_p"])
    prev = F.coalesce("prev", "before")
    return d.select("doc_id", "text_hash", prev["doc_id"].alias("prev_id"), prev["text_hash"].alias("prev_hash"),
                    prev["n_chars"].alias("prev_chars"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Trees of ``docs(doc_id, text)`` and of their edited texts: the last
    floor(n_chars / 4) code points replaced by the first as many (or all) of
    the next document in ascending doc_id.

    Returns a row per input row: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_sections,
    changed_sections`` (sections of the text that the edited text lacks).
    Null texts count as empty.  Rows that repeat (doc_id, text) share one
    place in the order and get equal results; rows of one doc_id with
    different texts follow each other by text hash; null ids come first.  A
    document alone in its table is its own next.  An empty table gives no rows.

    Each text is shuffled once: rows meet their predecessor's key, and only
    the prefix the predecessor needs and the leaves travel on to it.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = d.schema["doc_id"].dataType
    # keys without nulls, so that equal keys are dealt alike by joins and by grouping
    key = lambda i: [F.coalesce(i, F.lit(0).cast(kind)).alias("k"), i.isNull().alias("none")]
    d = d.withColumn("text_hash", F.xxhash64("text"))
    order = next_documents(d.select("doc_id", "text_hash", F.length("text").cast("bigint").alias("n_chars")))
    order = order.select(*key(F.col("doc_id")), "text_hash", "prev_id", "prev_hash", "prev_chars")
    by = ["k", "none", "text_hash"]
    # the same columns for both uses of the texts, so they are shuffled once
    rows = d.select(*key(F.col("doc_id")), "text_hash", "text").join(order, by)
    lent = rows.select(
        *key(F.col("prev_id")), F.col("prev_hash").alias("text_hash"),
        F.substring("text", F.lit(1), F.floor(F.col("prev_chars") / 4).cast("int")).alias("prefix"),
        leaves(F.col("text")).alias("next_leaves")).dropDuplicates(by)
    both = rows.join(lent, by)
    n = F.length("text")
    both = both.select(F.when(~F.col("none"), F.col("k")).alias("doc_id"), "text", n.cast("bigint").alias("n_chars"), "next_leaves", F.concat(
        F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("prefix")).alias("edited"))
    both = both.select(
        "doc_id", "n_chars", "next_leaves", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sections(paragraphs(F.col("text"))).alias("s"), sections(paragraphs(F.col("edited"))).alias("se"),
        leaves(F.col("text")).alias("l"), leaves(F.col("edited")).alias("le"))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", root(F.col("s")).alias("fingerprint"),
        root(F.col("se")).alias("edited_fingerprint"), likeness(F.col("l"), F.col("le")).alias("near_edited"),
        likeness(F.col("l"), F.col("next_leaves")).alias("near_next"),
        F.size("s").cast("bigint").alias("n_sections"), F.size(changed(F.col("s"), F.col("se"))).cast("bigint").alias("changed_sections"))


#: DuckDB SQL for the rows of ``edited_fingerprints`` over ``documents``;
#: leaves are rows here, with their counts.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
  SELECT row_number() OVER () AS rid, doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST),
         first_value(text) OVER (ORDER BY doc_id NULLS FIRST)) AS next_text
  FROM d
), e AS (
  SELECT rid, doc_id, text, next_text, length(text)::BIGINT AS n_chars,
         substr(text, 1, length(text) - length(text) // 4) || substr(next_text, 1, length(text) // 4) AS edited
  FROM n
), h AS (
  SELECT *, list_transform(string_split(text, chr(10)), lambda x: md5(x)) AS p,
         list_transform(string_split(edited, chr(10)), lambda x: md5(x)) AS pe
  FROM e
), s AS (
  SELECT *, list_transform(string_split(regexp_replace(array_to_string(p, ' '), '(\b[0-3][0-9a-f]{31}) ', '\1' || chr(10), 'g'),
                                        chr(10)), lambda x: md5(x)) AS s,
         list_transform(string_split(regexp_replace(array_to_string(pe, ' '), '(\b[0-3][0-9a-f]{31}) ', '\1' || chr(10), 'g'),
                                     chr(10)), lambda x: md5(x)) AS se
  FROM h
), whole AS (
  SELECT rid, 't' AS k, text AS x FROM e UNION ALL SELECT rid, 'e', edited FROM e UNION ALL SELECT rid, 'n', next_text FROM e
), line AS (
  SELECT rid, k, unnest(string_split(regexp_replace(x, '([.,;:!?|]) ', '\1' || chr(10), 'g'), chr(10))) AS c FROM whole
), clause AS (SELECT row_number() OVER () AS cid, * FROM line
), piece AS (
  SELECT row_number() OVER () AS pid, rid, k, c FROM (SELECT rid, k, unnest(string_split(
    regexp_replace(c, '([048DHLPTXdhlptx]) ', '\1' || chr(10), 'g'), chr(10))) AS c FROM clause WHERE length(c) > 96)
), long AS (SELECT pid, c, unnest(range(1, length(c) + 1)) AS i FROM piece WHERE length(c) > 64
), fin AS (
  SELECT pid, i, lag(i, 1, 0) OVER (PARTITION BY pid ORDER BY i) AS lo FROM long
  WHERE i = length(c) OR ord(substr(c, i, 1)) % 8 = 0
), part AS (SELECT pid, i, unnest(range(lo, i, 64)) AS lo FROM fin
), leaf AS (
  SELECT rid, k, c AS x FROM clause WHERE length(c) <= 96
  UNION ALL SELECT rid, k, c FROM piece WHERE length(c) <= 64
  UNION ALL SELECT rid, k, substr(c, lo + 1, least(64, i - lo)) FROM part JOIN piece USING (pid)
), bag AS (SELECT rid, k, substr(md5(x), 1, 8) AS x, length(x) + 1 AS w, count(*) AS n FROM leaf GROUP BY ALL
), total AS (SELECT rid, k, sum(w * n) AS w FROM bag GROUP BY ALL
), common AS (
  SELECT a.rid, b.k, sum(a.w * least(a.n, b.n)) AS w FROM bag a JOIN bag b ON a.rid = b.rid AND a.x = b.x AND a.w = b.w
  WHERE a.k = 't' AND b.k <> 't' GROUP BY ALL
), near AS (
  SELECT t.rid, o.k, 2.0::DOUBLE * coalesce(c.w, 0)::BIGINT / (t.w + o.w)::BIGINT AS near
  FROM total t JOIN total o ON t.rid = o.rid AND t.k = 't' AND o.k <> 't' LEFT JOIN common c ON c.rid = t.rid AND c.k = o.k
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
       sha256(array_to_string(s, ' ')) AS fingerprint, sha256(array_to_string(se, ' ')) AS edited_fingerprint,
       ne.near AS near_edited, nn.near AS near_next, len(s)::BIGINT AS n_sections,
       len(list_filter(list_distinct(s), lambda x: NOT list_contains(se, x)))::BIGINT AS changed_sections
FROM s JOIN near ne ON ne.rid = s.rid AND ne.k = 'e' JOIN near nn ON nn.rid = s.rid AND nn.k = 'n'
"""
