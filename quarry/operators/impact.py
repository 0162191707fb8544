"""Impact-ordered postings for ranked reading.

A clause's part of a score grows with its term frequency, so postings are
stored by level, the logarithm of the frequency: a level holds the frequencies
2^l .. 2^(l+1) - 1 and thus a range of scores above those of all lower ones.
A small table has each term's postings and highest frequency by level.

A ranked query reads levels from the top.  An entity that misses one of its
terms in the levels read has at most the best score of the next level of that
term with the highest of the others; once the k-th score found exceeds this
for every term, no other entity can enter the first k, and the lower levels
are not read.  Terms that are rare have few postings at any level; for common
ones the rest of the list is spared."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.operators.search import K1, parse_query


class Ranked(NamedTuple):
    """The first hits; how many postings were read, of how many."""

    hits: DataFrame
    read: int
    total: int


def _level() -> "F.Column":
    return F.floor(F.log2("tf")).cast("int")


def write_impacts(index: DataFrame, path: str) -> None:
    """Store the postings of ``index`` by type, sorted by term, level from the
    top and entity, and the table of levels beside them."""
    rows = IX.postings(index).select("entity_type", "term", _level().alias("level"), "entity_id", "page", "content_hash", "tf")
    order = [F.col("entity_type"), F.col("term"), F.col("level").desc(), F.col("entity_id")]
    (IX.spread(rows, ["entity_type", "term"], "entity_id").sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("entity_type").parquet(f"{path}/postings"))
    stored = rows.sparkSession.read.parquet(f"{path}/postings")
    levels = stored.groupBy("entity_type", "term", "level").agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"))
    (levels.repartitionByRange("entity_type", "term").sortWithinPartitions("entity_type", "term")
     .write.mode("overwrite").parquet(f"{path}/levels"))


def _part(tf: float) -> float:
    return tf / (tf + K1)


def top_k(spark: SparkSession, path: str, query: str, entity_type: str, limit: int = 20) -> Ranked:
    """The first ``limit`` hits of a query of required terms, as
    :func:`quarry.operators.index.search_index` scores and orders them (score
    descending, entity, page): ``(entity_id, page, score)``.

    Each round reads the chosen levels with filters that reach the scan and
    brings the first ``limit`` rows to the driver; the levels of the term that
    bounds the others are lowered until about four times as much is read, so
    all rounds together read little more than the last."""
    clauses = parse_query(query)
    if not clauses or any(c.kind != "term" for c in clauses):
        raise ValueError("ranked reading takes queries of required terms; search_index takes any")
    terms = [c.terms[0] for c in clauses]
    kept = spark.read.parquet(f"{path}/levels").filter((F.col("entity_type") == entity_type) & F.col("term").isin(*terms)).collect()
    blocks = {t: sorted(((r["level"], r["n"], r["max_tf"]) for r in kept if r["term"] == t), reverse=True) for t in terms}
    total = sum(n for b in blocks.values() for _, n, _ in b)
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("entity_type") == entity_type)
    schema = "entity_id string, page bigint, score double"
    if not all(blocks.values()):
        return Ranked(spark.createDataFrame([], schema), 0, total)
    used = {t: 1 for t in terms}  # levels read, from the top

    def cost() -> int:
        return sum(n for t in terms for _, n, _ in blocks[t][:used[t]])

    def bound() -> tuple[float, str | None]:
        """The best score of an entity not found whole, and the term that gives
        it; no term if all is read."""
        best = (-1.0, None)
        for t in terms:
            if used[t] < len(blocks[t]):
                rest = sum(_part(blocks[o][0][2]) for o in terms if o != t)
                best = max(best, (round((_part(blocks[t][used[t]][2]) + rest) / len(terms), 6), t))
        return best

    target = 4 * limit
    while True:
        while cost() < target and bound()[1]:
            used[bound()[1]] += 1
        wanted = F.lit(False)
        for t in terms:
            wanted = wanted | ((F.col("term") == t) & (F.col("level") >= blocks[t][used[t] - 1][0]))
        score = F.round(sum((F.col(f"_f{i}") / (F.col(f"_f{i}") + F.lit(K1)) for i in range(1, len(terms))),
                            F.col("_f0") / (F.col("_f0") + F.lit(K1))) / F.lit(float(len(terms))), 6)
        whole = postings.filter(wanted).groupBy(*IX.PAGE_KEY).agg(
            *[F.sum(F.when(F.col("term") == t, F.col("tf"))).alias(f"_f{i}") for i, t in enumerate(terms)]).dropna(
            subset=[f"_f{i}" for i in range(len(terms))])
        first = whole.select("entity_id", "page", score.alias("score")).orderBy(
            F.col("score").desc(), F.col("entity_id"), F.col("page")).limit(limit)
        rows = first.collect()  # bounded by ``limit``
        highest, open_term = bound()
        if open_term is None or len(rows) == limit and rows[-1]["score"] > highest:
            return Ranked(spark.createDataFrame([tuple(r) for r in rows], schema), cost(), total)
        target = 4 * cost()
